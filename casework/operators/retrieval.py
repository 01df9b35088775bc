"""Search over a table of questions: vector neighbours, keyword ranking, fusion, re-ranking.

All operators take many questions at once. Only candidates, at most ``k`` per question and
task, ever leave a task; the corpus itself is never crossed with the questions row by row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions.text import terms
from casework.operators.filters import audience_filter, score_filter
from casework.session import BROADCAST_ROWS, is_small

# Fixed values.
K1, B = 1.2, 0.75
RRF_CONSTANT = 60
RERANK_MAX = 4.0
OVERFETCH = 3
SCORE_DIGITS = 5

#: Floats of the question matrix that may be sent to every task (64 MB of doubles).
QUERY_FLOATS = 8_000_000
#: Questions that may be sent to every task, whatever their dimension.
MAX_BROADCAST_QUESTIONS = 20_000
#: Cells of one slice of the score matrix (32 MB).
SCORE_CELLS = 4_000_000
#: Candidates a task holds before it cuts them to the best (or twice what it must keep).
HELD_ROWS = 1_000_000
#: Question and chunk pairs that one task of the keyword ranking may add up, and the most tasks it is dealt to.
TASK_PAIRS, MOST_TASKS = 1_000_000, 10_000
#: Rows of one block in the blocked form.
BLOCK_ROWS = 20_000


def _top(matrix: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
    """Yield (question numbers, row numbers, scores) that may belong to the top k, ties included.

    ``floor`` holds, per question, a score known to be reached by k rows already and is raised.
    Rows are scored in slices, so the score matrix stays small whatever the number of questions.
    """
    step = max(4 * k, SCORE_CELLS // len(queries))
    for start in range(0, len(matrix), step):
        scores = np.round(matrix[start : start + step] @ queries.T, SCORE_DIGITS)
        if len(scores) >= k:
            kth = np.partition(scores, len(scores) - k, axis=0)[len(scores) - k]
            np.maximum(floor, kth, out=floor)
        asked, rows = np.nonzero((scores >= floor).T)
        yield asked, rows + start, scores[rows, asked]


class _Best:
    """The ``k`` best (score, smaller id first) per question seen by one task."""

    def __init__(self, questions: int, k: int):
        self.k, self.floor = k, np.full(questions, -np.inf)
        self.held, self.rows, self.most = [], 0, max(HELD_ROWS, 2 * questions * k)

    def add(self, asked: np.ndarray, ids: pa.Array, scores: np.ndarray) -> None:
        self.held.append(pd.DataFrame({"asked": asked, "id": ids.to_pandas(), "score": scores}))
        self.rows += len(asked)
        if self.rows > self.most:
            self.cut()

    def cut(self) -> pd.DataFrame:
        every = pd.concat(self.held) if self.held else pd.DataFrame({"asked": [], "id": [], "score": []})
        best = every.sort_values(["asked", "score", "id"], ascending=[True, False, True]).groupby("asked").head(self.k)
        self.held, self.rows = [best], len(best)
        return best

    def table(self, names: pa.Array, schema: pa.Schema) -> pa.Table:
        if not self.rows:
            return schema.empty_table()
        best = self.cut()
        asked = pa.array(best["asked"].to_numpy().astype(np.int64))
        return pa.Table.from_arrays([names.take(asked), pa.array(best["id"], schema.field("id").type), pa.array(best["score"].to_numpy())], schema=schema)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not pc.all(pc.equal(pc.list_value_length(column), dim)).as_py():
        raise ValueError(f"vectors must all have {dim} elements")
    return flat.astype(np.float64).reshape(len(column), dim)


def knn_exact(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    over: int = OVERFETCH,
    *,
    query_id: str = "q_id",
    id: str = "id",
    vector: str = "vector",
    query_floats: int = QUERY_FLOATS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact cosine neighbours of unit vectors: ``(q_id, id, score, rank)``, ``k * over`` per question.

    Filter the corpus first (:func:`casework.operators.filters.audience_filter`). Scores are
    rounded to 5 digits before ranking and ties go to the smaller id. Two physical forms:

    * the question matrix fits the bound ``query_floats`` (checked): it is broadcast and the
      corpus is scored where it lies, one matrix product per Arrow batch;
    * otherwise questions and corpus are hashed into blocks and every pair of blocks is one
      small grouped task, so neither side has to fit anywhere.
    """
    want = k * over
    q = queries.select(F.col(query_id).alias("q_id"), F.col(vector).alias("vector")).where("vector is not null")
    c = corpus.select(F.col(id).alias("id"), F.col(vector).alias("vector")).where("vector is not null")
    id_type, q_type = c.schema["id"].dataType, q.schema["q_id"].dataType
    first = q.select(F.size("vector").alias("d")).limit(1).collect()
    out = T.StructType([T.StructField("q_id", q_type), T.StructField("id", id_type), T.StructField("score", T.DoubleType())])
    if not first:
        return c.sparkSession.createDataFrame([], out).withColumn("rank", F.lit(1).cast("long"))
    dim = first[0].d
    bound = max(1, min(MAX_BROADCAST_QUESTIONS, query_floats // dim))
    asked = q.limit(bound + 1).toArrow()
    if asked.num_rows <= bound:
        scored = _knn_broadcast(c, asked, dim, want, out)
    else:
        scored = _knn_blocked(q, c, dim, want, out, block_rows)
    best = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "id")
    return scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= want)


def _knn_broadcast(corpus: DataFrame, asked: pa.Table, dim: int, want: int, out: T.StructType) -> DataFrame:
    sc = corpus.sparkSession.sparkContext
    shared = sc.broadcast((_matrix(asked.column("vector"), dim), asked.column("q_id").combine_chunks()))
    arrow = pa.schema([("q_id", _arrow(out["q_id"].dataType)), ("id", _arrow(out["id"].dataType)), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, names = shared.value
        best = _Best(len(matrix), want)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("id")
            for asked, rows, scores in _top(_matrix(batch.column("vector"), dim), matrix, want, best.floor):
                best.add(asked, keys.take(pa.array(rows)), scores)
        yield from best.table(names, arrow).to_batches()

    return corpus.mapInArrow(score, out)


def _knn_blocked(q, c, dim, want, out, block_rows, by: Sequence[str] = ()) -> DataFrame:
    """Both sides in blocks of about ``block_rows``, met within equal ``by`` columns only."""
    most = lambda df: df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    q_blocks, c_blocks = (max(1, math.ceil(most(df) / block_rows)) for df in (q, c))

    def block(col: str, n: int) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

    left = q.withColumn("qb", block("q_id", q_blocks)).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    right = c.withColumn("cb", block("id", c_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    arrow = pa.schema([("q_id", _arrow(out["q_id"].dataType)), ("id", _arrow(out["id"].dataType)), ("score", pa.float64())])

    def score(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return arrow.empty_table()
        matrix = _matrix(a.column("vector"), dim)
        best = _Best(len(matrix), want)
        names, keys = a.column("q_id").combine_chunks(), b.column("id").combine_chunks()
        for asked, rows, scores in _top(_matrix(b.column("vector"), dim), matrix, want, best.floor):
            best.add(asked, keys.take(pa.array(rows)), scores)
        return best.table(names, arrow)

    return left.groupBy(*by, "qb", "cb").cogroup(right.groupBy(*by, "qb", "cb")).applyInArrow(score, out)


def _arrow(t: T.DataType) -> pa.DataType:
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string()}[type(t)]


def keyword_index(
    chunks: DataFrame, id: str = "id", text: str = "content", keep: Sequence[str] = (), tokenise: Callable[[Column], Column] = terms
) -> DataFrame:
    """Distinct terms with their counts (``postings``) and the length per chunk.

    Built inside each row, without a shuffle: terms are sorted and a count is the distance
    between two run starts. Write it once as a table and search it many times. ``keep`` names
    tag columns (audience, category) that searches filter on.
    """
    n = F.size("__s")
    at = lambda i: F.element_at(F.col("__s"), i)
    starts = F.when(n > 0, F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (at(i) != at(F.greatest(i - 1, F.lit(1)))))).otherwise(
        F.array().cast("array<int>")
    )
    counted = F.transform(
        "__i", lambda p, j: F.struct(at(p).alias("term"), (F.coalesce(F.get(F.col("__i"), j + 1), n + 1) - p).alias("tf"))
    )
    split = chunks.select(F.col(id).alias("id"), *keep, F.sort_array(tokenise(F.col(text))).alias("__s"))
    return split.withColumn("__i", starts).select("id", *keep, n.alias("length"), counted.alias("postings"))


def bm25(
    queries: DataFrame,
    index: DataFrame,
    k: int = 10,
    *,
    query_id: str = "q_id",
    text: str = "text",
    k1: float = K1,
    b: float = B,
    tokenise: Callable[[Column], Column] = terms,
) -> DataFrame:
    """Keyword ranking: ``(q_id, id, score, rank)`` with scores rounded to 6 digits.

    Only postings of question terms leave the scan of a :func:`keyword_index`. They are hashed by
    chunk id, which is even however common a term is; the questions' terms are a counted,
    broadcast side, so scores add up without a further shuffle, and the rank cut starts in every
    task. The number of tasks follows from the counts of questions and chunks, so that the pairs a task
    adds up stay bounded.
    """
    asked = queries.select(F.col(query_id).alias("q_id"), F.explode(F.array_distinct(tokenise(F.col(text)))).alias("term"))
    stats = index.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg_length"))
    few = is_small(asked)
    vocabulary = asked.select("term").distinct()
    vocabulary = F.broadcast(vocabulary) if few else vocabulary
    pairs = index.count() * asked.select("q_id").distinct().count()
    tasks = min(MOST_TASKS, max(index.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / TASK_PAIRS)))
    postings = (
        index.select("id", "length", F.explode("postings").alias("p"))
        .select("id", "length", "p.term", "p.tf")
        .join(vocabulary, "term", "left_semi")
        .repartition(tasks, "id")
    )
    n, avg_length = stats.select("n").scalar(), stats.select("avg_length").scalar()
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = df.select("term", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    # At most one row per asked term, so the count of ``asked`` bounds this side too.
    weighted = asked.join(weights, "term")
    weighted = F.broadcast(weighted) if few else weighted
    tf = F.col("tf")
    part = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / avg_length))
    scored = (
        postings.join(weighted, "term")
        .groupBy("q_id", "id")
        .agg(F.round(F.sum(part), 6).alias("score"))
    )
    best = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "id")
    return scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def rrf(runs: Sequence[DataFrame], c: int = RRF_CONSTANT) -> DataFrame:
    """Reciprocal rank fusion of rankings ``(q_id, id, rank)``: sum of ``1 / (c + rank)``.

    A union with one aggregation; an item absent from a ranking adds nothing.
    """
    union = runs[0].select("q_id", "id", "rank")
    for run in runs[1:]:
        union = union.unionByName(run.select("q_id", "id", "rank"))
    return union.groupBy("q_id", "id").agg(F.round(F.sum(1 / (c + F.col("rank"))), 8).alias("fused"))


def term_share(question: Column, text: Column) -> Column:
    """Default re-ranker: 4 × share of the question's distinct terms found in the text."""
    asked = F.array_distinct(terms(question))
    found = F.size(F.array_intersect(asked, F.array_distinct(terms(text))))
    return F.coalesce(F.try_divide(found * RERANK_MAX, F.size(asked)), F.lit(0.0))


def rerank(
    candidates: DataFrame,
    scorer: Callable[[Column, Column], Column] = term_share,
    question: str = "text",
    content: str = "content",
) -> DataFrame:
    """Score candidates between 0 and 4 and order them: ``reranker_score``, ``rank``."""
    scored = candidates.withColumn("reranker_score", F.round(scorer(F.col(question), F.col(content)), 6))
    best = Window.partitionBy("q_id").orderBy(F.col("reranker_score").desc(), "id")
    return scored.withColumn("rank", F.row_number().over(best).cast("long"))


def hybrid_search(
    queries: DataFrame,
    chunks: DataFrame,
    *,
    audience: str = "customer",
    category: str | None = None,
    k: int = 5,
    over: int = OVERFETCH,
    scorer: Callable[[Column, Column], Column] = term_share,
    threshold_on: str = "cosine",
    threshold: float | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Filter → vector and keyword candidates → fusion → re-rank → top k → threshold.

    ``queries`` has ``q_id, text, vector``; ``chunks`` has ``id, content, vector, audience,
    category``. The threshold names its score column (``cosine``, ``fused`` or
    ``reranker_score``); ``None`` keeps all top k. ``index`` is a stored :func:`keyword_index`
    with the tag columns; without it texts are split on the fly.
    """
    allowed = audience_filter(chunks, audience, category)
    near = knn_exact(queries, allowed, k, over)
    stored = keyword_index(allowed) if index is None else audience_filter(index, audience, category)
    found = bm25(queries, stored, k * over)
    fused = rrf([near, found])
    cosine = near.select("q_id", "id", F.col("score").alias("cosine"))
    candidates = fused.join(cosine, ["q_id", "id"], "left")
    # Text joins the few candidates only; the vector column stays out of this branch.
    rest = [c for c in allowed.columns if c != "vector"]
    # Each question has at most 2 * k * over candidates, so a count of the questions bounds both sides.
    few = is_small(queries, BROADCAST_ROWS // (2 * k * over))
    asked = queries.select("q_id", F.col("text"))
    hint = F.broadcast if few else (lambda df: df)
    ranked = rerank(allowed.select(*rest).join(hint(candidates), "id").join(hint(asked), "q_id"), scorer)
    ranked = ranked.where(F.col("rank") <= k)
    return ranked if threshold is None else score_filter(ranked, threshold_on, threshold)

