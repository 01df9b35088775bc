"""Retrieval operators against brute force, context and routing rules."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casework.functions.hooks import register_reranker, register_tokeniser
from casework.operators import context, evaluation, filters, retrieval, routing, vector_index
from casework.sources.files import read_eval_set, table
from tests.conftest import SF


@pytest.fixture(scope="module")
def vectors(spark):
    df = table(spark, SF, "embeddings")
    return df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def brute(vectors, queries, k):
    rows = vectors.collect()
    m = np.array([r.vector for r in rows], dtype=float)
    ids = np.array([r.id for r in rows])
    out = {}
    for r in queries.collect():
        score = np.round(m @ np.array(r.vector, dtype=float), 5)
        out[r.q_id] = [int(ids[i]) for i in np.lexsort((ids, -score))[:k]]
    return out


def ranked(df):
    out = {}
    for r in df.orderBy("q_id", "rank").collect():
        out.setdefault(r.q_id, []).append(r.id)
    return out


def test_knn_broadcast_and_blocked_equal_brute_force(spark, vectors):
    queries = vectors.withColumnRenamed("id", "q_id").limit(60)
    want = brute(vectors, queries, 6)
    assert ranked(retrieval.knn_exact(queries, vectors, k=2, over=3)) == want
    # A bound of one question forces the blocked form.
    assert ranked(retrieval.knn_exact(queries, vectors, k=2, over=3, query_floats=64, block_rows=50)) == want


def test_knn_keeps_ties_by_id(spark):
    corpus = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(40)], "id long, vector array<float>").repartition(4)
    query = spark.createDataFrame([(1, [1.0, 0.0])], "q_id long, vector array<float>")
    assert ranked(retrieval.knn_exact(query, corpus, k=3, over=1)) == {1: [0, 1, 2]}


def test_few_ties_leave_a_task(spark):
    best = retrieval._Best(2, 3)
    for at in range(0, 20_000, 5_000):
        ids = np.arange(at, at + 5_000)[::-1]
        best.add(np.repeat([0, 1], 5_000), pa.array(np.tile(ids, 2)), np.ones(10_000))
    out = best.table(pa.array([7, 8]), pa.schema([("q_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]))
    assert out.to_pydict() == {"q_id": [7] * 3 + [8] * 3, "id": [0, 1, 2] * 2, "score": [1.0] * 6}


def test_approximate_blocks_equal_broadcast(spark, vectors, tmp_path):
    queries = vectors.withColumnRenamed("id", "q_id").limit(60)
    path = vector_index.build(vectors, str(tmp_path / "index"), 8)
    want = ranked(vector_index.search(queries, path, k=5, probes=2))
    got = ranked(vector_index.search(queries, path, k=5, probes=2, query_floats=64, block_rows=20))
    assert got == want != ranked(retrieval.knn_exact(queries, vectors, k=5, over=1))
    assert ranked(vector_index.search(queries, path, k=5, probes=8)) == ranked(retrieval.knn_exact(queries, vectors, k=5, over=1))


def test_unprobed_lists_are_not_read(spark, vectors, tmp_path):
    path = vector_index.build(vectors.where("id % 2 = 0"), str(tmp_path / "index"), 16)
    before = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "index" / "lists").glob("list=*")}
    vector_index.append(vectors.where("id % 2 = 1"), path)
    after = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "index" / "lists").glob("list=*")}
    assert len(before) == 16 and all(after[k] >= n for k, n in before.items())
    one = vectors.withColumnRenamed("id", "q_id").limit(1)
    found = vector_index.search(one, path, k=5, probes=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(list" in plan or "PartitionFilters: [list" in plan
    probed = vector_index._nearest(np.asarray([one.first().vector]), vector_index.centroids_of(spark, path), 2)[0]
    files = vector_index.stored_lists(spark, path, probed).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("list=")[1].split("/")[0] for r in files} == {str(x) for x in probed}
    assert spark.read.parquet(f"{path}/lists").count() == vectors.count()


def test_an_index_of_few_or_equal_vectors(spark, tmp_path):
    one = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, vector array<float>")
    query = spark.createDataFrame([(7, [1.0, 0.0])], "q_id long, vector array<float>")
    assert ranked(vector_index.search(query, vector_index.build(one, str(tmp_path / "one")), k=3)) == {7: [1]}
    same = spark.createDataFrame([(i, [0.0, 1.0]) for i in range(50)], "id long, vector array<float>")
    path = vector_index.build(same, str(tmp_path / "same"), 4)
    assert ranked(vector_index.search(query, path, k=3, probes=4)) == {7: [0, 1, 2]}
    assert vector_index.search(query.limit(0), path).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        vector_index.build(one.where("id = 2"), str(tmp_path / "none"))


def test_knn_rejects_mixed_dimensions(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "id long, vector array<float>")
    query = spark.createDataFrame([(1, [1.0, 0.0])], "q_id long, vector array<float>")
    with pytest.raises(Exception, match="elements"):
        retrieval.knn_exact(query, corpus).collect()


def test_approximate_recall(spark, vectors, tmp_path):
    queries = vectors.withColumnRenamed("id", "q_id").limit(50)
    exact = ranked(retrieval.knn_exact(queries, vectors, k=5, over=1))
    near = ranked(vector_index.search(queries, vector_index.build(vectors, str(tmp_path / "index"), 16), k=5, probes=10))
    hits = sum(len(set(exact[q]) & set(near.get(q, []))) for q in exact)
    assert hits / sum(map(len, exact.values())) >= 0.9


def test_bm25_against_the_formula(spark):
    texts = {1: "late fee late payment", 2: "payment terms and conditions", 3: "nothing here", 4: "late late late arrival"}
    chunks = spark.createDataFrame(list(texts.items()), "id long, content string")
    queries = spark.createDataFrame([(9, "late payment")], "q_id long, text string")
    tokens = {i: [t for t in re.split("[^a-z]+", x.lower()) if len(t) > 2] for i, x in texts.items()}
    avg = sum(map(len, tokens.values())) / len(tokens)
    want = {}
    for i, ts in tokens.items():
        score = 0.0
        for q in ("late", "payment"):
            df = sum(q in other for other in tokens.values())
            tf = ts.count(q)
            score += math.log(1 + (4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ts) / avg))
        if score:
            want[i] = round(score, 6)
    got = {r.id: r.score for r in retrieval.bm25(queries, retrieval.keyword_index(chunks)).collect()}
    assert got == pytest.approx(want)


def test_keyword_tasks_follow_the_pairs(spark):
    """A task adds up a bounded number of question and chunk pairs, however many there are."""
    chunks = spark.range(20_000).selectExpr("id", "concat('late payment ', id) as content")
    queries = spark.range(1000).selectExpr("id as q_id", "'late payment' as text")
    found = retrieval.bm25(queries, retrieval.keyword_index(chunks))
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert dealt and min(dealt) >= 20


def test_rrf_and_rerank(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "q_id long, id long, rank long")
    b = spark.createDataFrame([(1, 11, 1)], "q_id long, id long, rank long")
    got = {r.id: r.fused for r in retrieval.rrf([a, b]).collect()}
    assert got == pytest.approx({10: 1 / 61, 11: 1 / 62 + 1 / 61}, abs=1e-8)
    pairs = spark.createDataFrame([(1, 10, "late fee", "the fee"), (1, 11, "late fee", "late fee list")], "q_id long, id long, text string, content string")
    assert [(r.id, r.reranker_score) for r in retrieval.rerank(pairs).orderBy("rank").collect()] == [(11, 4.0), (10, 2.0)]
    custom = retrieval.rerank(pairs, register_reranker(lambda q, t: 9.0 if "list" not in t else 1.0)).orderBy("rank").collect()
    assert [(r.id, r.reranker_score) for r in custom] == [(10, 4.0), (11, 1.0)]


def test_hybrid_applies_audience_before_ranking(spark):
    rows = [(1, "late fee text", [1.0, 0.0], "internal", "a"), (2, "late fee other", [0.8, 0.6], "customer", "a"), (3, "unrelated words", [0.0, 1.0], "customer", "b")]
    chunks = spark.createDataFrame(rows, "id long, content string, vector array<float>, audience string, category string")
    queries = spark.createDataFrame([(1, "late fee", [1.0, 0.0])], "q_id long, text string, vector array<float>")
    out = retrieval.hybrid_search(queries, chunks, k=5, threshold=0.75).collect()
    assert [r.id for r in out] == [2]
    assert retrieval.hybrid_search(queries, chunks, k=5, category="b").collect()[0].id == 3


@pytest.mark.parametrize("score,band", [(0.85, "High"), (0.849, "Medium"), (0.70, "Medium"), (0.699, "Escalated"), (None, "Escalated")])
def test_band_borders(spark, score, band):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(routing.confidence_band("s").alias("b")).first().b == band


def test_threshold_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(1, 0.91), (2, 0.72), (3, 0.55), (4, None)], "id int, s double")
    assert [r.id for r in filters.score_filter(df, "s", filters.RERANK_THRESHOLD).collect()] == [1, 2]


def test_context_defaults_and_empty_questions(spark):
    questions = spark.createDataFrame([(1,), (2,)], "q_id long")
    hits = spark.createDataFrame(
        [(1, 1, 0.9, None, "first text", None, None), (1, 2, 0.95, "Second", "second text", "u", 3)],
        "q_id long, rank long, reranker_score double, title string, content string, source_url string, chunk_index int",
    )
    got = {r.q_id: r for r in context.format_context(questions, hits, style="title").collect()}
    assert got[1].context == "[Document 1: Second (chunk 3)]\nsecond text\n\n---\n\n[Document 2: Unknown (chunk 0)]\nfirst text"
    assert [tuple(c) for c in got[1].citations] == [("Second", "u", 3), ("Unknown", "", 0)]
    assert got[2].context == "" and got[2].citations == []
    named = hits.withColumns({"source_document": F.col("title"), "effective_date": F.lit("2026-01-01"), "category": F.lit("c")})
    by_source = {r.q_id: r.context for r in context.format_context(questions, named).collect()}
    assert by_source[2] == context.NO_DOCUMENTS


def test_eval_set_end_to_end(spark):
    cases = read_eval_set(spark, "tests/fixtures/eval_set.json").withColumn("case_id", F.monotonically_increasing_id())
    reason = routing.escalation("query")
    answers = cases.select(
        "case_id",
        F.when(reason != "", "passing you on").otherwise(F.concat("expected_answer_contains", F.lit(" Source: x"))).alias("answer"),
        F.array().cast("array<string>").alias("sources"),
        F.array(F.upper("expected_source")).alias("retrieved"),
        (reason != "").alias("escalation_required"),
        F.lit("high").alias("confidence"),
        F.lit(10.0).alias("latency_ms"),
        F.lit("").alias("error"),
    )
    report = evaluation.eval_report(evaluation.eval_cases(cases, answers)).first()
    assert (report.total_cases, report.passed, report.escalation_accuracy) == (20, 16, 1.0)
    waived = evaluation.eval_report(evaluation.eval_cases(cases, answers, exempt_escalated=True)).first()
    assert waived.passed == 20
    empty = evaluation.eval_report(evaluation.eval_cases(cases.limit(0), answers)).first()
    assert (empty.total_cases, empty.pass_rate) == (0, 0.0)


def test_answer_confidence(spark):
    answers = spark.createDataFrame([(1, "yes"), (2, "yes"), (3, "I cannot find it"), (4, "yes")], "q_id long, answer string")
    hits = spark.createDataFrame([(1, s) for s in (2.1, 2.5, 3.0)] + [(2, 2.0)] + [(3, 3.0)] * 3, "q_id long, reranker_score double")
    got = {r.q_id: r.confidence for r in routing.answer_confidence(answers, hits).collect()}
    assert got == {1: "high", 2: "medium", 3: "low", 4: "low"}


def test_hooks_take_batches_and_keep_nulls(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "c")], "id int, t string").coalesce(1)
    calls = spark.sparkContext.accumulator(0)

    def split(texts):
        calls.add(1)
        return [t.split() for t in texts]

    one = {r.id: r.w for r in df.select("id", register_tokeniser(str.split)("t").alias("w")).collect()}
    many = {r.id: r.w for r in df.select("id", register_tokeniser(split, batched=True)("t").alias("w")).collect()}
    assert one == many == {1: ["a", "b"], 2: None, 3: [], 4: ["c"]} and calls.value == 1
    score = register_reranker(lambda pairs: [len(t) for _, t in pairs], batched=True)
    assert [r.s for r in df.select("id", score(F.lit("q"), F.col("t")).alias("s")).orderBy("id").collect()] == [3.0, None, 0.0, 1.0]
    with pytest.raises(Exception, match="results for"):
        df.select(register_tokeniser(lambda texts: [], batched=True)("t")).collect()


def test_tokeniser_hook_gets_bounded_texts(spark):
    """However many texts an Arrow batch has, the tokens of few are held at a time."""
    df = spark.range(50, numPartitions=1).selectExpr("id", "if(id % 7 = 3, null, repeat('word ', 20000)) as t")
    sizes = register_tokeniser(lambda texts: [[str(sum(map(len, texts)))] for _ in texts], batched=True)
    got = df.select("id", sizes("t").alias("w")).collect()
    assert [r.id for r in got if r.w is None] == [i for i in range(50) if i % 7 == 3]
    assert max(int(r.w[0]) for r in got if r.w) <= 1 << 20
