"""Stored inverted lists: an index of unit vectors on disk, and approximate search over it.

An index is a folder with two tables. ``centroids`` has one vector per list. ``lists`` holds every
vector under the list of its nearest centroid and is partitioned by list, so a search opens only the
folders of the lists that some question probes; the others are pruned before the scan. New vectors
are appended to their lists without touching what is there or training again.

Lists are written by a rebalancing shuffle, which cuts a crowded list into several files and tasks.
Only centroids (at most ``MAX_LISTS``) and the questions of a bounded set reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.operators.retrieval import BLOCK_ROWS, MAX_BROADCAST_QUESTIONS, QUERY_FLOATS, SCORE_CELLS, _arrow, _Best, _knn_blocked, _matrix, _top
from casework.session import materialise

#: Lists an index may have, and rows per list that centroids are trained on.
MAX_LISTS, TRAIN_ROWS = 16_384, 256


def list_count(rows: int) -> int:
    """Lists for an index of so many rows: about their square root."""
    return max(1, min(MAX_LISTS, math.isqrt(max(1, rows))))


def train_centroids(corpus: DataFrame, lists: int, vector: str = "vector", id: str = "id", seed: int = 42) -> np.ndarray:
    """Centroids of at most ``lists`` lists from about ``TRAIN_ROWS`` rows per list, chosen by a hash of the id."""
    known = corpus.where(F.col(vector).isNotNull())
    rows = known.count()
    if not rows:
        raise ValueError("an index needs at least one vector to train on")
    share = min(1.0, TRAIN_ROWS * lists / rows)
    kept = known.where(F.pmod(F.xxhash64(id, F.lit(seed)), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30))))
    data = materialise(kept.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")), "centroid-sample")
    if lists < 2 or data.limit(2).count() < 2:
        return np.asarray([known.first()[vector]], dtype=np.float64)
    return np.asarray(KMeans(k=lists, seed=seed, maxIter=10).fit(data).clusterCenters(), dtype=np.float64)


def _nearest(rows: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the ``probes`` nearest centroids of each row, nearest first; a slice of rows at a time."""
    probes, half = min(probes, len(centroids)), (centroids**2).sum(1) / 2
    step, out = max(1, SCORE_CELLS // len(centroids)), [np.zeros((0, probes), dtype=np.int32)]
    for at in range(0, len(rows), step):
        distance = half - rows[at : at + step] @ centroids.T
        out.append(np.argsort(distance, axis=1, kind="stable")[:, :probes].astype(np.int32))
    return np.concatenate(out)


def _listed(corpus: DataFrame, centroids: np.ndarray, id: str, vector: str) -> DataFrame:
    """``id, vector, list`` with the nearest list of every vector."""
    slim = corpus.select(F.col(id).alias("id"), F.col(vector).cast("array<float>").alias("vector")).where("vector is not null")
    shared, dim = corpus.sparkSession.sparkContext.broadcast(centroids), centroids.shape[1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if batch.num_rows:
                near = _nearest(_matrix(batch.column(1), dim), shared.value, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near)], names=["id", "vector", "list"])

    return slim.mapInArrow(run, T.StructType([*slim.schema.fields, T.StructField("list", T.IntegerType())]))


def build(corpus: DataFrame, path: str, lists: int | None = None, *, id: str = "id", vector: str = "vector", seed: int = 42) -> str:
    """Train centroids and write the index of ``corpus`` to the new folder ``path``."""
    centroids = train_centroids(corpus, lists or list_count(corpus.count()), vector, id, seed)
    spark = corpus.sparkSession
    rows = [(i, c.tolist()) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "list int, centroid array<double>").coalesce(1).write.parquet(f"{path}/centroids")
    append(corpus, path, id=id, vector=vector)
    return path


def append(corpus: DataFrame, path: str, *, id: str = "id", vector: str = "vector") -> None:
    """Add the vectors of ``corpus`` (new ids) to their lists."""
    listed = _listed(corpus, centroids_of(corpus.sparkSession, path), id, vector)
    listed.hint("rebalance", "list").write.partitionBy("list").mode("append").parquet(f"{path}/lists")


def centroids_of(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/centroids").limit(MAX_LISTS + 1).collect()
    if len(rows) > MAX_LISTS:
        raise ValueError("too many lists")
    return np.asarray([r.centroid for r in sorted(rows, key=lambda r: r.list)], dtype=np.float64)


def stored_lists(spark: SparkSession, path: str, lists: np.ndarray) -> DataFrame:
    """``id, vector, list`` of the given lists; other folders are pruned."""
    return spark.read.parquet(f"{path}/lists").where(F.col("list").isin([int(x) for x in lists]))


def _scan(listed: DataFrame, matrix: np.ndarray, names: pa.Array, probed: np.ndarray, k: int, out: T.StructType) -> DataFrame:
    """Score stored rows where they lie against the questions that probe their list."""
    members: dict[int, list[int]] = {}
    for i, lists in enumerate(probed):
        for x in lists:
            members.setdefault(int(x), []).append(i)
    shared = listed.sparkSession.sparkContext.broadcast((matrix, {x: np.asarray(v) for x, v in members.items()}, names))
    arrow = pa.schema([("q_id", names.type), ("id", _arrow(out["id"].dataType)), ("score", pa.float64())])
    dim = matrix.shape[1]

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by_list, q_ids = shared.value
        top = _Best(len(asked), k)
        for batch in parts:
            if not batch.num_rows:
                continue
            vectors, keys = _matrix(batch.column("vector"), dim), batch.column("id")
            lists = batch.column("list").to_numpy(zero_copy_only=False)
            for x in np.unique(lists):
                who, here = by_list[int(x)], np.flatnonzero(lists == x)
                low = top.floor[who]
                for q, row, scores in _top(vectors[here], asked[who], k, low):
                    top.add(who[q], keys.take(pa.array(here[row])), scores)
                top.floor[who] = low
        yield from top.table(q_ids, arrow).to_batches()

    return listed.select("id", "vector", "list").mapInArrow(score, out)


def search(
    queries: DataFrame, path: str, k: int = 5, probes: int = 8, *, query_id: str = "q_id", vector: str = "vector", query_floats: int = QUERY_FLOATS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Approximate cosine neighbours from a stored index: ``(q_id, id, score, rank)``.

    Each question is scored against its ``probes`` nearest lists only; with all lists probed the result is
    exact. A question set beyond the bound ``query_floats`` is probed in tasks and meets
    the lists in blocks, with the same result. Raise ``probes`` for recall.
    """
    spark = queries.sparkSession
    q = queries.select(F.col(query_id).alias("q_id"), F.col(vector).alias("vector")).where("vector is not null")
    centroids = centroids_of(spark, path)
    dim = centroids.shape[1]
    id_type = spark.read.parquet(f"{path}/lists").schema["id"]
    out = T.StructType([q.schema["q_id"], T.StructField("id", id_type.dataType), T.StructField("score", T.DoubleType())])
    bound = max(1, min(MAX_BROADCAST_QUESTIONS, query_floats // dim))
    asked = q.limit(bound + 1).toArrow()
    if not asked.num_rows:
        return spark.createDataFrame([], out).withColumn("rank", F.lit(1).cast("long"))
    if asked.num_rows <= bound:
        matrix = _matrix(asked.column("vector"), dim)
        probed = _nearest(matrix, centroids, probes)
        names = asked.column("q_id").combine_chunks()
        scored = _scan(stored_lists(spark, path, np.unique(probed)), matrix, names, probed, k, out)
    else:
        met = materialise(_probes(q, centroids, probes), "probes")
        lists = np.array([r.list for r in met.select("list").distinct().collect()])  # at most MAX_LISTS
        scored = _knn_blocked(met, stored_lists(spark, path, lists), dim, k, out, block_rows, by=["list"])
    best = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "id")
    return scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def _probes(q: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``q_id, vector, list``: one row per question and probed list."""
    shared, dim = q.sparkSession.sparkContext.broadcast(centroids), centroids.shape[1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if batch.num_rows:
                near = _nearest(_matrix(batch.column(1), dim), shared.value, probes)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(near), pa.list_(pa.int32()))], names=["q_id", "vector", "lists"])

    lists = T.StructField("lists", T.ArrayType(T.IntegerType()))
    return q.mapInArrow(run, T.StructType([*q.schema.fields, lists])).select("q_id", "vector", F.explode("lists").alias("list"))
