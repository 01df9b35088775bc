"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately (k-means on a bounded sample), so a cell is a
pair of centroids. A query walks the pairs in order of summed distance with a heap until the
visited cells hold ``SHARE`` of the index, and the entries of these cells are reranked by their
exact inner product in double precision. Every row is indexed; equal vectors are one entry that
keeps its smallest ids, which are the only ones that can be returned.

Entries are stored as blocks of cells with one first-half centroid, cut into parts of about
``BLOCK`` rows; queries as blocks of about ``QUERIES``. A pair of blocks is joined only where some
query of the one visits a cell of the other, and gives at most k + 1 rows per query. So no task
holds more than two blocks, and many equal vectors or a full cell make more parts.

Defined results: vectors that are null, zero, hold null or non-finite values, or have another
length than the commonest take no part, nor do rows without an id; rows with equal id and vector
are one, and of several vectors under one id the first in byte order takes part; ties go to the smaller id; a query with fewer than k candidates gets all; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casework.llm.common import materialise

#: Rows the codebooks are fitted on, at most: those with the smallest hash of their id.
SAMPLE = 20_000
CENTROIDS = 32
ROUNDS = 12
#: Share of the index that a query visits; never fewer entries than it must return.
SHARE = 0.6
BLOCK, QUERIES = 4096, 512


def _kmeans(points: np.ndarray, k: int) -> np.ndarray:
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=k)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float) -> list[int]:
    """Cells by summed distance (``first[i] + second[j]``) until ``counts`` of them reach ``enough``."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b, width = first[one].tolist(), second[two].tolist(), len(second)
    one, two = one.tolist(), two.tolist()
    heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = one[i] * width + two[j]
        out.append(cell)
        held += counts[cell]
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, width)


def valid_vectors(df: DataFrame, id: str, vector: str) -> DataFrame:
    """Written rows ``id, vec`` (doubles as bytes) of the vectors that take part."""
    slim = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    slim = slim.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [(np.asarray(v, dtype="<f8") + 0.0).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["id", "vec"])

    return materialise(slim.mapInArrow(run, "id long, vec binary"), "vectors")


def search(df: DataFrame, is_query, k: int = 20, id: str = "vec_id", vector: str = "embedding", share: float = SHARE, centroids: int = CENTROIDS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` (a condition on ``id``) holds."""
    rows = valid_vectors(df, id, vector)
    sizes = rows.groupBy(F.length("vec").alias("bytes")).count().orderBy(F.desc("count"), "bytes").limit(1).collect()
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sizes:
        return empty
    width = sizes[0].bytes // 8
    # One vector per id; from here on an id, and the smallest id of a vector, are keys.
    rows = rows.where(F.length("vec") == 8 * width).groupBy("id").agg(F.min("vec").alias("vec"))
    sample = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(SAMPLE).collect()
    points = np.frombuffer(b"".join(bytes(r.vec) for r in sample), dtype="<f8").reshape(-1, width)
    half = max(1, width // 2)
    k_cells = min(centroids, len(points))
    books = [_kmeans(points[:, :half], k_cells), _kmeans(points[:, half:], k_cells) if width > 1 else np.zeros((1, 0))]
    width2 = len(books[1])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), width)
            own = nearest(v[:, :half], books[0]) * width2 + nearest(v[:, half:], books[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=[*batch.schema.names, "cell"])

    # One entry per distinct vector: its smallest k + 1 ids, found before anything is gathered.
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("r") <= k + 1)
    entries = ranked.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("entry"), "vec", "ids")
    entries = materialise(entries.mapInArrow(cells, "entry long, vec binary, ids array<long>, cell int"), "entries")
    counts = np.zeros(k_cells * width2, dtype=np.int64)
    for r in entries.groupBy("cell").count().collect():  # one row per cell
        counts[r.cell] = r["count"]
    total = int(counts.sum())
    parts = np.maximum(1, -(-counts.reshape(k_cells, width2).sum(1) // BLOCK))

    shard = F.expr(f"cell div {width2}")
    part = F.pmod(F.xxhash64("entry"), F.element_at(F.array(*[F.lit(int(p)) for p in parts]), (shard + 1).cast("int")))
    blocks = entries.groupBy(shard.alias("shard"), part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("cell", "entry", "vec"))).alias("es"))

    asked = rows.where(is_query(F.col("id"))).select(F.col("id").alias("query_id"), "vec")
    classes = entries.select("entry", "vec")
    asked = materialise(asked.join(classes, "vec").select("query_id", "entry"), "queries")
    distinct = asked.select("entry").distinct().join(classes, "entry").select(F.col("entry").alias("q"), "vec")
    many = max(1, asked.select("entry").distinct().count() // QUERIES)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enough, held = max(share * total, k + 1), counts.tolist()
        for batch in batches:
            v = _matrix(batch.column(1), width)
            first, second = -(v[:, :half] @ books[0].T), -(v[:, half:] @ books[1].T)
            found = [walk(x, y, held, enough) for x, y in zip(first, second)]
            masks, shards = [], []
            for visited in found:
                mask = np.zeros(len(held), dtype=np.uint8)
                mask[visited] = 1
                masks.append(np.packbits(mask).tobytes())
                shards.append(np.unique(np.asarray(visited) // width2).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(masks, pa.binary()), pa.array(shards, pa.list_(pa.int64()))], names=["q", "vec", "mask", "shards"])

    walked = distinct.mapInArrow(visits, "q long, vec binary, mask binary, shards array<long>").withColumn("group", F.pmod(F.xxhash64("q"), F.lit(many)))
    walked = materialise(walked, "walks")
    groups = walked.groupBy("group").agg(F.collect_list(F.struct("q", "vec", "mask")).alias("qs"))
    meets = walked.select("group", F.explode("shards").alias("shard")).distinct()
    pairs = blocks.join(meets, "shard").join(groups, "group").select("es", "qs")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                es, qs = batch.column(0)[i].values, batch.column(1)[i].values
                cell, entry = es.field("cell").to_numpy(), es.field("entry").to_numpy()
                e, q = _matrix(es.field("vec"), width), _matrix(qs.field("vec"), width)
                masks = np.unpackbits(np.frombuffer(b"".join(qs.field("mask").to_pylist()), dtype=np.uint8).reshape(len(q), -1), axis=1)
                scores = np.full((len(q), len(e)), -np.inf)
                starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                for a, b in zip(starts, np.r_[starts[1:], len(cell)]):
                    at = np.flatnonzero(masks[:, cell[a]])
                    if len(at):
                        scores[at, a:b] = q[at] @ e[a:b].T
                out = [[], [], []]
                names = qs.field("q").to_pylist()
                kth = min(k + 1, len(e))
                limits = np.partition(scores, len(e) - kth, axis=1)[:, len(e) - kth]
                for row, limit in enumerate(limits):
                    # A margin covers the rounding of the matrix product; the exact scores decide.
                    near = np.flatnonzero(scores[row] >= limit - 1e-9 * (1 + abs(limit))) if limit > -np.inf else np.flatnonzero(scores[row] > -np.inf)
                    exact = sorted((-math.fsum(e[j] * q[row]), int(entry[j])) for j in near)[: k + 1]
                    out[0] += [names[row]] * len(exact)
                    out[1] += [x[1] for x in exact]
                    out[2] += [-x[0] for x in exact]
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["q", "entry", "score"])

    best = pairs.mapInArrow(rerank, "q long, entry long, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "entry")
    best = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select("q", "entry", "score")
    spread = best.join(entries.select("entry", "ids"), "entry").select("q", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    spread = materialise(spread.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select("q", "score", "vec_id"), "answers")
    every = asked.join(spread, asked.entry == spread.q).where("vec_id <> query_id").select("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_neighbours(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, lambda id: F.pmod(id, F.lit(20)) == 0)
