"""Target-distribution importance resampling by hashed word n-grams.

Every text is a bag of hashed runs of words. Two arrays of bucket counts, one of the raw corpus and
one of the target texts, give each bucket a gain: the scaled log ratio of its smoothed shares. A
text's weight is the mean gain of its features; a Gumbel number that depends on its id alone turns
the k largest scores into a draw without replacement.

Count arrays have a fixed size and are added up per task before they meet. Scores are written once
to the shared folder; the cut-off is found there by bisection with exact counts, first over the score,
then over the tied ids (and, for repeated rows, over the feature count and the written row). Only
drawn rows are dealt into ranges of the order for their ranks, so no task sees all of them.

Defined results: a null or empty text has no features and weight 0; a null id hashes as the empty
string and ranks after all ids of its score; repeated rows are separate candidates; without target
texts all gains follow from smoothing alone; an empty table gives an empty result; a text is read as a
whole, however long; extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import column_bytes, materialise, table
from casework.llm.ranks import byte_slices, cutoff, numbered

BUCKETS = 10_000
SHARE, LEAST_WORDS, SEED = 25, 20, 7

_SPACED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
#: Words whose hashes are taken at a time.
_STEP = 1 << 18


def words(raw: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters of UTF-8 ``raw``, with A-Z lower-cased."""
    return raw.lower().translate(_SPACED).split()


def buckets(found: list[bytes], size: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket numbers of all words and all pairs of consecutive words."""
    for at in range(0, len(found), _STEP):
        part = found[at : at + _STEP]
        single = list(map(zlib.crc32, part))
        after = found[at + 1 : at + _STEP + 1]
        pairs = list(map(zlib.crc32, after, map(zlib.crc32, repeat(b" "), single)))
        yield np.array(single + pairs, dtype=np.int64) % size


def bucket_counts(texts: DataFrame, text: str = "text", size: int = BUCKETS) -> np.ndarray:
    """Features of all ``texts`` per bucket."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in byte_slices(parts):
            for raw in column_bytes(batch, "text"):
                for found in buckets(words(raw), size):
                    total += np.bincount(found, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "c"])

    slim = texts.select(F.col(text).cast("string").alias("text"))
    out = np.zeros(size, dtype=np.int64)
    for row in slim.mapInArrow(run, "bucket long, c long").groupBy("bucket").agg(F.sum("c").alias("c")).collect():  # at most ``size`` rows
        out[row.bucket] = row.c
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of the smoothed shares of each bucket."""
    size, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    ratio = [(t + 1) * (s_all + size) / ((s + 1) * (t_all + size)) for s, t in zip(raw.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def gumbel(id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel number of an id, from the first 32 bits of a hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weights(docs: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``id, n_words, n_features, weight``."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in byte_slices(parts):
            n_words, n_features, weight = [], [], []
            for raw in column_bytes(batch, "text"):
                found = words(raw)
                n = max(0, 2 * len(found) - 1)
                total = sum(int(gain[b].sum()) for b in buckets(found, len(gain)))
                n_words.append(len(found))
                n_features.append(n)
                weight.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(weight, pa.int64())], names=["id", "n_words", "n_features", "weight"]
            )

    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED, size: int = BUCKETS) -> DataFrame:
    """Per row of ``docs``: ``id, n_words, n_features, weight, score, rank``; drawn rows have a rank.

    Of the rows with at least ``least`` words the ``share`` percent with the highest scores are drawn.
    """
    gain = gains(bucket_counts(docs, text, size), bucket_counts(target, text, size))
    scored = weights(docs, gain, id, text).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    kept = materialise(scored.withColumn("_row", F.monotonically_increasing_id()), "resampling-scores")
    keyed = kept.select("*", (-F.col("score")).alias("_down"), F.isnull("id").cast("int").alias("_none"), F.coalesce("id", F.lit(0)).alias("_id"))
    able = keyed.where(F.col("n_words") >= least)
    keys = ["_down", "_none", "_id", "n_features", "_row"]
    drawn = (F.col("n_words") >= least) & cutoff(able, keys, able.count() * share // 100)
    ranked = numbered(keyed.where(drawn), [F.col(k) for k in keys], "rank", 1)
    columns = ["id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionByName(keyed.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_resampling(spark, sf_dir):
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: CRC-32 is taken byte by byte over the distinct features, with the usual table made from its polynomial.
OP13_SQL = r"""
WITH RECURSIVE bits(i, step, c) AS (
    SELECT i, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE step = 8),
raw AS (
    SELECT 0 AS side, row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
split AS (
    SELECT side, r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM raw),
feature AS (
    SELECT side, r, unnest(w) AS f FROM split
    UNION ALL SELECT side, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)),
bytes AS (
    SELECT f, list_transform(range(0, length(h) // 2), lambda j: (instr('0123456789ABCDEF', h[2 * j + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * j + 2]) - 1) AS b FROM hexed),
place AS (
    SELECT f, xor(list_reduce(list_transform(b, lambda x: x::BIGINT), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM bytes, crc),
total AS (SELECT count_if(side = 0) AS s_all, count_if(side = 1) AS t_all FROM feature),
gain AS (
    SELECT bucket, floor(1000 * ln(((count_if(side = 1) + 1) * (any_value(s_all) + 10000))::DOUBLE / ((count_if(side = 0) + 1) * (any_value(t_all) + 10000))::DOUBLE))::BIGINT AS g
    FROM feature JOIN place USING (f), total GROUP BY bucket),
weighed AS (
    SELECT r, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
    FROM feature JOIN place USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        list_reduce(list_transform(range(1, 9), lambda j: instr('0123456789abcdef', sha256('7:' || coalesce(doc_id::VARCHAR, ''))[j]) - 1), lambda a, d: a * 16 + d, 0::BIGINT) AS h
    FROM split LEFT JOIN weighed USING (r) WHERE side = 0),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) AS k FROM final)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_words >= 20 AND k <= 25 * (SELECT count(*) FROM final WHERE n_words >= 20) // 100 THEN k END AS rank
FROM ranked
"""
