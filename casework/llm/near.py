"""N-gram Jaccard join: documents whose sets of five-word shingles have a similarity of 0.75 or more.

1. One pass over the texts deals sorted shingle values of ``VALUE_BITS`` into ranges. Counting the
   ranges gives every value's frequency over all documents.
2. Shingles are ordered rarest first: seen once, seen twice or more (a bitmap of four bits or more
   for each repeated value, 2^``BITMAP_BITS`` at most), then by frequency class for the at most
   ``FREQUENT`` most frequent, then by hash. Both tables have a bound, whatever the input; beyond
   it the order is coarser, and results are equal.
3. A second pass writes each document's set size and a digest of its set, and its prefix in that
   order. A shingle seen once links nothing, so only prefixes holding a repeated shingle are
   posted, with their sets. Documents with equal sets are one node.
4. Nodes that share a prefix shingle are candidates. A group of near copies would have all its
   pairs, so the nodes of each posting list are first checked against a few members of its largest
   component, ``STAR_ROUNDS`` times, and then only pairs
   between different components are listed, with length and positional filters. A list that lies
   in one component stays so, and is dropped. Each pair is
   verified once: a suffix bound from counts per hash range, then the exact overlap.
5. Components come from label propagation over the links; nothing is collected.

All pairs at or above the threshold end in one component: every pair sharing a prefix shingle is
verified or already in one component, and a pair at the threshold shares its first common one.

Defined results: words are lower-cased (A-Z) and lie between white space; below five words the
whole sequence is the one shingle; null and empty texts have no shingle and no link; rows with
equal ids are one document; a null id gets a null component; repeated rows each get their row; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import column_bytes, materialise, slices, words

N = 5
#: Similarity as a fraction: intersection * DOWN >= union * UP.
UP, DOWN = 75, 100
#: Bits of a shingle value, and of the largest bitmap (64 MB). Of fewer, many values would seem repeated on a large corpus.
VALUE_BITS, BITMAP_BITS = 36, 29
FREQUENT = 1 << 20
FLUSH = 4_000_000
STAR_ROUNDS, LEADERS = 4, 4
KEPT_WORDS = 200_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_HASHES: dict[bytes, int] = {}


def _hashes(found: Sequence[bytes]) -> list[int]:
    got = list(map(_HASHES.get, found))
    if None in got:
        if len(_HASHES) > KEPT_WORDS:
            _HASHES.clear()
        for i, (word, h) in enumerate(zip(found, got)):
            if h is None:
                got[i] = xxhash.xxh3_64_intdigest(word)
                if len(word) <= 64:
                    _HASHES[word] = got[i]
    return got


def shingles(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each UTF-8 text."""
    found = [words(t) for t in texts]
    sizes = np.fromiter((len(w) for w in found), dtype=np.int64, count=len(found))
    flat = np.array([h for w in found for h in _hashes(w)], dtype=np.uint64)
    ends = np.cumsum(sizes)
    if len(flat) >= N:
        rolled = flat[: len(flat) - N + 1] * _MIX[0]
        for k in range(1, N):
            rolled = (rolled ^ (rolled >> np.uint64(29))) * _MIX[k] + flat[k : len(flat) - N + 1 + k]
        rolled = (rolled ^ (rolled >> np.uint64(32))) * _MIX[0]
        rolled ^= rolled >> np.uint64(29)
    out = []
    for w, end, n in zip(found, ends.tolist(), sizes.tolist()):
        if n >= N:
            out.append(np.unique(rolled[end - n : end - N + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=n)] if n else [], dtype=np.uint64))
    return out


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _values(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - VALUE_BITS)


def _packed(values: np.ndarray) -> bytes:
    """Sorted values as compressed differences, the lowest bytes of all of them first."""
    planes = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-VALUE_BITS // 8)]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def _unpacked(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), dtype=np.uint8).reshape(-(-VALUE_BITS // 8), -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, : len(planes)] = planes.T
    return np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64)


def _blocks(docs: DataFrame, range_bits: int) -> DataFrame:
    """Blocks of sorted shingle values: ``range, block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def flush() -> pa.RecordBatch:
            values = np.sort(np.concatenate(waiting))
            cuts = np.searchsorted(values, np.arange(1, 1 << range_bits, dtype=np.uint64) << np.uint64(VALUE_BITS - range_bits))
            got = [(i, _packed(v)) for i, v in enumerate(np.split(values, cuts)) if len(v)]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int32()), pa.array([b for _, b in got], pa.binary())], names=["range", "block"])

        for batch in slices(batches):
            sets = shingles(column_bytes(batch, "text"))
            waiting += [_values(s) for s in sets]
            held += sum(map(len, sets))
            if held >= FLUSH:
                yield flush()
                waiting, held = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "range int, block binary")


def _resized(bits: bytes, size: int) -> bytes:
    """A bitmap in ``size`` bits: neighbours become one, or a bit becomes several equal ones; both sizes are powers of two from 8 on."""
    flags = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))
    flags = np.repeat(flags, size // len(flags)) if size > len(flags) else flags.reshape(size, -1).max(1)
    return np.packbits(flags).tobytes()


def _frequencies(docs: DataFrame, range_bits: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Binary logarithm of a bitmap's size, the bitmap of values seen twice or more, and the most frequent values with their classes."""

    def count(key: tuple, group: pa.Table) -> pa.Table:
        values, counts = np.unique(np.concatenate([_unpacked(b.as_py()) for b in group.column("block")]), return_counts=True)
        again = values[counts >= 2]
        fine = min(max(3, int(8 * len(again)).bit_length()), BITMAP_BITS - range_bits)
        twice = np.zeros(1 << fine, dtype=np.uint8)
        twice[((again >> np.uint64(VALUE_BITS - range_bits - fine)) & np.uint64((1 << fine) - 1)).astype(np.int64)] = 1
        often = counts >= 4
        level = np.log2(counts[often]).astype(np.uint8)
        return pa.table({
            "range": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(twice).tobytes()], pa.binary()), "again": pa.array([len(again)], pa.int64()),
            "levels": pa.array([np.bincount(level, minlength=64).tolist()], pa.list_(pa.int64())),
            "vals": pa.array([values[often].astype("<u8").tobytes()], pa.binary()), "level": pa.array([level.tobytes()], pa.binary()),
        })

    counted = _blocks(docs, range_bits).groupBy("range").applyInArrow(count, "range int, bits binary, again long, levels array<long>, vals binary, level binary")
    counted = materialise(counted, "shingle-counts")
    totals, again = np.zeros(64, dtype=np.int64), 0
    for r in counted.select("again", "levels").collect():
        totals += np.asarray(r.levels)
        again += r.again
    least = next(k for k in range(2, 65) if totals[k:].sum() <= FREQUENT)
    size = min(max(range_bits + 3, (4 * again).bit_length()), BITMAP_BITS)
    span = 1 << (size - range_bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            bits, vals, level = (batch.column(i)[0].as_py() for i in (1, 2, 3))
            v, k = np.frombuffer(vals, dtype="<u8"), np.frombuffer(level, dtype=np.uint8)
            out = _resized(bits, span), v[k >= least].tobytes(), k[k >= least].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([x], pa.binary()) for x in out]], names=["range", "bits", "vals", "level"])

    bits, vals, level = np.zeros(1 << (size - 3), dtype=np.uint8), [], []
    kept = counted.select("range", "bits", "vals", "level").mapInArrow(keep, "range int, bits binary, vals binary, level binary")
    for r in kept.collect():  # at most 2^BITMAP_BITS bits and FREQUENT values
        bits[r.range * span // 8 : (r.range + 1) * span // 8] = np.frombuffer(r.bits, dtype=np.uint8)
        vals.append(np.frombuffer(r.vals, dtype="<u8"))
        level.append(np.frombuffer(r.level, dtype=np.uint8))
    vals, level = np.concatenate([np.empty(0, dtype="<u8"), *vals]), np.concatenate([np.empty(0, dtype=np.uint8), *level])
    order = np.argsort(vals)
    return size, bits, vals[order], level[order]


def _prefixes(docs: DataFrame, frequencies) -> DataFrame:
    """Rows ``row, id, n, digest, hashes, prefix``: a number of their own, and the last two where the prefix has a repeated shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)
    schema = "row long, id long, n long, digest binary, hashes binary, prefix array<struct<h:long,pos:int>>"
    item = pa.struct([("h", pa.int64()), ("pos", pa.int32())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(item)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, bits, vals, level = shared.value
        shift, row = np.uint64(VALUE_BITS - size), TaskContext.get().partitionId() << 40

        def prefix(own: np.ndarray) -> list[dict] | None:
            n = len(own)
            values = _values(own)
            at = (values >> shift).astype(np.int64)
            rank = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            length = n - (UP * n + DOWN - 1) // DOWN + 1
            if n - int(rank.sum()) >= length:
                return None
            if len(vals):
                spot = np.minimum(np.searchsorted(vals, values), len(vals) - 1)
                rank = np.where(vals[spot] == values, level[spot], rank)
            order = np.lexsort((own, rank))[:length]
            at = np.flatnonzero(rank[order])
            return [{"h": h, "pos": p} for h, p in zip(own[order][at].view(np.int64).tolist(), at.tolist())]

        for batch in slices(batches, 500):
            out = []
            for name, own in zip(batch.column(0).to_pylist(), shingles(column_bytes(batch, "text"))):
                found = prefix(own) if len(own) and name is not None else None
                out.append((row, name, len(own), digest(own), None if found is None else own.tobytes(), found))
                row += 1
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["row", "id", "n", "digest", "hashes", "prefix"])

    return docs.mapInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct ``pairs`` (``x, y``) that reach the similarity."""
    a = sets.select(F.col("node").alias("x"), F.col("hashes").alias("hx"))
    b = sets.select(F.col("node").alias("y"), F.col("hashes").alias("hy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
        for batch in slices(batches, 500):
            keep = []
            for hx, hy in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = np.frombuffer(hx, dtype=np.uint64), np.frombuffer(hy, dtype=np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                need = -(-UP * (len(p) + len(q)) // (UP + DOWN))
                by_range = [np.diff(np.searchsorted(v, pivots), prepend=0, append=len(v)) for v in (p, q)]
                if np.minimum(*by_range).sum() < need:  # suffix filter
                    keep.append(False)
                    continue
                spot = np.minimum(np.searchsorted(q, p), len(q) - 1)
                keep.append(int((q[spot] == p).sum()) >= need)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select("x", "y").distinct().join(a, "x").join(b, "y").select("x", "y", "hx", "hy")
    return both.mapInArrow(run, "x long, y long")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``node, comp``) with the components that ``links`` (``x, y``) connect made one, named by the smallest."""
    of = lambda side: labels.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
    edges = links.join(of("x"), "x").join(of("y"), "y").select("cx", "cy").where("cx <> cy")
    edges = materialise(edges.union(edges.select("cy", "cx")).distinct(), "component-edges")
    state = edges.select(F.col("cx").alias("c")).distinct().withColumn("to", F.col("c"))
    while True:
        near = edges.join(state.select(F.col("c").alias("cy"), F.col("to").alias("near")), "cy").groupBy("cx").agg(F.min("near").alias("near"))
        hooked = state.join(near, F.col("c") == F.col("cx")).select("c", F.col("to").alias("old"), F.least("to", "near").alias("to"))
        hooked = materialise(hooked, "component-labels")
        jump = hooked.select(F.col("c").alias("to"), F.col("to").alias("further"))
        state = materialise(hooked.join(jump, "to").select("c", "old", F.col("further").alias("to")), "component-labels")
        if not state.where("old <> to").take(1):
            break
        state = state.drop("old")
    moved = state.select(F.col("c").alias("comp"), "to")
    return materialise(labels.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "components")


def _similar_length(a: str, b: str) -> str:
    return f"{DOWN} * least({a}, {b}) >= {UP} * greatest({a}, {b})"


def link(postings: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Components over ``postings`` (``h, node, n, pos``); see the module's text, step 4."""
    for r in range(STAR_ROUNDS):
        placed = materialise(postings.join(labels, "node"), "postings")
        # Per list, members of its largest component stand for it; the other nodes meet a few of them.
        leads = F.array(*[F.struct(F.xxhash64("node", F.lit(r * LEADERS + i)), "node", "n") for i in range(LEADERS)])
        sides = placed.groupBy("h", "comp").agg(F.count("*").alias("m"), *[F.min(F.get(leads, i)).alias(f"lead{i}") for i in range(LEADERS)])
        major = F.max(F.struct("m", "comp", F.array(*[f"lead{i}" for i in range(LEADERS)]).alias("leads")))
        major = sides.groupBy("h").agg(major.alias("s"), F.count("*").alias("parts")).where("parts > 1").select("h", "s.comp", "s.leads").withColumnRenamed("comp", "major")
        minor = placed.join(major, "h").where("comp <> major").groupBy("node", "n").agg(*[F.min(F.struct(F.get("leads", i)["node"], F.get("leads", i)["n"])).alias(f"lead{i}") for i in range(LEADERS)])
        stars = minor.select("node", "n", F.explode(F.array(*[f"lead{i}" for i in range(LEADERS)])).alias("lead")).toDF("node", "n", "lead")
        stars = stars.select("node", "n", F.col("lead.node").alias("o_node"), F.col("lead.n").alias("o_n")).where(_similar_length("n", "o_n"))
        stars = stars.select(F.least("node", "o_node").alias("x"), F.greatest("node", "o_node").alias("y"))
        found = materialise(_verified(stars, sets), "links")
        postings = placed.join(major.select("h"), "h", "left_semi").select("h", "node", "n", "pos")
        if not found.take(1):
            break
        labels = components(labels, found)
    placed = materialise(postings.join(labels, "node"), "postings")
    mixed = placed.groupBy("h", "comp").agg(F.count("*").alias("m")).groupBy("h").agg(F.max(F.struct("m", "comp"))["comp"].alias("major"), F.count("*").alias("parts")).where("parts > 1")
    placed = materialise(placed.join(mixed.select("h", "major"), "h"), "mixed-postings")
    salts = 8
    a = placed.where("comp <> major").select("h", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "pos", "comp")], "major").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    b = placed.select("h", *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "pos", "comp")]).withColumn("salt", F.pmod(F.xxhash64("b_node"), F.lit(salts)).cast("int"))
    room = f"1 + least(a_n - a_pos - 1, b_n - b_pos - 1) >= ceil({UP} * (a_n + b_n) / {UP + DOWN})"
    cross = a.join(b, ["h", "salt"]).where(f"a_comp <> b_comp AND (b_comp = major OR a_node < b_node) AND {_similar_length('a_n', 'b_n')} AND {room}")
    pairs = cross.select(F.least("a_node", "b_node").alias("x"), F.greatest("a_node", "b_node").alias("y"))
    found = materialise(_verified(pairs, sets), "links")
    return components(labels, found)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query are deleted when it ends, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id, n_shingles, component_id``."""
    with shuffles_dropped(docs.sparkSession):
        return _near_duplicates(docs, id, text)


def _near_duplicates(docs: DataFrame, id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    range_bits = max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    table = materialise(_prefixes(slim, _frequencies(slim, range_bits)), "prefixes")
    rows = table.select("id", "n", "digest")
    first = table.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min(F.struct("id", "row")).alias("first"))
    classes = materialise(first.select("digest", F.col("first.id").alias("node"), "first.row"), "set-classes")
    posted = table.where("hashes IS NOT NULL").select("row", "n", "hashes", "prefix").join(classes.select("row", "node"), "row")
    posted = materialise(posted.select("node", F.col("n").cast("int").alias("n"), "hashes", "prefix"), "set-prefixes")
    classes = classes.drop("row")
    sets = posted.select("node", "hashes")
    postings = posted.select("node", "n", F.explode("prefix").alias("p")).select("node", "n", "p.h", "p.pos")
    shared = postings.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    postings = materialise(postings.join(shared, "h", "left_semi"), "postings")
    named = rows.where("n > 0 AND id IS NOT NULL").join(classes, "digest").select("id", "node")
    several = named.groupBy("id").agg(F.min("node").alias("x"), F.max("node").alias("last")).where("x < last").select("id", "x")
    twins = several.join(named, "id").where("node > x").select("x", F.col("node").alias("y")).distinct()
    twins = materialise(twins, "same-id")
    nodes = postings.select("node").union(twins.select("x")).union(twins.select("y")).distinct()
    labels = materialise(nodes.withColumn("comp", F.col("node")), "components")
    if twins.take(1):
        labels = components(labels, twins)
    labels = link(postings, sets, labels)
    smallest = classes.join(labels, "node", "left").select("digest", F.coalesce("comp", "node").alias("comp"))
    joined = rows.join(smallest, "digest", "left")
    return joined.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNull(), None).otherwise(F.coalesce("comp", "id")).cast("long").alias("component_id"))


def op10_near(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents linked to one with a smaller id; texts without words stay.

    Rows that share id and text with a kept row stay with it; null ids stay.
    """
    found = near_duplicates(docs)
    drop = found.where("component_id < id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(drop, "doc_id", "left_anti")

