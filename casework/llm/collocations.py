"""Phrase collocation mining by direct-address tiling of word-id pairs.

Texts are cut into blocks of some hundred thousand words; a block keeps its words once, and its
texts as numbers into that list. Words of a language that are frequent enough get ids by falling
frequency. A block's neighbouring ids are pairs of a square that is cut into tiles: ids are small
where words are frequent, so a few tiles near the origin are full and are counted by one dense
``bincount`` each, and all others hold few pairs and are counted as one sorted coordinate list.
Pairs that turn out frequent are ranked and numbered in turn, and again paired with the word that
follows: phrases of three words are tiles of (pair, word), of four words tiles of (triple, word).
Only frequent phrases can be part of a frequent longer one, so nothing is lost on the way.

Ids are numbered over all languages together, so an id tells its language and pairs need no other
key. Block counts are summed before they meet in ``groupBy``; a very frequent phrase has one row per
block there. Ids come back to a block in a join by phrase and a group by block, whose size is bounded by
``BLOCK`` words (or one text), so nothing that grows with the corpus is broadcast or collected; a bitmap of
fixed size spares most pairs that are not frequent that way, and the join settles the rest.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows
count as often as they occur; an empty table gives an empty result; a text is read as a whole, however
long; extra columns are not read. Scores are exact below 10^16 occurrences of a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.llm.common import column_bytes, materialise, table
from casework.llm.ranks import byte_slices, numbered

LEAST, LONGEST, COVER, TOP = 10, 3, 50, 2000
#: Words a block holds before it is closed; its last text is kept whole.
BLOCK = 1_000_000
#: Edge of a tile, and the share of its cells that must be met for a dense count.
TILE, DENSE = 512, 8
#: Parts of a language whose best phrases are found before those of the whole.
PARTS = 64
#: A bitmap of 2^25 bits (4 MB) keeps most infrequent pairs out of the shuffle that hands out ids.
FILTER_BITS = 25
#: Bits of a word id; the other bits of a pair hold the id of the phrase before it.
WORD_BITS = 27

_BREAK = b"."
_SPACED = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", _BREAK * 9 + b" ")


def tokens(raw: bytes) -> list[bytes]:
    """Words of UTF-8 ``raw`` with A-Z lower-cased, and a break between its pieces."""
    return raw.lower().translate(_SPACED).replace(_BREAK, b" . ").split()


def packed(values: np.ndarray) -> bytes:
    """Compressed bytes of an array of numbers, after their length."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), dtype=kind)


class _Block:
    """Words of some texts as numbers, by language."""

    def __init__(self):
        self.known: dict[str, dict[bytes, int]] = {}
        self.spots: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, raw: bytes) -> None:
        found = tokens(raw)
        known = self.known.setdefault(lang, {_BREAK: 0})
        got = list(map(known.get, found))
        if None in got:
            for i, word in enumerate(found):
                if got[i] is None:
                    got[i] = known.setdefault(word, len(known))
        self.spots.setdefault(lang, []).append(np.array([*got, 0], dtype=np.int32))
        self.size += len(found) + 1

    def rows(self, number: int) -> pa.RecordBatch:
        """One row per language: block, language, numbers (0 is a break), words and their counts."""
        langs, spots, counts = list(self.known), [], []
        for lang in langs:
            whole = np.concatenate(self.spots[lang])
            spots.append(packed(whole))
            counts.append(np.bincount(whole, minlength=len(self.known[lang]))[1:])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number + i for i in range(len(langs))], pa.int64()), pa.array(langs, pa.string()), pa.array(spots, pa.binary()),
                pa.array([list(self.known[x])[1:] for x in langs], pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64())),
            ],
            names=["block", "lang", "spots", "words", "counts"],
        )


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Written ``block, lang, spots, words, counts``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 40, _Block()
        for batch in byte_slices(parts, 2 << 20):
            for name, raw in zip(batch.column(0).to_pylist(), column_bytes(batch, "text")):
                block.add(name, raw)
                if block.size >= BLOCK:
                    yield block.rows(number)
                    number, block = number + len(block.known), _Block()
        if block.size:
            yield block.rows(number)

    slim = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    return materialise(slim.mapInArrow(run, "block long, lang string, spots binary, words array<binary>, counts array<long>"), "phrase-blocks")


def block_words(cut: DataFrame) -> DataFrame:
    """``block, lang, code, word, c``: the words of each block; ``code`` is the number used in its texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for block, lang, words, counts in zip(*(batch.column(i) for i in range(4))):
                n = len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(block, n), pa.repeat(lang, n), pa.array(np.arange(1, n + 1)), words.values, counts.values], names=["block", "lang", "code", "word", "c"]
                )

    return cut.select("block", "lang", "words", "counts").mapInArrow(run, "block long, lang string, code long, word binary, c long")


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pair codes and how often each occurs, tile by tile."""
    codes, counts = [], []
    across = int(right.max()) // TILE + 1 if len(right) else 1
    tile = left // TILE * across + right // TILE
    names, places, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    full = sizes * DENSE >= TILE * TILE
    for k in np.flatnonzero(full):
        mine = places == k
        up, along = int(names[k]) // across * TILE, int(names[k]) % across * TILE
        cells = np.bincount((left[mine] - up) * TILE + right[mine] - along, minlength=TILE * TILE)
        met = np.flatnonzero(cells)
        codes.append((met // TILE + up << WORD_BITS) | (met % TILE + along))
        counts.append(cells[met])
    rest = ~full[places]
    code, count = np.unique((left[rest] << WORD_BITS) | right[rest], return_counts=True)
    return np.concatenate([*codes, code]), np.concatenate([*counts, count])


def _pairs(cut: DataFrame, ids: DataFrame, k: int, last: bool) -> DataFrame:
    """Written ``block, base, tops, codes, counts``: per block the pairs of a phrase of ``k`` words and the next word.

    ``ids`` (``block, code, id``) has the ids of the frequent phrases of ``k`` words in each block;
    ``base`` holds the word ids of its texts and ``tops`` the ids of the phrases that start there.
    """

    def run(text: pa.Table, known: pa.Table) -> pa.Table:
        if not text.num_rows:
            return schema.empty_table()
        base = unpacked(text.column("base")[0].as_py(), "<i4").astype(np.int64)
        code, n = base, max(0, len(base) - k + 1)
        if k > 1:
            tops = base if k == 2 else unpacked(text.column("tops")[0].as_py(), "<i8")
            code = np.where((tops[:n] >= 0) & (base[k - 1 :] >= 0), (tops[:n] << WORD_BITS) | base[k - 1 :], -1)
        of, id = known.column("code").to_numpy(), known.column("id").to_numpy()
        order = np.argsort(of)
        of, id = of[order], id[order]
        spot = np.minimum(np.searchsorted(of, code), max(0, len(of) - 1))
        tops = np.where(of[spot] == code, id[spot], -1) if len(of) else np.full(len(code), -1)
        if k == 1:
            base = tops
        # A longer phrase needs the phrase here, the one a word later and a word after it.
        n = max(0, len(base) - k)
        start = np.flatnonzero((tops[:n] >= 0) & (tops[1 : n + 1] >= 0) & (base[k : k + n] >= 0))
        codes, counts = tile_counts(tops[start], base[start + k])
        order = np.argsort(codes)
        codes, counts = np.diff(codes[order], prepend=0), counts[order]
        values = [b"" if last else packed(base.astype("<i4")), b"" if last or k == 1 else packed(tops.astype("<i8")), packed(codes.astype("<i8")), packed(counts.astype("<i4"))]
        return pa.table([text.column("block").combine_chunks(), *[pa.array([v], pa.binary()) for v in values]], schema=schema)

    schema = pa.schema([("block", pa.int64()), ("base", pa.binary()), ("tops", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())])
    both = cut.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(run, "block long, base binary, tops binary, codes binary, counts binary")
    return materialise(both, "phrase-pairs")


def _bit(codes: np.ndarray) -> np.ndarray:
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(codes: DataFrame) -> np.ndarray:
    """Bitmap of fixed size in which every one of ``codes`` has its bit set, put together in tasks."""
    size = (1 << FILTER_BITS) // 8

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, any_row = np.zeros(1 << FILTER_BITS, dtype=bool), False
        for batch in parts:
            seen[_bit(batch.column(0).to_numpy())] = True
            any_row |= batch.num_rows > 0
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()], pa.binary())], names=["bits"])

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, dtype=np.uint8)
        for batch in parts:
            for bits in batch.column(0).to_pylist():
                out |= np.frombuffer(bits, dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["bits"])

    rows = codes.mapInArrow(mark, "bits binary").repartition(4).mapInArrow(join, "bits binary").collect()
    return np.bitwise_or.reduce([np.frombuffer(bytes(r.bits), dtype=np.uint8) for r in rows] + [np.zeros(size, dtype=np.uint8)])


def _flat(pairs: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """``block, code, c`` of written pairs; with a bitmap without most pairs that it does not hold."""
    shared = None if bits is None else pairs.sparkSession.sparkContext.broadcast(bits)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for block, codes, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                code, c = np.cumsum(unpacked(codes, "<i8")), unpacked(counts, "<i4")
                if shared is not None:
                    bit = _bit(code)
                    kept = (shared.value[bit >> 3] >> (7 - (bit & 7))) & 1 == 1
                    code, c = code[kept], c[kept]
                for at in range(0, len(code), 100_000):
                    part = code[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(part), pa.array(c[at : at + 100_000].astype(np.int64))], names=["block", "code", "c"])

    return pairs.select("block", "codes", "counts").mapInArrow(run, "block long, code long, c long")


def _bounded(ids: DataFrame, bits: int, what: str) -> DataFrame:
    """``ids`` where its ids fit ``bits``; more are refused, never wrapped."""
    refused = F.raise_error(F.lit(f"too many frequent {what}")).cast("long")
    return ids.withColumn("id", F.when(F.col("id") < (1 << bits), F.col("id")).otherwise(refused))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written ``id, lang, word`` and ``key, a`` (occurrences of each frequent phrase of word ids), and ``lang, n``."""
    cut = blocks(docs, text, lang)
    met = block_words(cut)
    every = materialise(met.groupBy("lang", "word").agg(F.sum("c").alias("a")), "phrase-words")
    words = numbered(every.where(F.col("a") >= least), [F.desc("a"), F.col("lang"), F.col("word")], "id")
    words = materialise(_bounded(words, WORD_BITS, "words"), "phrase-ids")
    counts = words.select(F.array("id").alias("key"), "a")
    level, frame = words.select("id", F.array("id").alias("key")), cut.select("block", F.col("spots").alias("base"))
    ids = met.join(words.select("lang", "word", "id"), ["lang", "word"]).select("block", "code", "id")
    for k in range(1, longest):
        frame = _pairs(frame, ids, k, k + 1 == longest)
        found = _flat(frame).groupBy("code").agg(F.sum("c").alias("a")).where(F.col("a") >= least)
        found = _bounded(numbered(found, [F.desc("a"), F.col("code")], "id"), 63 - WORD_BITS, "phrases")
        parts = found.withColumn("left", F.shiftright("code", WORD_BITS)).withColumn("right", F.col("code").bitwiseAND(F.lit((1 << WORD_BITS) - 1)))
        before = level.select(F.col("id").alias("left"), F.col("key").alias("start"))
        level = materialise(parts.join(before, "left").select("id", "code", "a", F.concat("start", F.array("right")).alias("key")), "phrase-level")
        counts = counts.unionByName(level.select("key", "a"))
        if k + 1 < longest:
            near = _flat(frame, _filter(level.select("code")))
            ids = near.select("block", "code").join(level.select("code", "id"), "code").select("block", "code", "id")
    return words, materialise(counts, "phrase-counts"), every.groupBy("lang").agg(F.sum("a").alias("n"))


def _runs(key: Column, size: Column) -> Column:
    """All contiguous parts of 2 to ``size - 1`` items of ``key``."""
    of = lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.slice(key, at, n))
    return F.flatten(F.transform(F.sequence(F.lit(2), size - 1), of))


def scored(counts: DataFrame, cover: int = COVER) -> DataFrame:
    """Candidates that no longer one covers: ``key, a, l, r, score`` of the lowest-scoring cut."""
    size = F.size("key")
    long = counts.where(size >= 2)
    halves = long.select("key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    halves = halves.select("*", F.slice("key", F.lit(1), F.col("k")).alias("head"), F.slice("key", F.col("k") + 1, size - F.col("k")).alias("tail"))
    halves = halves.join(counts.select(F.col("key").alias("head"), F.col("a").alias("l")), "head")
    halves = halves.join(counts.select(F.col("key").alias("tail"), F.col("a").alias("r")), "tail")
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    halves = halves.select("key", "a", "k", "l", "r", (exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7,0)")).alias("up"), (exact("l") * exact("r")).alias("down"))
    best = halves.groupBy("key").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r", "a")).alias("best"))
    best = best.select("key", "best.a", "best.l", "best.r", "best.score")
    around = counts.where(size >= 3).select(F.explode(_runs(F.col("key"), size)).alias("key"), F.col("a").alias("within"))
    around = around.groupBy("key").agg(F.max("within").alias("within"))
    return best.join(around, "key", "left").where(F.isnull("within") | (100 * F.col("within") < cover * F.col("a"))).drop("within")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``."""
    words, counts, totals = phrases(docs, text, lang, least, longest)
    found = scored(counts, cover).withColumn("id", F.col("key")[0]).join(words.select("id", "lang"), "id").drop("id")
    # First within parts of a language, so that one language sends few rows to one task however many tasks there are.
    # Ties at the end stay until the words are there to break them.
    for by in (["lang", F.pmod(F.xxhash64("key"), F.lit(PARTS))], ["lang"]):
        best = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
        found = found.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place")
    found = materialise(found, "phrase-best")
    spelled = found.select("key", F.posexplode("key").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
    spelled = spelled.select("key", F.array_join(F.transform("parts", lambda p: p["word"].cast("string")), " ").alias("phrase"))
    total = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.join(spelled, "key").withColumn("rank", F.row_number().over(total).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_collocations(spark, sf_dir):
    return mine(table(spark, sf_dir, "documents").select("text", "lang"))


OP11_SQL = r"""
WITH piece AS (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS p
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
split AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
f AS (
    SELECT lang, key, count(*)::BIGINT AS c FROM (
        SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS key FROM split
        UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM split
        UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM split)
    GROUP BY ALL),
total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE len(key) = 1 GROUP BY lang),
cand AS (SELECT lang, key, c AS a FROM f WHERE len(key) >= 2 AND c >= 10),
halves AS (SELECT lang, key, a, k, key[1:k] AS head, key[k + 1:] AS tail FROM (SELECT *, unnest(range(1, len(key))) AS k FROM cand)),
cut AS (
    SELECT h.lang, h.key, h.a, k, x.c AS l, y.c AS r, (1000000::HUGEINT * h.a * h.a // (x.c::HUGEINT * y.c))::BIGINT AS score
    FROM halves h JOIN f x ON x.lang = h.lang AND x.key = h.head JOIN f y ON y.lang = h.lang AND y.key = h.tail),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, key ORDER BY score, k) = 1),
cover AS (
    SELECT lang, part, max(a) AS within FROM (
        SELECT lang, key[1:2] AS part, a FROM cand WHERE len(key) = 3 UNION ALL SELECT lang, key[2:3], a FROM cand WHERE len(key) = 3)
    GROUP BY ALL),
kept AS (
    SELECT lowest.*, array_to_string(lowest.key, ' ') AS phrase FROM lowest LEFT JOIN cover ON cover.lang = lowest.lang AND cover.part = lowest.key
    WHERE within IS NULL OR 100 * within < 50 * lowest.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total ON total.lang = kept.lang QUALIFY rank <= 2000
"""
