"""Language-model scores: word counts over the whole corpus, and a small causal attention model.

The attention model reads subword ids. A text is cut into windows of ``WINDOW`` inputs, each
overlapping the one before by ``WINDOW - STRIDE``; only the last ``STRIDE`` positions of a window
are scored, so every token is scored exactly once and has earlier tokens in view. Windows of many
texts are scored as one batch under a causal mask. The next id is predicted as a class (the most
frequent ids have one each, the others share classes by frequency) times the id's share in its
class, which is a proper distribution over all ids.

Texts are split and encoded once; their word hashes and subword ids are written and read by all later steps.

Training is numpy in tasks, on every different training text. The texts are dealt by their hash into shards of about ``SHARD`` ids, each
written as one row. Every shard is trained on in an order of its own, and parameters are averaged, ``ROUNDS`` times; so the
model follows from the texts (up to rounding), not from files or partitions.

Word counts cover every training text. The ``HOT`` most frequent words, a fixed bound, travel to
the tasks; all other words of a document meet their counts in a join by word, where no key is
frequent. Words are joined by a 64-bit hash of their bytes. A task numbers the words it meets and
works on arrays of numbers; it takes rows in slices of bounded bytes and forgets its words when
they pass a bound, so only a single very long text needs memory of its own size.

Defined results: a null or empty text is its end token alone; a null id counts as the empty text
for the split; repeated rows each get their row; with no training text all counts are zero; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import copy
import math
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm import wordbpe
from casework.llm.common import materialise, slices

WINDOW, STRIDE, WIDTH = 32, 24, 16
CLASSES, OWN_CLASSES, INPUTS = 64, 44, 512
IDS, END, START = 49_408, 49_407, 49_406
SHARD, ROUNDS, BATCH, STEP = 500_000, 2, 64, 0.01
HOT = 50_000
KEPT_WORDS, KEPT_BYTES = 300_000, 16 << 20
SLICE_ROWS, SLICE_BYTES = 1000, 4 << 20
_END_HASH = 1
#: Stands for the end of a text among its words, none of which holds white space.
_END_WORD = b"\n"


def held_out(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def _far(x: np.ndarray) -> bool:
    """True where exponentials need a shift by the largest value of their row to stay finite and above zero."""
    return x.max(initial=0) > 60 or x.min(initial=0) < -60


class Model:
    """Parameters of the attention model and the class tables."""

    def __init__(self, id_counts: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        order = np.argsort(-id_counts, kind="stable")
        rank = np.empty(IDS, dtype=np.int64)
        rank[order] = np.arange(IDS)
        # Shared classes split the remaining ids evenly by log rank.
        low, shared = math.log(OWN_CLASSES + 1), CLASSES - OWN_CLASSES
        scaled = (np.log(rank + 1) - low) / (math.log(IDS + 1) - low)
        self.class_of = np.where(rank < OWN_CLASSES, rank, OWN_CLASSES + np.clip((scaled * shared).astype(np.int64), 0, shared - 1)).astype(np.int16)
        half = INPUTS - 64
        self.input_of = np.where(rank < half, rank, half + rank % 62).astype(np.int16)
        self.input_of[START] = INPUTS - 1
        weight = id_counts + 0.5
        self.within = np.log(weight / np.bincount(self.class_of, weight, CLASSES)[self.class_of]).astype(np.float32)
        d = WIDTH
        shapes = {"E": (INPUTS, d), "P": (WINDOW, d), "Q": (d, d), "K": (d, d), "V": (d, d), "U": (d, CLASSES), "b": (CLASSES,)}
        self.p = {k: (rng.normal(0, 0.1 if k in "EP" else 1 / math.sqrt(d), s) if k != "b" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
        share = np.bincount(self.class_of, weight, CLASSES)
        self.p["b"] = np.log(share / share.sum()).astype(np.float32)
        ahead = np.arange(WINDOW)[None, :] > np.arange(STRIDE)[:, None] + WINDOW - STRIDE
        self.mask = np.where(ahead, np.float32(-1e9), np.float32(0))
        self.rooms: dict[str, np.ndarray] = {}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = vector[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def room(self, name: str, *shape: int) -> np.ndarray:
        """Memory kept from batch to batch; fresh arrays of this size cost more than what is done with them."""
        size = math.prod(shape)
        if name not in self.rooms or self.rooms[name].size < size:
            self.rooms[name] = np.empty(size, dtype=np.float32)
        return self.rooms[name][:size].reshape(shape)

    def forward(self, inputs: np.ndarray, pad: np.ndarray):
        """What the last layer gives, and all steps before it; valid until the next call."""
        p, n = self.p, len(inputs)
        x = p["E"].take(inputs, axis=0, out=self.room("x", n, WINDOW, WIDTH), mode="clip")
        x += p["P"]
        # One product for queries, keys and values; the scale of the queries is a power of two, so it rounds nothing.
        w = np.hstack([p["Q"] * np.float32(1 / math.sqrt(WIDTH)), p["K"], p["V"]])
        qkv = self.room("qkv", n, WINDOW, 3 * WIDTH)
        np.matmul(x.reshape(-1, WIDTH), w, out=qkv.reshape(-1, 3 * WIDTH))
        q, k, v = qkv[:, WINDOW - STRIDE :, :WIDTH], qkv[:, :, WIDTH : 2 * WIDTH], qkv[:, :, 2 * WIDTH :]
        s = np.matmul(q, k.transpose(0, 2, 1), out=self.room("s", n, STRIDE, WINDOW))
        apart = _far(s)
        s += self.mask
        first = np.flatnonzero(pad[:, 0])  # windows at the start of a text
        if len(first):
            s[first] += pad[first, None, :]
        if apart:
            s -= s.max(-1, keepdims=True)
        np.exp(s, out=s)
        total = (s.reshape(-1, WINDOW) @ np.ones(WINDOW, dtype=np.float32)).reshape(n, STRIDE, 1)
        seen = np.matmul(s, v, out=self.room("seen", n, STRIDE, WIDTH))
        seen /= total
        h = np.add(seen, x[:, WINDOW - STRIDE :], out=self.room("h", n, STRIDE, WIDTH))
        logits = np.matmul(h.reshape(-1, WIDTH), p["U"], out=self.room("logits", n * STRIDE, CLASSES))
        logits += p["b"]
        return x, w, q, k, v, s, total, seen, h, logits

    def score(self, inputs: np.ndarray, pad: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target id; ``targets`` has one row of STRIDE ids per window."""
        logits = self.forward(inputs, pad)[-1]
        goal = targets.ravel()
        if _far(logits):
            logits -= logits.max(1, keepdims=True)
        own = logits.ravel()[np.arange(0, logits.size, CLASSES) + self.class_of[goal]]
        total = np.log(np.exp(logits, out=logits) @ np.ones(CLASSES, dtype=np.float32))
        return own - total + self.within[goal]

    def gradient(self, inputs, pad, targets, real) -> dict[str, np.ndarray]:
        """Gradient of the mean loss over real positions; valid until the next call."""
        p, n, over = self.p, len(inputs), WINDOW - STRIDE
        x, w, q, k, v, s, total, seen, h, logits = self.forward(inputs, pad)
        flat = lambda m: m.reshape(-1, m.shape[-1])
        if _far(logits):
            logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        weight = (real.ravel() / max(real.sum(), 1)).astype(np.float32)
        logits *= (weight / (logits @ np.ones(CLASSES, dtype=np.float32)))[:, None]
        logits.ravel()[np.arange(0, logits.size, CLASSES) + self.class_of[targets.ravel()]] -= weight
        g = {"U": (logits.T @ flat(h)).T, "b": np.ones(len(logits), dtype=np.float32) @ logits}
        dh = self.room("dh", n, STRIDE, WIDTH)
        np.matmul(logits, p["U"].T, out=flat(dh))
        # With a = s / total, the row sums of da * a are those of dh * seen, which has fewer columns.
        part = np.divide(dh, total, out=self.room("part", n, STRIDE, WIDTH))
        ds = np.matmul(part, v.transpose(0, 2, 1), out=self.room("ds", n, STRIDE, WINDOW))
        seen *= part
        ds -= (flat(seen) @ np.ones(WIDTH, dtype=np.float32)).reshape(n, STRIDE, 1)
        ds *= s
        dqkv = self.room("dqkv", n, WINDOW, 3 * WIDTH)
        dqkv[:, :over, :WIDTH] = 0
        np.matmul(ds, k, out=dqkv[:, over:, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[:, :, WIDTH : 2 * WIDTH])
        np.matmul(s.transpose(0, 2, 1), part, out=dqkv[:, :, 2 * WIDTH :])
        dw = (flat(dqkv).T @ flat(x)).T
        g["Q"], g["K"], g["V"] = dw[:, :WIDTH] * np.float32(1 / math.sqrt(WIDTH)), dw[:, WIDTH : 2 * WIDTH], dw[:, 2 * WIDTH :]
        dx = self.room("dx", n, WINDOW, WIDTH)
        np.matmul(flat(dqkv), w.T, out=flat(dx))
        dx[:, over:] += dh
        g["P"] = dx.sum(0)
        spots = (inputs.reshape(-1, 1).astype(np.int64) * WIDTH) + np.arange(WIDTH)
        g["E"] = np.bincount(spots.ravel(), dx.ravel(), INPUTS * WIDTH).astype(np.float32).reshape(INPUTS, WIDTH)
        return g


def windows(texts: list[np.ndarray], model: Model):
    """Inputs, padding, targets and real positions of the windows of some texts, and each window's text."""
    over = WINDOW - STRIDE
    counts = np.array([-(-len(t) // STRIDE) for t in texts], dtype=np.int64)
    room = counts * STRIDE + over
    ends = np.cumsum(room)
    ids = np.full(int(ends[-1]) + 1, -1, dtype=np.int64)  # inputs; -1 is padding
    goal = np.full(int(ends[-1]) + 1, END, dtype=np.int64)
    real = np.zeros(int(ends[-1]) + 1, dtype=bool)
    for t, end, size in zip(texts, ends.tolist(), room.tolist()):
        at = end - size + over
        ids[at] = START
        ids[at + 1 : at + len(t)] = t[:-1]
        goal[at : at + len(t)] = t
        real[at : at + len(t)] = True
    starts = np.repeat(ends - room, counts) + STRIDE * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    spots = starts[:, None] + np.arange(WINDOW)
    seen = ids[spots]
    scored = spots[:, over:]
    pad = np.where(seen < 0, np.float32(-1e9), np.float32(0))
    return model.input_of[seen], pad, goal[scored], real[scored], np.repeat(np.arange(len(texts)), counts)


def score_texts(texts: list[np.ndarray], model: Model, chunk: int = 128) -> np.ndarray:
    """Log10 probability of each text of ids (the end included)."""
    out = np.zeros(len(texts))
    inputs, pad, goal, real, owner = windows(texts, model)
    for at in range(0, len(inputs), chunk):
        part = slice(at, at + chunk)
        got = model.score(inputs[part], pad[part], goal[part]) * real[part].ravel()
        out += np.bincount(owner[part], got.reshape(-1, STRIDE).sum(1), len(texts))
    return out / math.log(10)


class _Words(dict):
    """Words met by a task, numbered, with the hash and the subword ids of each."""

    def __init__(self, path: str):
        super().__init__()
        self.encoder = wordbpe.WordEncoder(path, kept=0)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.hashes, self.ids, self.ends, self.held = array("Q", [_END_HASH]), array("H", [END]), array("q", [0, 1]), 1
        self[_END_WORD] = 0

    def full(self) -> bool:
        return len(self) > KEPT_WORDS or self.held > KEPT_BYTES

    def spots(self, found: list[bytes]) -> np.ndarray:
        """Number of each word, all different; new ones get the next."""
        got = np.fromiter(map(self.get, found, repeat(-1)), dtype=np.int64, count=len(found))
        fresh = np.flatnonzero(got < 0)
        new = [found[i] for i in fresh.tolist()]
        got[fresh] = np.arange(len(self), len(self) + len(new))
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.hashes.extend(map(xxhash.xxh3_64_intdigest, new))
        self.held += sum(map(len, new))
        encode, ids, ends = self.encoder.encode, self.ids, self.ends
        for word in new:
            ids.extend(encode(word.decode("utf-8", "replace")))
            ends.append(len(ids))
        return got

    def hashed(self) -> np.ndarray:
        return np.array(self.hashes, dtype=np.uint64).view(np.int64)

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Word hashes of the texts of a batch (ends included), how many each text has, and the ids of each text."""
        spots, sizes, ids = self.numbered(batch)
        return self.hashed()[spots], sizes, ids

    def numbered(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The same with numbers in place of hashes."""
        spots, sizes = _spots(batch, self)
        ends = np.array(self.ends)
        lengths = np.diff(ends)[spots]
        upto = np.cumsum(lengths)
        ids = np.array(self.ids).astype(np.int64)[np.repeat(ends[spots] - (upto - lengths), lengths) + np.arange(lengths.sum())]
        return spots, sizes, np.split(ids, upto[np.cumsum(sizes)[:-1] - 1])


def _spots(batch: pa.RecordBatch, known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, each text with its end, and how many each has; one lookup per different word."""
    text = batch.column(batch.schema.get_field_index("text"))  # no cast: Arrow lower-cases a cast slice wrongly
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    flat = parts.flatten()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    offsets = parts.offsets.to_numpy()
    upto = np.concatenate([[0], np.cumsum(filled)])[offsets - offsets[0]]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    spots = known.spots(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
    return np.insert(spots, upto[1:], known[_END_WORD]), np.diff(upto) + 1


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of bounded rows and bytes; a longer text is a slice of its own."""
    for batch in slices(parts, SLICE_ROWS):
        rows = batch.num_rows if batch.nbytes <= SLICE_BYTES else max(1, batch.num_rows * SLICE_BYTES // batch.nbytes)
        for part in slices(iter([batch]), rows):
            if part.nbytes <= 2 * SLICE_BYTES:
                yield part
            else:
                yield from slices(iter([part]), 1)


_WORDS: dict[str, _Words] = {}


def _known(path: str) -> _Words:
    if path not in _WORDS:
        _WORDS[path] = _Words(path)
    return _WORDS[path]


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """Written once, read by every later step: a row per text and rows of counts.

    A text has its ``id`` and ``held``, a hash of the text (``same``), whether its task met it before with the same ``held`` (``again``), the hashes of
    its words with its end (``words``) and its subword ``ids``. A row of counts has only ``counts``: words of the
    texts that are not held out, each with its occurrences in a part of a task.
    """
    names = ["id", "held", "same", "again", "words", "ids", "counts"]
    pairs = pa.list_(pa.struct([("word", pa.int64()), ("c", pa.int64())]))
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met, total = _known(path), set(), np.zeros(1, dtype=np.int64)

        def counted() -> pa.RecordBatch:
            seen = np.flatnonzero(total)
            rows = pa.StructArray.from_arrays([pa.array(known.hashed()[seen]), pa.array(total[seen])], names=["word", "c"])
            lists = pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()), rows).cast(pairs)
            return pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types), lists], names=names)

        for batch in _pieces(batches):
            if known.full():
                yield counted()
                known.forget()
                total = np.zeros(1, dtype=np.int64)
            if len(met) > KEPT_WORDS:
                met.clear()
            spots, sizes, ids = known.numbered(batch)
            held, same = batch.column("held"), batch.column("same")
            more = np.bincount(spots[np.repeat(~held.to_numpy(zero_copy_only=False), sizes)], minlength=len(known))
            more[: len(total)] += total
            total = more
            ends = np.cumsum(sizes)
            words = [x.tobytes() for x in np.split(known.hashed()[spots], ends[:-1])]
            raw, again = [x.astype("<u2").tobytes() for x in ids], []
            for key in zip(held.to_pylist(), same.to_pylist(), map(xxhash.xxh3_128_digest, raw)):
                again.append(key in met)
                met.add(key)
            made = [pa.array(again), pa.array(words, pa.binary()), pa.array(raw, pa.binary()), pa.nulls(len(ids), pairs)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), held, same, *made], names=names)
        yield counted()

    read = docs.select("id", "held", F.xxhash64(F.coalesce("text", F.lit(""))).alias("same"), "text")
    schema = "id long, held boolean, same long, again boolean, words binary, ids binary, counts array<struct<word:long,c:long>>"
    return materialise(read.mapInArrow(run, schema), "text-tokens", compression="zstd")


def word_counts(read: DataFrame) -> DataFrame:
    """Written ``word, c``: occurrences of each word hash in the texts of :func:`tokens` that are not held out."""
    return materialise(read.select(F.inline("counts")).groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def _summed(rows: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """Weighted sum of the vectors in ``rows`` (``n, v``), added up in tasks; at most 16 rows arrive here."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(size), 0.0
        for batch in batches:
            for n, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += np.frombuffer(v, dtype="<f8")
                weight += n
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([total.tobytes()], pa.binary())], names=["n", "v"])

    got = rows.repartition(16).mapInArrow(add, "n double, v binary").collect()
    return sum((np.frombuffer(bytes(r.v), dtype="<f8") for r in got), np.zeros(size)), sum(r.n for r in got)


def _texts(shard: pa.RecordBatch | pa.Table) -> Iterator[list[np.ndarray]]:
    """The ids of the texts of each shard."""
    for texts in shard.column("texts"):
        yield [np.frombuffer(x.as_buffer(), dtype="<u2").astype(np.int64) for x in texts.values]


def _fitted(shared: Model, texts: list[np.ndarray], seed: int, r: int) -> tuple[np.ndarray, int]:
    """Parameters after every ``ROUNDS``-th batch-ordered window of a shard from the ``r``-th on, and how many windows those are."""
    local = copy.copy(shared)
    local.rooms, now = {}, shared.vector().astype(np.float32)
    local.p, at = {}, 0
    for k, v in shared.p.items():  # views, so that one step moves all parameters
        local.p[k] = now[at : at + v.size].reshape(v.shape)
        at += v.size
    first, second = np.zeros_like(now), np.zeros_like(now)
    inputs, pad, goal, real, _ = windows(texts, local)
    order = np.random.default_rng(seed).permutation(len(inputs))[r::ROUNDS]
    for step, at in enumerate(range(0, len(order), BATCH), 1):
        pick = order[at : at + BATCH]
        g = local.gradient(inputs[pick], pad[pick], goal[pick], real[pick])
        v = np.concatenate([g[k].ravel() for k in local.p])
        first += 0.1 * (v - first)
        second += 0.01 * (v * v - second)
        now -= STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return now, len(order)


def shards(read: DataFrame) -> DataFrame:
    """Written ``shard, texts``: the ids of all different texts that are not held out, in shards of about ``SHARD`` ids."""
    known = read.where("NOT held AND NOT again")  # copies are left out in their task, so no shard gets a row per copy
    n = known.select("same", F.octet_length("ids").alias("size")).distinct().agg(F.sum("size") / 2).first()[0] or 0
    dealt = known.select("same", "ids", F.pmod(F.xxhash64("ids"), F.lit(max(1, math.ceil(n / SHARD)))).alias("shard"))

    def gather(key, rows):
        texts = sorted(ids for _, ids in set(zip(rows.column("same").to_pylist(), rows.column("ids").to_pylist())))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "texts": pa.array([texts], pa.list_(pa.binary()))})

    return materialise(dealt.groupBy("shard").applyInArrow(gather, "shard long, texts array<binary>"), "training-shards", compression="zstd")


def trained(read: DataFrame) -> Model:
    """The attention model, trained on all different texts of :func:`tokens` that are not held out."""
    spark, dealt = read.sparkSession, shards(read)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS)
        for batch in batches:
            for texts in _texts(batch):
                total += np.bincount(np.concatenate(texts), minlength=IDS)
        yield pa.RecordBatch.from_arrays([pa.array([float(total.sum())]), pa.array([total.tobytes()], pa.binary())], names=["n", "v"])

    model = Model(_summed(dealt.mapInArrow(count, "n double, v binary"), IDS)[0])
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for seed, texts in zip(batch.column("shard").to_pylist(), _texts(batch)):
                    vector, n = _fitted(shared.value, texts, seed, r)
                    vector = vector.astype("<f8") * n
                    yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([vector.tobytes()], pa.binary())], names=["n", "v"])

        total, weight = _summed(dealt.mapInArrow(fit, "n double, v binary"), model.vector().size)
        if weight:
            model.load(total / weight)
    return model


def train(docs: DataFrame, path: str) -> Model:
    """The attention model, trained on all different texts of ``docs`` (``text, held``) that are not held out."""
    return trained(tokens(docs.select(F.lit(0).cast("long").alias("id"), "text", "held"), path))


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: id, held_out, token counts, ``base_score`` of the word counts and ``score`` of the model."""
    spark, path = docs.sparkSession, path or wordbpe.default_path()
    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).withColumn("held", held_out(F.col("id")))
    read = tokens(slim, path)
    counts = word_counts(read)
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(HOT).collect()
    hot_words = np.array([r.word for r in top], dtype=np.int64)
    hot_counts = np.array([r.c for r in top], dtype=np.float64)
    order = np.argsort(hot_words)
    total = math.log10(whole.n + whole.v + 1)
    shared = spark.sparkContext.broadcast((trained(read), hot_words[order], np.log10(hot_counts[order] + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hot, logs = shared.value
        part, row = TaskContext.get().partitionId(), 0
        for batch in _pieces(batches):
            words = [np.frombuffer(x.as_buffer(), dtype="<i8") for x in batch.column("words")]
            flat, sizes = np.concatenate(words), np.array([len(x) for x in words])
            ids = [np.frombuffer(x.as_buffer(), dtype="<u2").astype(np.int64) for x in batch.column("ids")]
            n = len(sizes)
            owner = np.repeat(np.arange(n), sizes)
            if len(hot):
                spot = np.minimum(np.searchsorted(hot, flat), len(hot) - 1)
                frequent = hot[spot] == flat
            else:
                spot, frequent = np.zeros(len(flat), dtype=np.int64), np.zeros(len(flat), dtype=bool)
            base = np.bincount(owner[frequent], logs[spot[frequent]] - total, n)
            sure = np.bincount(owner[frequent], minlength=n)
            rare, whose = flat[~frequent], owner[~frequent]
            ends = np.cumsum(np.bincount(whose, minlength=n))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(rare))
            keys = (np.int64(part) << 40) + row + np.arange(n)
            row += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), batch.column("id"), batch.column("held"), pa.array(sizes.astype(np.int64)), pa.array(sure.astype(np.int64)), pa.array(base), pa.array(score_texts(ids, model)), lists],
                names=["key", "id", "held", "n_tokens", "sure", "base", "score", "rare"],
            )

    scored = read.where("ids IS NOT NULL").select("id", "held", "words", "ids").mapInArrow(run, "key long, id long, held boolean, n_tokens long, sure long, base double, score double, rare array<long>")
    scored = materialise(scored, "scored-texts")
    rare = scored.select("key", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("key").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1) - total).alias("more"), F.count("c").alias("known"))
    return scored.select("key", "id", "held", "n_tokens", "sure", "base", "score").join(rare, "key", "left").select(
        F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", (F.col("sure") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(whole.n)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )


def op5_scoring(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
