"""Language identification by interpolated Kneser-Ney character models, one per language.

A word is read as ``^word$``; the model of a language gives every character after the start mark a
probability from up to ``ORDER - 1`` characters before it in the word. The highest order counts
occurrences, lower ones count the different characters seen before, each order is discounted by its own
amount and interpolated with the next shorter one, and the shortest with the uniform distribution. Each
order is stored as a sorted array of 64-bit hashes with, beside each, the log-probability of the run's
last character and the weight that a longer context gives away where it knows no better. A text's
language is that of the lowest cross-entropy per character over the words of the whole text.

Models are fitted on a bounded sample: about ``ROWS`` texts of each language, chosen by a hash of
their id and text (at the rate ``ROWS / texts of the language``). Three quarters of the sample feed the models, the
rest calibrates: a logistic curve turns the lead over the second language, the distance from
the language's usual cross-entropy and the length into the probability that the answer is right. Its
negative cases are wrong answers and, for texts in unknown languages, the same texts with their own
language's model withheld. Answers below ``ACCEPT`` are marked as not accepted; they are still given.

Texts are counted in tasks; only word counts of the sample meet, one group per language. The models
that travel to the tasks grow with the number of languages, not with the corpus. Every text is read
once, whole; words keep their costs in a bounded cache of the worker.

Defined results: a null text or one without letters is ``und`` with score 0, and so is any text where
nothing could be learned; a null id counts as the empty text for the split; of equally good languages
the first by name is given; repeated rows each get their row; an empty table gives an empty result;
extra columns are not read. Texts are read whole, however long.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import materialise, table
from casework.llm.ranks import byte_slices

ORDER, ROWS, ACCEPT = 5, 2000, 0.5
#: Of four sampled texts one calibrates.
CALIBRATE = 4
START, STOP = "\x02", "\x03"
#: Words and characters of a worker's cache, and characters whose costs are worked out at a time.
KEPT_WORDS, KEPT_CHARS, STEP = 400_000, 8_000_000, 400_000
UNKNOWN = "und"

#: A run of more than 10,000 letters counts as several words.
_WORD = re.compile(r"[^\W\d_]{1,10000}")
_LETTERS = regex.compile(r"\p{L}+")


def held_out(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased and composed."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    found = _WORD.findall(text.lower())
    if found and not "".join(found).isalpha():  # numerals that are neither letters nor decimal digits
        found = [x for w in found for x in _LETTERS.findall(w)]
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Symbols:
    """Characters of ``^word$`` of some words, and hashes of the runs that end at each."""

    def __init__(self, found: list[str]):
        whole = "".join([START + w + STOP for w in found])
        self.chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        begins = self.chars == ord(START)
        self.owner = np.cumsum(begins) - 1
        first = np.flatnonzero(begins)
        self.place = np.arange(len(self.chars)) - first[self.owner] if len(first) else np.zeros(0, dtype=np.int64)
        self.sums = [self.chars + np.uint64(1)]

    def runs(self, n: int) -> np.ndarray:
        """Hash of the ``n`` characters up to each position; only right where ``place >= n - 1``."""
        while len(self.sums) < n:
            before = np.empty_like(self.chars)
            before[:1], before[1:] = 0, self.sums[-1][:-1]
            # The run of n - 1 up to the character before, times a prime, plus this character.
            self.sums.append(before * np.uint64(0x100000001B3) + self.chars + np.uint64(1))
        return _mixed(self.sums[n - 1] + np.uint64(n))


def _grams(counts: dict[str, int], n: int) -> tuple[np.ndarray, ...]:
    """Runs of ``n`` characters of weighted words: hash, context, end part, whether at a word's start, occurrences."""
    of = Symbols(list(counts))
    weight = np.array(list(counts.values()), dtype=np.int64)
    at = np.flatnonzero((of.place >= n - 1) & (of.place >= 1))
    run = of.runs(n)[at]
    context = of.runs(n - 1)[at - 1] if n > 1 else np.zeros(len(at), dtype=np.uint64)
    end = of.runs(n - 1)[at] if n > 1 else np.zeros(len(at), dtype=np.uint64)
    kinds, first, back = np.unique(run, return_index=True, return_inverse=True)
    times = np.bincount(back, weight[of.owner[at]], len(kinds)).astype(np.int64)
    return kinds, context[first], end[first], (of.place[at] == n - 1)[first], times


class Model:
    """One language: per order sorted hashes of runs, log10 of their last character's probability and of the weight they pass on."""

    def __init__(self, runs: list[np.ndarray], logs: list[np.ndarray], back: list[np.ndarray], other: float):
        self.runs, self.logs, self.back, self.other = runs, logs, back, other

    @classmethod
    def fit(cls, counts: dict[str, int], order: int = ORDER) -> Model:
        levels = [_grams(counts, n) for n in range(1, order + 1)]
        alphabet = len(levels[0][0]) + 1  # and any other character
        runs, probs, gives, given0 = [], [], [], 1.0
        for n in range(1, order + 1):
            kinds, context, end, initial, times = levels[n - 1]
            seen = times
            if n < order:
                before, different = np.unique(levels[n][2], return_counts=True)
                spot = np.minimum(np.searchsorted(before, kinds), max(0, len(before) - 1))
                left = np.where(before[spot] == kinds, different[spot], 0) if len(before) else np.zeros(len(kinds), dtype=np.int64)
                seen = np.where(initial, times, left) if n > 1 else np.maximum(left, 1)
            once, twice = int((seen == 1).sum()), int((seen == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.75
            hosts, host = np.unique(context, return_inverse=True)
            total, kindred = np.bincount(host, seen, len(hosts)), np.bincount(host, minlength=len(hosts))
            passed = discount * kindred / total
            lower = np.full(len(kinds), 1 / alphabet)
            if n > 1:
                lower = probs[-1][np.searchsorted(runs[-1], end)]
            p = (seen - discount) / total[host] + passed[host] * lower
            if n == 1:
                given0 = passed[0] / alphabet if len(hosts) else 1 / alphabet
            else:
                gives.append((hosts, passed))
            runs.append(kinds)
            probs.append(p)
        back = []
        for n in range(1, order + 1):
            weight = np.ones(len(runs[n - 1]))
            if n < order:
                hosts, passed = gives[n - 1]
                spot = np.minimum(np.searchsorted(hosts, runs[n - 1]), max(0, len(hosts) - 1))
                weight = np.where(hosts[spot] == runs[n - 1], passed[spot], 1.0) if len(hosts) else weight
            back.append(np.log10(weight).astype(np.float32))
        # The start mark alone is a context, but never predicted: it stands first with its weight.
        mark = Symbols([""]).runs(1)[:1]
        hosts, passed = gives[0] if gives else (mark[:0], mark[:0])
        spot = np.flatnonzero(hosts == mark)
        at = np.searchsorted(runs[0], mark[0])
        runs[0] = np.insert(runs[0], at, mark)
        probs[0] = np.insert(probs[0], at, 1.0)
        back[0] = np.insert(back[0], at, np.float32(math.log10(passed[spot[0]]) if len(spot) else 0))
        return cls(runs, [np.log10(p).astype(np.float32) for p in probs], back, math.log10(given0))

    def symbol_logs(self, of: Symbols) -> np.ndarray:
        """Log10 probability of every character; 0 for start marks."""
        n = len(of.chars)
        out, passed = np.full(n, self.other), np.zeros(n)
        for k, (runs, logs, back) in enumerate(zip(self.runs, self.logs, self.back), 1):
            run = of.runs(k)
            spot = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
            known = (runs[spot] == run) & (of.place >= k - 1) & (of.place >= 1)
            # A context of k - 1 characters that does not know this one passes its weight on.
            out = np.where(known, logs[spot], np.where(of.place >= k - 1, out + passed, out))
            is_context = (runs[spot] == run) & (of.place >= k - 1)
            weight = np.where(is_context, back[spot], 0.0)
            passed = np.empty(n)
            passed[:1], passed[1:] = 0, weight[:-1]
        out[of.place == 0] = 0
        return out

    def word_logs(self, found: list[str]) -> np.ndarray:
        of = Symbols(found)
        return np.bincount(of.owner, self.symbol_logs(of), len(found))


class Scorer:
    """Costs of texts under the models of some languages, with a cache of word costs."""

    def __init__(self, models: dict[str, Model]):
        self.langs = sorted(models)
        self.models = [models[x] for x in self.langs]
        self.known: dict[str, int] = {}
        self.chars = 0
        self.costs = np.zeros((0, len(self.langs)), dtype=np.float32)

    def _costs(self, found: list[str]) -> np.ndarray:
        ends = np.cumsum([len(w) + 2 for w in found])
        cuts = np.unique(np.searchsorted(ends, np.arange(STEP, int(ends[-1]) + STEP, STEP))) if found else []
        out, at = [np.zeros((0, len(self.langs)))], 0
        for cut in [*cuts, len(found)]:
            if cut > at:
                out.append(np.stack([m.word_logs(found[at:cut]) for m in self.models], axis=1))
                at = cut
        return -np.concatenate(out)

    def totals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: cost in log10 units under each language, and characters scored."""
        if len(self.known) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.known, self.costs, self.chars = {}, self.costs[:0], 0
        fresh = list(dict.fromkeys(w for t in texts for w in t if w not in self.known))
        at = len(self.known)
        self.known.update(zip(fresh, range(at, at + len(fresh))))
        self.chars += sum(map(len, fresh))
        self.costs = np.concatenate([self.costs, self._costs(fresh).astype(np.float32)])
        cost = np.zeros((len(texts), len(self.langs)))
        size = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                cost[i] = self.costs[list(map(self.known.__getitem__, t))].sum(0, dtype=np.float64)
                size[i] = sum(map(len, t)) + len(t)
        return cost, size


def answers(cost: np.ndarray, size: np.ndarray, usual: np.ndarray, curve: np.ndarray, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the best language, its calibrated probability and the features behind it.

    ``without`` withholds one language per text.
    """
    rate = cost / np.maximum(size, 1)[:, None]
    if without is not None:
        rate = rate.copy()
        rate[np.arange(len(rate)), without] = np.inf
    best = rate.argmin(1)
    rows = np.arange(len(rate))
    own = rate[rows, best]
    rest = rate.copy()
    rest[rows, best] = np.inf
    second = rest.min(1)
    lead = np.where(np.isfinite(second), second - own, 1.0)
    features = np.stack([np.ones(len(rate)), lead, own - usual[best], np.log1p(size), lead * np.log1p(size)], axis=1)
    return best, 1 / (1 + np.exp(-np.clip(features @ curve, -30, 30))), features


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _texts(batch: pa.RecordBatch, name: str) -> list[list[str]]:
    return [words(t) for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def sample(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """Written texts to learn from: ``text, lang, part``; about ``rows`` of each language."""
    labelled = docs.where(~held_out(F.col("id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    dealt = F.pmod(F.xxhash64("id", "text", F.lit(11)), F.lit(1 << 40))
    # One row per language, as the models that travel later; texts must not meet in a shuffle by language.
    chosen = labelled.withColumn("dealt", dealt).join(F.broadcast(sizes), "lang").where(F.col("dealt") < F.lit(float(rows) * (1 << 40)) / F.col("n"))
    return materialise(chosen.select("text", "lang", F.pmod(F.xxhash64("id", "text", F.lit(12)), F.lit(CALIBRATE)).alias("part")), "language-sample")


def fit_models(chosen: DataFrame, order: int = ORDER) -> dict[str, Model]:
    """The model of each language in a written sample."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(parts):
            found: dict[str, Counter] = {}
            for lang, ws in zip(batch.column(1).to_pylist(), _texts(batch, "text")):
                found.setdefault(lang, Counter()).update(ws)
            flat = [(lang, w, c) for lang, ws in found.items() for w, c in ws.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "word", "c"), x)) for x in flat], schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("c", pa.int64())]))

    def fit(found: pa.Table) -> pa.Table:
        counts = dict(zip(found.column("word").to_pylist(), found.column("c").to_pylist()))
        model = Model.fit({w: counts[w] for w in sorted(counts)}, order)
        pack = lambda arrays, kind: [x.astype(kind).tobytes() for x in arrays]
        return pa.table(
            [
                found.column("lang").combine_chunks().slice(0, 1), pa.array([pack(model.runs, "<u8")], pa.list_(pa.binary())), pa.array([pack(model.logs, "<f4")], pa.list_(pa.binary())),
                pa.array([pack(model.back, "<f4")], pa.list_(pa.binary())), pa.array([model.other]),
            ],
            names=["lang", "runs", "logs", "back", "other"],
        )

    counted = chosen.where("part > 0").select("text", "lang").mapInArrow(count, "lang string, word string, c long")
    counted = counted.groupBy("lang", "word").agg(F.sum("c").alias("c"))
    rows = counted.groupBy("lang").applyInArrow(fit, "lang string, runs array<binary>, logs array<binary>, back array<binary>, other double").collect()
    load = lambda blobs, kind: [np.frombuffer(bytes(b), dtype=kind) for b in blobs]
    return {r.lang: Model(load(r.runs, "<u8"), load(r.logs, "<f4"), load(r.back, "<f4"), r.other) for r in rows}


def calibrate(chosen: DataFrame, models: dict[str, Model]) -> tuple[np.ndarray, np.ndarray]:
    """Usual cost per character of each language, and the curve from features to probability."""
    langs = sorted(models)
    shared = chosen.sparkSession.sparkContext.broadcast(models)

    def costs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in byte_slices(parts):
            cost, size = scorer.totals(_texts(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(cost), pa.list_(pa.float64())), pa.array(size)], names=["lang", "cost", "size"])

    # Sorted, so that sums do not depend on the order of arrival.
    got = sorted(tuple(r) for r in chosen.where("part = 0").select("text", "lang").mapInArrow(costs, "lang string, cost array<double>, size long").collect())
    got = [r for r in got if r[0] in models and r[2]]
    if not got:
        return np.zeros(len(langs)), np.zeros(5)
    truth = np.array([langs.index(r[0]) for r in got])
    cost, size = np.array([r[1] for r in got]), np.array([r[2] for r in got])
    own = cost[np.arange(len(got)), truth] / size
    usual = np.array([own[truth == k].mean() if (truth == k).any() else own.mean() for k in range(len(langs))])
    best, _, x = answers(cost, size, usual, np.zeros(5))
    y = (best == truth).astype(float)
    if len(langs) > 1:
        _, _, strange = answers(cost, size, usual, np.zeros(5), without=truth)
        x, y = np.concatenate([x, strange]), np.concatenate([y, np.zeros(len(strange))])
    return usual, logistic(x, y)


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = ROWS, order: int = ORDER, accept: float = ACCEPT) -> DataFrame:
    """Per row: ``id, held_out, lang_pred, score, accepted, entropy`` (log10 units per character)."""
    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    chosen = sample(slim, rows)
    models = fit_models(chosen, order)
    usual, curve = calibrate(chosen, models) if models else (np.zeros(0), np.zeros(5))
    shared = docs.sparkSession.sparkContext.broadcast((models, usual, curve))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, usual, curve = shared.value
        scorer = Scorer(models)
        for batch in byte_slices(parts, 4 << 20):
            texts, n = _texts(batch, "text"), batch.num_rows
            pred, score, entropy = [UNKNOWN] * n, np.zeros(n), np.zeros(n)
            if models:
                cost, size = scorer.totals(texts)
                best, sure, _ = answers(cost, size, usual, curve)
                lettered = size > 0
                pred = [scorer.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                score = np.where(lettered, sure, 0.0)
                entropy = np.where(lettered, cost[np.arange(n), best] / np.maximum(size, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(entropy)], names=["id", "lang_pred", "score", "entropy"])

    scored = slim.select("id", "text").mapInArrow(run, "id long, lang_pred string, score double, entropy double")
    return scored.select("id", held_out(F.col("id")).alias("held_out"), "lang_pred", "score", (F.col("score") >= accept).alias("accepted"), "entropy")


def op12_language(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).withColumnRenamed("id", "doc_id")
