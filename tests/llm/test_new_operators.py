"""Collocations, language identification and resampling against brute force, and on untidy tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from casework.llm import collocations, language, ranks, resampling
from tests.llm.test_operators import DOCS, SF, UNTIDY


@pytest.fixture()
def untidy(spark):
    clash = {"id": 1, "score": "x", "rank": "y", "block": 2, "code": 3}
    return spark.createDataFrame(UNTIDY, DOCS).withColumns({k: F.lit(v) for k, v in clash.items()})


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Collocations.


def collocations_of(rows, least, longest, cover, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        able = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in able.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in able.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


TALK = [
    ("en", "New York city. New York state, new york! In new york the new york times\tand New  York"),
    ("en", "a a a a a a; b a a b a a\nb a a"),
    ("de", "\u00c4 u \u00c4 u \u00e4 u.\u00c4 u"),
    (None, "x\u00a0y z x\u00a0y z x\u00a0y z"),
    ("en", None), ("en", ""), ("en", ".,;"), ("", "q r q r"),
]


@pytest.mark.parametrize("block, tile, dense, longest", [(1_000_000, 512, 8, 3), (7, 2, 1, 3), (20, 1, 4, 4), (1, 3, 100, 5)])
def test_collocations_equal_brute_force(spark, monkeypatch, block, tile, dense, longest):
    for name, value in (("BLOCK", block), ("TILE", tile), ("DENSE", dense)):
        monkeypatch.setattr(collocations, name, value)
    rows = TALK * 3
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.mine(df, least=3, longest=longest, top=8).collect()
    assert sorted(tuple(r) for r in got) == collocations_of(rows, 3, longest, 50, 8)


def test_tiles_count_every_pair():
    rng = np.random.default_rng(0)
    left, right = (rng.zipf(1.3, 20_000) % 3000).astype(np.int64), (rng.zipf(1.5, 20_000) % 900).astype(np.int64)
    codes, counts = collocations.tile_counts(left, right)
    want = Counter(zip(left.tolist(), right.tolist()))
    bits = collocations.WORD_BITS
    assert {(c >> bits, c & (1 << bits) - 1): n for c, n in zip(codes.tolist(), counts.tolist())} == want and len(codes) == len(want)


def test_collocations_untidy_and_empty(spark, untidy):
    rows = [(r.lang, r.text) for r in untidy.collect()]
    got = collocations.mine(untidy, least=2).collect()
    assert sorted(tuple(r) for r in got) == collocations_of(rows, 2, 3, 50, 2000)
    assert collocations.mine(untidy.limit(0)).collect() == []


# Language identification.


def plain_model(counts, order):
    """Interpolated Kneser-Ney by dictionaries: probability of a character after a context."""
    grams = [Counter() for _ in range(order + 1)]
    for w, c in counts.items():
        s = "^" + w + "$"
        for i in range(1, len(s)):
            for n in range(1, order + 1):
                if i - n + 1 >= 0:
                    grams[n][s[i - n + 1 : i + 1]] += c
    seen = [None]
    for n in range(1, order + 1):
        if n == order:
            seen.append(dict(grams[n]))
            continue
        left = Counter(g[1:] for g in grams[n + 1])
        seen.append({g: grams[n][g] if g[0] == "^" else left[g] for g in grams[n]})
    v = len(grams[1]) + 1

    def p(char, context):
        if context is None:
            return 1 / v
        n = len(context) + 1
        lower = p(char, context[1:] if context else None)
        ones, twos = (sum(x == k for x in seen[n].values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.75
        kin = {g[-1]: c for g, c in seen[n].items() if g[:-1] == context}
        total = sum(kin.values())
        if not total:
            return lower
        return max(kin.get(char, 0) - d, 0) / total + d * len(kin) / total * lower

    return p


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_language_model_equals_plain_kneser_ney(order):
    counts = {"banana": 3, "band": 1, "an": 7, "\u00e9t\u00e9": 2, "b": 1, "nab": 1}
    model, p = language.Model.fit(counts, order), plain_model(counts, order)
    for word in ("banana", "bandana", "zb", "", "\u00e9tan", "nnn"):
        s = "^" + word + "$"
        want = sum(math.log10(p(s[i], s[max(0, i - order + 1) : i])) for i in range(1, len(s)))
        assert model.word_logs([word])[0] == pytest.approx(want, rel=1e-5)


def test_language_model_is_a_distribution():
    counts = {"banana": 3, "band": 1, "an": 7, "nab": 1}
    p = plain_model(counts, 4)
    for context in ("", "^", "an", "^ba", "zzz", "nan"):
        assert sum(p(c, context) for c in "band$") + p("?", context) == pytest.approx(1)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.id: r for r in language.identify(docs).collect()}
    held = [(r.doc_id, r.lang) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and {i for i, r in rows.items() if r.held_out} == {i for i, _ in held}
    assert sum(rows[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_held_out_labels_and_partitions_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    key = lambda df: sorted((r.id, r.lang_pred, round(r.score, 6)) for r in language.identify(df).collect())
    want = key(docs)
    other = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).repartition(7)
    assert key(other) == want


def test_foreign_texts_are_not_accepted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(900_000 + i, "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 " * 20, None) for i in range(3)], docs.schema)
    rows = [r for r in language.identify(docs.unionByName(strange)).collect() if r.id >= 900_000]
    assert len(rows) == 3 and not any(r.accepted for r in rows) and all(r.lang_pred in ("de", "en", "es", "fr") for r in rows)


def test_language_untidy_and_empty(spark, untidy):
    more = [(20, "123 \u00bd \u2460 !", "en"), (21, "\u00bdabc", "en"), (22, "x" * 300_000, "en"), (23, "\u0301\ud55c\uae00", None)]
    df = untidy.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    rows = language.identify(df).collect()
    assert len(rows) == len(UNTIDY) + len(more)
    by = {r.id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5, 20))
    assert all(by[i].lang_pred != "und" for i in (1, 2, 6, 7, 21, 22, 23))
    nothing = language.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.identify(df.limit(0)).collect() == []
    one = language.identify(df.withColumn("lang", F.lit("en"))).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}


# Resampling.


def resample_plain(docs, target, share, least, seed, size):
    def features(text):
        w = re.findall("[^\x00-/:-`{-\x7f]+", low(text))
        return w, [zlib.crc32(f.encode()) % size for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = (Counter(b for x in part for b in features(x)[1]) for part in ([x for _, x in docs], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + size) / ((s[b] + 1) * (sum(t.values()) + size)))) for b in range(size)]
    rows = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = able[: len(able) * share // 100]
    return Counter((*r, k) for k, r in enumerate(drawn, 1)) + Counter((*r, None) for r in able[len(drawn) :] + [r for r in rows if r[1] < least])


@pytest.mark.parametrize("share, least, size", [(25, 20, 10_000), (100, 0, 7), (0, 0, 100), (60, 1, 1)])
def test_resampling_equals_brute_force(spark, untidy, share, least, size):
    docs = untidy.unionByName(untidy).repartition(3)
    target = spark.createDataFrame([("word1 word2 Word3",), (None,), ("caf\u00e9-short text",)], "text string")
    got = resampling.resample(docs, target, share=share, least=least, size=size).collect()
    want = resample_plain([(r[0], r[1]) for r in UNTIDY] * 2, [r.text for r in target.collect()], share, least, 7, size)
    assert Counter((r.id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got) == want


def test_resampling_without_rows_or_targets(spark, untidy):
    none = untidy.select("text").limit(0)
    assert resampling.resample(untidy.limit(0), none).collect() == []
    assert len(resampling.resample(untidy, none).collect()) == len(UNTIDY)


def test_cut_offs_and_numbers_equal_a_sort(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b), i) for i, (a, b) in enumerate(zip(rng.integers(-10, 10, 500), rng.integers(0, 3, 500)))] + [(2**62, 0, 500), (-(2**62), 0, 501)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(4).cache()
    order = sorted(rows)
    for k in (0, 1, 2, 13, 250, 501, 502, 900):
        assert sorted(tuple(r) for r in df.where(ranks.cutoff(df, ["a", "b", "i"], k)).collect()) == order[:k]
    got = ranks.numbered(df, [F.col("a"), F.col("b"), F.col("i")], "place", 1).collect()
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.place)] == order and sorted(r.place for r in got) == list(range(1, 503))
    assert ranks.numbered(df.limit(0), [F.col("a")], "place").collect() == []
