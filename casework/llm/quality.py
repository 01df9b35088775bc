"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one bit per
failed rule; policies (named, versioned sets of rules) and ablations read the ledger only.

Defined results: a null or empty text has no words and fails ``few_words``; repeated rows and
repeated ids are separate rows; other columns of the input pass through untouched, and those
named like a ledger column are replaced; an empty table gives an empty ledger.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import batches, column_bytes, text_or_empty, words

WINDOW = 8
#: Rule name -> failing condition over the measurements, in integers. The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "stuttering": "100 * n_same_words > 30 * n_words",
}
#: Policy version -> rules it applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": tuple(RULES),
}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_words")
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_CONTINUATION = bytes(range(0x80, 0xC0))


def _repeated(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words per document that lie in a window of WINDOW words found twice or more in it.

    Windows are ranked by doubling (1, 2, 4, 8 words), so equal ranks mean equal words.
    """
    n = len(ids)
    if n < WINDOW:
        return np.zeros(n_docs, dtype=np.int64)
    rank, width = ids, 1
    while width < WINDOW:
        key = rank[:-width].astype(np.int64) * (int(rank.max()) + 1) + rank[width:]
        rank = np.unique(key, return_inverse=True)[1]
        width *= 2
    inside = doc[: len(rank)] == doc[WINDOW - 1 :]
    at = np.flatnonzero(inside)
    key = rank[at].astype(np.int64) * n_docs + doc[at]
    _, group, counts = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[counts[group] >= 2]
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    covered = np.cumsum(edge[:n]) > 0
    return np.bincount(doc[covered], minlength=n_docs).astype(np.int64)


def measure(texts: Sequence[bytes]) -> dict[str, np.ndarray]:
    """Measurements of a batch of UTF-8 texts."""
    n = len(texts)
    out = {name: np.zeros(n, dtype=np.int64) for name in MEASURES}
    seen: dict[bytes, int] = {}
    ids, sizes = [], np.zeros(n, dtype=np.int64)
    for i, text in enumerate(texts):
        found = text.split()
        sizes[i] = len(found)
        joined = b"".join(found)
        out["word_chars"][i] = len(joined.translate(None, _CONTINUATION))
        out["n_symbols"][i] = len(_SYMBOLS.findall(text))
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        ids.extend([seen.setdefault(w, len(seen)) for w in found])
    out["n_words"] = sizes
    doc = np.repeat(np.arange(n, dtype=np.int64), sizes)
    ids = np.asarray(ids, dtype=np.int64)
    out["n_repeat_words"] = _repeated(ids, doc, n)
    same = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    out["n_same_words"] = np.bincount(doc[1:][same], minlength=n).astype(np.int64)
    return out


def ledger(docs: DataFrame, text: str = "text", rules: Mapping[str, str] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failed``, a long with bit i set where rule i fails."""
    keep = [c for c in docs.columns if c not in MEASURES and c != "failed"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = measure(column_bytes(batch, text))
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        return pa.RecordBatch.from_arrays(columns + [pa.array(got[m]) for m in MEASURES], names=keep + list(MEASURES))

    measured = batches(docs.select(*[F.col(f"`{c}`") for c in keep]), run, ", ".join(fields + [f"{m} long" for m in MEASURES]))
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules.values())]
    return measured.withColumn("failed", sum(bits[1:], bits[0]).cast("long"))


def mask(policy: Sequence[str], rules: Mapping[str, str] = RULES) -> int:
    order = list(rules)
    return sum(1 << order.index(name) for name in policy)


def passes(policy: Sequence[str], failed: str = "failed") -> Column:
    """True where no rule of ``policy`` fails."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def ablations(led: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """One row per policy and rule: documents, those the policy rejects, those the rule fails and
    those that only this rule of the policy fails, i.e. that come back without the rule."""
    counted = led.groupBy("failed").agg(F.count("*").alias("n"))  # at most 2^rules rows
    out = []
    for name, chosen in policies.items():
        bits = F.col("failed").bitwiseAND(F.lit(mask(chosen)))
        for rule in chosen:
            bit = mask([rule])
            out.append((name, rule, bits, bit))
    aggregates = [F.sum("n").alias("documents")]
    for i, (_, _, bits, bit) in enumerate(out):
        aggregates += [
            F.sum(F.when(bits != 0, F.col("n")).otherwise(0)).alias(f"r{i}"),
            F.sum(F.when(bits.bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0)).alias(f"f{i}"),
            F.sum(F.when(bits == bit, F.col("n")).otherwise(0)).alias(f"o{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("policy"), F.lit(rule).alias("rule"), F.col("documents"),
            F.col(f"r{i}").alias("rejected"), F.col(f"f{i}").alias("fails"), F.col(f"o{i}").alias("only_this"),
        )
        for i, (name, rule, _, _) in enumerate(out)
    ]
    return counted.agg(*aggregates).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def op6_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text_or_empty().alias("text"))
    led = ledger(docs)
    base = passes(POLICIES["base"])
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), (base & passes(POLICIES[CURRENT])).alias("kept"), "n_lines", "n_same_words", "failed",
    )


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d
), win AS (
  SELECT rid, i, list_slice(w, i, i + 7) AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM m WHERE len(w) >= 8)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n >= 2
), cov AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM rep, range(0, 8) AS r(j) GROUP BY rid
), a AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
         len([i for i in range(2, len(w) + 1) if w[i] = w[i - 1]])::BIGINT AS n_same_words
  FROM m LEFT JOIN cov USING (rid)
), b AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
    + 8 * (100 * n_dup_lines > 60 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT + 64 * (100 * n_same_words > 30 * n_words)::BIGINT AS failed FROM a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, n_lines, n_same_words, failed FROM b
"""
