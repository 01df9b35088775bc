"""Mixing sources to target weights by hierarchical budgets over a domain-language-source tree.

Leaves are (domain, lang, source). A node's budget goes to its children by weight; a child whose
share exceeds what it can give (its tokens times ``epochs``) is filled, and what it lacks goes to
its siblings first. Only when all siblings are full does a shortage reach the next ancestor,
because a node's capacity is the sum of its leaves'. Budgets are whole tokens.

A leaf with budget b and T tokens gives b div T whole epochs, and from one more epoch a prefix of
b mod T tokens in seeded order. Prefixes are found without sorting a leaf: rows fall into ordered
hash buckets, sized by the row count, bucket totals give each bucket its offset, and only rows of
one (leaf, bucket) meet in a window. A leaf with a third of all rows is many buckets.

Defined results: null domain, language or source is a leaf of its own; a null or empty text has no
tokens, belongs to every epoch of its leaf and to a prefix if the prefix reaches its place; rows
that tie (same id and size) are interchangeable; an empty table gives no rows; extra columns pass
through. Weights are whole numbers; budget times total weight must stay below 2^63.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.llm.common import materialise, text_or_empty

EPOCHS = 4
SEED = 17
ROWS_PER_BUCKET = 20_000
#: Weight of a name at its level; others have weight 1. Levels are domain, lang, source.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 5, "reference": 3, "code": 2},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}
LEVELS = ("domain", "lang", "source")


def n_tokens(text: Column) -> Column:
    """Words between spaces and the control characters 09 to 0D."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def domain_of(source: Column) -> Column:
    """Domain of a source of the standard tables: by the number in its name."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d+)$", 1)
    return F.when(number == "", "web").otherwise(F.element_at(F.array(*map(F.lit, ("web", "web", "reference", "code"))), (F.pmod(number.cast("long"), F.lit(4)) + 1).cast("int")))


def weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for name, value in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, value).otherwise(out)
    return out.cast("long")


def _fill(nodes: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """Split ``parent_budget`` over the children of each parent: columns ``w``, ``cap`` in, ``budget`` out.

    In order of cap / w, child i is full iff all before it are and the level at which it fills
    costs at most the parent's budget; the rest share what is left by weight, remainders going to
    the first of them.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    rank = by.orderBy((F.col("cap") / F.col("w")), *order)
    past = rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = nodes.withColumn("caps", F.sum("cap").over(past)).withColumn("later", F.sum("w").over(by) - F.sum("w").over(past))
    full = (F.col("caps") * F.col("w") + F.col("cap") * F.col("later")) <= F.col("parent_budget") * F.col("w")
    out = out.withColumn("open", (~full).cast("int")).withColumn("open", F.max("open").over(past))
    left = F.col("parent_budget") - F.sum(F.when(F.col("open") == 0, F.col("cap")).otherwise(0)).over(by)
    share = F.sum(F.when(F.col("open") == 1, F.col("w")).otherwise(0)).over(by)
    out = out.withColumn("left", left).withColumn("share", share)
    out = out.withColumn("part", F.when(F.col("open") == 1, F.expr("(left * w) div share")).otherwise(F.col("cap")))
    spare = F.col("left") - F.sum(F.when(F.col("open") == 1, F.col("part")).otherwise(0)).over(by)
    place = F.sum("open").over(past)
    return out.withColumn("spare", spare).withColumn("budget", F.col("part") + F.when((F.col("open") == 1) & (place <= F.col("spare")), 1).otherwise(0))


def budgets(leaves: DataFrame, budget: int | None = None, epochs: int = EPOCHS, weights=WEIGHTS) -> DataFrame:
    """Leaves ``domain, lang, source, tokens`` with ``budget``; the default total is the corpus size."""
    capped = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0))) if budget is None else F.lit(budget).cast("long")
    level = capped.withColumn("all", total)
    for depth, name in enumerate(LEVELS):
        up, own = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        extra = F.max("all").alias("parent_budget") if not depth else F.max("budget").alias("parent_budget")
        nodes = level.groupBy(*own).agg(F.sum("cap").alias("cap"), extra)
        nodes = nodes.withColumn("parent_budget", F.least("parent_budget", F.sum("cap").over(Window.partitionBy(*up) if up else Window.partitionBy(F.lit(0)))))
        filled = _fill(nodes.withColumn("w", weight(name, weights)), up, [name]).select(*own, "budget")
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in own]
        kept = [F.col(f"l.{c}") for c in level.columns if c != "budget"]
        level = level.alias("l").join(filled.alias("f"), on=_all(same)).select(*kept, "f.budget")
    return level.select(*LEVELS, "tokens", "budget")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def mix(docs: DataFrame, id: str = "doc_id", budget: int | None = None, epochs: int = EPOCHS, seed: int = SEED, weights=WEIGHTS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows of ``docs`` (columns ``domain, lang, source, tokens`` among them), once per epoch that
    selects them, with ``epoch``, ``take`` (tokens of the row in the mixture) and ``leaf_budget``."""
    written = docs
    buckets = max(1, written.count() // rows_per_bucket)
    key = lambda epoch: F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id).cast("string"), F.lit("null"))))
    leaf = budgets(written.groupBy(*LEVELS).agg(F.sum("tokens").cast("long").alias("tokens")), budget, epochs, weights)
    leaf = leaf.select(
        *[F.col(c).alias(f"k_{c}") for c in LEVELS], F.col("budget").alias("leaf_budget"),
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0)).alias("rest"),
    )
    leaf = materialise(leaf, "leaf-budgets")
    same = _all([F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in LEVELS])
    salted = leaf.withColumn("k_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    salt = F.pmod(F.xxhash64(id), F.lit(16)).cast("int")
    joined = written.withColumn("salt", salt).join(salted, same & (F.col("salt") == F.col("k_salt"))).drop(*[f"k_{c}" for c in LEVELS], "k_salt", "salt")
    joined = joined.withColumn("place", key(F.col("whole")))
    # The first 13 hexadecimal digits stay exact in a double, so buckets follow the order of the hash.
    joined = joined.withColumn("bucket", F.floor(F.conv(F.substring("place", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52)) * buckets).cast("long"))
    totals = joined.where("rest > 0").groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"b_{c}") for c in LEVELS], F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0)).alias("offset"))
    whole = joined.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))).withColumn("take", F.col("tokens"))
    inside = Window.partitionBy(*LEVELS, "bucket").orderBy("place", id, "tokens").rowsBetween(Window.unboundedPreceding, -1)
    part = joined.where("rest > 0").withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    part = part.join(totals, _all([F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in LEVELS]) & (F.col("bucket") == F.col("b_bucket")))
    start = F.col("offset") + F.col("inner")
    part = part.withColumn("epoch", F.col("whole")).withColumn("take", F.least(F.col("tokens"), F.col("rest") - start)).where(start < F.col("rest"))
    columns = [*docs.columns, "epoch", "take", "leaf_budget"]
    return whole.select(*columns).unionByName(part.select(*columns))


def op1_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = docs.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", n_tokens(text_or_empty()).alias("tokens"))
    return mix(materialise(slim, "token-counts"))


def _level_sql(depth: int) -> str:
    own, up = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
    name, over = LEVELS[depth], f"PARTITION BY {', '.join(LEVELS[:depth])}" if depth else ""
    cases = " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in WEIGHTS[name].items())
    source = "SELECT *, sum(tokens) OVER () AS up FROM leaves" if not depth else f"SELECT leaves.*, p.budget AS up FROM leaves JOIN f{depth - 1} p ON " + " AND ".join(f"leaves.{c} IS NOT DISTINCT FROM p.{c}" for c in LEVELS[:depth])
    return f"""
n{depth} AS (SELECT {own}, sum(tokens * {EPOCHS})::BIGINT AS cap, max(up)::BIGINT AS up, CASE {cases} ELSE 1 END AS w FROM ({source}) GROUP BY {own}),
m{depth} AS (SELECT * REPLACE (least(up, sum(cap) OVER ({over})) AS up), sum(cap) OVER r AS caps, sum(w) OVER ({over}) - sum(w) OVER r AS later
  FROM n{depth} WINDOW r AS ({over} ORDER BY cap / w, {name} NULLS FIRST ROWS UNBOUNDED PRECEDING)),
o{depth} AS (SELECT *, max(CASE WHEN caps * w + cap * later <= up * w THEN 0 ELSE 1 END) OVER ({over} ORDER BY cap / w, {name} NULLS FIRST ROWS UNBOUNDED PRECEDING) AS opened FROM m{depth}),
s{depth} AS (SELECT *, up - sum(CASE WHEN opened = 0 THEN cap ELSE 0 END) OVER ({over}) AS lft, sum(CASE WHEN opened = 1 THEN w ELSE 0 END) OVER ({over}) AS share FROM o{depth}),
p{depth} AS (SELECT *, CASE WHEN opened = 1 THEN (lft * w) // share ELSE cap END AS part FROM s{depth}),
q{depth} AS (SELECT *, lft - sum(CASE WHEN opened = 1 THEN part ELSE 0 END) OVER ({over}) AS spare,
  sum(opened) OVER ({over} ORDER BY cap / w, {name} NULLS FIRST ROWS UNBOUNDED PRECEDING) AS place FROM p{depth}),
f{depth} AS (SELECT {own}, (part + CASE WHEN opened = 1 AND place <= spare THEN 1 ELSE 0 END)::BIGINT AS budget FROM q{depth})"""


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'web'
      ELSE ['web', 'web', 'reference', 'code'][CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 + 1] END AS domain,
    lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents
), leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
{_level_sql(0).strip()},
{_level_sql(1).strip()},
{_level_sql(2).strip()},
j AS (SELECT d.*, f2.budget AS leaf_budget, CASE WHEN l.tokens > 0 THEN f2.budget // l.tokens ELSE 0 END AS whole, CASE WHEN l.tokens > 0 THEN f2.budget % l.tokens ELSE 0 END AS rest
  FROM d JOIN leaves l ON d.domain = l.domain AND d.lang IS NOT DISTINCT FROM l.lang AND d.source IS NOT DISTINCT FROM l.source
  JOIN f2 ON d.domain = f2.domain AND d.lang IS NOT DISTINCT FROM f2.lang AND d.source IS NOT DISTINCT FROM f2.source),
k AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM j)
SELECT doc_id, domain, lang, source, tokens, unnest(range(0, whole))::BIGINT AS epoch, tokens AS take, leaf_budget FROM j WHERE whole > 0
UNION ALL SELECT doc_id, domain, lang, source, tokens, whole, least(tokens, rest - start)::BIGINT, leaf_budget FROM k WHERE start < rest
"""


def mixed_documents(docs: DataFrame, budget: int | None = None, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` (the standard table's columns) as the mixture: a row per epoch that selects it.

    The row at a leaf's boundary keeps the words of its part of the prefix.
    """
    names = {c: f"doc_{c}" for c in docs.columns if c not in ("doc_id", "lang", "source")}
    slim = docs.withColumnsRenamed(names).withColumn("domain", domain_of(F.col("source"))).withColumn("tokens", n_tokens(text_or_empty("doc_text")))
    mixed = mix(slim, budget=budget, epochs=epochs)
    cut = F.col("take") < F.col("tokens")
    found = F.regexp_extract_all("doc_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(found, F.lit(1), F.col("take").cast("int")), " ")
    mixed = mixed.withColumn("head", F.when(cut, head))
    out = {"text": F.when(cut, F.col("head")).otherwise(F.col("doc_text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(cut, F.length("head").cast("long")).otherwise(F.col("doc_n_chars"))
    return mixed.select(*[out[c].alias(c) if c in out else F.col(names.get(c, c)).alias(c) for c in docs.columns])
