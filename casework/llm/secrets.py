"""Secret scan with multipart credential linking.

Three plain kinds (assignments, access identifiers, long hexadecimal runs) are always reported.
Weak candidates, i.e. long mixed tokens and endpoint addresses, are reported only near a
complementary part of the same document: a mixed token needs an access identifier within
``REACH`` characters, an endpoint an access identifier or an assignment.

Linking is an interval join on (document, bucket of REACH characters). The anchors of a bucket
are first reduced to their smallest and largest start: an anchor within reach of a candidate lies
in its bucket, or it is the last of the bucket before or the first of the bucket after. So
the join is exact and produces at most three rows per candidate, never pairs.

Defined results: a null or empty text has no span; equal rows get equal rows; extra columns are
not read; an empty table gives an empty result. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import materialise, text_or_empty

REACH = 200
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Pattern per kind; the order is the order of kinds at equal starts.
PLAIN: dict[str, str] = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
WEAK: dict[str, str] = {
    "candidate": r"[A-Za-z0-9+/=_-]{18,}",
    "endpoint": r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?",
}
#: What a whole match of a kind must hold besides.
HOLDS = {"candidate": ("[0-9]", "[A-Za-z]")}
#: Kinds that make a weak candidate worth reporting.
ANCHORS: dict[str, tuple[str, ...]] = {"candidate": ("access",), "endpoint": ("access", "assign")}
KINDS = (*PLAIN, *WEAK)
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def spans(text: str, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, kind number, end).

    Starts follow from the lengths of the matches and of the text between them. Matches that lack
    what ``HOLDS`` asks for are passed over whole.
    """
    holds = " AND ".join(f"x.hit RLIKE '{p}'" for p in HOLDS.get(kind, ())) or "true"
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    build = f"""aggregate(
      zip_with(split({text}, '{quoted}', -1), regexp_extract_all({text}, '{quoted}', 0), (g, h) -> struct(g AS gap, h AS hit)),
      struct(0 AS at, cast(array() AS {_SPANS}) AS out),
      (acc, x) -> CASE WHEN x.hit IS NULL THEN acc ELSE struct(
        acc.at + length(x.gap) + length(x.hit) AS at,
        CASE WHEN {holds} THEN concat(acc.out, array(struct(acc.at + length(x.gap) AS start, {KINDS.index(kind)} AS kind, acc.at + length(x.gap) + length(x.hit) AS end))) ELSE acc.out END AS out) END,
      acc -> acc.out)"""
    return F.expr(f"CASE WHEN {text} RLIKE '{quoted}' THEN {build} ELSE cast(array() AS {_SPANS}) END")


def plain_spans(text: str, kind: str) -> Column:
    """Spans of a plain kind; assignments with a short value are matched and then dropped."""
    found = spans(text, kind, PLAIN[kind])
    if kind != "assign":
        return found
    value = lambda s: F.regexp_extract(F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]), ASSIGN, 2)
    return F.filter(found, lambda s: F.length(value(s)) >= 8)


def linked(found: DataFrame, key: Sequence[str], reach: int = REACH) -> DataFrame:
    """``*key, links``: the weak spans of ``found`` near an anchor span, from columns named like kinds."""
    both = F.lit(False)
    for weak, anchors in ANCHORS.items():
        for a in anchors:
            both = both | ((F.size(weak) > 0) & (F.size(a) > 0))
    some = found.where(both)
    bucket = lambda c: F.expr(f"{c} div {reach}")
    parts = []
    for weak, anchors in ANCHORS.items():
        spots = some.select(*key, F.explode(F.concat(*anchors)).alias("s")).withColumn("bucket", bucket("s.start"))
        spots = spots.groupBy(*key, "bucket").agg(F.min("s.start").alias("first"), F.max("s.start").alias("last"))
        spots = spots.select(*[F.col(k).alias(f"a_{k}") for k in key], F.col("bucket").alias("a_bucket"), "first", "last")
        mine = some.select(*key, F.explode(weak).alias("s")).withColumn("bucket", F.explode(F.array(*[bucket("s.start") + d for d in (-1, 0, 1)])))
        same = F.col("bucket") == F.col("a_bucket")
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"a_{k}"))
        near = (F.abs(F.col("first") - F.col("s.start")) <= reach) | (F.abs(F.col("last") - F.col("s.start")) <= reach)
        parts.append(mine.join(spots, same & near).select(*key, "s"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*key).agg(F.collect_set("s").alias("links"))


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """Per row: id, digest of the text, the plain kinds' span arrays and ``links``, the reported weak spans.

    Texts are read once: their spans are written, weak ones only beside an anchor, and links
    are sought in that table.
    """
    rows = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.select("doc_id", "text", F.md5("text").alias("digest"), *[plain_spans("text", k).alias(k) for k in PLAIN])
    anchored = F.size(F.concat(*{a for v in ANCHORS.values() for a in v})) > 0
    none = F.expr(f"cast(array() AS {_SPANS})")
    key = ["doc_id", "digest"]
    weak = rows.select(*key, *PLAIN, *[F.when(anchored, spans("text", k, p)).otherwise(none).alias(k) for k, p in WEAK.items()])
    overlaps = lambda s: F.exists(F.concat(*PLAIN), lambda p: (p["start"] < s["end"]) & (s["start"] < p["end"]))
    found = materialise(weak.withColumn("candidate", F.filter("candidate", lambda s: ~overlaps(s))), "spans")
    links = linked(found, key, reach).select(F.col("doc_id").alias("l_id"), F.col("digest").alias("l_digest"), "links")
    same = F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("digest") == F.col("l_digest"))
    return found.join(links, same, "left").select(*key, *PLAIN, F.coalesce("links", none).alias("links"))


def written(found: Column) -> Column:
    """Spans as text, kind:start:end by start."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op8_secrets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.concat(*PLAIN)
    return find(docs).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in PLAIN],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.concat(base, "links")).alias("spans"),
    )


def redact(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with each reported span replaced by its kind in brackets and ``n_chars`` counted anew."""
    rows = find(docs.select("doc_id", "text"), reach=reach)
    every = F.array_sort(F.concat(*PLAIN, "links"))
    spots = rows.where(F.size(every) > 0).select(F.col("doc_id").alias("r_id"), F.col("digest").alias("r_digest"), every.alias("r_spans")).dropDuplicates(["r_id", "r_digest"])
    # Overlapping spans: text between the furthest end so far and the next start is kept.
    built = F.expr(f"""aggregate(r_spans, struct(0 AS at, '' AS out),
      (acc, s) -> CASE WHEN s.end <= acc.at THEN acc ELSE struct(s.end AS at,
        concat(acc.out, substring(text, acc.at + 1, greatest(s.start - acc.at, 0)), '[', element_at(array({', '.join(repr(k) for k in KINDS)}), s.kind + 1), ']') AS out) END,
      acc -> concat(acc.out, substring(text, acc.at + 1, length(text))))""")
    full = docs.withColumn("__digest", F.md5(text_or_empty()))
    joined = full.join(spots, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("__digest") == F.col("r_digest")), "left")
    joined = joined.withColumn("r_clean", F.when(F.col("r_spans").isNotNull(), built))
    out = {"text": F.coalesce("r_clean", "text"), "n_chars": F.when(F.col("r_clean").isNull(), F.col("n_chars")).otherwise(F.length("r_clean").cast("long"))}
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


def _spans_sql(kind: str, pattern: str) -> str:
    return f"""SELECT rid, unnest([{{'start': list_sum([length(g) for g in gaps[1:i]])::BIGINT + coalesce(list_sum([length(h) for h in hits[1:i - 1]]), 0)::BIGINT, 'hit': hits[i], 'kind': '{kind}'}} for i in range(1, len(hits) + 1)], recursive := true)
  FROM (SELECT rid, regexp_extract_all(text, {pattern}) AS hits, regexp_split_to_array(text, {pattern}) AS gaps FROM d WHERE regexp_matches(text, {pattern}))"""


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({_spans_sql("assign", _quote(ASSIGN))} UNION ALL {_spans_sql("access", _quote(PLAIN["access"]))} UNION ALL {_spans_sql("hex", _quote(PLAIN["hex"]))}),
base AS (SELECT rid, kind, start, start + length(hit) AS fin FROM s WHERE kind <> 'assign' OR length(regexp_extract(hit, {_quote(ASSIGN)}, 2)) >= 8),
t AS ({_spans_sql("candidate", "'[A-Za-z0-9+/=_-]{18,}'")}),
e AS ({_spans_sql("endpoint", _quote(WEAK["endpoint"]))}),
weak AS (SELECT rid, kind, start, start + length(hit) AS fin FROM t WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')
    AND NOT EXISTS (FROM base b WHERE b.rid = t.rid AND b.start < t.start + length(hit) AND t.start < b.fin)
  UNION ALL SELECT rid, kind, start, start + length(hit) FROM e),
links AS (SELECT * FROM weak w WHERE EXISTS (FROM base b WHERE b.rid = w.rid AND abs(b.start - w.start) <= {REACH} AND (b.kind = 'access' OR (b.kind = 'assign' AND w.kind = 'endpoint')))),
f AS (SELECT *, list_position(['assign', 'access', 'hex', 'candidate', 'endpoint'], kind) AS k FROM (FROM base UNION ALL FROM links)),
g AS (SELECT rid, string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, k) AS spans, string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, k) FILTER (k <= 3) AS base,
  count(*) FILTER (kind = 'assign') AS n1, count(*) FILTER (kind = 'access') AS n2, count(*) FILTER (kind = 'hex') AS n3 FROM f GROUP BY rid)
SELECT doc_id, coalesce(n1, 0)::BIGINT AS n_assign, coalesce(n2, 0)::BIGINT AS n_access, coalesce(n3, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""
