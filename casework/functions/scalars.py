"""Scalar columns: ids, titles, tags, audit fields, parsing of text into values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions.ordered import running
from casework.functions.text import col, strip, words
from casework.schemas import AUDIT_RECORD, BANDS

# Fixed values.
DEFAULT_CATEGORY = "general"
DEFAULT_AUDIENCE = "internal"
ANONYMOUS = "anonymous"
QUERY_CHARS, RESPONSE_CHARS, CITATION_CHARS, SUMMARY_CHARS = 255, 5000, 2000, 500
AUDIT_LENGTHS = {"query": 5000, "response": 32000}
MAX_SCORE = 4.0


def chunk_id(name: str | Column, index: str | Column, style: str = "sha256") -> Column:
    """Stable id: first 32 hex digits of SHA-256 of ``name:index``, or MD5 of ``name::index``."""
    name, index = col(name), col(index).cast("string")
    if style == "sha256":
        return F.substring(F.sha2(F.concat(name, F.lit(":"), index), 256), 1, 32)
    if style == "md5":
        return F.md5(F.concat(name, F.lit("::"), index))
    raise ValueError(f"unknown style {style!r}")


def title_from_path(path: str | Column) -> Column:
    """File stem with ``_`` and ``-`` as spaces."""
    stem = F.regexp_extract(col(path), r"([^/]*?)(\.[^./]*)?$", 1)
    return F.translate(stem, "_-", "  ")


def source_url(url: str | Column, path: str | Column) -> Column:
    """The given URL, or the path where it is null or empty."""
    return F.coalesce(F.nullif(col(url), F.lit("")), col(path))


def with_tag_defaults(df: DataFrame, tags: str = "tags", run_date: Column | None = None) -> DataFrame:
    """Category, audience and effective date from a tag map, with the defaults for missing tags."""
    tag = F.col(tags)
    return df.withColumns(
        {
            "category": F.coalesce(tag["category"], F.lit(DEFAULT_CATEGORY)),
            "audience": F.coalesce(tag["audience"], F.lit(DEFAULT_AUDIENCE)),
            "effective_date": F.coalesce(
                F.to_date(tag["effective_date"]), run_date if run_date is not None else F.current_date()
            ),
        }
    )


# Index field names.
INDEX_FIELDS = {
    "id": "id",
    "title": "title",
    "content": "content",
    "source_url": "sourceUrl",
    "author": "author",
    "last_modified": "lastModified",
    "chunk_index": "chunkIndex",
    "total_chunks": "totalChunks",
    "content_vector": "contentVector",
}


def to_index_fields(df: DataFrame) -> DataFrame:
    """Index row: known columns under their field names; an empty date becomes null."""
    present = [c for c in INDEX_FIELDS if c in df.columns]
    return df.select(
        *[
            (F.nullif(F.col(c), F.lit("")) if c == "last_modified" else F.col(c)).alias(INDEX_FIELDS[c])
            for c in present
        ]
    )


def audit_projection(df: DataFrame) -> DataFrame:
    """Audit list row: lengths cut to the list limits, score to 4 digits, blank session named."""
    return df.withColumns(
        {
            "session_id": F.coalesce(F.nullif(F.col("session_id"), F.lit("")), F.lit(ANONYMOUS)),
            "top_score": F.round("top_score", 4),
            "query": F.substring("query", 1, QUERY_CHARS),
            "response_summary": F.substring("response", 1, SUMMARY_CHARS),
            "response": F.substring("response", 1, RESPONSE_CHARS),
            "citations": F.substring(F.to_json("citations"), 1, CITATION_CHARS),
        }
    )


def audit_list_row(df: DataFrame) -> DataFrame:
    """Row of the compliance list, from an audit record with user, SME and environment columns."""
    return df.select(
        F.coalesce(F.nullif(F.col("session_id"), F.lit("")), F.lit(ANONYMOUS)).alias("SessionID"),
        F.col("user_upn").alias("UserUPN"),
        F.col("timestamp").alias("Timestamp"),
        F.col("query").alias("QueryText"),
        F.substring("response", 1, SUMMARY_CHARS).alias("ResponseSummary"),
        F.array_join(F.array_distinct(F.transform("citations", lambda c: c["title"])), "; ").alias("SourceDocuments"),
        F.col("confidence_band").alias("ConfidenceBand"),
        F.when(F.col("escalated"), F.col("sme")).otherwise("").alias("EscalatedTo"),
        F.col("environment").alias("EnvironmentName"),
    )


def audit_problems() -> Column:
    """Breaches of the audit record contract: missing fields, lengths, band, score range, citations."""
    checks = [F.when(F.col(f).isNull(), F.lit(f"missing:{f}")) for f in AUDIT_RECORD.fieldNames()]
    checks += [F.when(F.length(c) > n, F.lit(f"long:{c}")) for c, n in AUDIT_LENGTHS.items()]
    checks += [
        F.when(~F.col("confidence_band").isin(*BANDS), F.lit("enum:confidence_band")),
        F.when(~F.col("top_score").between(0, MAX_SCORE), F.lit("range:top_score")),
        F.when(F.exists("citations", lambda c: c["title"].isNull() | c["source_url"].isNull() | (F.coalesce(c["chunk_index"], F.lit(-1)) < 0)), F.lit("citation")),
        F.when(F.col("escalated") & (F.size("citations") > 0), F.lit("cited_when_escalated")),
    ]
    return F.array_compact(F.array(*checks))


def extract_number(c: str | Column) -> Column:
    """Number left after keeping digits and dots; null when none can be read."""
    kept = F.regexp_replace(col(c).cast("string"), "[^0-9.]", "")
    return F.when(kept != "", kept.try_cast("double"))


def parse_discount(c: str | Column) -> Column:
    """``15%`` → 0.15; a lone ``-`` → 0."""
    bare = F.regexp_replace(col(c), "%+$", "")
    return F.when(bare == "-", F.lit(0.0)).otherwise(bare.try_cast("double") / 100)


def extract_sources(answer: str | Column) -> Column:
    """Every ``Source: …`` value up to a comma or line end, stripped."""
    return F.transform(F.regexp_extract_all(col(answer), F.lit(r"Source:\s*([^\n,]+)"), F.lit(1)), strip)


def parse_model_json(
    df: DataFrame,
    c: str,
    schema: T.StructType,
    enums: Mapping[str, Sequence[str]] | None = None,
    max_words: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add ``parsed`` and ``problems``; bad rows are flagged, never dropped.

    Problems: ``bad_json``, ``missing:<field>``, ``enum:<field>``, ``long:<field>``.
    """
    # Parsed once; the corrupt-record field tells broken text from absent fields.
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    df = df.withColumn("__p", F.from_json(F.col(c), whole, {"columnNameOfCorruptRecord": "_corrupt"}))
    parsed = F.col("__p")
    bad = F.col(c).isNull() | (strip(c) == "") | parsed["_corrupt"].isNotNull()
    checks = [F.when(bad, F.lit("bad_json"))]
    for f in schema.fieldNames():
        checks.append(F.when(~bad & parsed[f].isNull(), F.lit(f"missing:{f}")))
    for f, allowed in (enums or {}).items():
        checks.append(F.when(~bad & ~parsed[f].isin(*allowed), F.lit(f"enum:{f}")))
    for f, limit in (max_words or {}).items():
        checks.append(F.when(~bad & (F.size(words(parsed[f])) > limit), F.lit(f"long:{f}")))
    fields = F.struct(*[parsed[f].alias(f) for f in schema.fieldNames()])
    return df.withColumns({"parsed": fields, "problems": F.array_compact(F.array(*checks))}).drop("__p")


def prompt_block(c: str | Column) -> Column:
    """Text of the first fenced block of a prompt file, or the whole text without one."""
    block = F.regexp_extract(col(c), "(?s)```\\n(.*?)```", 1)
    return F.when(block != "", strip(block)).otherwise(col(c))


def build_prompt(template: str | Column, context: str | Column, question: str | Column) -> Column:
    """Fill ``{retrieved_chunks}`` and ``{user_query}`` of a template row by row."""
    block = prompt_block(F.lit(template) if isinstance(template, str) else template)
    # Cut at the markers first, so that braces inside the context are never filled.
    parts = F.split(block, r"\{retrieved_chunks\}", 2)
    fill = lambda part: F.replace(part, F.lit("{user_query}"), col(question))
    return F.when(
        F.size(parts) == 2, F.concat(fill(F.get(parts, F.lit(0))), col(context), fill(F.get(parts, F.lit(1))))
    ).otherwise(fill(block))


def preview(c: str | Column, n: int = 80) -> Column:
    """First ``n`` characters, with ``...`` when the text is longer."""
    return F.when(F.length(col(c)) > n, F.concat(F.substring(col(c), 1, n), F.lit("..."))).otherwise(col(c))


def calendar(span: DataFrame, start: str = "start", end: str = "end", holidays: DataFrame | None = None) -> DataFrame:
    """Date table from one ``(start, end)`` row: month, weekday, month end, business and holiday flags."""
    days = span.select(F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))).alias("date"))
    if holidays is not None:
        marked = holidays.select(F.to_date("date").alias("date"), F.lit(True).alias("__h")).distinct()
        days = days.join(marked, "date", "left").withColumn("is_holiday", F.coalesce("__h", F.lit(False))).drop("__h")
    else:
        days = days.withColumn("is_holiday", F.lit(False))
    weekday = F.dayofweek("date")
    days = days.withColumns(
        {
            "month": F.date_format("date", "yyyy-MM"),
            "weekday": weekday,
            "is_month_end": F.col("date") == F.last_day("date"),
            "is_business_day": ~weekday.isin(1, 7) & ~F.col("is_holiday"),
        }
    )
    last = days.where("is_business_day").groupBy("month").agg(F.max("date").alias("last_business_day"))
    return days.join(last, "month", "left")


def reference_no(df: DataFrame, date: str, key: str, prefix: str = "INC", **split) -> DataFrame:
    """Add ``reference``: ``PREFIX-YYYY-NNNN`` numbered within the year by date and key."""
    numbered = running(df.withColumn("__year", F.year(date)), ["__year"], [date, key], __no=("number", None), **split)
    # printf pads to four digits and lets longer numbers run on.
    return numbered.withColumn("reference", F.format_string(f"{prefix}-%d-%04d", "__year", "__no")).drop("__year", "__no")


def mask_pii(df: DataFrame, hash_cols: Sequence[str] = (), drop_cols: Sequence[str] = (), salt: str = "") -> DataFrame:
    """Hash or drop the named person columns."""
    for c in hash_cols:
        df = df.withColumn(c, F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256))
    return df.drop(*drop_cols)
