"""Row filters: audience, score, versions, row security, roles, retention, code routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
COSINE_THRESHOLD = 0.75
RERANK_THRESHOLD = 0.70


def audience_filter(df: DataFrame, audience: str = "customer", category: str | None = None) -> DataFrame:
    """Rows of one audience, and of one category when given. Apply before any ranking."""
    kept = df.where(F.col("audience") == audience)
    return kept if category is None else kept.where(F.col("category") == category)


def score_filter(df: DataFrame, score: str, threshold: float = COSINE_THRESHOLD) -> DataFrame:
    """Rows whose named score reaches the threshold; a missing score counts as 0."""
    return df.where(F.coalesce(F.col(score), F.lit(0.0)) >= threshold)


def active_only(df: DataFrame, key: Sequence[str], effective: str, as_of: date, tiebreak: str, active: Column) -> DataFrame:
    """The version of each key in force at ``as_of``: latest effective row among active ones."""
    newest = Window.partitionBy(*key).orderBy(F.col(effective).desc(), F.col(tiebreak).desc())
    current = df.where((F.to_date(effective) <= F.lit(as_of)) & active)
    return current.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")


def row_security(df: DataFrame, owner: str, users: DataFrame, user: str) -> DataFrame:
    """Rows a user may see: all for principals and admins, their own for others, none if unknown.

    ``users`` has ``user_id``, ``owner_id`` and ``role``. The user's entries are read once as
    an entitlement filter, so no join with the fact table is needed.
    """
    mine = users.where(F.col("user_id") == user)
    sees_all = mine.where(F.lower("role").isin("principal", "admin"))
    if sees_all.limit(1).count():
        return df
    return df.join(mine.select(F.col("owner_id").alias(owner)).distinct(), owner, "left_semi")


def role_view(
    df: DataFrame, dataset: str, role: str, grants: Mapping[tuple[str, str], str], masked: Sequence[str] = ()
) -> DataFrame:
    """View of a dataset for a role: ``none`` no rows, ``read`` with masked columns, ``full``."""
    level = grants.get((role, dataset), "none")
    if level == "none":
        return df.where(F.lit(False))
    if level == "read":
        return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in masked})
    return df


def retention(df: DataFrame, ts: str, as_of: str, keep: str = "90 days") -> DataFrame:
    """Add ``disposition``: keep or purge, by age at ``as_of``."""
    limit = F.expr(f"cast('{as_of}' as timestamp_ntz) - interval {keep}")
    return df.withColumn("disposition", F.when(F.col(ts) >= limit, "keep").otherwise("purge"))


def retention_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows kept and purged per group."""
    kept = F.col("disposition") == "keep"
    return df.groupBy(*by).agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("purged"))


def drop_null_target(df: DataFrame, target: str, drop_cols: Sequence[str] = ()) -> DataFrame:
    """Rows with a label, without the listed columns (those that exist)."""
    return df.where(F.col(target).isNotNull()).drop(*drop_cols)


def exact_code_route(queries: DataFrame, catalogue: DataFrame, pattern: str, code: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Split queries into exact hits (code found in text and catalogue) and the rest for ranking."""
    found = queries.withColumn("__code", F.regexp_extract(text, pattern, 0))
    hits = found.join(catalogue, F.col("__code") == F.col(code)).drop("__code")
    rest = found.join(catalogue.select(F.col(code).alias("__code")).distinct(), "__code", "left_anti").drop("__code")
    return hits, rest
