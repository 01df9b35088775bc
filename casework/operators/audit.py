"""Audit, usage and data-profile aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions.quantiles import exact_quantiles
from casework.operators.routing import confidence_band


def latency_stats(df: DataFrame, by: Sequence[str], latency: str, target: float, exact: bool = True, **split) -> DataFrame:
    """Mean, P95, P99 and the share under a target per group.

    ``exact`` uses counted values and running sums; otherwise a sketch (one pass, approximate).
    """
    probs = {"p95": 0.95, "p99": 0.99}
    base = [
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(latency), 4).alias("mean"),
        F.round(F.avg((F.col(latency) < target).cast("int")), 6).alias("under_target"),
    ]
    if not exact:
        return df.groupBy(*by).agg(*base, *[F.percentile_approx(latency, p, 10_000).alias(n) for n, p in probs.items()])
    stats = df.groupBy(*by).agg(*base)
    q = exact_quantiles(df, by, latency, probs, **split)
    return stats.join(q, list(by), "left").withColumns({n: F.round(n, 4) for n in probs})


def band_counts(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """High / Medium / Escalated counts of a run."""
    band = confidence_band(score)
    return df.groupBy(*by).agg(*[F.count_if(band == b).alias(b.lower()) for b in ("High", "Medium", "Escalated")])


def audit_overview(df: DataFrame, session: str, topic: str, environment: str, score: str, escalated: Column) -> DataFrame:
    """Volume, escalation rate over distinct sessions and mean score by topic and environment, with subtotals.

    Records are reduced to one row per (topic, environment, session) first; subtotals and the
    distinct counts then work on sessions, not on records.
    """
    per = df.groupBy(topic, environment, session).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(score).alias("__s"), F.count(score).alias("__sn"), F.bool_or(escalated).alias("__e")
    )
    out = per.rollup(topic, environment).agg(
        F.grouping_id().alias("level"),
        F.sum("__n").alias("queries"),
        F.countDistinct(session).alias("sessions"),
        F.countDistinct(F.when(F.col("__e"), F.col(session))).alias("escalated_sessions"),
        F.round(F.sum("__s") / F.sum("__sn"), 6).alias("mean_score"),
    )
    rate = F.round(F.try_divide(F.col("escalated_sessions"), F.col("sessions")), 6)
    return out.withColumn("escalation_rate", rate)


def activity_heatmap(df: DataFrame, ts: str) -> DataFrame:
    """Weekday (1 = Sunday) × hour counts, one column per hour."""
    hours = [F.count_if(F.hour(ts) == h).alias(f"h{h:02d}") for h in range(24)]
    return df.groupBy(F.dayofweek(ts).alias("weekday")).agg(*hours)


def user_activity(df: DataFrame, user: str, salt: str) -> DataFrame:
    """Query volume per user, users as salted hashes."""
    counts = df.groupBy(user).agg(F.count(F.lit(1)).alias("queries"))
    return counts.select(F.sha2(F.concat(F.lit(salt), F.col(user).cast("string")), 256).alias("user_hash"), "queries")


def daily_summary(df: DataFrame, ts: str, severity: str, category: str, severities: Sequence[str], categories: Sequence[str], hour: int = 7) -> DataFrame:
    """Incidents per reporting day (24 h up to 07:00), severity × category, with zero rows.

    ``day`` is the date on which the 24 hours start.
    """
    day = F.to_date(F.col(ts) - F.expr(f"interval {hour} hours"))
    counts = df.groupBy(day.alias("day"), severity, category).agg(F.count(F.lit(1)).alias("n"))
    grid = (
        df.select(day.alias("day")).distinct()
        .withColumn(severity, F.explode(F.array(*[F.lit(s) for s in severities])))
        .withColumn(category, F.explode(F.array(*[F.lit(c) for c in categories])))
    )
    return grid.join(counts, ["day", severity, category], "left").withColumn("incidents", F.coalesce("n", F.lit(0))).drop("n")


def change_stats(df: DataFrame, kind: str, submitted: str, approved: str, error: Column) -> DataFrame:
    """Change volume, mean approval hours and error rate per type and month."""
    seconds = F.unix_micros(F.col(approved).cast("timestamp")) - F.unix_micros(F.col(submitted).cast("timestamp"))
    return df.groupBy(F.col(kind), F.date_format(submitted, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("changes"),
        F.round(F.avg(seconds / 3.6e9), 4).alias("turnaround_hours"),
        F.round(F.avg(error.cast("int")), 6).alias("error_rate"),
    )


def feedback_rate(df: DataFrame, channel: str, topic: str, feedback: str) -> DataFrame:
    """Helpful, not helpful, human request and resolution rate by channel, by topic and in total.

    Counts are taken per (channel, topic) first; grouping sets run on those few rows.
    """
    f = F.col(feedback)
    base = df.groupBy(F.col(channel).alias("channel"), F.col(topic).alias("topic")).agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(f == "helpful").alias("helpful"),
        F.count_if(f == "not_helpful").alias("not_helpful"),
        F.count_if(f == "human").alias("human"),
    )
    sets = [[F.col("channel")], [F.col("topic")], []]
    out = base.groupingSets(sets, "channel", "topic").agg(*[F.sum(c).alias(c) for c in ("answers", "helpful", "not_helpful", "human")])
    resolved = F.round(F.try_divide(F.col("answers") - F.col("human"), F.col("answers")), 6)
    return out.withColumn("resolution_rate", resolved)


def access_review(
    users: DataFrame,
    activity: DataFrame,
    user: str,
    ts: str,
    as_of: str,
    sandbox_created: str | None = None,
    licence_use: Column | None = None,
) -> DataFrame:
    """Reasons to act per user; an empty list means keep.

    Inactive over 90 days, licence unused over 90 days (``licence_use`` marks the activity that
    uses it), sandbox idle over 14 days or older than 30 days. Users never seen are inactive.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    use = licence_use if licence_use is not None else F.lit(True)
    last = activity.groupBy(user).agg(F.max(ts).alias("last_seen"), F.max(F.when(use, F.col(ts))).alias("last_use"))
    days = lambda c: F.datediff(now, c)
    over = lambda c, n: F.col(c).isNull() | (days(F.col(c)) > n)
    reasons = [
        F.when(over("last_seen", 90), "inactive_90d"),
        F.when(over("last_use", 90), "licence_unused_90d"),
    ]
    if sandbox_created:
        has = F.col(sandbox_created).isNotNull()
        reasons += [
            F.when(has & over("last_seen", 14), "sandbox_idle_14d"),
            F.when(has & (days(F.col(sandbox_created)) > 30), "sandbox_expired_30d"),
        ]
    joined = users.join(last, user, "left")
    return joined.withColumn("reasons", F.array_compact(F.array(*reasons))).withColumn("keep", F.size("reasons") == 0)


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column and whether any is missing; one pass."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"__{c}") for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(f"__{c}").alias("missing")) for c in columns])
    return one.select("rows", F.inline(lines)).withColumn("any_missing", F.col("missing") > 0)


def unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns as rows ``(column, value)``."""
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(lines))


def profile(df: DataFrame, columns: Sequence[str], **split) -> DataFrame:
    """Count, mean, standard deviation (sample), minimum, exact quartiles and maximum per column."""
    rows = unpivoted(df, columns)
    stats = rows.groupBy("column").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev_samp("value"), 4).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(rows, ["column"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, **split)
    return stats.join(quartiles, "column", "left").withColumns({c: F.round(c, 4) for c in ("p25", "p50", "p75")})


def value_counts(df: DataFrame, columns: Sequence[str], normalize: bool = False) -> DataFrame:
    """Frequency of each value per column; shares of the non-null values when normalised."""
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(lines)).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    totals = counts.groupBy("column").agg(F.sum("n").alias("__total"))
    return counts.join(totals, "column").withColumn("share", F.round(F.col("n") / F.col("__total"), 6)).drop("__total")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix as rows ``(a, b, r)``; all pairs from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    index = {p: i for i, p in enumerate(pairs)}
    lines = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"c{index[(a, b)] if (a, b) in index else index[(b, a)]}"), 6).alias("r"))
            for a in columns
            for b in columns
        ]
    )
    return one.select(F.inline(lines))


def top_correlated(df: DataFrame, columns: Sequence[str], target: str, k: int = 10) -> DataFrame:
    """The ``k`` columns with the greatest absolute correlation with the target."""
    matrix = correlation(df, [*[c for c in columns if c != target], target])
    ranked = matrix.where((F.col("a") != target) & (F.col("b") == target)).select(F.col("a").alias("feature"), F.abs("r").alias("abs_r"))
    return ranked.orderBy(F.col("abs_r").desc(), "feature").limit(k)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bin counts per column (bin 1 … ``bins``; the maximum falls in the last)."""
    rows = unpivoted(df, columns).where("value is not null")
    edges = rows.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    place = F.when(hi == lo, F.lit(1)).otherwise(F.least(F.lit(bins), F.floor((F.col("value") - lo) * bins / (hi - lo)) + 1))
    # Equal values are counted first, so the join with the edges meets distinct values only.
    counted = rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    binned = counted.join(edges, "column").withColumn("bin", place.cast("long"))
    return binned.groupBy("column", "bin").agg(F.sum("c").alias("n"))
