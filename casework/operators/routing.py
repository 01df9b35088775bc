"""Decision rules: escalation, intent, confidence, severity, approval, tiers, sync."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.text import col

# Patterns that always escalate, in order.
ESCALATION_PATTERNS = [
    r"\baccount\s*(number|detail|balance|statement)\b",
    r"\bpolicy\s*number\b",
    r"\bpassword\b",
    r"\bcomplaint\b",
    r"\bspeak\s*to\s*(a\s*)?(human|person|agent|someone)\b",
    r"\blegal\s*advice\b",
    r"\bfinancial\s*advice\b",
    r"\bsue\b|\blawsuit\b|\blitigation\b",
]

# Refusal phrases of an answer.
REFUSALS = ["don't have confident information", "cannot find", "not covered in"]

HIGH_BAND, MEDIUM_BAND = 0.85, 0.70
GOOD_HIT, GOOD_HITS = 2.0, 3
AUTO_THRESHOLD = 0.85


def escalation(query: str | Column, patterns: Sequence[str] = ESCALATION_PATTERNS) -> Column:
    """Reason text of the first matching pattern, else an empty string."""
    lowered = F.lower(col(query))
    matched = [F.when(lowered.rlike(p), F.lit(f"Query matched escalation pattern: {p}")) for p in patterns]
    return F.coalesce(*matched, F.lit(""))


def intent(query: str | Column, triggers: Sequence[tuple[str, str, int]], default: str = "generative") -> Column:
    """Topic of the trigger phrase with the lowest priority number found in the text.

    ``triggers`` holds ``(topic, phrase, priority)``; the table is a parameter, so the rule is
    one expression and needs no join.
    """
    lowered = F.lower(col(query))
    ordered = sorted(triggers, key=lambda t: (t[2], t[0], t[1]))
    return F.coalesce(*[F.when(lowered.contains(p.lower()), F.lit(topic)) for topic, p, _ in ordered], F.lit(default))


def confidence_band(score: str | Column) -> Column:
    """High from 0.85, Medium from 0.70, else Escalated; use the top hit's score."""
    s = F.coalesce(col(score), F.lit(0.0))
    return F.when(s >= HIGH_BAND, "High").when(s >= MEDIUM_BAND, "Medium").otherwise("Escalated")


def query_bands(questions: DataFrame, hits: DataFrame, score: str) -> DataFrame:
    """Top score and band per question; a question without hits is escalated with score 0."""
    top = hits.groupBy("q_id").agg(F.max(score).alias("top_score"))
    out = questions.select("q_id").join(top, "q_id", "left").withColumn("top_score", F.coalesce("top_score", F.lit(0.0)))
    return out.withColumns({"band": confidence_band("top_score"), "escalated": F.col("top_score") < MEDIUM_BAND})


def answer_confidence(answers: DataFrame, hits: DataFrame, answer: str = "answer", score: str = "reranker_score") -> DataFrame:
    """low without hits or with a refusal phrase; high with 3 hits above 2.0; else medium."""
    counts = hits.groupBy("q_id").agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(score) > GOOD_HIT).alias("__good"))
    refusal = F.lit(False)
    for phrase in REFUSALS:
        refusal = refusal | F.lower(F.col(answer)).contains(phrase)
    rated = F.when(F.col("__n").isNull() | refusal, "low").when(F.col("__good") >= GOOD_HITS, "high").otherwise("medium")
    return answers.join(counts, "q_id", "left").withColumn("confidence", rated).drop("__n", "__good")


def field_routing(fields: Column) -> Column:
    """Needs Review when any field is null or of low confidence; ``fields`` is an array of (value, confidence)."""
    weak = F.exists(fields, lambda f: f["value"].isNull() | (F.coalesce(f["confidence"], F.lit("low")) == "low"))
    return F.when(weak, "Needs Review").otherwise("Processed")


def threshold_routing(df: DataFrame, score: str, threshold: float = AUTO_THRESHOLD) -> DataFrame:
    """Add ``route``: auto at or above the threshold, else review."""
    auto = F.coalesce(F.col(score), F.lit(0.0)) >= threshold
    return df.withColumn("route", F.when(auto, "auto").otherwise("review"))


def threshold_calibration(df: DataFrame, score: str, error: Column, thresholds: Sequence[float]) -> DataFrame:
    """Review share and error rate of the automatic part per threshold, in one pass over the data."""
    aggregates = []
    for i, t in enumerate(thresholds):
        auto = F.coalesce(F.col(score), F.lit(0.0)) >= t
        aggregates += [
            F.count_if(auto).alias(f"a{i}"),
            F.count_if(auto & error).alias(f"e{i}"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggregates)
    lines = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"a{i}").alias("auto"), F.col(f"e{i}").alias("errors")) for i, t in enumerate(thresholds)])
    return one.select("n", F.inline(lines)).select(
        "threshold",
        "auto",
        (F.col("n") - F.col("auto")).alias("review"),
        F.round(F.try_divide(F.col("n") - F.col("auto"), F.col("n")), 6).alias("review_share"),
        F.round(F.coalesce(F.try_divide(F.col("errors"), F.col("auto")), F.lit(0.0)), 6).alias("error_rate"),
    )


# Severity → first recipients, minutes to acknowledge, next recipient.
ESCALATION_MATRIX = {
    "critical": ("Clinical Lead, CEO", 15, "On-Call Manager"),
    "high": ("Clinical Lead", 120, "CEO"),
    "standard": ("Clinical Lead", None, None),
}


def severity_route(df: DataFrame, severity: str, reported: str, flag: str, matrix: Mapping = ESCALATION_MATRIX) -> DataFrame:
    """Recipients, deadline and next recipient by severity; flag mismatches are reported, not dropped."""
    s = F.col(severity)

    def pick(i: int, cast: str) -> Column:
        out = F.lit(None).cast(cast)
        for name, values in matrix.items():
            if values[i] is not None:
                out = F.when(s == name, F.lit(values[i]).cast(cast)).otherwise(out)
        return out

    minutes = pick(1, "long")
    return df.withColumns(
        {
            "recipients": pick(0, "string"),
            "deadline": F.col(reported) + F.make_dt_interval(mins=minutes.cast("int")),
            "escalate_to": pick(2, "string"),
            "flag_mismatch": (s == "critical") & ~F.coalesce(F.col(flag), F.lit(False)),
        }
    )


def approval_route(df: DataFrame, kind: str, submitted: str, decided: str, as_of: Column, below_tier: Column) -> DataFrame:
    """Route and state of a change request.

    Price changes go to finance, prices below the tier to the pricing specialist, the rest to
    the catalogue manager. A finance request without an answer within 4 hours is approved
    automatically and the director is told.
    """
    route = F.when(below_tier, "Pricing Specialist").when(F.col(kind) == "price", "Finance Manager").otherwise("Catalogue Manager")
    limit = F.col(submitted) + F.expr("interval 4 hours")
    silent = (F.col(decided).isNull() | (F.col(decided) > limit)) & (as_of >= limit)
    auto = silent & (F.col("route") == "Finance Manager")
    out = df.withColumn("route", route)
    return out.withColumns(
        {
            "state": F.when(auto, "auto-approved").when(F.col(decided).isNotNull(), "decided").otherwise("pending"),
            "notify_director": auto,
        }
    )


def storage_tier(modified: str | Column, as_of: Column) -> Column:
    """hot; cool after more than 90 days; archive after more than 365 days."""
    age = F.datediff(as_of, col(modified))
    return F.when(age > 365, "archive").when(age > 90, "cool").otherwise("hot")


def recoverable(deleted: str | Column, as_of: Column, days: int = 30) -> Column:
    """True for a soft-deleted file still within the retention days."""
    return col(deleted).isNotNull() & (F.datediff(as_of, col(deleted)) <= days)


def sync_status(attempts: DataFrame, key: str, order: Sequence[Column], succeeded: Column, started: Column) -> DataFrame:
    """Last attempt per record: Complete, Failed (on the retry list) or Pending."""
    last = Window.partitionBy(key).orderBy(*order)
    status = F.when(succeeded, "Complete").when(started, "Failed").otherwise("Pending")
    latest = attempts.withColumn("__rn", F.row_number().over(last)).where("__rn = 1").drop("__rn")
    return latest.withColumn("status", status).withColumn("retry", F.col("status") == "Failed")
