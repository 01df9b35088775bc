"""Scoring answers against evaluation cases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.text import words
from casework.operators.routing import REFUSALS

# Fixed values.
ANSWER_CHARS = 300
CHECKS = ["retrieval_hit", "citation_present", "answer_relevant", "escalation_correct"]
TARGETS = {
    "pass_rate": 0.75,
    "retrieval_recall": 0.80,
    "citation_rate": 1.00,
    "answer_relevance": 0.80,
    "escalation_accuracy": 0.95,
}
GREEN, AMBER = 0.90, 0.75
MAX_ANSWER_WORDS = 200


def eval_cases(cases: DataFrame, answers: DataFrame, key: str = "case_id", exempt_escalated: bool = False) -> DataFrame:
    """Flags per case.

    ``answers`` has ``answer, sources, retrieved, escalation_required, confidence, latency_ms,
    error``; a case without an answer, or with an error, fails every check. An escalated answer
    has no citation, so by the plain rule it cannot pass; ``exempt_escalated`` waives its citation.
    """
    joined = cases.join(answers, key, "left")
    error = F.coalesce(F.col("error"), F.lit(""))
    failed = (error != "") | F.col("answer").isNull()
    has = lambda part, whole: F.contains(F.lower(whole), F.lower(part))
    hit = F.col("should_escalate") | F.exists("retrieved", lambda s: has(F.col("expected_source"), s))
    cited = (F.size("sources") > 0) | F.contains(F.col("answer"), F.lit("Source:"))
    if exempt_escalated:
        cited = cited | (F.col("should_escalate") & F.col("escalation_required"))
    expected = F.coalesce(F.col("expected_answer_contains"), F.lit(""))
    flags = {
        "retrieval_hit": hit,
        "citation_present": cited,
        "answer_relevant": (expected == "") | has(expected, F.col("answer")),
        "escalation_correct": F.col("escalation_required") == F.col("should_escalate"),
    }
    out = joined.withColumns({n: F.when(failed, False).otherwise(F.coalesce(c, F.lit(False))) for n, c in flags.items()})
    passed = F.col(CHECKS[0])
    for c in CHECKS[1:]:
        passed = passed & F.col(c)
    return out.withColumns(
        {
            "passed": passed,
            "confidence": F.when(failed, "low").otherwise(F.col("confidence")),
            "answer": F.substring(F.coalesce("answer", F.lit("")), 1, ANSWER_CHARS),
            "error": error,
        }
    )


def eval_report(results: DataFrame) -> DataFrame:
    """One row of counts and rates; the pass rate of an empty run is 0."""
    mean = lambda c: F.round(F.avg(F.col(c).cast("int")), 6)
    return results.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if("passed").alias("passed"),
        F.round(F.coalesce(F.try_divide(F.count_if("passed"), F.count(F.lit(1))), F.lit(0.0)), 6).alias("pass_rate"),
        mean("retrieval_hit").alias("retrieval_recall"),
        mean("citation_present").alias("citation_rate"),
        mean("answer_relevant").alias("answer_relevance"),
        mean("escalation_correct").alias("escalation_accuracy"),
        F.round(F.avg("latency_ms"), 4).alias("avg_latency_ms"),
    )


def failed_checks(results: DataFrame) -> DataFrame:
    """Failed cases with the names of their failed checks, or the error."""
    names = F.array_compact(F.array(*[F.when(~F.col(c), F.lit(f"{c}=False")) for c in CHECKS]))
    failed = results.where(~F.col("passed"))
    return failed.withColumn("failed", F.when(F.col("error") != "", F.array(F.concat(F.lit("error: "), "error"))).otherwise(names))


def scorecard(report: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """Metric, actual, target, status and colour band from a one-row report."""
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("actual"), F.lit(float(v)).alias("target")) for m, v in targets.items()])
    rows = report.select(F.inline(lines))
    actual = F.col("actual")
    return rows.withColumns(
        {
            "status": F.when(actual >= F.col("target"), "Met").otherwise("Below"),
            "band": F.when(actual >= GREEN, "target met").when(actual >= AMBER, "needs improvement").otherwise("failing"),
        }
    )


def refused(answer: str | Column) -> Column:
    lowered = F.lower(F.col(answer) if isinstance(answer, str) else answer)
    out = F.lit(False)
    for phrase in REFUSALS:
        out = out | F.contains(lowered, F.lit(phrase))
    return out


def answer_quality(df: DataFrame, answer: str, should_refuse: Column, grounded: Column, cited: Column, escalated: Column, should_escalate: Column) -> DataFrame:
    """Shares over answers: correct refusal, within 200 words, cited, ungrounded, false escalation."""
    share = lambda c: F.round(F.coalesce(F.avg(c.cast("double")), F.lit(0.0)), 6)
    given = ~refused(answer)
    return df.agg(
        F.count(F.lit(1)).alias("answers"),
        share(F.when(should_refuse, refused(answer))).alias("correct_refusal"),
        share(F.size(words(answer)) <= MAX_ANSWER_WORDS).alias("within_200_words"),
        share(F.when(given, cited)).alias("cited"),
        share(F.when(given, ~grounded)).alias("ungrounded"),
        share(F.when(~should_escalate, escalated)).alias("false_escalation"),
    )


def compare_methods(runs: DataFrame, questions: DataFrame, relevant: Column) -> DataFrame:
    """Recall, failed share and mean latency per retrieval method.

    ``runs`` holds hits ``(method, q_id, …, latency_ms)``; a question is recalled when one of
    its hits is relevant. Questions without any hit count as failed.
    """
    total = questions.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_q = runs.groupBy("method", "q_id").agg(F.bool_or(relevant).alias("hit"), F.max("latency_ms").alias("ms"))
    recall = F.count_if("hit") / total
    return per_q.groupBy("method").agg(
        F.round(recall * 100, 4).alias("recall_pct"), F.round(100 - recall * 100, 4).alias("failed_pct"), F.round(F.avg("ms"), 4).alias("avg_latency_ms")
    )


def model_table(models: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Rows of (model, metric, value) with rank and the best of each metric marked."""
    w = Window.partitionBy(metric).orderBy(F.col(value).desc(), "model")
    return models.withColumn("rank", F.row_number().over(w).cast("long")).withColumn("best", F.col("rank") == 1)
