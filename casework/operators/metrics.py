"""Classifier metrics from prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions.ordered import running

# Fixed values.
THRESHOLDS = [0.8, 0.5, 0.3]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def _rates(tp, predicted, support):
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    precision, recall = zero(F.try_divide(tp, predicted)), zero(F.try_divide(tp, support))
    return precision, recall, zero(F.try_divide(2 * precision * recall, precision + recall))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, plus ``macro`` and ``accuracy`` rows.

    Everything after the confusion counts works on class rows only.
    """
    cells = confusion(df, label, prediction)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        )
    )
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    p, r, f1 = _rates(F.col("tp"), F.col("predicted"), F.col("support"))
    per = per.select("class", "support", "tp", p.alias("precision"), r.alias("recall"), f1.alias("f1"))
    overall = per.agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")])
    accuracy = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    rows = F.array(
        F.struct(F.lit("macro").alias("class"), F.col("support"), F.col("precision"), F.col("recall"), F.col("f1")),
        F.struct(F.lit("accuracy").alias("class"), F.col("support"), accuracy.alias("precision"), accuracy.alias("recall"), accuracy.alias("f1")),
    )
    out = per.drop("tp").unionByName(overall.select(F.inline(rows)))
    return out.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Confusion counts and rates per threshold (predicted positive when score > t), one pass."""
    pos = F.col(label) == 1
    aggregates = [
        F.count_if((F.col(score) > t) & (pos if a else ~pos)).alias(f"{n}{i}")
        for i, t in enumerate(thresholds)
        for n, a in (("tp", True), ("fp", False))
    ]
    one = df.agg(F.count_if(pos).alias("p"), F.count_if(~pos).alias("q"), *aggregates)
    lines = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp")) for i, t in enumerate(thresholds)])
    out = one.select("p", "q", F.inline(lines)).withColumns({"fn": F.col("p") - F.col("tp"), "tn": F.col("q") - F.col("fp")})
    precision, recall, f1 = _rates(F.col("tp"), F.col("tp") + F.col("fp"), F.col("p"))
    accuracy = F.coalesce(F.try_divide(F.col("tp") + F.col("tn"), F.col("p") + F.col("q")), F.lit(0.0))
    rounded = {"accuracy": accuracy, "precision": precision, "recall": recall, "f1": f1}
    return out.select("threshold", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(n) for n, c in rounded.items()])


def roc_points(df: DataFrame, label: str = "label", score: str = "score", **split) -> DataFrame:
    """One ROC point per distinct score, ties grouped: ``score, tpr, fpr`` and the trapezoid below it.

    Rows are counted per score before anything is ordered; the running sums are skew-safe.
    """
    pos = F.col(label) == 1
    steps = df.groupBy(F.col(score).alias("score")).agg(F.count_if(pos).alias("__p"), F.count_if(~pos).alias("__q"))
    totals = steps.agg(F.sum("__p").alias("p"), F.sum("__q").alias("q"))
    p, q = totals.select("p").scalar(), totals.select("q").scalar()
    cum = running(steps, [], [-F.col("score")], __tp=("sum", "__p"), __fp=("sum", "__q"), **split)
    tpr, fpr = F.try_divide(F.col("__tp"), p), F.try_divide(F.col("__fp"), q)
    before_tpr, before_fpr = F.try_divide(F.col("__tp") - F.col("__p"), p), F.try_divide(F.col("__fp") - F.col("__q"), q)
    return cum.select("score", tpr.alias("tpr"), fpr.alias("fpr"), ((fpr - before_fpr) * (tpr + before_tpr) / 2).alias("area"))


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the ROC curve from its points."""
    return points.agg(F.round(F.sum("area"), 6).alias("auc"), F.count(F.lit(1)).alias("points"))
