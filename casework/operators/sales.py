"""Sales opportunity measures and room utilisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stages in order, and the ones a stage share counts over.
STAGES = ["Discovery", "Proposal", "Negotiation", "Closed Won", "Closed Lost"]
REACHED = {"Discovery": 1, "Proposal": 2, "Negotiation": 3, "Closed Won": 4}


def deal_measures(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Weighted and unweighted value, share of deals now in Proposal, mean won cycle in days."""
    known = F.col("stage").isin(*STAGES)
    won_days = F.when(F.col("stage") == "Closed Won", F.datediff("closed", "created"))
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("deals"),
        F.round(F.sum(F.col("revenue") * F.col("probability") / 100), 4).alias("weighted"),
        F.round(F.sum("revenue"), 4).alias("unweighted"),
        F.round(F.coalesce(F.try_divide(F.count_if(F.col("stage") == "Proposal"), F.count_if(known)), F.lit(0.0)), 6).alias("proposal_share"),
        F.round(F.avg(won_days), 4).alias("avg_cycle_days"),
    )


def funnel(df: DataFrame) -> DataFrame:
    """Deals and value per stage and owner with subtotals (``level`` is the grouping id)."""
    return df.cube("stage", "owner").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("deals"), F.round(F.sum("revenue"), 4).alias("value")
    )


def reached_stages(df: DataFrame) -> DataFrame:
    """True conversion: deals that reached each stage and the share that went on.

    A deal now in a later stage has passed the earlier ones. A lost deal counts for the first
    stage only, since the stage it was lost in is not recorded. One pass of conditional counts.
    """
    position = F.lit(1)
    for name, i in REACHED.items():
        position = F.when(F.col("stage") == name, i).otherwise(position)
    names = list(REACHED)
    one = df.agg(*[F.count_if(position >= i + 1).alias(f"r{i}") for i in range(len(names))])
    lines = F.array(
        *[
            F.struct(
                F.lit(n).alias("stage"),
                F.col(f"r{i}").alias("reached"),
                (F.col(f"r{i + 1}") if i + 1 < len(names) else F.lit(None).cast("long")).alias("went_on"),
            )
            for i, n in enumerate(names)
        ]
    )
    rate = F.round(F.try_divide(F.col("went_on"), F.col("reached")), 6)
    return one.select(F.inline(lines)).withColumn("conversion", rate)


def win_loss(df: DataFrame, by: str = "industry") -> DataFrame:
    """Won, lost and win share per group."""
    won, lost = F.count_if(F.col("stage") == "Closed Won"), F.count_if(F.col("stage") == "Closed Lost")
    return df.groupBy(by).agg(won.alias("won"), lost.alias("lost"), F.round(F.coalesce(F.try_divide(won, won + lost), F.lit(0.0)), 6).alias("win_share"))


def forecast_by_month(df: DataFrame, closes: str = "closed") -> DataFrame:
    """Weighted and unweighted value expected to close per month; months without deals are 0."""
    month = F.trunc(F.to_date(closes), "month")
    sums = df.where(F.col(closes).isNotNull()).groupBy(month.alias("month")).agg(
        F.sum(F.col("revenue") * F.col("probability") / 100).alias("weighted"), F.sum("revenue").alias("unweighted")
    )
    span = sums.agg(F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month"))
    zero = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias(c)
    return span.join(sums, "month", "left").select("month", zero("weighted"), zero("unweighted"))


def utilisation(bookings: DataFrame, live: Column) -> DataFrame:
    """Live bookings and booked hours by room, weekday and starting hour."""
    hours = (F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 3.6e9
    return bookings.where(live).groupBy("room", F.dayofweek("start").alias("weekday"), F.hour("start").alias("hour")).agg(
        F.count(F.lit(1)).alias("bookings"), F.round(F.sum(hours), 2).alias("hours")
    )


def double_bookings_per_week(counts: DataFrame, start: str = "start", earlier: str = "earlier") -> DataFrame:
    """Conflicting pairs per week (Monday) of the later start, from :func:`casework.operators.intervals.conflict_counts`."""
    week = F.to_date(F.date_trunc("week", start))
    return counts.where(F.col(earlier) > 0).groupBy(week.alias("week")).agg(F.sum(earlier).alias("double_bookings"))
