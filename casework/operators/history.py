"""Per-key histories and conversations. All ordered work goes through the skew-safe helper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions.ordered import running


def history(changes: DataFrame, key: str, at: str, value: str, tiebreak: str, **split) -> DataFrame:
    """Validity of each change: ``valid_from``, ``valid_to``, ``is_current``, ``previous``."""
    out = running(changes, [key], [at, tiebreak], valid_to=("lead", at), previous=("lag", value), **split)
    return out.withColumns({"valid_from": F.col(at), "is_current": F.col("valid_to").isNull()})


def transcript(turns: DataFrame, session: str, turn: str, speaker: str, text: str, part_turns: int = 1000, **split) -> DataFrame:
    """Conversation text in turn order with the number of turns.

    A session longer than ``part_turns`` continues in further rows (``part``); no row grows
    without bound and nothing is cut.
    """
    line = F.concat(F.col(speaker), F.lit(": "), F.col(text))
    slim = turns.select(session, F.col(turn).alias("__t"), line.alias("__line"))
    placed = running(slim, [session], ["__t"], __no=("number", None), **split)
    part = F.floor((F.col("__no") - 1) / part_turns).cast("long").alias("part")
    rows = F.sort_array(F.collect_list(F.struct("__no", "__line")))
    out = placed.groupBy(session, part).agg(rows.alias("__rows"))
    return out.select(
        session, "part", F.size("__rows").cast("long").alias("turns"), F.array_join(F.transform("__rows", lambda r: r["__line"]), "\n").alias("transcript")
    )


def turn_context(turns: DataFrame, session: str, turn: str, speaker: str, text: str, n: int = 1, **split) -> DataFrame:
    """Each turn with the last user and assistant text before it and the ``n`` previous texts."""
    said = lambda who: F.when(F.col(speaker) == who, F.col(text))
    df = turns.withColumns({"__u": said("user"), "__a": said("assistant")})
    out = running(df, [session], [turn], __lu=("last", "__u"), __la=("last", "__a"), __b1=("lag", text), **split)
    # "Before it": the running value of the previous turn.
    out = running(out, [session], [turn], previous_user=("lag", "__lu"), previous_assistant=("lag", "__la"), **split)
    before = ["__b1"]
    for i in range(2, n + 1):
        out = running(out, [session], [turn], **{f"__b{i}": ("lag", f"__b{i - 1}")}, **split)
        before.insert(0, f"__b{i}")
    out = out.withColumn("previous_texts", F.array_compact(F.array(*before)))
    return out.drop("__u", "__a", "__lu", "__la", *before)


def clarify_limit(turns: DataFrame, session: str, turn: str, low: Column, n: int = 2, **split) -> DataFrame:
    """Mark the turn at which the ``n``-th low-confidence attempt is reached and hand over."""
    out = running(turns.withColumn("__low", low.cast("long")), [session], [turn], low_so_far=("sum", "__low"), **split)
    return out.withColumn("hand_over", (F.col("__low") == 1) & (F.col("low_so_far") == n)).drop("__low")


def win_rate_12m(deals: DataFrame, closed: str, status: str, months: int = 12) -> DataFrame:
    """Rolling win rate per month: won / (won + lost) of the last 12 calendar months, 0 when none.

    Deals are first reduced to one row per month; the window runs over months only, on a
    calendar without gaps.
    """
    month = F.trunc(F.to_date(closed), "month")
    monthly = (
        deals.where(F.col(status).isin("Closed Won", "Closed Lost"))
        .groupBy(month.alias("month"))
        .agg(F.count_if(F.col(status) == "Closed Won").alias("won"), F.count_if(F.col(status) == "Closed Lost").alias("lost"))
    )
    return rolling_rate(monthly, months)


def rolling_rate(monthly: DataFrame, months: int = 12) -> DataFrame:
    """Rolling sums over the last ``months`` months: every month adds to the ones that follow.

    Each month row is copied to the months whose window contains it, so the sum is a plain
    aggregation instead of a window over one partition.
    """
    ahead = F.explode(F.sequence(F.lit(0), F.lit(months - 1)))
    copies = monthly.withColumn("__i", ahead).select(F.add_months("month", F.col("__i")).alias("month"), "won", "lost")
    ends = monthly.agg(F.max("month").alias("m")).scalar()
    out = copies.where(F.col("month") <= ends).groupBy("month").agg(F.sum("won").alias("won_12m"), F.sum("lost").alias("lost_12m"))
    rate = F.coalesce(F.try_divide(F.col("won_12m"), F.col("won_12m") + F.col("lost_12m")), F.lit(0.0))
    span = monthly.agg(F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month"))
    full = span.join(out, "month", "left")
    return full.select("month", F.coalesce("won_12m", F.lit(0)).alias("won_12m"), F.coalesce("lost_12m", F.lit(0)).alias("lost_12m"), F.round(F.coalesce(rate, F.lit(0.0)), 6).alias("win_rate"))

