"""Interval and as-of joins, price tiers and acknowledgement times."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions.ordered import running

# Minutes allowed to acknowledge.
ACK_MINUTES = {"critical": 15, "high": 120, "standard": 240}


def _cell(c: str | Column, seconds: int) -> Column:
    """Number of the time cell of so many seconds."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(F.unix_micros(c.cast("timestamp")) / (seconds * 1_000_000)).cast("long")


def _last_cell(end: str, start: str, seconds: int) -> Column:
    return F.greatest(_cell(F.col(end) - F.expr("interval 1 microsecond"), seconds), _cell(start, seconds))


def _halved(c: Column, level: Column) -> Column:
    return F.call_function("shiftright", c, level)


def cover(first: Column, last: Column, levels: Column) -> Column:
    """Dyadic cover of the cells ``first`` to ``last``: an array of ``(level, node)``.

    A node of level ``l`` stands for 2^l cells. The cover is disjoint and has at most two nodes
    per level, so an interval of ``n`` cells has about ``2 log2 n`` nodes, whatever the size of a cell.
    """

    def at(level: Column) -> Column:
        # What is left of the interval after all lower levels, in nodes of this one.
        low, high = -_halved(-first, level), _halved(last + 1, level)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        node = lambda n: F.struct(level.cast("int").alias("level"), n.cast("long").alias("node"))
        left = F.when(odd(low) & (low < high), node(low))
        right = F.when(odd(high) & (low + F.pmod(low, F.lit(2)) < high), node(high - 1))
        return F.array(left, right)

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), levels), at)), lambda n: n.isNotNull())


def path_up(cell: Column, levels: Column) -> Column:
    """The node of every level that holds a cell: an array of ``(level, node)``."""
    return F.transform(F.sequence(F.lit(0), levels), lambda l: F.struct(l.cast("int").alias("level"), _halved(cell, l).cast("long").alias("node")))


def _top_level(df: DataFrame, start: str, end: str, seconds: int) -> Column:
    """Highest level that a cover of these intervals can use; one number, from one pass."""
    cells = _last_cell(end, start, seconds) - _cell(start, seconds) + 1
    return F.lit(math.ceil(math.log2(df.agg(F.max(cells)).first()[0] or 1)))


def _nodes(df: DataFrame, nodes: Column) -> DataFrame:
    return df.withColumn("__n", F.explode(nodes)).select("*", F.col("__n.level").alias("__level"), F.col("__n.node").alias("__node")).drop("__n")


def interval_conflicts(
    df: DataFrame, key: str, id: str, start: str = "start", end: str = "end", grain_seconds: int = 3600, shown: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """Pairs of overlapping intervals of the same key, each pair once: ``(key, a, b, from, to)``.

    The interval that starts later (ties by id) is looked up at its starting cell: an earlier one holds
    that cell iff one node of its dyadic cover lies on the cell's path up, and then exactly one
    does. Intervals of a minute and of a year meet without a bucket size to choose: both are a few
    dozen rows at most. Crowded nodes are split by AQE's skew join. ``shown`` (such as a date format) makes ``from``
    and ``to`` of times; it is applied once per interval, of which there are far fewer than pairs.
    """
    whole = df.where(F.col(start) < F.col(end))
    top = _top_level(whole, start, end, grain_seconds)
    slim = whole.select(F.col(key).alias("key"), F.col(id).alias("id"), F.col(start).alias("s"), F.col(end).alias("e"))
    a = slim.select("key", F.col("id").alias("a"), F.col("s").alias("a_s"), F.col("e").alias("a_e"), shown(F.col("e")).alias("a_to"))
    a = _nodes(a, cover(_cell("a_s", grain_seconds), _last_cell("a_e", "a_s", grain_seconds), top))
    b = slim.select("key", F.col("id").alias("b"), F.col("s").alias("b_s"), F.col("e").alias("b_e"), shown(F.col("s")).alias("b_from"), shown(F.col("e")).alias("b_to"))
    b = _nodes(b, path_up(_cell("b_s", grain_seconds), top))
    later = (F.col("b_s") > F.col("a_s")) | ((F.col("b_s") == F.col("a_s")) & (F.col("b") > F.col("a")))
    pairs = a.join(b, ["key", "__level", "__node"]).where(later & (F.col("b_s") < F.col("a_e")))
    return pairs.select(
        F.col("key").alias(key),
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.col("b_from").alias("from"),
        F.when(F.col("a_e") <= F.col("b_e"), F.col("a_to")).otherwise(F.col("b_to")).alias("to"),
    )


def conflict_counts(df: DataFrame, key: str, id: str, start: str = "start", end: str = "end") -> DataFrame:
    """``(key, id, start, earlier)``: how many intervals of the same key that began before (ties by id) still run at the start.

    The sum of ``earlier`` is the number of conflicting pairs. Starts and ends are merged in time order and
    summed as they go, so no pair is formed. Empty intervals and those with a null key, end or start are left out.
    """
    whole = df.where((F.col(start) < F.col(end)) & F.col(key).isNotNull())
    event = lambda at, kind, step: whole.select(F.col(key), F.col(at).alias("__t"), F.lit(kind).alias("__k"), F.col(id), F.lit(step).alias("__step"))
    # An interval that ends where another starts is no conflict, so ends come first.
    merged = running(event(end, 0, -1).unionByName(event(start, 1, 1)), [key], ["__t", "__k", id], __open=("sum", "__step"))
    return merged.where("__k = 1").select(key, id, F.col("__t").alias(start), (F.col("__open") - 1).cast("long").alias("earlier"))


def in_conflict(df: DataFrame, key: str, id: str, start: str = "start", end: str = "end") -> DataFrame:
    """``df`` with ``conflict``: whether the interval overlaps another of the same key.

    In start order an interval overlaps one before it iff the latest end so far lies past its start,
    and one after it iff the next starts before its end; no pair is formed. Empty
    intervals and those with a null key, end or start conflict with none.
    """
    whole = (F.col(start) < F.col(end)) & F.col(key).isNotNull()
    ordered = running(
        df.where(whole), [key], [start, id, end], **{"__next": ("lead", F.col(start)), "__most": ("max", F.col(end))}
    )
    ordered = running(ordered, [key], [start, id, end], **{"__before": ("lag", F.col("__most"))})
    hit = F.coalesce(F.col("__before") > F.col(start), F.lit(False)) | F.coalesce(F.col("__next") < F.col(end), F.lit(False))
    out = ordered.select(*df.columns, hit.alias("conflict"))
    return out.unionByName(df.where(~F.coalesce(whole, F.lit(False))).withColumn("conflict", F.lit(False)))


def overlapping(
    df: DataFrame, other: DataFrame, key: str, id: str, start: str = "start", end: str = "end", grain_seconds: int = 3600
) -> DataFrame:
    """Rows of ``df`` (unique ``id``) overlapping an interval of ``other`` with the same key.

    An existence test: of two overlapping intervals one holds the other's start, so each side's starting
    cells meet the dyadic covers of the other in a semi join, and only ids come back.
    """
    left = df.where(F.col(start) < F.col(end)).select(id, F.col(key).alias("__k"), F.col(start).alias("__s"), F.col(end).alias("__e"))
    right = other.where(F.col(start) < F.col(end)).select(F.col(key).alias("__k2"), F.col(start).alias("__s2"), F.col(end).alias("__e2"))

    def hits(point: DataFrame, spans: DataFrame, at: str, first: str, last: str) -> tuple[DataFrame, DataFrame]:
        top = _top_level(spans, first, last, grain_seconds)
        return _nodes(point, path_up(_cell(at, grain_seconds), top)), _nodes(spans, cover(_cell(first, grain_seconds), _last_cell(last, first, grain_seconds), top))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnsRenamed({"__level": "__level2", "__node": "__node2"})
        same = (F.col("__k") == F.col("__k2")) & (F.col("__level") == F.col("__level2")) & (F.col("__node") == F.col("__node2"))
        return a.join(b, same & (F.col("__s") < F.col("__e2")) & (F.col("__s2") < F.col("__e")), "left_semi").select(id)

    points, spans = hits(left, right, "__s", "__s2", "__e2")
    starts, holders = hits(right, left, "__s2", "__s", "__e")
    return df.join(met(points, spans).unionByName(met(holders, starts)).distinct(), id, "left_semi")


def leave_clash(shifts: DataFrame, leave: DataFrame, key: str, id: str, **options) -> DataFrame:
    """Shifts that fall in approved leave of the same person."""
    return overlapping(shifts, leave, key, id, **options)


def available(rooms: DataFrame, bookings: DataFrame, blocks: DataFrame, slot: tuple[str, str], room: str = "room") -> DataFrame:
    """Rooms with neither a booking nor a maintenance block in the slot."""
    lo, hi = (F.lit(s).cast("timestamp_ntz") for s in slot)
    busy = bookings.select(room, "start", "end").unionByName(blocks.select(room, "start", "end"))
    taken = busy.where((F.col("start") < hi) & (F.col("end") > lo)).select(room).distinct()
    return rooms.join(taken, room, "left_anti")


def tier_lookup(requests: DataFrame, tiers: DataFrame, sku: str = "sku", quantity: str = "quantity") -> DataFrame:
    """Price tier of each request, indicative total and a flag: ``ok``, ``custom`` or ``no_tier``.

    ``tiers`` has ``sku, lo, hi, price``; a null ``hi`` is an open top tier. A request asking
    for customised terms (``custom`` true) is flagged whatever its tier.
    """
    t = tiers.select(F.col(sku).alias("__sku"), "lo", "hi", "price")
    match = (F.col(sku) == F.col("__sku")) & (F.col(quantity) >= F.col("lo"))
    match = match & (F.col(quantity) <= F.coalesce(F.col("hi"), F.lit(2**62)))
    custom = F.coalesce(F.col("custom"), F.lit(False)) if "custom" in requests.columns else F.lit(False)
    out = requests.join(t, match, "left").drop("__sku")
    return out.withColumns(
        {
            "total": F.round(F.col(quantity) * F.col("price"), 2),
            "flag": F.when(F.col("price").isNull(), "no_tier").when(custom, "custom").otherwise("ok"),
        }
    )


def owner_as_of(
    events: DataFrame, periods: DataFrame, key: Sequence[str], ts: str, id: str, since: str, value: str, **split
) -> DataFrame:
    """Events with the value of the latest period starting at or before them (null if none).

    Periods and events are merged in time order and the last value carried forward, so no
    pair of an event and an earlier period is formed. Equal starts: the greatest value wins.
    """
    typ = periods.schema[value].dataType
    left = events.select(*key, F.col(ts).alias("__t"), F.lit(1).alias("__k"), F.col(id).cast("string").alias("__i"), F.lit(None).cast(typ).alias("__v"), F.struct(*events.columns).alias("__row"))
    right = periods.where(F.col(value).isNotNull()).select(
        *key, F.col(since).alias("__t"), F.lit(0).alias("__k"), F.lit("").alias("__i"), F.col(value).alias("__v"), F.lit(None).cast(left.schema["__row"].dataType).alias("__row")
    )
    merged = running(left.unionByName(right), key, ["__t", "__k", "__i", "__v"], __value=("last", "__v"), **split)
    return merged.where("__k = 1").select("__row.*", F.col("__value").alias(value))


def first_ack(
    incidents: DataFrame,
    acks: DataFrame,
    key: str,
    id: str,
    ts: str = "ts",
    severity: str = "severity",
    limits: Mapping[str, int] = ACK_MINUTES,
    **split,
) -> DataFrame:
    """Incidents with the first acknowledgement of the same key, minutes to it, and ``sla_met``.

    Incidents and acknowledgements are merged backwards in time and the next acknowledgement is
    carried to each incident: one pass, no pairs.
    """
    back = lambda c: -F.unix_micros(F.col(c).cast("timestamp"))
    left = incidents.select(F.col(key), back(ts).alias("__t"), F.lit(1).alias("__k"), F.col(id).cast("string").alias("__i"), F.lit(None).cast(acks.schema[ts].dataType).alias("__a"), F.struct(*incidents.columns).alias("__row"))
    right = acks.select(F.col(key), back(ts).alias("__t"), F.lit(0).alias("__k"), F.lit("").alias("__i"), F.col(ts).alias("__a"), F.lit(None).cast(left.schema["__row"].dataType).alias("__row"))
    merged = running(left.unionByName(right), [key], ["__t", "__k", "__i"], __next=("last", "__a"), **split)
    out = merged.where("__k = 1").select("__row.*", F.col("__next").alias("acked_at"))
    minutes = (F.unix_micros(F.col("acked_at").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 60_000_000
    limit = F.lit(None).cast("double")
    for name, m in limits.items():
        limit = F.when(F.col(severity) == name, F.lit(float(m))).otherwise(limit)
    out = out.withColumns({"minutes_to_ack": minutes, "limit_minutes": limit})
    return out.withColumn("sla_met", F.coalesce(F.col("minutes_to_ack") <= F.col("limit_minutes"), F.lit(False)))


def recurring(
    rules: DataFrame, id: str, start: str = "start", end: str = "end", weeks: str | int = "weeks"
) -> DataFrame:
    """Weekly instances of each rule: ``occurrence`` 0 … weeks − 1, no instance twice.

    ``weeks`` is a column or a number. Mark clashes with :func:`in_conflict`.
    """
    n = F.col(weeks) if isinstance(weeks, str) else F.lit(weeks)
    out = rules.dropDuplicates([id]).withColumn("occurrence", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)))
    shift = F.make_dt_interval(days=F.col("occurrence") * 7)
    return out.withColumns({start: F.col(start) + shift, end: F.col(end) + shift})
