"""Ordered computations (row numbers, running sums, neighbours, last value) safe under skew.

A plain window sends every row of a key to one task. :func:`running` does the same work, but
a key that holds a large share of the rows is first cut into ordered segments:

1. cut points come from a hash sample of the (key, order) columns, at most a few ten
   thousand rows, and are kept only for keys that span several of ``SEGMENTS`` equal shares;
2. the window runs per (key, segment), so no task holds more than about two shares;
3. one row per hot (key, segment) carries counts, sums and edge values over the cuts. These
   rows are bounded by the number of cut points, so joining them back is a broadcast.

Results do not depend on where the cuts fall. Small inputs skip step 1 and use the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.session import estimated_bytes, has_shuffle, materialise

SEGMENTS = 512
SAMPLES_PER_SEGMENT = 32
#: Inputs estimated below this size are left to a plain window: one task for each key, or a single one where there is no key.
SPLIT_BYTES, SPLIT_BYTES_WITHOUT_KEY = 1 << 30, 64 << 20

_SEG, _HOT, _RN = "__segment", "__cuts", "__rn"


def _sortable(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """Order columns as types whose values can travel as literals."""
    fields = df.select(*[c.alias(f"o{i}") for i, c in enumerate(order)]).schema.fields
    out = []
    for c, f in zip(order, fields):
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dataType, T.DateType):
            c = F.unix_date(c)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c)
    return out


def cut_points(df: DataFrame, keys: Sequence[str], order: Sequence[Column], segments: int, samples: int):
    """Rows ``(*keys, cuts)`` for keys spanning more than two shares of the data."""
    cols = [F.col(k) for k in keys] + [c.alias(f"__o{i}") for i, c in enumerate(order)]
    slim = df.select(*cols)
    rate = max(1, slim.count() // (segments * samples))
    sample = (
        slim.where(F.pmod(F.xxhash64(*[F.col(c) for c in slim.columns]), F.lit(rate)) == 0)
        .distinct()
        .orderBy(*[F.col(c) for c in slim.columns])
    )
    rows = sample.collect()
    width = len(keys)
    cuts = []
    for key, group in groupby(rows, key=lambda r: tuple(r[:width])):
        points = [tuple(r[width:]) for r in group]
        if len(points) > 2 * samples:
            cuts.append((*key, points[samples::samples]))
    fields = list(sample.schema.fields)
    struct = T.StructType(fields[width:])
    return cuts, T.StructType([*fields[:width], T.StructField(_HOT, T.ArrayType(struct))])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    *,
    split_bytes: int | None = None,
    segments: int = SEGMENTS,
    samples: int = SAMPLES_PER_SEGMENT,
    **outputs: tuple[str, str | Column | None],
) -> DataFrame:
    """Add ordered columns to ``df``; ``outputs`` maps a name to ``(kind, column)``.

    Kinds: ``number`` (row number), ``sum`` (running sum up to the row), ``max`` (running maximum),
    ``lag``, ``lead`` and ``last`` (last non-null value up to the row). ``order`` is ascending and must be total.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    outputs = {n: (k, F.col(c) if isinstance(c, str) else c) for n, (k, c) in outputs.items()}
    limit = (SPLIT_BYTES if keys else SPLIT_BYTES_WITHOUT_KEY) if split_bytes is None else split_bytes
    cuts: list = []
    if estimated_bytes(df) > limit:
        # Cut points, edges and rows are three readings; a shuffled input is written once instead.
        df = materialise(df, "ordered") if has_shuffle(df) else df
        plain = _sortable(df, order)
        cuts, schema = cut_points(df, keys, plain, segments, samples)
    if not cuts:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[_local(k, c, window).alias(n) for n, (k, c) in outputs.items()])
    return _segmented(df, keys, order, plain, cuts, schema, outputs)


def _local(kind: str, c: Column | None, window) -> Column:
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "number":
        return F.row_number().over(window).cast("long")
    if kind == "sum":
        return F.sum(c).over(upto)
    if kind == "max":
        return F.max(c).over(upto)
    if kind == "lag":
        return F.lag(c).over(window)
    if kind == "lead":
        return F.lead(c).over(window)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(upto)
    raise ValueError(f"unknown kind {kind!r}")


def _segmented(df, keys, order, plain, cuts, schema, outputs) -> DataFrame:
    spark = df.sparkSession
    names = [f"__k{i}" for i in range(len(keys))]
    here = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(plain)])
    if keys:
        hot = spark.createDataFrame(cuts, schema).toDF(*names, _HOT)
        match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
        df = df.join(F.broadcast(hot), match, "left").drop(*names)
    else:
        points = [
            F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(p, schema[_HOT].dataType.elementType)])
            for p in cuts[0][0]
        ]
        df = df.withColumn(_HOT, F.array(*points))
    segment = F.coalesce(F.size(F.filter(F.col(_HOT), lambda p: p <= here)), F.lit(0))
    df = df.withColumn(_SEG, F.when(F.col(_HOT).isNull(), 0).otherwise(segment))

    at = F.struct(*order)
    edges = []
    for name, (kind, c) in outputs.items():
        if kind == "number":
            edges.append(F.count(F.lit(1)).alias(name))
        elif kind == "sum":
            edges.append(F.sum(c).alias(name))
        elif kind == "max":
            edges.append(F.max(c).alias(name))
        elif kind == "lag":
            edges.append(F.max_by(c, at).alias(name))
        elif kind == "lead":
            edges.append(F.min_by(c, at).alias(name))
        else:
            edges.append(F.max_by(c, F.when(c.isNotNull(), at)).alias(name))
    edge = df.where(F.col(_HOT).isNotNull()).groupBy(*keys, _SEG).agg(*edges)

    across = Window.partitionBy(*keys).orderBy(_SEG)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for name, (kind, _) in outputs.items():
        c = F.col(name)
        if kind in ("number", "sum"):
            c = F.sum(c).over(before)
        elif kind == "max":
            c = F.max(c).over(before)
        elif kind == "lag":
            c = F.lag(c).over(across)
        elif kind == "lead":
            c = F.lead(c).over(across)
        else:
            c = F.last(c, ignorenulls=True).over(before)
        carried.append(c.alias(f"__c_{name}"))
    edge = edge.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(_SEG).alias("__s"), *carried)

    window = Window.partitionBy(*keys, _SEG).orderBy(*order)
    full = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    original = [c for c in df.columns if c not in (_HOT, _SEG)]
    local = df.select(
        *original,
        _SEG,
        F.row_number().over(window).alias(_RN),
        F.count(F.lit(1)).over(full).alias("__size"),
        *[_local(k, c, window).alias(f"__l_{n}") for n, (k, c) in outputs.items()],
    )
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)] + [F.col(_SEG) == F.col("__s")]
    joined = local.join(F.broadcast(edge), match, "left")
    final = []
    for name, (kind, _) in outputs.items():
        here_, carry = F.col(f"__l_{name}"), F.col(f"__c_{name}")
        if kind == "number":
            value = here_ + F.coalesce(carry, F.lit(0))
        elif kind == "sum":
            value = F.when(here_.isNull(), carry).otherwise(here_ + F.coalesce(carry, F.lit(0)))
        elif kind == "max":
            value = F.greatest(here_, carry)
        elif kind == "lag":
            value = F.when(F.col(_RN) == 1, carry).otherwise(here_)
        elif kind == "lead":
            value = F.when(F.col(_RN) == F.col("__size"), carry).otherwise(here_)
        else:
            value = F.coalesce(here_, carry)
        final.append(value.alias(name))
    return joined.select(*original, *final)
