"""Positions in a total order and cut-offs, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.session import materialise

_ROW_BITS = 33

#: Thresholds counted by one job of :func:`cutoff`.
WAYS = 16


def byte_slices(parts: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of about ``limit`` bytes; a longer row makes a slice of its own."""
    for batch in parts:
        if not batch.num_rows:
            continue
        rows = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if part.num_rows > 1 and part.nbytes > 2 * limit:
                yield from byte_slices(iter([part.slice(0, part.num_rows // 2), part.slice(part.num_rows // 2)]), limit)
            else:
                yield part


def numbered(df: DataFrame, order: list[Column], name: str, first: int = 0) -> DataFrame:
    """``df`` with its position in ``order`` (a total order) as column ``name``, from ``first``.

    Rows are dealt into ranges of the order and sorted there; a second pass adds the sizes of the
    ranges before, which are one row per partition.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, f"ranges-{name.strip('_')}")
    part, row = F.shiftright("_at", _ROW_BITS).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", F.shiftright("_at", _ROW_BITS)).join(F.broadcast(sizes), "_part")
    return joined.withColumn(name, F.col("_before") + row + first).drop("_part", "_at", "_before")


def _counts(df: DataFrame, tests: list[Column]) -> list[int]:
    row = df.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests)]).first()
    return [int(x) for x in row]


def cutoff(df: DataFrame, keys: list[str], k: int) -> Column:
    """Condition that the first ``k`` rows of ``df`` meet, ordered by the non-null integer ``keys``.

    The threshold of a key is found by repeated exact counts over ``df``, which should be a written
    table, each narrowing its interval ``WAYS`` times; rows that tie there go on to the next key. The
    keys together must tell all rows apart.
    """
    if k <= 0:
        return F.lit(False)
    tied, chosen, need = F.lit(True), F.lit(False), k
    for key in keys:
        low, high = df.where(tied).agg(F.min(key), F.max(key)).first()
        if low is None:
            return chosen
        while low < high:  # the threshold lies in low .. high
            steps = min(WAYS, high - low + 1)
            marks = sorted({low + (high - low) * i // steps for i in range(1, steps)} | ({low} if high - low < WAYS else set()))
            found = _counts(df.where(tied), [F.col(key) <= F.lit(m) for m in marks])
            above = [m for m, n in zip(marks, found) if n < need]
            high = min([m for m, n in zip(marks, found) if n >= need], default=high)
            low = max(above) + 1 if above else low
        below, upto = _counts(df.where(tied), [F.col(key) < F.lit(low), F.col(key) <= F.lit(low)])
        if upto <= need:
            return chosen | (tied & (F.col(key) <= F.lit(low)))
        chosen = chosen | (tied & (F.col(key) < F.lit(low)))
        tied, need = tied & (F.col(key) == F.lit(low)), need - below
        if not need:
            return chosen
    return chosen
