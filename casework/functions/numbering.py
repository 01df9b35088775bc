"""Numbers in a total order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.session import materialise

#: Bits of Spark's increasing ids that count rows within a partition.
_ROWS = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str, first: int = 0) -> DataFrame:
    """``df`` with the position of each row in ``order`` as column ``name``, counted from ``first``.

    Rows are dealt into ranges of the order, sorted and written; the sizes of the ranges before, one
    row per partition, are added in a second pass. Equal rows of a partial order get neighbouring numbers.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = materialise(placed, "numbered")
    part = F.shiftright("__at", _ROWS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROWS) - 1))
    met = placed.withColumn("__part", part).join(F.broadcast(sizes), "__part")
    return met.withColumn(name, F.col("__before") + row + first).drop("__part", "__at", "__before")
