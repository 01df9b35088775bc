"""Exact quantiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions.ordered import running


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], **split) -> DataFrame:
    """Linear-interpolated quantiles per key, one column per entry of ``probs``.

    Equal values are counted before the shuffle; positions come from a running sum over the
    distinct values, so a group of any size works. Nulls are ignored.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counts, keys, [value], __upto=("sum", "__n"), **split)
    totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    if keys:
        totals = totals.toDF(*[f"__t{i}" for i in range(len(keys))], "__total")
        placed = placed.join(totals, [F.col(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(keys)])
    else:
        placed = placed.withColumn("__total", totals.scalar())
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("__total") - 1)
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("__upto") - F.col("__n") <= position) & (position < F.col("__upto"))
            picks.append(F.max(F.when(inside, F.col(value).cast("double"))).alias(f"__{side}_{name}"))
        picks.append(F.max(at - F.floor(at)).alias(f"__f_{name}"))
    picked = placed.groupBy(*keys).agg(*picks)
    out = [
        (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}")).alias(n) for n in probs
    ]
    return picked.select(*keys, *out)
