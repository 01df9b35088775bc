"""Feature preparation: encoding, scaling, imputing, splitting, weighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.ordered import running
from casework.functions.quantiles import exact_quantiles
from casework.operators.audit import unpivoted

# Fixed values.
RARE_SHARE = 0.01


def label_encode(df: DataFrame, columns: Sequence[str], **split) -> DataFrame:
    """Integer codes in sorted value order, as ``<column>_code``; null stays null."""
    for c in columns:
        values = df.where(F.col(c).isNotNull()).select(F.col(c).alias("__v")).distinct()
        codes = running(values, [], ["__v"], __n=("number", None), **split)
        codes = codes.select("__v", (F.col("__n") - 1).alias(f"{c}_code"))
        df = df.join(codes, F.col(c) == F.col("__v"), "left").drop("__v")
    return df


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of means and **population** standard deviations (``StandardScaler`` uses the sample form)."""
    return df.agg(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("mean", F.avg), ("std", F.stddev_pop))])


def standardise(df: DataFrame, columns: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """z-scores; pass the row fitted on the training part to scale the test part with it."""
    fitted = fitted if fitted is not None else fit_standard(df, columns)
    stat = lambda n: fitted.select(n).scalar()
    return df.withColumns({c: F.coalesce(F.try_divide(F.col(c) - stat(f"mean_{c}"), stat(f"std_{c}")), F.lit(0.0)) for c in columns})


def impute(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), **split) -> DataFrame:
    """Nulls replaced by the exact median, or by the most frequent value (ties: the smaller).

    Only one fitted value per column comes to the driver.
    """
    fills: dict[str, object] = {}
    if numeric:
        medians = exact_quantiles(unpivoted(df, numeric), ["column"], "value", {"median": 0.5}, **split)
        fills |= {r["column"]: r["median"] for r in medians.collect()}
    if categorical:
        lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in categorical])
        counts = df.select(F.inline(lines)).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("column").orderBy(F.col("n").desc(), "value")
        modes = counts.withColumn("rn", F.row_number().over(w)).where("rn = 1")
        fills |= {r["column"]: r["value"] for r in modes.collect()}
    done = {c: F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c))) for c in numeric}
    done |= {c: F.coalesce(F.col(c), F.lit(fills.get(c)).cast(df.schema[c].dataType)) for c in categorical}
    return df.withColumns(done)


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each non-null value: ``(value, share)``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.select("value", (F.col("n") / total).alias("share"))


def rare_group(df: DataFrame, column: str, threshold: float = RARE_SHARE, other: str = "other") -> DataFrame:
    """``<column>_grp``: the value, or ``other`` when its share is at or under the threshold.

    At most ``1 / threshold`` values are kept, which bounds the broadcast side.
    """
    keep = value_share(df, column).where(F.col("share") > threshold).select(F.col("value").alias("__keep"))
    joined = df.join(F.broadcast(keep), F.col(column) == F.col("__keep"), "left")
    return joined.withColumn(f"{column}_grp", F.coalesce("__keep", F.lit(other))).drop("__keep")


def frequency_encode(df: DataFrame, column: str, of: DataFrame | None = None, of_column: str | None = None) -> DataFrame:
    """``<column>_freq``: share of the value in ``of`` (default the frame itself), absent values 0."""
    shares = value_share(of if of is not None else df, of_column or column)
    joined = df.join(shares.select(F.col("value").alias("__v"), F.col("share").alias("__s")), F.col(column) == F.col("__v"), "left")
    return joined.withColumn(f"{column}_freq", F.coalesce("__s", F.lit(0.0))).drop("__v", "__s")


def one_hot(df: DataFrame, column: str, prefix: str | None = None, max_categories: int = 1000) -> DataFrame:
    """0/1 columns per value in sorted order, the first dropped. The column list must stay bounded."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} values; group rare ones first")
    values = sorted(r[0] for r in rows)[1:]
    prefix = prefix or column
    return df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def hash_fraction(key: str | Column, seed: int = 42) -> Column:
    """Number in [0, 1) from seed and key; the same in every run and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def split(df: DataFrame, test: float = 0.3, seed: int = 42, key: str | Column = "id") -> DataFrame:
    """Add ``part`` (``train`` or ``test``) by a hash of the key.

    Unlike ``randomSplit`` the result does not depend on partitions or retries.
    """
    return df.withColumn("part", F.when(hash_fraction(key, seed) < test, "test").otherwise("train"))


def fold(key: str | Column, folds: int, seed: int = 42) -> Column:
    """Fold number 0 … folds − 1 by a hash of the key."""
    return F.floor(hash_fraction(key, seed) * folds).cast("int")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``weight`` = n / (classes × class rows)."""
    counts = df.groupBy(F.col(label).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.agg(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"))
    weight = totals.select("n").scalar() / (totals.select("k").scalar() * F.col("__n"))
    return df.join(counts.withColumn("weight", weight), F.col(label).eqNullSafe(F.col("__c"))).drop("__c", "__n")
