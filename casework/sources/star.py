"""Star schemas: a fact table and its dimensions, read with declared schemas and joined by declared keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.sources.files import load_star

Reader = Callable[[str, T.StructType], DataFrame]


@dataclass(frozen=True)
class Table:
    """A table's name and its declared columns as DDL."""

    name: str
    columns: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


@dataclass(frozen=True)
class Dimension(Table):
    """A dimension; ``fact_key`` of the fact, or of a dimension before this one, holds its ``key``."""

    key: str = ""
    fact_key: str = ""


@dataclass(frozen=True)
class Star:
    fact: Table
    dimensions: tuple[Dimension, ...] = field(default_factory=tuple)


#: Opportunities with their accounts, owners and the default probability of a stage.
SALES = Star(
    Table(
        "opportunities",
        "opportunity_id long, account_id long, owner_id long, stage string, estimated_revenue double, stage_probability double, "
        "close_date date, actual_close_date date, created_date date, status string",
    ),
    (
        Dimension("accounts", "account_id long, account_name string, industry string, tier string", "account_id", "account_id"),
        Dimension("users", "user_id long, full_name string, team string", "user_id", "owner_id"),
        Dimension("stage_probability", "stage string, default_probability double", "stage", "stage"),
    ),
)


def declared(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """The declared columns of ``df`` in their types, found in any case; other columns drop out, a missing one is an error."""
    there = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in there]
    if missing:
        raise ValueError(f"table {name} lacks the columns {', '.join(missing)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def from_folder(spark: SparkSession, folder: str, format: str = "parquet", **options) -> Reader:
    """Reader of ``<folder>/<name>.<format>``. CSV files have a header, whose names and order must be the declared ones."""

    def read(name: str, schema: T.StructType) -> DataFrame:
        reader = spark.read.format(format)
        if format == "csv":
            reader = reader.option("header", "true").option("enforceSchema", "false").option("mode", "FAILFAST").schema(schema)
        elif format == "json":
            reader = reader.option("mode", "FAILFAST").schema(schema)
        return reader.options(**options).load(f"{folder.rstrip('/')}/{name}.{format}")

    return read


def from_jdbc(spark: SparkSession, url: str, **options) -> Reader:
    """Reader of database tables; give ``partitionColumn`` and its bounds for tables that one task cannot read."""

    def read(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()

    return read


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row has, with their number of rows."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def read_star(star: Star, read: Reader) -> DataFrame:
    """The fact table with the columns of all dimensions, one row per fact.

    A fact without a partner in a dimension stays, with nulls there. A key that a dimension has twice
    would multiply facts and is an error. A dimension's key is left out, as the fact has it; a column
    whose name is taken is called ``<dimension>_<column>``.
    """
    wide = declared(read(star.fact.name, star.fact.schema), star.fact.schema, star.fact.name)
    for d in star.dimensions:
        dim = declared(read(d.name, d.schema), d.schema, d.name)
        twice = repeated_keys(dim, d.key).first()
        if twice is not None:
            raise ValueError(f"dimension {d.name} has {twice['rows']} rows with {d.key} = {twice[0]}")
        taken = set(wide.columns)
        dim = dim.withColumnsRenamed({c: f"{d.name}_{c}" for c in dim.columns if c in taken and c != d.key}).withColumnRenamed(d.key, "__key")
        wide = load_star(wide, [(dim, d.fact_key, "__key")]).drop("__key")
    return wide


def orphans(star: Star, read: Reader) -> DataFrame:
    """Per dimension: facts whose key it lacks, and facts without a key. Dimensions must hang on the fact itself.

    The fact's keys are counted before they meet a dimension, so a frequent key is one row in each task.
    """
    fact = declared(read(star.fact.name, star.fact.schema), star.fact.schema, star.fact.name)
    parts = []
    for d in star.dimensions:
        dim = declared(read(d.name, d.schema), d.schema, d.name).select(F.col(d.key).alias("__key"), F.lit(True).alias("__there"))
        keys = fact.groupBy(F.col(d.fact_key).alias("__fact_key")).agg(F.count(F.lit(1)).alias("n"))
        met = keys.join(dim.distinct(), F.col("__fact_key") == F.col("__key"), "left")
        lacking = F.when(F.col("__fact_key").isNotNull() & F.col("__there").isNull(), F.col("n")).otherwise(0)
        keyless = F.when(F.col("__fact_key").isNull(), F.col("n")).otherwise(0)
        parts.append(
            met.agg(F.coalesce(F.sum(lacking), F.lit(0)).alias("orphans"), F.coalesce(F.sum(keyless), F.lit(0)).alias("keyless")).select(F.lit(d.name).alias("dimension"), "orphans", "keyless")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sales_deals(read: Reader) -> DataFrame:
    """The sales star as deals for the sales measures; a deal's own probability goes before its stage's default."""
    wide = read_star(SALES, read)
    return wide.select(
        F.col("opportunity_id").alias("deal_id"),
        "account_name",
        "industry",
        "tier",
        F.col("full_name").alias("owner"),
        "team",
        "stage",
        F.col("estimated_revenue").alias("revenue"),
        F.coalesce("stage_probability", "default_probability").alias("probability"),
        F.col("created_date").alias("created"),
        F.col("close_date").alias("due"),
        F.col("actual_close_date").alias("closed"),
        "status",
    )
