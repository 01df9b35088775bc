"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.session import prepare
from casework.sources.files import table


class Tables:
    """Attribute access to the tables of a folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"{name} registered twice")
        REGISTRY[name] = Entry(name, fn, sql)
        return fn

    return add


#: Times in results.
TIME = "yyyy-MM-dd HH:mm:ss"


def portable(df: DataFrame) -> DataFrame:
    """Result columns in types every SQL engine shares: bigint, double, boolean, string."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIME)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        out.append(c.alias(f.name))
    return df.select(*out)


def runnable(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(entry.build(Tables(prepare(spark), folder)))

    run.__name__ = entry.name
    return run
