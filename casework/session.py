"""Session settings, scratch folders and size checks shared by every module."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows a side may have before it is no longer sent to every executor.
BROADCAST_ROWS = 100_000


def build_session(app: str = "casework", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and skew-join handling; extra settings by keyword."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``; only where that is
    unset on a local master is a folder of our own made and set. A cluster without one is
    refused, because its executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="casework-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh, never reused path below :func:`scratch_root`."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``options`` are those of the Parquet writer.

    Used where one result feeds several jobs (iterative training, split planning). The
    table survives lost executors and cuts the lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; needs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def has_shuffle(df: DataFrame) -> bool:
    """True when computing ``df`` needs a shuffle, so that computing it twice is worth avoiding."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` is proven to have at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows
