"""Streams: audit log, index and catalogue upkeep, acknowledgement watch, counts, alerts.

Event time must be ``timestamp``; parquet written elsewhere often holds ``timestamp_ntz``, which
watermarks reject, so :func:`read_stream` casts it. State lives in RocksDB, sinks are
idempotent per batch, and every job takes its checkpoint folder from the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casework.sources.versions import VersionedTable

# Fixed values.
LATENESS = "1 hour"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with changelog checkpoints, instead of the executors' heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, ts: str | None = None, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """File stream with a declared schema and, when named, an event time of type ``timestamp``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.parquet(path)
    return df.withColumn(ts, F.col(ts).cast("timestamp")) if ts else df


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Process everything there is now and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def audit_stream(src: DataFrame, record_id: Sequence[str], ts: str, valid: Column, lateness: str = LATENESS) -> DataFrame:
    """One record per interaction even when a sender retries; invalid records are marked.

    Duplicates are remembered only as long as the watermark needs.
    """
    once = src.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(record_id))
    return once.withColumns({"valid": F.coalesce(valid, F.lit(False)), "date": F.to_date(ts)})


def json_log(df: DataFrame, path: str):
    """Append-only JSON sink, one folder per date."""
    return df.writeStream.format("json").option("path", path).partitionBy("date").outputMode("append")


def versioned_sink(table: VersionedTable, prepare: Callable[[DataFrame], DataFrame], removed: Callable[[DataFrame], DataFrame] | None = None, compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink that publishes each batch as one version of a table.

    A retried batch is known by its number and counts once. ``removed`` gives the keys whose older rows go;
    with ``compact_every`` loads are merged whenever so many have gathered.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        done = table.apply(prepare(batch), f"batch {batch_id}", removed(batch) if removed else None)
        if compact_every and len(done.folders) >= compact_every:
            table.compact()

    return write


def index_stream(src: DataFrame, table: VersionedTable, chunk: Callable[[DataFrame], DataFrame], key: str = "doc_id", compact_every: int | None = None):
    """New and changed documents re-chunked into a versioned index.

    Every processed document replaces its old chunks, also when it no longer yields any.
    """
    return src.writeStream.foreachBatch(versioned_sink(table, chunk, lambda batch: batch.select(key), compact_every)).outputMode("append")


def forget(table: VersionedTable, gone: DataFrame, batch: str) -> None:
    """Take the documents ``gone`` (their keys) out of a versioned index."""
    empty = table.read().limit(0)
    table.apply(empty, batch, gone)


def unacked_stream(incidents: DataFrame, acks: DataFrame, key: str, ts: str, limits: dict[str, int], lateness: str = LATENESS) -> DataFrame:
    """Incidents not acknowledged within the minutes their severity allows.

    A left-outer interval join; an incident comes out once both watermarks have passed its limit.
    Severities without a limit are left out. The sides meet by key and stretch of time, as long as the
    longest limit, so a key with very many incidents is spread over tasks: an acknowledgement
    is sent to its own stretch and the one before, an incident is in one.
    """
    minutes = F.lit(None).cast("int")
    for name, m in limits.items():
        minutes = F.when(F.col("severity") == name, F.lit(m)).otherwise(minutes)
    longest = max(limits.values())
    stretch = lambda c: F.floor(F.unix_seconds(F.col(c)) / (longest * 60))
    watched = incidents.withColumn("__deadline", F.col(ts) + F.make_dt_interval(mins=minutes)).where("__deadline is not null").withWatermark(ts, lateness)
    watched = watched.withColumn("__part", stretch(ts))
    answers = acks.select(F.col(key).alias("__ack_key"), F.col(ts).alias("__ack_ts")).withWatermark("__ack_ts", lateness)
    answers = answers.withColumn("__ack_part", F.explode(F.array(stretch("__ack_ts"), stretch("__ack_ts") - 1)))
    within = (
        (F.col(key) == F.col("__ack_key"))
        & (F.col("__part") == F.col("__ack_part"))
        & (F.col("__ack_ts") >= F.col(ts))
        & (F.col("__ack_ts") <= F.col(ts) + F.expr(f"interval {longest} minutes"))
        & (F.col("__ack_ts") <= F.col("__deadline"))
    )
    joined = watched.join(answers, within, "left_outer")
    return joined.where("__ack_ts is null").withColumnRenamed("__deadline", "deadline").drop("__ack_key", "__ack_ts", "__part", "__ack_part")


def tumbling_counts(src: DataFrame, ts: str, by: Sequence[str], every: str = "1 day", offset: str = "7 hours", lateness: str = LATENESS) -> DataFrame:
    """Counts per tumbling window (daily from 07:00) and group; rows past the watermark are dropped."""
    w = F.window(ts, every, every, offset)
    counts = src.withWatermark(ts, lateness).groupBy(w.alias("__w"), *by).agg(F.count(F.lit(1)).alias("incidents"))
    return counts.select(F.to_date(F.col("__w.start")).alias("day"), *by, "incidents")


def alerts(src: DataFrame, escalated: Column, log: str, notify: str):
    """Every row to the log, escalated rows also to the notify sink; both idempotent per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        batch.write.mode("overwrite").parquet(f"{log}/load={batch_id}")
        batch.where(escalated).write.mode("overwrite").parquet(f"{notify}/load={batch_id}")
        batch.unpersist()

    return src.writeStream.foreachBatch(write).outputMode("append")


def price_sync(src: DataFrame, table: VersionedTable, approved: str, synced: str, limit: str = "2 hours", compact_every: int | None = None):
    """Approved changes applied to a versioned catalogue, whose order says which change is newest; changes later than the limit are flagged."""
    late = F.col(synced) > F.col(approved) + F.expr(f"interval {limit}")
    newest = Window.partitionBy(table.key).orderBy(*[F.col(c).desc() for c in table.order])

    def last_change(batch: DataFrame) -> DataFrame:
        ranked = batch.withColumn("late", late).withColumn("__rn", F.row_number().over(newest))
        return ranked.where("__rn = 1").drop("__rn")

    return src.writeStream.foreachBatch(versioned_sink(table, last_change, compact_every=compact_every)).outputMode("append")
