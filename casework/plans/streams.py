"""Streaming jobs run to the end of the given tables and compared with their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from casework.operators import corpus, intervals
from casework.plans.bindings import SQL_CHUNKS, acks, audit_records, incidents
from casework.plans.measures import categorised
from casework.plans.registry import query
from casework.plans.relations import FMT, SQL_ACKED
from casework.session import scratch_path
from casework.sources.versions import VersionedTable
from casework.streaming import jobs, ladder


def played(t, name, steps, start):
    """Feed a stream step by step: each step's frames are written with their own partitions and the job runs until it has read them.

    ``steps`` maps source names to frames; ``start`` takes the streams' folders and schemas by source, and a checkpoint folder.
    """
    sources = {k: (scratch_path(t.spark, f"{name}-{k}"), df.schema) for k, df in steps[0].items()}
    checkpoint = scratch_path(t.spark, f"{name}-checkpoint")
    for step in steps:
        for k, df in step.items():
            df.write.mode("append").parquet(sources[k][0])
        start(sources, checkpoint)


def closing(df, ts="ts", **fixed):
    """One row far in the future, which lets the watermark pass every real row."""
    last = df.agg(F.max(ts).alias(ts)).select((F.col(ts) + F.expr("interval 30 days")).alias(ts))
    cols = []
    for f in df.schema.fields:
        value = F.col(ts) if f.name == ts else F.lit(fixed.get(f.name)).cast(f.dataType)
        cols.append(value.alias(f.name))
    return last.select(*cols)


def into(t, path, build, ts="ts"):
    """A ``start`` for :func:`played`: the job ``build`` makes of the streams, appended to a parquet folder."""

    def start(sources, checkpoint):
        out = build(**{k: jobs.read_stream(t.spark, folder, schema, ts) for k, (folder, schema) in sources.items()})
        jobs.run_available(out.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)

    return start


@query(
    "t1_audit_stream",
    """SELECT event_id, event_type, value >= 1 AS valid, strftime(ts, '%Y-%m-%d') AS date FROM events""",
)
def _(t):
    jobs.use_rocksdb(t.spark)
    read = lambda: jobs.read_stream(t.spark, t.folder, t.events.schema, "ts", glob="events.parquet")
    retried = read().unionByName(read().where("event_type <> 'view'"))
    out = jobs.audit_stream(retried, ["event_id"], "ts", F.col("value") >= 1).select("event_id", "event_type", "valid", "date")
    path = scratch_path(t.spark, "audit")
    jobs.run_available(jobs.json_log(out, path), scratch_path(t.spark, "audit-checkpoint"))
    return t.spark.read.schema(out.schema).json(path)


CHANGED = "(SELECT doc_id, CASE WHEN lang = 'en' THEN text || ' and these words were added later' ELSE text END AS text, lang, source FROM documents)"


@query(
    "t2_index_stream",
    f"""WITH {SQL_CHUNKS.replace('FROM documents)', 'FROM ' + CHANGED + ')')}
SELECT doc_id, chunk_index, md5(content) AS content_md5 FROM chunks""",
)
def _(t):
    docs = t.documents.select("doc_id", "text", "lang")
    changed = docs.where("lang = 'en'").withColumn("text", F.concat("text", F.lit(" and these words were added later")))
    table = VersionedTable(t.spark, scratch_path(t.spark, "index"), "doc_id")
    chunk = lambda batch: corpus.chunk_fixed(batch.select("doc_id", "text"), "doc_id", "text")

    def start(sources, checkpoint):
        jobs.run_available(jobs.index_stream(jobs.read_stream(t.spark, *sources["docs"]), table, chunk, compact_every=2), checkpoint)

    played(t, "documents", [{"docs": docs}, {"docs": changed}], start)
    return table.read().select("doc_id", "chunk_index", F.md5("content").alias("content_md5"))


LIMITS = {"critical": 15, "high": 120}


@query(
    "t3_unacked_stream",
    f"""WITH {SQL_ACKED} SELECT event_id, severity, strftime(ts + CASE severity WHEN 'critical' THEN INTERVAL 15 MINUTE ELSE INTERVAL 120 MINUTE END, '{FMT}') AS deadline
FROM acked WHERE severity <> 'standard' AND coalesce(epoch(acked_at - ts) / 60 > CASE severity WHEN 'critical' THEN 15 ELSE 120 END, true)""",
)
def _(t):
    jobs.use_rocksdb(t.spark)
    opened, answered = incidents(t), acks(t)
    last = {"incidents": closing(opened, event_id=-1, user_id=-1, severity="high"), "acks": closing(answered, user_id=-1)}
    path = scratch_path(t.spark, "unacked")
    watch = lambda incidents, acks: jobs.unacked_stream(incidents, acks, "user_id", "ts", LIMITS)
    played(t, "incidents", [{"incidents": opened, "acks": answered}, last], into(t, path, watch))
    return t.spark.read.parquet(path).where("event_id >= 0").select("event_id", "severity", "deadline")


@query(
    "t4_escalation_ladder",
    f"""WITH {SQL_ACKED}, steps(severity, step, minutes, recipient) AS (VALUES ('critical', 0, 0, 'Clinical Lead, CEO'), ('critical', 1, 15, 'On-Call Manager'), ('high', 0, 120, 'Clinical Lead'), ('high', 1, 240, 'CEO'))
SELECT event_id AS incident_id, severity, step::BIGINT AS step, recipient, strftime(ts + to_minutes(minutes), '{FMT}') AS due
FROM acked JOIN steps USING (severity) WHERE minutes = 0 OR acked_at IS NULL OR acked_at > ts + to_minutes(minutes)""",
)
def _(t):
    jobs.use_rocksdb(t.spark)
    acked = intervals.first_ack(incidents(t), acks(t), "user_id", "event_id")
    cols = lambda kind, ts: [F.col("event_id").alias("incident_id"), F.lit(kind).alias("kind"), "severity", F.col(ts).alias("ts")]
    log = acked.select(*cols("incident", "ts")).unionByName(acked.where("acked_at is not null").select(*cols("ack", "acked_at")))
    path = scratch_path(t.spark, "ladder-log")
    steps = [{"log": log}, {"log": closing(log, incident_id=-1, kind="ack", severity="standard")}]
    played(t, "ladder", steps, into(t, path, lambda log: ladder.escalation_ladder(log)))
    return t.spark.read.parquet(path)


@query(
    "t5_tumbling_counts",
    """WITH d AS (SELECT (ts - INTERVAL 7 HOUR)::DATE::VARCHAR AS day, CASE WHEN value >= 200 THEN 'critical' WHEN value >= 50 THEN 'high' ELSE 'standard' END AS severity,
  CASE user_id % 3 WHEN 0 THEN 'fall' WHEN 1 THEN 'behaviour' ELSE 'other' END AS category FROM events WHERE event_type = 'error')
SELECT day, severity, category, count(*) AS incidents FROM d GROUP BY ALL""",
)
def _(t):
    jobs.use_rocksdb(t.spark)
    rows = categorised(t).select("ts", "severity", "category")
    path = scratch_path(t.spark, "daily")
    steps = [{"rows": rows}, {"rows": closing(rows, severity="none", category="none")}]
    played(t, "categorised", steps, into(t, path, lambda rows: jobs.tumbling_counts(rows, "ts", ["severity", "category"])))
    return t.spark.read.parquet(path).where("severity <> 'none'")


@query(
    "t6_alerts",
    """SELECT 'log' AS target, event_type AS topic, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT 'notify', event_type, count(*) FROM events WHERE (value % 100) / 100 < 0.7 GROUP BY ALL""",
)
def _(t):
    log, notify = scratch_path(t.spark, "log"), scratch_path(t.spark, "notify")

    def start(sources, checkpoint):
        jobs.run_available(jobs.alerts(jobs.read_stream(t.spark, *sources["records"]), F.col("top_score") < 0.7, log, notify), checkpoint)

    played(t, "audit", [{"records": audit_records(t).select("event_id", "topic", "top_score")}], start)
    read = lambda path, name: t.spark.read.parquet(path).groupBy(F.lit(name).alias("target"), "topic").agg(F.count(F.lit(1)).alias("n"))
    return read(log, "log").unionByName(read(notify, "notify"))


@query(
    "t7_price_sync",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderkey % 5 > 2 AS late FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t):
    """Two steps: settled changes first, pending ones later; the later approval wins, whichever step brings it."""
    rows = t.orders.select(
        "o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").alias("approved"), (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 5).cast("int"))).alias("synced"), "o_orderstatus"
    )
    table = VersionedTable(t.spark, scratch_path(t.spark, "catalogue"), "o_custkey", ["approved", "o_orderkey"])

    def start(sources, checkpoint):
        jobs.run_available(jobs.price_sync(jobs.read_stream(t.spark, *sources["changes"]), table, "approved", "synced"), checkpoint)

    played(t, "changes", [{"changes": rows.where("o_orderstatus <> 'P'")}, {"changes": rows.where("o_orderstatus = 'P'")}], start)
    return table.read().select("o_custkey", "o_orderkey", "o_totalprice", "late")
