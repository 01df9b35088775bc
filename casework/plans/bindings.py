"""Stand-in views of the standard tables for the case data the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.operators.corpus import chunk_fixed
from casework.sources.files import spread


def tagged_documents(t) -> DataFrame:
    """Documents with audience and category, as the chunker expects them."""
    return spread(t.documents).select(
        "doc_id",
        "text",
        F.when(F.col("lang") == "en", "customer").otherwise("internal").alias("audience"),
        F.col("source").alias("category"),
    )


def chunks(t) -> DataFrame:
    return chunk_fixed(tagged_documents(t), "doc_id", "text")


# SQL text shared by several twins.
BLANK_RUN = r"[ \t\r\n\f]+"
STRIP = r"regexp_replace({0}, '^[ \t\r\n\f]+|[ \t\r\n\f]+$', '', 'g')"


def sql_strip(c: str) -> str:
    return STRIP.format(c)


def sql_words(c: str) -> str:
    return rf"string_split_regex({sql_strip(c)}, '{BLANK_RUN}')"


def sql_terms(c: str) -> str:
    return rf"list_filter(string_split_regex(lower({c}), '[^a-z]+'), lambda x: length(x) >= 3)"


SQL_CHUNKS = rf"""
words AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN 'customer' ELSE 'internal' END AS audience, source AS category,
         {sql_words('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, audience, category, i, array_to_string(w[i * 448 + 1 : i * 448 + 512], ' ') AS content
  FROM (SELECT *, unnest(range(0, CASE WHEN len(w) <= 512 THEN 1
                                       ELSE ceil((len(w) - 512) / 448.0)::BIGINT + 1 END)) AS i FROM words)),
chunks AS (
  SELECT doc_id, audience, category, content,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_index
  FROM windows WHERE length({sql_strip('content')}) > 50)
"""

SQL_CHUNK_IDS = """chunk_ids AS (
  SELECT substring(sha256(doc_id::VARCHAR || ':' || chunk_index::VARCHAR), 1, 32) AS id, * FROM chunks)"""


def opportunities(t) -> DataFrame:
    """Orders as sales opportunities; the deal closes with its last shipment."""
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    stage = F.element_at(
        F.create_map(*[F.lit(x) for p in STAGE_OF_PRIORITY.items() for x in p]), F.substring("o_orderpriority", 1, 1)
    )
    return (
        t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(t.customer.select("c_custkey", F.col("c_mktsegment").alias("industry")), F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("deal"),
            (F.col("o_custkey") % 12).alias("owner"),
            stage.alias("stage"),
            F.col("o_totalprice").alias("revenue"),
            F.when(F.col("o_orderkey") % 5 == 0, 50.0).alias("own_probability"),
            F.col("o_orderdate").alias("created"),
            "closed",
            "industry",
        )
    )


STAGE_OF_PRIORITY = {"1": "Discovery", "2": "Proposal", "3": "Negotiation", "4": "Closed Lost", "5": "Closed Won"}
PROBABILITY = {"Discovery": 10.0, "Proposal": 40.0, "Negotiation": 70.0, "Closed Won": 100.0, "Closed Lost": 0.0}


def deals(t) -> DataFrame:
    """Opportunities with the stage default where a deal has no probability of its own."""
    from casework.operators.compare import override_default

    ref = t.spark.createDataFrame(list(PROBABILITY.items()), "stage string, default_probability double")
    return override_default(opportunities(t), ref, "stage", "own_probability", "default_probability").drop("own_probability")


SQL_DEALS = """
deals AS (
  SELECT o_orderkey AS deal, o_custkey % 12 AS owner,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Discovery' WHEN '2' THEN 'Proposal' WHEN '3' THEN 'Negotiation'
              WHEN '4' THEN 'Closed Lost' ELSE 'Closed Won' END AS stage,
         o_totalprice AS revenue,
         CASE WHEN o_orderkey % 5 = 0 THEN 50.0::DOUBLE ELSE CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 10 WHEN '2' THEN 40 WHEN '3' THEN 70
              WHEN '4' THEN 0 ELSE 100 END END::DOUBLE AS probability,
         o_orderdate AS created, closed, c_mktsegment AS industry
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS closed FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey)
"""


def bookings(t) -> DataFrame:
    """Orders as room bookings of one to four hours."""
    start = F.col("o_orderdate") + F.make_dt_interval(hours=(8 + F.col("o_orderkey") % 10).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 5).alias("room"),
        (F.col("o_orderstatus") != "P").alias("live"),
        start.alias("start"),
        (start + F.make_dt_interval(hours=(1 + F.col("o_orderkey") % 4).cast("int"))).alias("end"),
    )


SQL_BOOKINGS = """
bookings AS (
  SELECT *, "start" + to_hours((1 + id % 4)::INTEGER) AS "end" FROM (
    SELECT o_orderkey AS id, o_custkey % 5 AS room, o_orderstatus <> 'P' AS live,
           o_orderdate + to_hours((8 + o_orderkey % 10)::INTEGER) AS "start" FROM orders)),
conflicts AS (
  SELECT a.room, least(a.id, b.id) AS a, greatest(a.id, b.id) AS b, greatest(a."start", b."start") AS "from", least(a."end", b."end") AS "to"
  FROM bookings a JOIN bookings b ON a.room = b.room AND a.id < b.id AND a."start" < b."end" AND b."start" < a."end"
  WHERE a.live AND b.live)
"""


def incidents(t) -> DataFrame:
    """Error events as incidents."""
    v = F.col("value")
    return t.events.where("event_type = 'error'").select(
        "event_id",
        "user_id",
        "ts",
        F.when(v >= 200, "critical").when(v >= 50, "high").otherwise("standard").alias("severity"),
    )


def acks(t) -> DataFrame:
    """Clicks of the same user as acknowledgements."""
    return t.events.where("event_type = 'click'").select("user_id", "ts")


SQL_INCIDENTS = """
incidents AS (
  SELECT event_id, user_id, ts, CASE WHEN value >= 200 THEN 'critical' WHEN value >= 50 THEN 'high' ELSE 'standard' END AS severity
  FROM events WHERE event_type = 'error'),
acks AS (SELECT user_id, ts FROM events WHERE event_type = 'click')
"""


def audit_records(t) -> DataFrame:
    """Events as audit records: a session is a user's day."""
    return t.events.select(
        "event_id",
        "ts",
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session"),
        F.col("event_type").alias("topic"),
        F.when(F.col("event_id") % 3 == 0, "Dev").when(F.col("event_id") % 3 == 1, "Test").otherwise("Production").alias("environment"),
        ((F.col("value") % 100) / 100).alias("top_score"),
    )


SQL_AUDIT = """
audit AS (
  SELECT event_id, ts, user_id, user_id::VARCHAR || '-' || strftime(ts, '%Y-%m-%d') AS session, event_type AS topic,
         CASE event_id % 3 WHEN 0 THEN 'Dev' WHEN 1 THEN 'Test' ELSE 'Production' END AS environment, (value % 100) / 100 AS top_score FROM events)
"""
