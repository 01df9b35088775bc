"""Filters, joins, windows, set operations and routing over the case tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from casework.operators import audit, compare, context, filters, history, intervals, routing
from casework.plans.bindings import (
    PROBABILITY,
    SQL_BOOKINGS,
    SQL_DEALS,
    SQL_INCIDENTS,
    acks,
    bookings,
    deals,
    incidents,
    opportunities,
    tagged_documents,
)
from casework.plans.measures import SQL_LABELLED, labelled
from casework.plans.registry import TIME, query

FMT = "%Y-%m-%d %H:%M:%S"


# --- filters -------------------------------------------------------------------------------


@query("f1_audience_filter", "SELECT doc_id, source AS category FROM documents WHERE lang = 'en' AND source = 'src2'")
def _(t):
    return filters.audience_filter(tagged_documents(t), "customer", "src2").select("doc_id", "category")


@query(
    "f3_active_only",
    """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS effective FROM orders WHERE o_orderdate::DATE <= DATE '1999-06-30' AND o_orderstatus <> 'P'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t):
    out = filters.active_only(t.orders, ["o_custkey"], "o_orderdate", date(1999, 6, 30), "o_orderkey", F.col("o_orderstatus") != "P")
    return out.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("effective"))


@query(
    "f4_row_security",
    """SELECT 'own' AS viewer, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey % 25 = 3
UNION ALL SELECT 'principal', count(*), round(sum(o_totalprice), 2) FROM orders UNION ALL SELECT 'unknown', 0, 0.0::DOUBLE""",
)
def _(t):
    users = t.nation.select(
        F.col("n_name").alias("user_id"),
        F.col("n_nationkey").cast("long").alias("owner_id"),
        F.when(F.col("n_nationkey") == 0, "Principal").otherwise("BD Staff").alias("role"),
    )
    owned = t.orders.withColumn("owner", F.col("o_custkey") % 25)
    parts = []
    for viewer, name in (("own", "NATION_3"), ("principal", "NATION_0"), ("unknown", "nobody")):
        seen = filters.row_security(owned, "owner", users, name)
        parts.append(
            seen.agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("total")).select(F.lit(viewer).alias("viewer"), "n", "total")
        )
    return compare.union_runs(*parts)


GRANTS = {("compliance", "audit"): "full", ("operations", "audit"): "read"}


@query(
    "f5_role_view",
    """SELECT 'compliance' AS role, event_id, user_id::VARCHAR AS user_id, event_type FROM events
UNION ALL SELECT 'operations', event_id, NULL, event_type FROM events""",
)
def _(t):
    log = t.events.select("event_id", F.col("user_id").cast("string").alias("user_id"), "event_type")
    views = [
        filters.role_view(log, "audit", role, GRANTS, masked=["user_id"]).select(F.lit(role).alias("role"), "*")
        for role in ("compliance", "operations", "staff")
    ]
    return compare.union_runs(*views)


@query(
    "f6_retention",
    """SELECT event_type, count(*) FILTER (ts >= TIMESTAMP '2024-04-10 00:00:00' - INTERVAL 90 DAY) AS kept,
  count(*) FILTER (ts < TIMESTAMP '2024-04-10 00:00:00' - INTERVAL 90 DAY) AS purged FROM events GROUP BY 1""",
)
def _(t):
    return filters.retention_counts(filters.retention(t.events, "ts", "2024-04-10 00:00:00"), ["event_type"])


@query("f7_drop_null_target", f"WITH {SQL_LABELLED} SELECT doc_id, lang, quality::BIGINT AS quality FROM labelled WHERE quality IS NOT NULL")
def _(t):
    df = labelled(t).select("doc_id", "lang", "quality", "source", "toxic")
    return filters.drop_null_target(df, "quality", ["source", "toxic", "absent"])


SQL_ASKED = """asked AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'SKU-' || l_partkey::VARCHAR END AS code FROM lineitem)"""


@query(
    "f8_exact_code_route",
    f"""WITH {SQL_ASKED}, joined AS (SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM asked LEFT JOIN part ON 'SKU-' || p_partkey::VARCHAR = code AND p_size <= 25)
SELECT CASE WHEN p_name IS NULL THEN 'ranking' ELSE 'exact' END AS route, coalesce(p_name, '') AS p_name, count(*) AS n, sum(l_partkey)::BIGINT AS key_sum FROM joined GROUP BY ALL""",
)
def _(t):
    tail = F.when(F.col("l_linenumber") % 3 == 0, "blue widget").otherwise(F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")))
    asked = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("price of "), tail, F.lit(", please")).alias("text"))
    catalogue = t.part.where("p_size <= 25").select(F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("code"), "p_name")
    hits, rest = filters.exact_code_route(asked, catalogue, "SKU-[0-9]+", "code")
    both = compare.union_runs(hits.withColumn("route", F.lit("exact")), rest.withColumn("route", F.lit("ranking")))
    return both.groupBy("route", F.coalesce("p_name", F.lit("")).alias("p_name")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("key_sum"))


# --- joins ---------------------------------------------------------------------------------


@query(
    "r7_tier_lookup",
    """WITH tiers AS (SELECT p_partkey, unnest([100, 200, 500]) AS lo, unnest([199, 499, NULL]) AS hi, unnest([p_retailprice, p_retailprice * 0.9, p_retailprice * 0.8]) AS price FROM part),
r AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, (l_quantity * 20)::BIGINT AS quantity, l_linenumber = 7 AS custom FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, quantity, round(price, 4) AS price,
  CASE WHEN price IS NULL THEN 'no_tier' WHEN custom THEN 'custom' ELSE 'ok' END AS flag
FROM r LEFT JOIN tiers ON p_partkey = l_partkey AND quantity >= lo AND quantity <= coalesce(hi, 1000000000)""",
)
def _(t):
    p = F.col("p_retailprice")
    steps = [(100, 199, 1.0), (200, 499, 0.9), (500, None, 0.8)]
    tier = lambda lo, hi, f: F.struct(F.lit(lo).alias("lo"), F.lit(hi).cast("int").alias("hi"), (p * f).alias("price"))
    tiers = t.part.select(F.col("p_partkey").alias("sku"), F.inline(F.array(*[tier(*s) for s in steps])))
    requests = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("sku"), (F.col("l_quantity") * 20).cast("long").alias("quantity"), (F.col("l_linenumber") == 7).alias("custom")
    )
    out = intervals.tier_lookup(requests, tiers)
    return out.select("l_orderkey", "l_linenumber", F.col("sku").alias("l_partkey"), "quantity", F.round("price", 4).alias("price"), "flag")


@query("r8_interval_conflicts", f"""WITH {SQL_BOOKINGS} SELECT room, a, b, strftime("from", '{FMT}') AS "from", strftime("to", '{FMT}') AS "to" FROM conflicts""")
def _(t):
    return intervals.interval_conflicts(bookings(t).where("live"), "room", "id", shown=lambda c: F.date_format(c, TIME))


@query(
    "r9_available",
    f"""WITH {SQL_BOOKINGS} SELECT c_custkey AS room FROM customer WHERE c_custkey NOT IN (
 SELECT o_custkey FROM bookings JOIN orders ON o_orderkey = id WHERE (live OR o_orderpriority = '1-URGENT') AND "start" < TIMESTAMP '1998-07-01' AND "end" > TIMESTAMP '1998-01-01')""",
)
def _(t):
    held = bookings(t).drop("room").join(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("room"), "o_orderpriority"), "id")
    rooms = t.customer.select(F.col("c_custkey").alias("room"))
    return intervals.available(rooms, held.where("live"), held.where("not live and o_orderpriority = '1-URGENT'"), ("1998-01-01", "1998-07-01"))


@query(
    "r10_leave_clash",
    f"""WITH {SQL_BOOKINGS}, leave AS (SELECT room, "start" - INTERVAL 1 DAY AS s, "end" + INTERVAL 2 DAY AS e FROM bookings WHERE NOT live)
SELECT id, room FROM bookings b WHERE live AND EXISTS (SELECT 1 FROM leave l WHERE l.room = b.room AND b."start" < l.e AND l.s < b."end")""",
)
def _(t):
    all_ = bookings(t)
    leave = all_.where("not live").select(
        "room", (F.col("start") - F.expr("interval 1 day")).alias("start"), (F.col("end") + F.expr("interval 2 days")).alias("end")
    )
    return intervals.leave_clash(all_.where("live"), leave, "room", "id").select("id", "room")


@query(
    "r11_channel_mismatch",
    """WITH b AS (SELECT p_partkey, p_name, CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 1.1 ELSE p_retailprice END AS price FROM part WHERE p_brand <> 'Brand#3')
SELECT part.p_partkey, CASE WHEN b.p_partkey IS NULL THEN 'missing_in_b' ELSE 'different' END AS problem, p_retailprice AS price_a, round(b.price, 4) AS price_b, part.p_name AS p_name_a, b.p_name AS p_name_b
FROM part LEFT JOIN b USING (p_partkey) WHERE b.p_partkey IS NULL OR price <> p_retailprice""",
)
def _(t):
    a = t.part.select("p_partkey", F.col("p_retailprice").alias("price"), "p_name", "p_brand", "p_type")
    raised = F.when(F.col("p_type") == "ECONOMY", F.col("price") * 1.1).otherwise(F.col("price"))
    b = a.where("p_brand <> 'Brand#3'").withColumn("price", raised)
    return compare.channel_mismatch(a, b, "p_partkey", ["price", "p_name"]).withColumn("price_b", F.round("price_b", 4))


@query(
    "r12_missing_required",
    """WITH need AS (SELECT n_nationkey, k FROM nation, (VALUES ('AUTOMOBILE'), ('BUILDING'), ('MACHINERY'), ('AEROSPACE')) v(k)),
miss AS (SELECT n_nationkey, array_to_string(list_sort(list(k) FILTER (k NOT IN (SELECT c_mktsegment FROM customer WHERE c_nationkey = need.n_nationkey AND c_acctbal > 9000))), '|') AS missing FROM need GROUP BY 1)
SELECT n_nationkey::BIGINT AS n_nationkey, coalesce(missing, '') AS missing, CASE WHEN coalesce(missing, '') = '' THEN 'PASS' WHEN contains(missing, 'BUILDING') THEN 'FAIL' ELSE 'WARN' END AS status FROM miss""",
)
def _(t):
    rich = t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    return compare.missing_required(t.nation, "n_nationkey", ["AUTOMOBILE", "BUILDING", "MACHINERY", "AEROSPACE"], rich, "c_mktsegment", mandatory=["BUILDING"])


@query(
    "r13_orphans",
    "SELECT o_custkey, count(*) AS assets FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1",
)
def _(t):
    return compare.orphans(t.orders, t.customer.where("c_acctbal >= 0"), "o_custkey", "c_custkey")


@query(
    "r14_reconcile",
    """WITH s AS (SELECT user_id, event_type, date_trunc('hour', ts) AS h FROM events), g AS (SELECT user_id, event_type, date_trunc('hour', ts) AS h FROM events WHERE event_type <> 'signup'
 UNION ALL SELECT user_id, event_type, date_trunc('hour', ts) FROM events WHERE event_type = 'error')
SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM g) AS target_rows, (SELECT count(*) FROM (FROM s EXCEPT ALL FROM g)) AS missing,
  (SELECT count(*) FROM (FROM g EXCEPT ALL FROM s)) AS extra, (SELECT count(*) FROM (FROM s EXCEPT ALL FROM g)) + (SELECT count(*) FROM (FROM g EXCEPT ALL FROM s)) = 0 AS matched""",
)
def _(t):
    s = t.events.select("event_id", "user_id", "event_type", F.date_trunc("hour", "ts").alias("h"))
    g = s.where("event_type <> 'signup'").unionByName(s.where("event_type = 'error'"))
    return compare.reconcile(s, g, ["user_id", "event_type", "h"])


@query("r15_override_default", f"WITH {SQL_DEALS} SELECT deal, stage, probability FROM deals")
def _(t):
    ref = t.spark.createDataFrame(list(PROBABILITY.items()), "stage string, default_probability double")
    out = compare.override_default(opportunities(t), ref, "stage", "own_probability", "default_probability")
    return out.select("deal", "stage", "probability")


@query(
    "r16_owner_as_of",
    """SELECT e.event_id, s.event_id AS owner FROM (SELECT * FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY ALL) s ON e.user_id = s.user_id AND e.ts >= s.ts""".replace(
        "s.event_id AS owner", "coalesce(s.event_id, -1) AS owner"
    ),
)
def _(t):
    buys = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    duty = t.events.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("owner"))
    out = intervals.owner_as_of(buys, duty, ["user_id"], "ts", "event_id", "ts", "owner")
    return out.select("event_id", F.coalesce("owner", F.lit(-1)).alias("owner"))


# --- windows -------------------------------------------------------------------------------


@query(
    "w1_top_k",
    """SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders
QUALIFY rank <= 3""",
)
def _(t):
    return context.top_k(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query(
    "w2_win_rate_12m",
    f"""WITH {SQL_DEALS}, m AS (SELECT date_trunc('month', closed)::DATE AS month, count(*) FILTER (stage = 'Closed Won') AS won, count(*) FILTER (stage = 'Closed Lost') AS lost
  FROM deals WHERE stage IN ('Closed Won', 'Closed Lost') AND closed IS NOT NULL GROUP BY 1),
span AS (SELECT unnest(generate_series((SELECT min(month) FROM m), (SELECT max(month) FROM m), INTERVAL 1 MONTH))::DATE AS month),
r AS (SELECT s.month, (SELECT coalesce(sum(won), 0) FROM m WHERE m.month <= s.month AND m.month > s.month - INTERVAL 12 MONTH) AS w,
  (SELECT coalesce(sum(lost), 0) FROM m WHERE m.month <= s.month AND m.month > s.month - INTERVAL 12 MONTH) AS l FROM span s)
SELECT month::VARCHAR AS month, w::BIGINT AS won_12m, l::BIGINT AS lost_12m, round(CASE WHEN w + l = 0 THEN 0 ELSE w / (w + l) END, 6)::DOUBLE AS win_rate FROM r""",
)
def _(t):
    return history.win_rate_12m(deals(t).where("closed is not null"), "closed", "stage")


@query(
    "w3_history",
    f"""SELECT o_custkey, o_orderkey, strftime(o_orderdate, '{FMT}') AS valid_from, strftime(lead(o_orderdate) OVER w, '{FMT}') AS valid_to,
  lead(o_orderdate) OVER w IS NULL AS is_current, lag(o_orderpriority) OVER w AS previous FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t):
    out = history.history(t.orders, "o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey")
    return out.select("o_custkey", "o_orderkey", "valid_from", "valid_to", "is_current", "previous")


@query(
    "w4_transcript",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS no FROM conversations)
SELECT conv_id, ((no - 1) // 1000)::BIGINT AS part, count(*) AS turns, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS transcript_md5 FROM n GROUP BY ALL""",
)
def _(t):
    return history.transcript(t.conversations, "conv_id", "turn", "role", "text").withColumn("transcript_md5", F.md5("transcript")).drop("transcript")


@query(
    "w5_turn_context",
    """SELECT conv_id, turn, md5(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w) AS previous_user,
  md5(last_value(CASE WHEN role = 'assistant' THEN text END IGNORE NULLS) OVER w) AS previous_assistant,
  md5(coalesce(lag(text, 2) OVER o || '|', '') || coalesce(lag(text, 1) OVER o, '')) AS previous_texts
FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn), w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def _(t):
    out = history.turn_context(t.conversations, "conv_id", "turn", "role", "text", n=2)
    return out.select(
        "conv_id",
        "turn",
        F.md5("previous_user").alias("previous_user"),
        F.md5("previous_assistant").alias("previous_assistant"),
        F.md5(F.array_join("previous_texts", "|")).alias("previous_texts"),
    )


@query(
    "w6_clarify_limit",
    """WITH l AS (SELECT conv_id, turn, (role = 'assistant' AND length(text) < 400)::INT AS low FROM conversations),
s AS (SELECT *, sum(low) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS low_so_far FROM l)
SELECT conv_id, turn, low_so_far, low = 1 AND low_so_far = 2 AS hand_over FROM s""",
)
def _(t):
    low = (F.col("role") == "assistant") & (F.length("text") < 400)
    return history.clarify_limit(t.conversations, "conv_id", "turn", low).select("conv_id", "turn", "low_so_far", "hand_over")


SQL_ACKED = f"""{SQL_INCIDENTS},
acked AS (SELECT i.*, (SELECT min(ts) FROM acks a WHERE a.user_id = i.user_id AND a.ts >= i.ts) AS acked_at FROM incidents i)"""


@query(
    "w8_first_ack",
    f"""WITH {SQL_ACKED} SELECT event_id, severity, strftime(acked_at, '{FMT}') AS acked_at, round(epoch(acked_at - ts) / 60, 4) AS minutes_to_ack,
  coalesce(epoch(acked_at - ts) / 60 <= CASE severity WHEN 'critical' THEN 15 WHEN 'high' THEN 120 ELSE 240 END, false) AS sla_met FROM acked""",
)
def _(t):
    out = intervals.first_ack(incidents(t), acks(t), "user_id", "event_id")
    return out.select("event_id", "severity", "acked_at", F.round("minutes_to_ack", 4).alias("minutes_to_ack"), "sla_met")


# --- set operations ------------------------------------------------------------------------


@query(
    "o3_union_runs",
    "SELECT event_id, user_id::DOUBLE AS user_id, NULL::DOUBLE AS value FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, NULL, value FROM events WHERE event_type <> 'view'",
)
def _(t):
    a = t.events.where("event_type = 'view'").select("event_id", F.col("user_id").cast("double").alias("user_id"))
    return compare.union_runs(a, t.events.where("event_type <> 'view'").select("value", "event_id"))


@query(
    "o4_scope_diff",
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'only_a' WHEN d.doc_id IS NULL THEN 'only_b' ELSE 'both' END AS place
FROM (SELECT DISTINCT doc_id FROM documents WHERE lang <> 'fr') d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
)
def _(t):
    return compare.scope_diff(t.documents.where("lang <> 'fr'"), t.labels, ["doc_id"])


@query(
    "o5_sample_per_group",
    "SELECT label::BIGINT AS label, vec_id, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id::VARCHAR), vec_id) AS pick FROM embeddings QUALIFY pick <= 10",
)
def _(t):
    return compare.sample_per_group(t.embeddings.select("label", "vec_id"), "label", "vec_id", 10)


# --- routing -------------------------------------------------------------------------------


@query(
    "d5_field_routing",
    f"""WITH {SQL_LABELLED} SELECT doc_id, CASE WHEN quality IS NULL OR source IS NULL OR n_chars < 200 THEN 'Needs Review' ELSE 'Processed' END AS route FROM labelled""",
)
def _(t):
    field = lambda v, c: F.struct(v.cast("string").alias("value"), c.alias("confidence"))
    fields = F.array(
        field(F.col("source"), F.lit("high")),
        field(F.col("quality"), F.lit("medium")),
        field(F.col("n_chars"), F.when(F.col("n_chars") < 200, "low").otherwise("high")),
    )
    return labelled(t).select("doc_id", routing.field_routing(fields).alias("route"))


SQL_SCORED = """scored AS (SELECT doc_id, quality, n_chars / (n_chars + 2000) AS score FROM labels JOIN documents USING (doc_id))"""


def scored(t):
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", "quality", (F.col("n_chars") / (F.col("n_chars") + 2000)).alias("score")
    )


@query("d6_threshold_routing", f"WITH {SQL_SCORED} SELECT doc_id, CASE WHEN score >= 0.5 THEN 'auto' ELSE 'review' END AS route FROM scored")
def _(t):
    return routing.threshold_routing(scored(t), "score", 0.5).select("doc_id", "route")


@query(
    "d6_calibration",
    f"""WITH {SQL_SCORED}, th AS (SELECT unnest([0.3, 0.5, 0.7, 0.85]::DOUBLE[]) AS threshold)
SELECT threshold, count(*) FILTER (score >= threshold) AS auto, count(*) FILTER (score < threshold) AS review, round(count(*) FILTER (score < threshold) / count(*), 6) AS review_share,
  round(coalesce(count(*) FILTER (score >= threshold AND quality = 0) / nullif(count(*) FILTER (score >= threshold), 0), 0), 6)::DOUBLE AS error_rate FROM scored, th GROUP BY threshold""",
)
def _(t):
    return routing.threshold_calibration(scored(t), "score", F.col("quality") == 0, [0.3, 0.5, 0.7, 0.85])


@query(
    "d7_severity_route",
    f"""WITH {SQL_INCIDENTS} SELECT event_id, CASE severity WHEN 'critical' THEN 'Clinical Lead, CEO' ELSE 'Clinical Lead' END AS recipients,
  strftime(CASE severity WHEN 'critical' THEN ts + INTERVAL 15 MINUTE WHEN 'high' THEN ts + INTERVAL 120 MINUTE END, '{FMT}') AS deadline,
  CASE severity WHEN 'critical' THEN 'On-Call Manager' WHEN 'high' THEN 'CEO' END AS escalate_to, severity = 'critical' AND event_id % 3 <> 0 AS flag_mismatch FROM incidents""",
)
def _(t):
    out = routing.severity_route(incidents(t).withColumn("flag", F.col("event_id") % 3 == 0), "severity", "ts", "flag")
    return out.select("event_id", "recipients", "deadline", "escalate_to", "flag_mismatch")


@query(
    "d8_approval_route",
    """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'price' ELSE 'text' END AS kind, o_orderdate AS s,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate + to_hours((o_orderkey % 7)::INTEGER) END AS d, o_orderkey % 10 = 0 AS below FROM orders),
r AS (SELECT *, CASE WHEN below THEN 'Pricing Specialist' WHEN kind = 'price' THEN 'Finance Manager' ELSE 'Catalogue Manager' END AS route,
  (d IS NULL OR d > s + INTERVAL 4 HOUR) AND TIMESTAMP '2001-01-01' >= s + INTERVAL 4 HOUR AS silent FROM c)
SELECT o_orderkey, route, CASE WHEN silent AND route = 'Finance Manager' THEN 'auto-approved' WHEN d IS NOT NULL THEN 'decided' ELSE 'pending' END AS state,
  silent AND route = 'Finance Manager' AS notify_director FROM r""",
)
def _(t):
    k = F.col("o_orderkey")
    df = t.orders.select(
        "o_orderkey",
        F.when(k % 3 == 0, "price").otherwise("text").alias("kind"),
        F.col("o_orderdate").alias("submitted"),
        F.when(k % 4 != 0, F.col("o_orderdate") + F.make_dt_interval(hours=(k % 7).cast("int"))).alias("decided"),
    )
    out = routing.approval_route(df, "kind", "submitted", "decided", F.lit("2001-01-01").cast("timestamp_ntz"), k % 10 == 0)
    return out.select("o_orderkey", "route", "state", "notify_director")


@query(
    "d9_access_review",
    """WITH l AS (SELECT user_id, max(ts) AS seen, max(ts) FILTER (event_type = 'purchase') AS use FROM events GROUP BY 1),
u AS (SELECT c_custkey AS user_id, CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-03-20' WHEN c_custkey % 4 = 1 THEN TIMESTAMP '2024-01-05' END AS created FROM customer),
r AS (SELECT u.user_id, array_to_string(list_filter([
  CASE WHEN seen IS NULL OR date_diff('day', seen, TIMESTAMP '2024-04-29 12:00:00') > 90 THEN 'inactive_90d' END,
  CASE WHEN use IS NULL OR date_diff('day', use, TIMESTAMP '2024-04-29 12:00:00') > 90 THEN 'licence_unused_90d' END,
  CASE WHEN created IS NOT NULL AND (seen IS NULL OR date_diff('day', seen, TIMESTAMP '2024-04-29 12:00:00') > 14) THEN 'sandbox_idle_14d' END,
  CASE WHEN created IS NOT NULL AND date_diff('day', created, TIMESTAMP '2024-04-29 12:00:00') > 30 THEN 'sandbox_expired_30d' END], lambda x: x IS NOT NULL), '|') AS reasons
  FROM u LEFT JOIN l ON l.user_id = u.user_id)
SELECT user_id, reasons, reasons = '' AS keep FROM r""",
)
def _(t):
    k = F.col("c_custkey")
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    users = t.customer.select(k.alias("user_id"), F.when(k % 4 == 0, day("2024-03-20")).when(k % 4 == 1, day("2024-01-05")).alias("created"))
    out = audit.access_review(users, t.events, "user_id", "ts", "2024-04-29 12:00:00", "created", F.col("event_type") == "purchase")
    return out.select("user_id", "reasons", "keep")


@query(
    "d10_storage_tier",
    """SELECT o_orderkey, CASE WHEN age > 365 THEN 'archive' WHEN age > 90 THEN 'cool' ELSE 'hot' END AS tier, o_orderstatus = 'F' AND age <= 30 AS recoverable
FROM (SELECT *, date_diff('day', o_orderdate, TIMESTAMP '2001-08-01') AS age FROM orders)""",
)
def _(t):
    now = F.lit("2001-08-01").cast("timestamp_ntz")
    gone = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return t.orders.select("o_orderkey", routing.storage_tier("o_orderdate", now).alias("tier"), routing.recoverable(gone, now).alias("recoverable"))


@query(
    "d12_sync_status",
    """SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'Complete' WHEN 'error' THEN 'Failed' WHEN 'click' THEN 'Failed' ELSE 'Pending' END AS status,
  event_type IN ('error', 'click') AS retry FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    kind = F.col("event_type")
    out = routing.sync_status(t.events, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], kind == "purchase", kind.isin("error", "click"))
    return out.select("user_id", "event_id", "status", "retry")


@query(
    "d13_recurring",
    f"""WITH {SQL_BOOKINGS}, inst AS (SELECT id * 10 + i AS id, room, "start" + to_days((7 * i)::INTEGER) AS s, "end" + to_days((7 * i)::INTEGER) AS e FROM bookings, range(0, 4) r(i)),
bad AS (SELECT DISTINCT unnest([a.id, b.id]) AS id FROM inst a JOIN inst b ON a.room = b.room AND a.id < b.id AND a.s < b.e AND b.s < a.e)
SELECT inst.id, room, strftime(s, '{FMT}') AS "start", bad.id IS NOT NULL AS conflict FROM inst LEFT JOIN bad USING (id)""",
)
def _(t):
    inst = intervals.recurring(bookings(t), "id", weeks=4)
    inst = inst.withColumn("id", F.col("id") * 10 + F.col("occurrence"))
    return intervals.in_conflict(inst, "room", "id").select("id", "room", "start", "conflict")

