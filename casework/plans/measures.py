"""Evaluation, audit, sales and profile aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from casework.operators import audit, compare, evaluation, intervals, retrieval, sales
from casework.plans.bindings import SQL_AUDIT, SQL_BOOKINGS, SQL_DEALS, SQL_INCIDENTS, audit_records, bookings, deals, incidents
from casework.plans.registry import query
from casework.plans.search import SQL_KNN, SQL_VCHUNKS, runs, sql_bm25, vector_questions


def cases(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        F.struct("conv_id", "turn").alias("case_id"),
        F.col("text").alias("query"),
        F.concat(F.lit("SOURCE-"), (F.col("conv_id") % 4).cast("string")).alias("expected_source"),
        F.when(F.col("turn") % 3 == 0, "A").when(F.col("turn") % 3 == 1, "").otherwise("zz").alias("expected_answer_contains"),
        (F.col("turn") % 5 == 0).alias("should_escalate"),
    )


def answers(t):
    return t.conversations.where("turn <> 7").select(
        F.struct("conv_id", "turn").alias("case_id"),
        F.concat(F.col("text"), F.when(F.col("conv_id") % 3 == 0, "\nSource: a").otherwise("")).alias("answer"),
        F.when(F.col("turn") % 2 == 0, F.array(F.lit("doc"))).otherwise(F.array().cast("array<string>")).alias("sources"),
        F.array(F.concat(F.lit("my source-"), (F.col("turn") % 4).cast("string")), F.lit("other")).alias("retrieved"),
        (F.col("turn") % 10 == 0).alias("escalation_required"),
        F.lit("high").alias("confidence"),
        F.length("text").cast("double").alias("latency_ms"),
        F.when(F.col("conv_id") % 9 == 4, "timeout").otherwise("").alias("error"),
    )


SQL_EVAL = """
results AS (
  SELECT *, retrieval_hit AND citation_present AND answer_relevant AND escalation_correct AS passed FROM (
    SELECT conv_id, turn, CASE WHEN bad THEN NULL ELSE ms END AS latency_ms, error,
      NOT bad AND (esc OR contains('my source-' || (turn % 4)::VARCHAR, 'source-' || (conv_id % 4)::VARCHAR)) AS retrieval_hit,
      NOT bad AND (turn % 2 = 0 OR contains(answer, 'Source:') {exempt}) AS citation_present,
      NOT bad AND CASE turn % 3 WHEN 0 THEN contains(lower(answer), 'a') WHEN 1 THEN true ELSE contains(lower(answer), 'zz') END AS answer_relevant,
      NOT bad AND (turn % 10 = 0) = esc AS escalation_correct,
      CASE WHEN bad THEN 'low' ELSE 'high' END AS confidence, CASE WHEN turn = 7 THEN '' ELSE substring(answer, 1, 300) END AS answer
    FROM (SELECT conv_id, turn, turn % 5 = 0 AS esc, turn = 7 OR conv_id % 9 = 4 AS bad, length(text)::DOUBLE AS ms,
            CASE WHEN turn <> 7 AND conv_id % 9 = 4 THEN 'timeout' ELSE '' END AS error,
            text || CASE WHEN conv_id % 3 = 0 THEN chr(10) || 'Source: a' ELSE '' END AS answer FROM conversations)))
"""
FLAGS = "retrieval_hit, citation_present, answer_relevant, escalation_correct, passed, confidence"


def results(t, **options):
    out = evaluation.eval_cases(cases(t), answers(t), **options)
    return out.withColumn("latency_ms", F.when(F.col("error") == "", F.col("latency_ms")))


@query("a1_eval_cases", f"WITH {SQL_EVAL.format(exempt='')} SELECT conv_id, turn, {FLAGS}, md5(answer) AS answer_md5, error FROM results")
def _(t):
    return evaluation.eval_cases(cases(t), answers(t)).select(
        "conv_id", "turn", *FLAGS.split(", "), F.md5("answer").alias("answer_md5"), "error"
    )


@query("a1_eval_cases_exempt", f"WITH {SQL_EVAL.format(exempt='OR (esc AND turn % 10 = 0)')} SELECT conv_id, turn, {FLAGS} FROM results")
def _(t):
    return evaluation.eval_cases(cases(t), answers(t), exempt_escalated=True).select("conv_id", "turn", *FLAGS.split(", "))


SQL_REPORT = """
report AS (
  SELECT count(*) AS total_cases, count(*) FILTER (passed) AS passed, round(count(*) FILTER (passed) / count(*), 6) AS pass_rate,
   round(avg(retrieval_hit::INT), 6) AS retrieval_recall, round(avg(citation_present::INT), 6) AS citation_rate,
   round(avg(answer_relevant::INT), 6) AS answer_relevance, round(avg(escalation_correct::INT), 6) AS escalation_accuracy,
   round(avg(latency_ms), 4) AS avg_latency_ms FROM results)
"""


@query("a2_eval_report", f"WITH {SQL_EVAL.format(exempt='')}, {SQL_REPORT} SELECT * FROM report")
def _(t):
    return evaluation.eval_report(results(t))


@query(
    "a3_failed_checks",
    f"""WITH {SQL_EVAL.format(exempt='')}
SELECT conv_id, turn, CASE WHEN error <> '' THEN 'error: ' || error ELSE array_to_string(list_filter([
  CASE WHEN NOT retrieval_hit THEN 'retrieval_hit=False' END, CASE WHEN NOT citation_present THEN 'citation_present=False' END,
  CASE WHEN NOT answer_relevant THEN 'answer_relevant=False' END, CASE WHEN NOT escalation_correct THEN 'escalation_correct=False' END],
  lambda x: x IS NOT NULL), '|') END AS failed FROM results WHERE NOT passed""",
)
def _(t):
    return evaluation.failed_checks(results(t)).select("conv_id", "turn", "failed")


@query(
    "a4_scorecard",
    f"""WITH {SQL_EVAL.format(exempt='')}, {SQL_REPORT}, m AS (
  SELECT unnest(['pass_rate', 'retrieval_recall', 'citation_rate', 'answer_relevance', 'escalation_accuracy']) AS metric,
         unnest([pass_rate, retrieval_recall, citation_rate, answer_relevance, escalation_accuracy]) AS actual,
         unnest([0.75, 0.8, 1.0, 0.8, 0.95]::DOUBLE[]) AS target FROM report)
SELECT metric, actual, target, CASE WHEN actual >= target THEN 'Met' ELSE 'Below' END AS status,
  CASE WHEN actual >= 0.9 THEN 'target met' WHEN actual >= 0.75 THEN 'needs improvement' ELSE 'failing' END AS band FROM m""",
)
def _(t):
    return evaluation.scorecard(evaluation.eval_report(results(t)))


@query(
    "a5_answer_quality",
    rf"""WITH a AS (SELECT turn, conv_id, CASE WHEN turn % 4 = 1 THEN 'Sorry, I cannot find that.' ELSE text END AS answer FROM conversations),
b AS (SELECT *, contains(lower(answer), 'don''t have confident information') OR contains(lower(answer), 'cannot find') OR contains(lower(answer), 'not covered in') AS refused FROM a)
SELECT count(*) AS answers, round(coalesce(avg(refused::INT) FILTER (conv_id % 3 = 0), 0), 6) AS correct_refusal,
  round(avg((len(string_split_regex(regexp_replace(answer, '^[ \t\r\n\f]+|[ \t\r\n\f]+$', '', 'g'), '[ \t\r\n\f]+')) <= 200)::INT), 6) AS within_200_words,
  round(avg((turn % 2 = 0)::INT) FILTER (NOT refused), 6) AS cited, round(avg((turn % 7 = 0)::INT) FILTER (NOT refused), 6) AS ungrounded,
  round(avg((turn % 11 = 3)::INT) FILTER (NOT turn % 5 = 0), 6) AS false_escalation FROM b""",
)
def _(t):
    turn, conv = F.col("turn"), F.col("conv_id")
    df = t.conversations.withColumn("answer", F.when(turn % 4 == 1, "Sorry, I cannot find that.").otherwise(F.col("text")))
    return evaluation.answer_quality(df, "answer", conv % 3 == 0, turn % 7 != 0, turn % 2 == 0, turn % 11 == 3, turn % 5 == 0)


@query(
    "a6_compare_methods",
    f"""WITH {SQL_VCHUNKS}, {SQL_KNN.format(corpus='placed')}, {sql_bm25('allowed', 15)},
near AS (SELECT q_id, id, rank FROM knn WHERE rank <= 15),
runs AS (SELECT 'vector' AS method, q_id, id, 120.0 + q_id AS ms FROM near UNION ALL SELECT 'keyword', q_id, id, 45.0 + q_id FROM bm
  UNION ALL SELECT 'hybrid', coalesce(a.q_id, b.q_id), coalesce(a.id, b.id), 145.0 + coalesce(a.q_id, b.q_id) FROM near a FULL JOIN bm b ON a.q_id = b.q_id AND a.id = b.id),
per AS (SELECT method, q_id, bool_or(('0x' || substring(id, 1, 6))::BIGINT % 20 = q_id % 20) AS hit, max(ms) AS ms FROM runs GROUP BY ALL)
SELECT method, round(count(*) FILTER (hit) / (SELECT count(*) FROM benchmark LEFT JOIN embeddings ON vec_id = item_id) * 100, 4) AS recall_pct,
  round(100 - count(*) FILTER (hit) / (SELECT count(*) FROM benchmark LEFT JOIN embeddings ON vec_id = item_id) * 100, 4) AS failed_pct,
  round(avg(ms), 4)::DOUBLE AS avg_latency_ms FROM per GROUP BY method""",
)
def _(t):
    _, near, found = runs(t)
    hybrid = retrieval.rrf([near, found])
    timed = lambda df, name, ms: df.select(F.lit(name).alias("method"), "q_id", "id", (F.lit(ms) + F.col("q_id")).alias("latency_ms"))
    union = compare.union_runs(timed(near, "vector", 120.0), timed(found, "keyword", 45.0), timed(hybrid, "hybrid", 145.0))
    return evaluation.compare_methods(union, vector_questions(t), F.conv(F.substring("id", 1, 6), 16, 10).cast("long") % 20 == F.col("q_id") % 20)


SQL_LATENCY = """SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(avg((value < 100)::INT), 6) AS under_target,
  round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99 FROM events GROUP BY event_type"""


@query("a7_latency_stats", SQL_LATENCY)
def _(t):
    return audit.latency_stats(t.events, ["event_type"], "value", 100.0)


@query(
    "a8_band_counts",
    f"""WITH {SQL_AUDIT} SELECT environment, count(*) FILTER (top_score >= 0.85) AS high, count(*) FILTER (top_score >= 0.7 AND top_score < 0.85) AS medium,
  count(*) FILTER (top_score < 0.7) AS escalated FROM audit GROUP BY environment""",
)
def _(t):
    return audit.band_counts(audit_records(t), "top_score", ["environment"])


@query(
    "a9_audit_overview",
    f"""WITH {SQL_AUDIT}, g AS (
 SELECT coalesce(topic, 'all') AS topic, coalesce(environment, 'all') AS environment, grouping(topic, environment) AS level, count(*) AS queries, count(DISTINCT session) AS sessions,
   count(DISTINCT session) FILTER (top_score < 0.2) AS escalated_sessions, round(avg(top_score), 6) AS mean_score
 FROM audit GROUP BY ROLLUP (topic, environment))
SELECT topic, environment, level::BIGINT AS level, queries, sessions, escalated_sessions, mean_score, round(escalated_sessions / sessions, 6) AS escalation_rate FROM g""",
)
def _(t):
    out = audit.audit_overview(audit_records(t), "session", "topic", "environment", "top_score", F.col("top_score") < 0.2)
    return out.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("topic", "environment")})


@query(
    "a10_activity_heatmap",
    "SELECT dayofweek(ts) + 1 AS weekday, "
    + ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h:02d}" for h in range(24))
    + " FROM events GROUP BY 1",
)
def _(t):
    return audit.activity_heatmap(t.events, "ts")


@query("a10_user_activity", "SELECT sha256('s1' || user_id::VARCHAR) AS user_hash, count(*) AS queries FROM events GROUP BY 1")
def _(t):
    return audit.user_activity(t.events, "user_id", "s1")


SQL_MEASURES = """count(*) AS deals, round(sum(revenue * probability / 100), 4) AS weighted, round(sum(revenue), 4) AS unweighted,
  round(count(*) FILTER (stage = 'Proposal') / count(*), 6) AS proposal_share,
  round(avg(date_diff('day', created, closed)) FILTER (stage = 'Closed Won'), 4) AS avg_cycle_days"""


@query("a11_deal_measures", f"WITH {SQL_DEALS} SELECT owner, {SQL_MEASURES} FROM deals GROUP BY owner")
def _(t):
    return sales.deal_measures(deals(t), ["owner"])


@query("a11_deal_totals", f"WITH {SQL_DEALS} SELECT {SQL_MEASURES} FROM deals")
def _(t):
    return sales.deal_measures(deals(t))


@query(
    "a12_funnel",
    f"""WITH {SQL_DEALS} SELECT coalesce(stage, 'all') AS stage, coalesce(owner, -1) AS owner, grouping(stage, owner)::BIGINT AS level,
  count(*) AS deals, round(sum(revenue), 4) AS value FROM deals GROUP BY CUBE (stage, owner)""",
)
def _(t):
    return sales.funnel(deals(t)).withColumns({"stage": F.coalesce("stage", F.lit("all")), "owner": F.coalesce("owner", F.lit(-1))})


@query(
    "a12_reached_stages",
    f"""WITH {SQL_DEALS}, p AS (SELECT CASE stage WHEN 'Proposal' THEN 2 WHEN 'Negotiation' THEN 3 WHEN 'Closed Won' THEN 4 ELSE 1 END AS p FROM deals),
r AS (SELECT s.i, s.stage, (SELECT count(*) FROM p WHERE p >= s.i) AS reached, CASE WHEN s.i < 4 THEN (SELECT count(*) FROM p WHERE p >= s.i + 1) END AS went_on
  FROM (VALUES (1, 'Discovery'), (2, 'Proposal'), (3, 'Negotiation'), (4, 'Closed Won')) s(i, stage))
SELECT stage, reached, went_on::DOUBLE AS went_on, round(went_on / reached, 6) AS conversion FROM r""",
)
def _(t):
    return sales.reached_stages(deals(t)).withColumn("went_on", F.col("went_on").cast("double"))


@query(
    "a12_win_loss",
    f"""WITH {SQL_DEALS} SELECT industry, count(*) FILTER (stage = 'Closed Won') AS won, count(*) FILTER (stage = 'Closed Lost') AS lost,
  round(count(*) FILTER (stage = 'Closed Won') / count(*) FILTER (stage IN ('Closed Won', 'Closed Lost')), 6) AS win_share FROM deals GROUP BY industry""",
)
def _(t):
    return sales.win_loss(deals(t))


@query(
    "a13_forecast_by_month",
    f"""WITH {SQL_DEALS}, m AS (SELECT date_trunc('month', closed) AS month, sum(revenue * probability / 100) AS w, sum(revenue) AS u FROM deals WHERE closed IS NOT NULL GROUP BY 1),
span AS (SELECT unnest(generate_series((SELECT min(month) FROM m), (SELECT max(month) FROM m), INTERVAL 1 MONTH)) AS month)
SELECT strftime(span.month, '%Y-%m-%d') AS month, round(coalesce(w, 0), 4) AS weighted, round(coalesce(u, 0), 4) AS unweighted FROM span LEFT JOIN m ON m.month = span.month""",
)
def _(t):
    return sales.forecast_by_month(deals(t))


@query(
    "a14_utilisation",
    f"""WITH {SQL_BOOKINGS} SELECT room, dayofweek("start") + 1 AS weekday, hour("start") AS hour, count(*) AS bookings,
  round(sum(epoch("end" - "start") / 3600), 2) AS hours FROM bookings WHERE live GROUP BY ALL""",
)
def _(t):
    return sales.utilisation(bookings(t), F.col("live"))


@query(
    "a14_double_bookings",
    f"""WITH {SQL_BOOKINGS} SELECT strftime(date_trunc('week', "from"), '%Y-%m-%d') AS week, count(*) AS double_bookings FROM conflicts GROUP BY 1""",
)
def _(t):
    return sales.double_bookings_per_week(intervals.conflict_counts(bookings(t).where("live"), "room", "id"))


SQL_DAILY = f"""WITH {SQL_INCIDENTS}, d AS (SELECT (ts - INTERVAL 7 HOUR)::DATE AS day, severity, CASE user_id % 3 WHEN 0 THEN 'fall' WHEN 1 THEN 'behaviour' ELSE 'other' END AS category FROM incidents),
grid AS (SELECT day, severity, category FROM (SELECT DISTINCT day FROM d), (VALUES ('critical'), ('high'), ('standard')) s(severity), (VALUES ('fall'), ('behaviour'), ('other'), ('choking')) c(category))
SELECT day::VARCHAR AS day, severity, category, (SELECT count(*) FROM d WHERE d.day = grid.day AND d.severity = grid.severity AND d.category = grid.category) AS incidents FROM grid"""


def categorised(t):
    u = F.col("user_id") % 3
    return incidents(t).withColumn("category", F.when(u == 0, "fall").when(u == 1, "behaviour").otherwise("other"))


@query("a15_daily_summary", SQL_DAILY)
def _(t):
    return audit.daily_summary(
        categorised(t), "ts", "severity", "category", ["critical", "high", "standard"], ["fall", "behaviour", "other", "choking"]
    )


@query(
    "a16_change_stats",
    """WITH f AS (SELECT l_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS changes,
  round(avg(epoch(shipped - o_orderdate) / 3600), 4) AS turnaround_hours, round(avg((o_orderstatus = 'P')::INT), 6) AS error_rate
FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def _(t):
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped"))
    df = t.orders.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return audit.change_stats(df, "o_orderpriority", "o_orderdate", "shipped", F.col("o_orderstatus") == "P")


@query(
    "a17_connector_policy",
    """WITH tiers AS (SELECT s_suppkey, CASE WHEN s_suppkey % 20 = 0 THEN 'Blocked' WHEN s_suppkey % 5 = 1 THEN 'Non-Business' WHEN s_suppkey % 7 = 3 THEN NULL ELSE 'Business' END AS tier FROM supplier),
f AS (SELECT l_orderkey, CASE WHEN l_orderkey % 4 = 0 THEN 'Development' ELSE 'Production' END AS environment, coalesce(tier, 'Non-Business') AS tier FROM lineitem LEFT JOIN tiers ON s_suppkey = l_suppkey),
g AS (SELECT l_orderkey, environment, bool_or(tier = 'Blocked') AS has_blocked, bool_or(tier = 'Business') AND bool_or(tier = 'Non-Business') AS mixed FROM f GROUP BY ALL)
SELECT *, CASE WHEN environment = 'Development' THEN 'exempt' WHEN has_blocked THEN 'blocked' WHEN mixed THEN 'suspended' ELSE 'allowed' END AS decision FROM g""",
)
def _(t):
    s = F.col("s_suppkey")
    tier = F.when(s % 20 == 0, "Blocked").when(s % 5 == 1, "Non-Business").when(s % 7 != 3, "Business")
    tiers = t.supplier.select(s.alias("connector"), tier.alias("tier")).where("tier is not null")
    flows = t.lineitem.select("l_orderkey", "l_suppkey", F.when(F.col("l_orderkey") % 4 == 0, "Development").otherwise("Production").alias("environment"))
    return compare.connector_policy(flows, tiers, "l_orderkey", "l_suppkey", "environment")


@query("a18_multi_owner", "SELECT l_partkey, count(DISTINCT l_suppkey) AS owners FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def _(t):
    return compare.multi_owner(t.lineitem, "l_partkey", "l_suppkey")


@query(
    "a19_quality_gate",
    """WITH c AS (SELECT user_id, bool_and(value > 0) AS a, bool_and(value < 480) AS b, bool_and(event_type <> 'error' OR value < 400) AS c FROM events GROUP BY 1),
n AS (SELECT *, (a::INT + b::INT + c::INT)::BIGINT AS passed, (NOT c)::BIGINT AS warned, ((NOT a)::INT + (NOT b)::INT)::BIGINT AS failed FROM c)
SELECT user_id, passed, warned, failed, array_to_string(list_filter([CASE WHEN NOT a THEN 'positive' END, CASE WHEN NOT b THEN 'below_limit' END,
  CASE WHEN NOT c THEN 'small_errors' END], lambda x: x IS NOT NULL), '|') AS reasons,
  CASE WHEN failed > 0 THEN 'FAIL' WHEN warned > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM n""",
)
def _(t):
    v = F.col("value")
    checks = {
        "positive": (v > 0, "mandatory"),
        "below_limit": (v < 480, "mandatory"),
        "small_errors": ((F.col("event_type") != "error") | (v < 400), "advisory"),
    }
    return compare.quality_gate(t.events, "user_id", checks)


SQL_LABELLED = """labelled AS (SELECT documents.*, labels.quality, labels.toxic FROM documents LEFT JOIN labels USING (doc_id))"""


def labelled(t):
    return t.documents.join(t.labels, "doc_id", "left")


@query(
    "a20_completeness",
    f"""WITH {SQL_LABELLED}, n AS (SELECT count(*) AS rows, count(*) FILTER (text <> '' AND lang <> '' AND quality IS NOT NULL AND toxic IS NOT NULL) AS complete_rows,
 count(*) FILTER (coalesce(text, '') = '') AS m1, count(*) FILTER (coalesce(lang, '') = '') AS m2, count(*) FILTER (quality IS NULL) AS m3, count(*) FILTER (toxic IS NULL) AS m4 FROM labelled)
SELECT rows, complete_rows, unnest(['text', 'lang', 'quality', 'toxic']) AS "column", unnest([m1, m2, m3, m4]) AS missing FROM n""",
)
def _(t):
    return compare.completeness(labelled(t), ["text", "lang", "quality", "toxic"])


@query(
    "a21_missing_report",
    f"""WITH {SQL_LABELLED}, n AS (SELECT count(*) AS rows, count(*) FILTER (quality IS NULL) AS m1, count(*) FILTER (toxic IS NULL) AS m2, count(*) FILTER (source IS NULL) AS m3 FROM labelled)
SELECT rows, unnest(['quality', 'toxic', 'source']) AS "column", unnest(['int', 'int', 'string']) AS dtype, unnest([m1, m2, m3]) AS missing, unnest([m1 > 0, m2 > 0, m3 > 0]) AS any_missing FROM n""",
)
def _(t):
    df = labelled(t).withColumns({"quality": F.col("quality").cast("int"), "toxic": F.col("toxic").cast("int")})
    return audit.missing_report(df, ["quality", "toxic", "source"])


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a21_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, max({c}) AS max,
  round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75 FROM lineitem"""
        for c in NUMERIC
    ),
)
def _(t):
    return audit.profile(t.lineitem, NUMERIC)


@query(
    "a22_value_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY {c}"""
        for c in ("o_orderstatus", "o_orderpriority")
    ),
)
def _(t):
    return audit.value_counts(t.orders, ["o_orderstatus", "o_orderpriority"], normalize=True)


@query(
    "a23_correlation",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in NUMERIC for b in NUMERIC),
)
def _(t):
    return audit.correlation(t.lineitem, NUMERIC)


@query(
    "a23_top_correlated",
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS feature, abs(round(corr({a}, l_extendedprice), 6)) AS abs_r FROM lineitem" for a in NUMERIC if a != "l_extendedprice")
    + ") ORDER BY abs_r DESC, feature LIMIT 10",
)
def _(t):
    return audit.top_correlated(t.lineitem, NUMERIC, "l_extendedprice")


@query(
    "a24_histogram",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", least(10, floor(({c} - lo) * 10 / (hi - lo)) + 1)::BIGINT AS bin, count(*) AS n
  FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY ALL"""
        for c in ("l_quantity", "l_extendedprice")
    ),
)
def _(t):
    return audit.histogram(t.lineitem, ["l_quantity", "l_extendedprice"])


@query(
    "a25_feedback_rate",
    """WITH e AS (SELECT CASE event_id % 2 WHEN 0 THEN 'web' ELSE 'teams' END AS channel, 'topic' || (user_id % 5)::VARCHAR AS topic,
  CASE event_type WHEN 'error' THEN 'human' WHEN 'click' THEN 'not_helpful' ELSE 'helpful' END AS feedback FROM events)
SELECT coalesce(channel, 'all') AS channel, coalesce(topic, 'all') AS topic, count(*) AS answers, count(*) FILTER (feedback = 'helpful') AS helpful,
  count(*) FILTER (feedback = 'not_helpful') AS not_helpful, count(*) FILTER (feedback = 'human') AS human,
  round((count(*) - count(*) FILTER (feedback = 'human')) / count(*), 6) AS resolution_rate FROM e GROUP BY GROUPING SETS ((channel), (topic), ())""",
)
def _(t):
    kind = F.col("event_type")
    df = t.events.select(
        F.when(F.col("event_id") % 2 == 0, "web").otherwise("teams").alias("channel"),
        F.concat(F.lit("topic"), (F.col("user_id") % 5).cast("string")).alias("topic"),
        F.when(kind == "error", "human").when(kind == "click", "not_helpful").otherwise("helpful").alias("feedback"),
    )
    out = audit.feedback_rate(df, "channel", "topic", "feedback")
    return out.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("channel", "topic")})
