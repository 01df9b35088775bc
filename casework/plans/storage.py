"""Readers and writers, each as a round trip over the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions import hooks
from casework.functions.scalars import build_prompt, extract_sources
from casework.operators import evaluation
from casework.plans.bindings import SQL_CHUNK_IDS, SQL_CHUNKS, chunks
from casework.plans.measures import SQL_EVAL, results
from casework.plans.registry import query
from casework.session import scratch_path
from casework.sources import files, sinks, star


@query(
    "s1_scan_files",
    """WITH lines AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT source AS folder, sum(strlen(line) + 1)::BIGINT AS bytes, count(*) AS n_lines, sum(('0x' || substr(md5(line), 1, 8))::BIGINT)::BIGINT AS line_digests FROM lines GROUP BY source""",
)
def _(t):
    """Documents written as text files below one folder per source, English ones in a folder that Spark hides, then scanned back."""
    path = scratch_path(t.spark, "files")
    for below, some in (("", ~F.col("lang").eqNullSafe("en")), ("/_sub", F.col("lang").eqNullSafe("en"))):
        t.documents.where(some).select("source", "text").write.mode("append").partitionBy("source").text(path + below)
    scanned = files.scan_files(t.spark, path, [".TXT"])
    folder = F.regexp_extract("path", "(?:^|/)source=([^/]+)/", 1)
    lines = scanned.select(folder.alias("folder"), F.explode(F.split(F.regexp_replace("text", "\\n\\z", ""), "\n")).alias("line"))
    digest = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("long")
    return lines.groupBy("folder").agg(
        F.sum(F.octet_length("line") + 1).alias("bytes"), F.count(F.lit(1)).alias("n_lines"), F.sum(digest).alias("line_digests")
    )


@query("s2_read_csv", "SELECT p_partkey, p_name AS part_name, p_retailprice AS retail_price_aud, p_size::BIGINT AS p_size FROM part")
def _(t):
    source = t.part.select("p_partkey", F.col("p_name").alias(" Part Name "), F.col("p_retailprice").alias("Retail Price (AUD)"), "p_size")
    return files.read_csv(t.spark, sinks.round_trip_csv(source))


@query(
    "s3_read_eval_set",
    """SELECT text AS query, 'doc-' || item_id::VARCHAR AS expected_source, substring(text, 1, 5) AS expected_answer_contains, 'policy' AS category,
  item_id % 3 = 0 AS should_escalate, false AS is_out_of_scope FROM benchmark""",
)
def _(t):
    case = F.struct(
        F.col("text").alias("query"),
        F.concat(F.lit("doc-"), F.col("item_id").cast("string")).alias("expected_source"),
        F.substring("text", 1, 5).alias("expected_answer_contains"),
        F.lit("policy").alias("category"),
        F.when(F.col("item_id") % 3 == 0, True).alias("should_escalate"),
    )
    path = scratch_path(t.spark, "cases")
    t.benchmark.select(F.array(case).alias("cases")).write.json(path)
    return files.read_eval_set(t.spark, path, multi_line=False)


@query("s4_append_jsonl", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    path = scratch_path(t.spark, "audit-log")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    for kind in ("event_type in ('view', 'click')", "event_type not in ('view', 'click')"):
        sinks.append_jsonl(rows.where(kind), path)
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "s5_upsert",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN 'v3' ELSE 'v1' END AS version FROM documents""",
)
def _(t):
    """English documents are ingested again twice; the later load wins and nothing is doubled."""
    base = t.documents.select("doc_id", "lang", F.lit("v1").alias("version"), F.lit(1).alias("load"))
    again = base.where("lang = 'en'")
    new = again.withColumns({"version": F.lit("v2"), "load": F.lit(2)}).unionByName(again.withColumns({"version": F.lit("v3"), "load": F.lit(3)}))
    return sinks.upsert(base, new, ["doc_id"], F.col("load")).select("doc_id", "version")


@query(
    "s6_write_batches",
    f"""WITH {SQL_CHUNKS}, {SQL_CHUNK_IDS}, numbered AS (SELECT (row_number() OVER (ORDER BY id) - 1) // 100 AS batch FROM chunk_ids)
SELECT batch, count(*) AS rows, count(*) AS succeeded, NULL::VARCHAR AS error FROM numbered GROUP BY batch""",
)
def _(t):
    return sinks.write_batches(chunks(t).select("id", "doc_id"), len, ["id"], size=100)


@query(
    "s7_write_report",
    f"WITH {SQL_EVAL.format(exempt='')} SELECT passed, count(*) AS n, sum(round(latency_ms, 1)) AS ms FROM results GROUP BY passed",
)
def _(t):
    path = scratch_path(t.spark, "report")
    scored = results(t)
    sinks.write_report(evaluation.eval_report(scored), scored.select("query", "passed", "latency_ms", "sources", "error"), path)
    schema = T.StructType.fromDDL("query string, passed boolean, latency_ms double, sources array<string>, error string")
    return t.spark.read.schema(schema).json(f"{path}/results").groupBy("passed").agg(F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("ms"))


@query(
    "s8_load_star",
    """SELECT n_name, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""",
)
def _(t):
    joined = files.load_star(t.orders, [(t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey")])
    return joined.groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


STAR = star.Star(
    star.Table("orders", "o_orderkey long, o_custkey long, o_totalprice double"),
    (
        star.Dimension("customer", "c_custkey long, c_nationkey long, c_mktsegment string", "c_custkey", "o_custkey"),
        star.Dimension("nation", "n_nationkey long, n_regionkey long, n_name string", "n_nationkey", "c_nationkey"),
        star.Dimension("region", "r_regionkey long, r_name string", "r_regionkey", "n_regionkey"),
    ),
)


@query(
    "s8_read_star",
    """SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
)
def _(t):
    """Declared tables of the folder, joined by their declared keys through three levels."""
    wide = star.read_star(STAR, star.from_folder(t.spark, t.folder))
    return wide.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query(
    "u1_custom_embedder",
    f"WITH {SQL_CHUNKS}, {SQL_CHUNK_IDS} SELECT id, length(content)::DOUBLE AS chars, NULL::VARCHAR AS error FROM chunk_ids",
)
def _(t):
    def lengths(texts):
        return [[float(len(x)), float(x.count(" "))] for x in texts]

    out = hooks.register_embedder(lengths, batch=50)(chunks(t).select("id", "content"))
    return out.select("id", F.element_at("content_vector", 1).cast("double").alias("chars"), "error")


@query(
    "u4_custom_generator",
    """SELECT item_id, 'Source: doc-' || item_id::VARCHAR AS answer, 'doc-' || item_id::VARCHAR AS sources FROM benchmark""",
)
def _(t):
    name = F.concat(F.lit("doc-"), F.col("item_id").cast("string"))
    prompts = t.benchmark.select("item_id", build_prompt("```\n{retrieved_chunks}|{user_query}\n```", name, "text").alias("prompt"))

    def answer(texts):
        return [f"Source: {x.split('|')[0]}" for x in texts]

    out = hooks.register_generator(answer)(prompts)
    return out.select("item_id", "answer", extract_sources("answer").alias("sources"))

