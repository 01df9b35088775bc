"""Corpus preparation and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions import hooks, scalars
from casework.operators import corpus
from casework.plans.bindings import SQL_CHUNK_IDS, SQL_CHUNKS, chunks, sql_strip, sql_terms, sql_words
from casework.plans.registry import query
from casework.sources.files import spread


@query(
    "c1_chunk_fixed",
    f"""WITH {SQL_CHUNKS}
SELECT substring(sha256(doc_id::VARCHAR || ':' || chunk_index::VARCHAR), 1, 32) AS id, doc_id, chunk_index, audience, category,
       greatest(1, chunk_index // 4 + 1)::BIGINT AS page_number, md5(content) AS content_md5
FROM chunks""",
)
def _(t):
    return chunks(t).select(
        "id", "doc_id", "chunk_index", "audience", "category", "page_number", F.md5("content").alias("content_md5")
    )


SQL_RATIO = f"""
words AS (SELECT doc_id, source, {sql_words('text')} AS w FROM documents WHERE {sql_strip('text')} <> ''),
ratio AS (
  SELECT doc_id, source, i, n AS total_chunks, w[i * 410 + 1 : i * 410 + 512] AS part
  FROM (SELECT *, unnest(range(0, n)) AS i
        FROM (SELECT *, CASE WHEN len(w) <= 512 THEN 1 ELSE ceil((len(w) - 512) / 410.0)::BIGINT + 1 END AS n FROM words)))
"""


@query(
    "c2_chunk_ratio",
    f"""WITH {SQL_RATIO}
SELECT md5(doc_id::VARCHAR || '::' || i::VARCHAR) AS id, doc_id, i::BIGINT AS chunk_index, total_chunks::BIGINT AS total_chunks,
       len(part)::BIGINT AS token_count, md5(array_to_string(part, ' ')) AS content_md5 FROM ratio""",
)
def _(t):
    out = corpus.chunk_ratio(spread(t.documents).select("doc_id", "text"), "doc_id", "text")
    return out.select("id", "doc_id", "chunk_index", "total_chunks", "token_count", F.md5("content").alias("content_md5"))


@query(
    "c3_chunk_by_key",
    """WITH lines AS (
  SELECT l_partkey, l_quantity::BIGINT::VARCHAR || ' @ ' || round(l_extendedprice * 100)::BIGINT::VARCHAR AS line,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, line) AS no FROM lineitem)
SELECT l_partkey, ((no - 1) // 1000)::BIGINT AS chunk_index, count(*) AS lines, md5(string_agg(line, chr(10) ORDER BY no)) AS content_md5
FROM lines GROUP BY ALL""",
)
def _(t):
    line = F.concat(
        F.col("l_quantity").cast("long").cast("string"),
        F.lit(" @ "),
        F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"),
    )
    out = corpus.chunk_by_key(t.lineitem, "l_partkey", [F.col("l_orderkey"), F.col("l_linenumber")], line)
    return out.select("l_partkey", "chunk_index", "lines", F.md5("content").alias("content_md5"))


SQL_NORMAL = rf"regexp_replace(lower({sql_strip('text')}), '[ \t\r\n\f]+', ' ', 'g')"


@query(
    "c4_dedupe_docs",
    f"""SELECT doc_id, text_hash FROM (
  SELECT doc_id, md5({SQL_NORMAL}) AS text_hash FROM documents)
QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY doc_id DESC) = 1""",
)
def _(t):
    out = corpus.dedupe_docs(spread(t.documents), "text", [F.col("doc_id").desc()])
    return out.select("doc_id", "text_hash")


@query(
    "c5_quality_check",
    rf"""SELECT doc_id, array_to_string(list_filter([
  CASE WHEN length(s) = 0 THEN 'empty' END,
  CASE WHEN length(s) > 0 AND length(s) <= 50 THEN 'near_empty' END,
  CASE WHEN len(string_split_regex(s, '[ \t\r\n\f]+')) > 2000 THEN 'too_long' END,
  CASE WHEN regexp_matches(string_split(s, chr(10))[1], '^[Ss]ection [0-9]+(\.[0-9]+)*[ \t\r]*$') THEN 'vague_heading' END],
  lambda x: x IS NOT NULL), '|') AS flags
FROM (SELECT doc_id, {sql_strip('text')} AS s FROM documents)""",
)
def _(t):
    return corpus.quality_check(spread(t.documents), "text").select("doc_id", "flags")


@query(
    "c6_ingest_summary",
    f"""WITH {SQL_CHUNKS}, per_doc AS (SELECT doc_id, count(*) AS c FROM chunks GROUP BY doc_id)
SELECT count(*) AS documents, count(c) AS documents_processed, count(*) FILTER (c IS NULL) AS documents_failed,
       sum(c)::BIGINT AS chunks_created, sum(c)::BIGINT AS chunks_indexed
FROM documents LEFT JOIN per_doc USING (doc_id)""",
)
def _(t):
    return corpus.ingest_summary(t.documents, chunks(t), "doc_id")


@query(
    "c6_failed_documents",
    f"WITH {SQL_CHUNKS} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM chunks)",
)
def _(t):
    return corpus.failed_documents(t.documents, chunks(t), "doc_id")


@query(
    "c7_dry_run",
    f"""WITH {SQL_RATIO}
SELECT coalesce(doc_id::VARCHAR, 'total') AS document, count(*) AS chunks, ceil(count(*) / 100.0)::BIGINT AS batches
FROM ratio GROUP BY ROLLUP (doc_id)""",
)
def _(t):
    out = corpus.dry_run(corpus.chunk_ratio(spread(t.documents).select("doc_id", "text"), "doc_id", "text"), "doc_id")
    return out.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("total")).alias("document"), "chunks", "batches")


@query(
    "c8_embed",
    f"""WITH {SQL_CHUNKS}, {SQL_CHUNK_IDS}
SELECT id, 256::BIGINT AS dim, CASE WHEN len({sql_terms('content')}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS squared_norm, NULL::VARCHAR AS error FROM chunk_ids""",
)
def _(t):
    out = hooks.embed(chunks(t).select("id", "content"))
    norm = F.aggregate("content_vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return out.select("id", F.size("content_vector").alias("dim"), F.round(norm, 4).alias("squared_norm"), "error")


@query(
    "p1_chunk_id",
    """SELECT doc_id, substring(sha256(doc_id::VARCHAR || ':0'), 1, 32) AS sha_id,
       md5(doc_id::VARCHAR || '::0') AS md5_id FROM documents""",
)
def _(t):
    name = F.col("doc_id").cast("string")
    return t.documents.select(
        "doc_id",
        scalars.chunk_id(name, F.lit(0)).alias("sha_id"),
        scalars.chunk_id(name, F.lit(0), "md5").alias("md5_id"),
    )


@query(
    "p2_title_from_path",
    r"""SELECT page_id, translate(regexp_extract(url, '([^/]*?)(\.[^./]*)?$', 1), '_-', '  ') AS title,
       coalesce(nullif(CASE WHEN page_id % 3 = 0 THEN '' ELSE url END, ''), 'page/' || page_id::VARCHAR) AS source_url FROM pages""",
)
def _(t):
    given = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.col("url"))
    path = F.concat(F.lit("page/"), F.col("page_id").cast("string"))
    return t.pages.select(
        "page_id", scalars.title_from_path("url").alias("title"), scalars.source_url(given, path).alias("source_url")
    )


@query(
    "p3_tag_defaults",
    """SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'general' ELSE source END AS category,
       CASE WHEN doc_id % 10 = 5 THEN 'internal' WHEN lang = 'en' THEN 'customer' ELSE 'internal' END AS audience,
       CASE WHEN doc_id % 10 = 7 THEN '2026-01-01' ELSE '2025-0' || (doc_id % 9 + 1)::VARCHAR || '-15' END AS effective_date
FROM documents""",
)
def _(t):
    d = F.col("doc_id")
    tags = F.create_map(
        F.lit("category"),
        F.when(d % 10 != 3, F.col("source")),
        F.lit("audience"),
        F.when(d % 10 != 5, F.when(F.col("lang") == "en", "customer").otherwise("internal")),
        F.lit("effective_date"),
        F.when(d % 10 != 7, F.concat(F.lit("2025-0"), (d % 9 + 1).cast("string"), F.lit("-15"))),
    )
    out = scalars.with_tag_defaults(t.documents.withColumn("tags", tags), run_date=F.to_date(F.lit("2026-01-01")))
    return out.select("doc_id", "category", "audience", "effective_date")


@query(
    "p5_index_fields",
    f"""WITH {SQL_RATIO}
SELECT md5(doc_id::VARCHAR || '::' || i::VARCHAR) AS id, source AS title, md5(array_to_string(part, ' ')) AS content,
       doc_id::VARCHAR AS "sourceUrl", CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '2025-06-01' END AS "lastModified",
       i::BIGINT AS "chunkIndex", total_chunks::BIGINT AS "totalChunks" FROM ratio""",
)
def _(t):
    out = corpus.chunk_ratio(spread(t.documents).select("doc_id", "source", "text"), "doc_id", "text")
    rows = out.select(
        "id",
        F.col("source").alias("title"),
        F.md5("content").alias("content"),
        F.col("doc_id").cast("string").alias("source_url"),
        F.when(F.col("doc_id") % 4 == 0, "").otherwise("2025-06-01").alias("last_modified"),
        "chunk_index",
        "total_chunks",
    )
    return scalars.to_index_fields(rows)


@query(
    "p7_audit_projection",
    """SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 THEN 'anonymous' ELSE conv_id::VARCHAR END AS session_id,
       substring(text, 1, 255) AS query, md5(substring(text, 1, 5000)) AS response_md5,
       substring(text, 1, 500) AS response_summary, round(length(text) / 7919.0, 4) AS top_score,
       '[{"title":"' || role || '","source_url":"turn","chunk_index":' || turn::VARCHAR || '}]' AS citations
FROM conversations""",
)
def _(t):
    cite = F.array(
        F.struct(F.col("role").alias("title"), F.lit("turn").alias("source_url"), F.col("turn").alias("chunk_index"))
    )
    rows = t.conversations.select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 7 == 0, "").otherwise(F.col("conv_id").cast("string")).alias("session_id"),
        F.col("text").alias("query"),
        F.col("text").alias("response"),
        (F.length("text") / 7919.0).alias("top_score"),
        cite.alias("citations"),
    )
    out = scalars.audit_projection(rows)
    return out.withColumn("response_md5", F.md5("response")).drop("response")


def audit_turns(t):
    """Conversation turns as audit records, some of them in breach of the contract."""
    turn, conv = F.col("turn"), F.col("conv_id")
    cite = F.struct(
        F.concat(F.lit("title "), (turn % 2).cast("string")).alias("title"),
        F.col("role").alias("source_url"),
        (turn - 1).cast("int").alias("chunk_index"),
    )
    return t.conversations.select(
        "conv_id",
        "turn",
        F.lit("2026-01-01T00:00:00+00:00").alias("timestamp"),
        F.when(conv % 7 != 0, conv.cast("string")).alias("session_id"),
        F.repeat("text", F.when(turn == 1, 40).otherwise(1)).alias("query"),
        F.col("text").alias("response"),
        F.when(turn % 5 == 4, "Low").when(turn % 2 == 0, "High").otherwise("Escalated").alias("confidence_band"),
        (turn * 1.0).alias("top_score"),
        (turn % 2 == 1).alias("escalated"),
        F.when(turn % 4 == 1, F.array().cast("array<struct<title:string,source_url:string,chunk_index:int>>")).otherwise(F.array(cite, cite)).alias("citations"),
        F.concat(F.col("role"), F.lit("@example.org")).alias("user_upn"),
        F.lit("on-duty expert").alias("sme"),
        F.lit("Test").alias("environment"),
    )


@query(
    "p7_audit_list",
    """SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 THEN 'anonymous' ELSE conv_id::VARCHAR END AS "SessionID", role || '@example.org' AS "UserUPN",
  substring(text, 1, 500) AS "ResponseSummary", CASE WHEN turn % 4 = 1 THEN '' ELSE 'title ' || (turn % 2)::VARCHAR END AS "SourceDocuments",
  CASE WHEN turn % 2 = 1 THEN 'on-duty expert' ELSE '' END AS "EscalatedTo" FROM conversations""",
)
def _(t):
    rows = audit_turns(t).withColumn("environment", F.concat_ws("/", "conv_id", "turn"))
    out = scalars.audit_list_row(rows)
    key = F.split("EnvironmentName", "/")
    return out.select(
        key[0].cast("long").alias("conv_id"), key[1].cast("long").alias("turn"), "SessionID", "UserUPN", "ResponseSummary", "SourceDocuments", "EscalatedTo"
    )


@query(
    "p11_audit_problems",
    """SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN conv_id % 7 = 0 THEN 'missing:session_id' END,
  CASE WHEN turn = 1 AND length(text) * 40 > 5000 THEN 'long:query' END, CASE WHEN length(text) > 32000 THEN 'long:response' END,
  CASE WHEN turn % 5 = 4 THEN 'enum:confidence_band' END, CASE WHEN turn > 4 THEN 'range:top_score' END,
  CASE WHEN turn % 4 <> 1 AND turn = 0 THEN 'citation' END, CASE WHEN turn % 2 = 1 AND turn % 4 <> 1 THEN 'cited_when_escalated' END], lambda x: x IS NOT NULL), '|') AS problems
FROM conversations""",
)
def _(t):
    return audit_turns(t).select("conv_id", "turn", scalars.audit_problems().alias("problems"))


@query(
    "p8_extract_number",
    """SELECT p_partkey, try_cast(nullif(regexp_replace(p_name || ' ' || p_brand, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS number FROM part""",
)
def _(t):
    return t.part.select("p_partkey", scalars.extract_number(F.concat_ws(" ", "p_name", "p_brand")).alias("number"))


@query(
    "p9_parse_discount",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
       CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE round(l_discount * 100)::BIGINT::DOUBLE / 100 END AS discount FROM lineitem""",
)
def _(t):
    text = F.when(F.col("l_discount") == 0, "-").otherwise(
        F.concat(F.round(F.col("l_discount") * 100).cast("long").cast("string"), F.lit("%"))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", scalars.parse_discount(text).alias("discount"))


@query(
    "p10_extract_sources",
    """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'doc ' || conv_id::VARCHAR || '|' || role ELSE '' END AS sources
FROM conversations""",
)
def _(t):
    cited = F.concat(
        F.col("text"),
        F.lit("\nSource:  doc "),
        F.col("conv_id").cast("string"),
        F.lit(" , Section 4\nSource: "),
        F.col("role"),
        F.lit("\n"),
    )
    answer = F.when(F.col("turn") % 2 == 0, cited).otherwise(F.col("text"))
    return t.conversations.select("conv_id", "turn", scalars.extract_sources(answer).alias("sources"))


@query(
    "p11_parse_model_json",
    """SELECT event_id, k, CASE WHEN bad THEN 'bad_json' ELSE array_to_string(list_filter([
   CASE WHEN k IS NULL THEN 'missing:k' END, CASE WHEN k NOT IN ('0','1','2','3','4') THEN 'enum:k' END], lambda x: x IS NOT NULL), '|') END AS problems
FROM (SELECT event_id, event_id % 11 = 0 AS bad,
        CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events)""",
)
def _(t):
    raw = (
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("not json "), F.col("props")))
        .when(F.col("event_id") % 13 == 0, F.lit('{"other": 1}'))
        .otherwise(F.col("props"))
    )
    schema = T.StructType([T.StructField("k", T.StringType())])
    rows = t.events.select("event_id", raw.alias("raw"))
    out = scalars.parse_model_json(rows, "raw", schema, {"k": ["0", "1", "2", "3", "4"]}, {"k": 20})
    return out.select("event_id", F.col("parsed.k").alias("k"), "problems")


PROMPT = "# Prompt\n\n```\nContext:\n{retrieved_chunks}\n\nQuestion: {user_query}\n```\n"


@query(
    "p12_build_prompt",
    """SELECT doc_id, md5('Context:' || chr(10) || text || chr(10) || chr(10) || 'Question: what is said about ' || source || '?') AS prompt_md5
FROM documents""",
)
def _(t):
    question = F.concat(F.lit("what is said about "), F.col("source"), F.lit("?"))
    return t.documents.select("doc_id", F.md5(scalars.build_prompt(PROMPT, "text", question)).alias("prompt_md5"))


@query(
    "p13_preview",
    """SELECT doc_id, CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '...' ELSE text END AS preview FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", scalars.preview("text", 80).alias("preview"))


@query(
    "p14_calendar",
    """WITH span AS (SELECT min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders),
days AS (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY))::DATE AS d FROM span),
marked AS (SELECT d, strftime(d, '%Y-%m') AS month, dayofweek(d) + 1 AS weekday, d = last_day(d) AS is_month_end,
   strftime(d, '%m-%d') IN ('01-01', '12-25') AS is_holiday FROM days),
biz AS (SELECT *, weekday NOT IN (1, 7) AND NOT is_holiday AS is_business_day FROM marked)
SELECT d::VARCHAR AS date, month, weekday, is_month_end, is_holiday, is_business_day,
   (max(d) FILTER (is_business_day) OVER (PARTITION BY month))::VARCHAR AS last_business_day FROM biz""",
)
def _(t):
    span = t.orders.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    holidays = (
        t.orders.select(F.year("o_orderdate").alias("y")).distinct()
        .select(F.explode(F.array(F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(25)))).alias("date"))
    )
    return scalars.calendar(span, holidays=holidays)


@query(
    "p16_reference_no",
    """SELECT o_orderkey, 'INC-' || y::VARCHAR || '-' || CASE WHEN no < 10000 THEN lpad(no::VARCHAR, 4, '0') ELSE no::VARCHAR END AS reference
FROM (SELECT o_orderkey, year(o_orderdate) AS y, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS no FROM orders)""",
)
def _(t):
    out = scalars.reference_no(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")
    return out.select("o_orderkey", "reference")


@query(
    "p17_mask_pii",
    """SELECT c_custkey, sha256('s1' || c_name) AS c_name, c_mktsegment FROM customer""",
)
def _(t):
    out = scalars.mask_pii(t.customer, hash_cols=["c_name"], drop_cols=["c_acctbal", "c_nationkey"], salt="s1")
    return out.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "u3_custom_tokeniser",
    """SELECT doc_id, len(string_split(text, ' '))::BIGINT AS tokens FROM documents""",
)
def _(t):
    split = hooks.register_tokeniser(lambda texts: [s.split(" ") for s in texts], batched=True)
    return t.documents.select("doc_id", F.size(split(F.col("text"))).alias("tokens"))


