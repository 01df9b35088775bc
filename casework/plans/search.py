"""Retrieval, context and answer routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from casework.operators import context, filters, retrieval, routing, vector_index
from casework.plans.bindings import SQL_CHUNK_IDS, SQL_CHUNKS, chunks, sql_strip, sql_terms
from casework.plans.registry import query
from casework.session import materialise, scratch_path
from casework.sources.files import spread


def questions(t):
    """Benchmark items as questions; the question's vector is the embedding of the same number."""
    return t.benchmark.select(F.col("item_id").alias("q_id"), "text")


def vector_questions(t):
    vectors = t.embeddings.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("vector"))
    return questions(t).join(vectors, "q_id", "left")


def vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def vector_chunks(t):
    """Chunks of all documents with audience and category, and the vector of their document where it has one."""
    own = vectors(t).withColumnRenamed("id", "doc_id")
    return chunks(t).select("id", "doc_id", "content", "audience", "category").join(own, "doc_id", "left")


SQL_KNN = """
knn AS (
  SELECT q_id, id, score, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) AS rank FROM (
    SELECT b.item_id AS q_id, e.vec_id AS id,
           round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 5) AS score
    FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id CROSS JOIN {corpus} e))
"""


@query("r1_knn_exact", f"WITH {SQL_KNN.format(corpus='embeddings')} SELECT q_id, id, score, rank FROM knn WHERE rank <= 15")
def _(t):
    return retrieval.knn_exact(vector_questions(t), vectors(t), k=5, over=3)


def stored_vectors(t, lists=16, parts=1):
    """Index of all vectors; with two parts the second is appended to the lists trained on the first."""
    corpus, path = vectors(t), scratch_path(t.spark, "vector-index")
    vector_index.build(corpus.where(F.col("id") % parts == 0), path, lists)
    for i in range(1, parts):
        vector_index.append(corpus.where(F.col("id") % parts == i), path)
    return path


@query("r2_knn_approx")
def _(t):
    return vector_index.search(vector_questions(t), stored_vectors(t), k=5, probes=10)


@query("r2_recall", f"WITH {SQL_KNN.format(corpus='embeddings')} SELECT count(*) AS answers, true AS enough FROM knn WHERE rank <= 5")
def _(t):
    """Exact neighbours, and whether the index finds nine tenths of them."""
    exact = retrieval.knn_exact(vector_questions(t), vectors(t), k=5, over=1).select("q_id", "id")
    found = vector_index.search(vector_questions(t), stored_vectors(t), k=5, probes=10).select("q_id", "id", F.lit(1).alias("hit"))
    return exact.join(found, ["q_id", "id"], "left").agg(F.count("*").alias("answers"), (F.count("hit") >= 0.9 * F.count("*")).alias("enough"))


@query("r2_all_lists", f"WITH {SQL_KNN.format(corpus='embeddings')} SELECT q_id, id, score, rank FROM knn WHERE rank <= 5")
def _(t):
    """An index grown in two parts, with every list probed, gives the exact neighbours."""
    return vector_index.search(vector_questions(t), stored_vectors(t, parts=2), k=5, probes=16)


def sql_bm25(corpus: str, k: int) -> str:
    return f"""
asked AS (SELECT DISTINCT q_id, unnest(terms) AS term FROM (SELECT item_id AS q_id, {sql_terms('text')} AS terms FROM benchmark)),
indexed AS (SELECT id, terms, len(terms) AS dl FROM (SELECT id, {sql_terms('content')} AS terms FROM {corpus})),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM indexed),
post AS (SELECT id, dl, term, count(*) AS tf FROM (SELECT id, dl, unnest(terms) AS term FROM indexed) GROUP BY ALL),
idf AS (SELECT term, ln(1 + ((SELECT n FROM stats) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM post GROUP BY term),
scored AS (
  SELECT q_id, id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (SELECT avgdl FROM stats)))), 6) AS score
  FROM post JOIN idf USING (term) JOIN asked USING (term) GROUP BY ALL),
bm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) AS rank FROM scored) WHERE rank <= {k})
"""


@query("r3_bm25", f"WITH {SQL_CHUNKS}, {SQL_CHUNK_IDS}, {sql_bm25('chunk_ids', 10)} SELECT q_id, id, score, rank FROM bm")
def _(t):
    index = materialise(retrieval.keyword_index(chunks(t)), "keyword-index")
    return retrieval.bm25(questions(t), index, k=10)


SQL_VCHUNKS = f"""{SQL_CHUNKS}, {SQL_CHUNK_IDS},
allowed AS (
  SELECT c.id, c.doc_id, c.content, c.audience, c.category, e.embedding
  FROM chunk_ids c LEFT JOIN embeddings e ON e.vec_id = c.doc_id WHERE c.audience = 'customer'),
placed AS (SELECT id AS vec_id, embedding FROM allowed WHERE embedding IS NOT NULL)
"""
SQL_HYBRID = f"""{SQL_VCHUNKS}, {SQL_KNN.format(corpus='placed')}, near AS (SELECT * FROM knn WHERE rank <= 15),
{sql_bm25('allowed', 15)},
fused AS (
  SELECT coalesce(a.q_id, b.q_id) AS q_id, coalesce(a.id, b.id) AS id,
         round(coalesce(1 / (60 + a.rank), 0) + coalesce(1 / (60 + b.rank), 0), 8) AS fused, a.score AS cosine
  FROM near a FULL JOIN bm b ON a.q_id = b.q_id AND a.id = b.id)
"""
SQL_RERANK = f"""
pairs AS (
  SELECT f.*, a.category, a.content, {sql_terms('q.text')} AS qt, {sql_terms('a.content')} AS ct
  FROM fused f JOIN allowed a ON a.id = f.id JOIN benchmark q ON q.item_id = f.q_id),
reranked AS (
  SELECT q_id, id, fused, cosine, category, content,
         round(coalesce(4.0::DOUBLE * len(list_intersect(list_distinct(qt), list_distinct(ct))) / nullif(len(list_distinct(qt)), 0), 0), 6) AS reranker_score
  FROM pairs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY reranker_score DESC, id) AS rank FROM reranked)
"""


def search_tables(t):
    """Chunks of all documents, and their keyword index, each written once and searched many times."""
    docs = materialise(vector_chunks(t), "chunks")
    return docs, materialise(retrieval.keyword_index(docs, keep=["audience", "category"]), "keyword-index")


def runs(t):
    docs, index = search_tables(t)
    allowed = filters.audience_filter(docs)
    near = retrieval.knn_exact(vector_questions(t), allowed, k=5, over=3)
    found = retrieval.bm25(questions(t), filters.audience_filter(index), k=15)
    return allowed, near, found


@query("r4_rrf", f"WITH {SQL_HYBRID} SELECT q_id, id, fused FROM fused")
def _(t):
    _, near, found = runs(t)
    return retrieval.rrf([near, found])


@query("r5_rerank", f"WITH {SQL_HYBRID}, {SQL_RERANK} SELECT q_id, id, fused, reranker_score, rank FROM ranked")
def _(t):
    allowed, near, found = runs(t)
    fused = retrieval.rrf([near, found])
    pairs = fused.join(allowed.select("id", "content"), "id").join(questions(t), "q_id")
    return retrieval.rerank(pairs).select("q_id", "id", "fused", "reranker_score", "rank")


def search(t, **options):
    docs, index = search_tables(t)
    return retrieval.hybrid_search(vector_questions(t), docs, index=index, **options)


@query(
    "r6_hybrid_search",
    f"""WITH {SQL_HYBRID}, {SQL_RERANK}
SELECT q_id, id, category, cosine, fused, reranker_score, rank FROM ranked WHERE rank <= 5 AND reranker_score >= 0.7""",
)
def _(t):
    out = search(t, k=5, threshold_on="reranker_score", threshold=filters.RERANK_THRESHOLD)
    return out.select("q_id", "id", "category", "cosine", "fused", "reranker_score", "rank")


@query(
    "f2_score_filter",
    f"WITH {SQL_KNN.format(corpus='embeddings')} SELECT q_id, id, score FROM knn WHERE rank <= 15 AND score >= 0.75",
)
def _(t):
    hits = retrieval.knn_exact(vector_questions(t), vectors(t), k=5, over=3)
    return filters.score_filter(hits, "score").select("q_id", "id", "score")


@query(
    "o1_format_context",
    f"""WITH {SQL_HYBRID}, {SQL_RERANK}, hits AS (SELECT * FROM ranked WHERE rank <= 5 AND reranker_score >= 0.7),
blocks AS (SELECT q_id, row_number() OVER (PARTITION BY q_id ORDER BY reranker_score DESC, rank) AS n, * EXCLUDE (q_id) FROM hits)
SELECT b.item_id AS q_id,
  md5(coalesce((SELECT string_agg('[Document ' || n::VARCHAR || ']' || chr(10) || 'Source: doc-' || id::VARCHAR || ' (effective 2026-01-01)' || chr(10)
       || 'Category: ' || category || chr(10) || 'Content:' || chr(10) || content, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY n)
       FROM blocks WHERE q_id = b.item_id), 'No relevant documents found.')) AS context_md5,
  coalesce((SELECT string_agg('doc-' || id::VARCHAR, '|' ORDER BY n) FROM blocks WHERE q_id = b.item_id), '') AS citations
FROM benchmark b""",
)
def _(t):
    hits = search(t, k=5, threshold_on="reranker_score", threshold=filters.RERANK_THRESHOLD)
    hits = hits.withColumns(
        {"source_document": F.concat(F.lit("doc-"), F.col("id").cast("string")), "effective_date": F.lit("2026-01-01")}
    )
    return context.format_context(questions(t), hits).select("q_id", F.md5("context").alias("context_md5"), "citations")


@query(
    "o1_format_context_titles",
    f"""WITH {SQL_HYBRID}, {SQL_RERANK}, hits AS (SELECT * FROM ranked WHERE rank <= 3)
SELECT b.item_id AS q_id,
  md5(coalesce((SELECT string_agg('[Document ' || rank::VARCHAR || ': ' || category || ' (chunk 0)]' || chr(10) || content,
       chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) FROM hits WHERE q_id = b.item_id), '')) AS context_md5,
  coalesce((SELECT string_agg(category || '/' || id::VARCHAR || '/0', '|' ORDER BY rank) FROM hits WHERE q_id = b.item_id), '') AS citations
FROM benchmark b""",
)
def _(t):
    hits = search(t, k=5).where("rank <= 3").withColumns(
        {"title": F.col("category"), "source_url": F.col("id").cast("string"), "chunk_index": F.lit(None).cast("int")}
    )
    out = context.format_context(questions(t), hits, style="title")
    cite = F.transform("citations", lambda c: F.concat_ws("/", c["title"], c["source_url"], c["chunk_index"].cast("string")))
    return out.select("q_id", F.md5("context").alias("context_md5"), cite.alias("citations"))


@query(
    "o2_highlights",
    rf"""WITH q AS (SELECT doc_id, {sql_terms("'the report for ' || source || ' about data and system'")} AS qt, string_split_regex(text, '[.!?]+[ \t\r\n]+') AS s FROM documents)
SELECT doc_id, len(h)::BIGINT AS n, array_to_string(list_transform(h, lambda x: {sql_strip('x')}), '|') AS highlights
FROM (SELECT doc_id, list_filter(s, lambda x: list_has_any({sql_terms('x')}, qt))[1:3] AS h FROM q)""".replace("lambda x: length(x) >= 3), qt)", "lambda y: length(y) >= 3), qt)"),
)
def _(t):
    question = F.concat(F.lit("the report for "), F.col("source"), F.lit(" about data and system"))
    out = spread(t.documents).select("doc_id", context.highlights(question, "text", 3).alias("highlights"))
    return out.select("doc_id", F.size("highlights").alias("n"), "highlights")


@query(
    "d1_escalation",
    r"""SELECT conv_id, turn, CASE
 WHEN regexp_matches(q, '\baccount\s*(number|detail|balance|statement)\b') THEN 'Query matched escalation pattern: \baccount\s*(number|detail|balance|statement)\b'
 WHEN regexp_matches(q, '\bpolicy\s*number\b') THEN 'Query matched escalation pattern: \bpolicy\s*number\b'
 WHEN regexp_matches(q, '\bpassword\b') THEN 'Query matched escalation pattern: \bpassword\b'
 WHEN regexp_matches(q, '\bcomplaint\b') THEN 'Query matched escalation pattern: \bcomplaint\b'
 WHEN regexp_matches(q, '\bspeak\s*to\s*(a\s*)?(human|person|agent|someone)\b') THEN 'Query matched escalation pattern: \bspeak\s*to\s*(a\s*)?(human|person|agent|someone)\b'
 WHEN regexp_matches(q, '\blegal\s*advice\b') THEN 'Query matched escalation pattern: \blegal\s*advice\b'
 WHEN regexp_matches(q, '\bfinancial\s*advice\b') THEN 'Query matched escalation pattern: \bfinancial\s*advice\b'
 WHEN regexp_matches(q, '\bsue\b|\blawsuit\b|\blitigation\b') THEN 'Query matched escalation pattern: \bsue\b|\blawsuit\b|\blitigation\b'
 ELSE '' END AS reason
FROM (SELECT conv_id, turn, lower(text || CASE turn % 5 WHEN 0 THEN ' I forgot my Password.' WHEN 1 THEN ' Can I speak to a person?'
   WHEN 2 THEN ' Is this legal  advice or a complaint' WHEN 3 THEN ' pursue an issue' ELSE '' END) AS q FROM conversations)""",
)
def _(t):
    turn = F.col("turn") % 5
    extra = (
        F.when(turn == 0, " I forgot my Password.").when(turn == 1, " Can I speak to a person?")
        .when(turn == 2, " Is this legal  advice or a complaint").when(turn == 3, " pursue an issue").otherwise("")
    )
    return t.conversations.select("conv_id", "turn", routing.escalation(F.concat("text", extra)).alias("reason"))


TRIGGERS = [("policy", "policy", 2), ("data", "data", 3), ("process", "how to", 1), ("faq", "question", 1), ("order", "order", 4)]


@query(
    "d2_intent",
    """SELECT doc_id, CASE WHEN contains(x, 'question') THEN 'faq' WHEN contains(x, 'how to') THEN 'process' WHEN contains(x, 'policy') THEN 'policy'
 WHEN contains(x, 'data') THEN 'data' WHEN contains(x, 'order') THEN 'order' ELSE 'generative' END AS topic
FROM (SELECT doc_id, lower(text) AS x FROM documents)""",
)
def _(t):
    return t.documents.select("doc_id", routing.intent("text", TRIGGERS).alias("topic"))


@query(
    "d3_confidence_band",
    f"""WITH {SQL_KNN.format(corpus='embeddings')}
SELECT b.item_id AS q_id, coalesce(m, 0) AS top_score,
  CASE WHEN coalesce(m, 0) >= 0.85 THEN 'High' WHEN coalesce(m, 0) >= 0.7 THEN 'Medium' ELSE 'Escalated' END AS band, coalesce(m, 0) < 0.7 AS escalated
FROM benchmark b LEFT JOIN (SELECT q_id, max(score) AS m FROM knn WHERE rank <= 15 AND id <> q_id GROUP BY q_id) ON q_id = b.item_id""",
)
def _(t):
    hits = retrieval.knn_exact(vector_questions(t), vectors(t), k=5, over=3).where("id <> q_id")
    return routing.query_bands(questions(t), hits, "score")


@query(
    "d4_answer_confidence",
    f"""WITH {SQL_HYBRID}, {SQL_RERANK}, hits AS (SELECT * FROM ranked WHERE rank <= 5 AND reranker_score >= 0.7)
SELECT b.item_id AS q_id, CASE WHEN n IS NULL OR b.item_id % 7 = 0 THEN 'low' WHEN good >= 3 THEN 'high' ELSE 'medium' END AS confidence
FROM benchmark b LEFT JOIN (SELECT q_id, count(*) AS n, count(*) FILTER (reranker_score > 2) AS good FROM hits GROUP BY q_id) ON q_id = b.item_id""",
)
def _(t):
    answers = questions(t).select(
        "q_id", F.when(F.col("q_id") % 7 == 0, "Sorry, I cannot find this").otherwise("It is so.").alias("answer")
    )
    hits = search(t, k=5, threshold_on="reranker_score", threshold=filters.RERANK_THRESHOLD)
    return routing.answer_confidence(answers, hits).select("q_id", "confidence")


@query(
    "u2_custom_reranker",
    f"""WITH {SQL_HYBRID}, pairs AS (
  SELECT f.q_id, f.id, least(4.0, len(string_split(a.content, ' ')) / 100.0)::DOUBLE AS reranker_score FROM fused f JOIN allowed a ON a.id = f.id)
SELECT q_id, id, round(reranker_score, 6) AS reranker_score, row_number() OVER (PARTITION BY q_id ORDER BY round(reranker_score, 6) DESC, id) AS rank FROM pairs""",
)
def _(t):
    from casework.functions.hooks import register_reranker

    allowed, near, found = runs(t)
    pairs = retrieval.rrf([near, found]).join(allowed.select("id", "content"), "id").join(questions(t), "q_id")
    by_length = register_reranker(lambda pairs: [len(text.split(" ")) / 100.0 for _, text in pairs], batched=True)
    return retrieval.rerank(pairs, by_length).select("q_id", "id", "reranker_score", "rank")
