"""Context blocks, citations and highlights for retrieved chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.text import strip, terms

# Fixed values.
SEPARATOR = "\n\n---\n\n"
NO_DOCUMENTS = "No relevant documents found."


def format_context(questions: DataFrame, hits: DataFrame, style: str = "source", k: int = 50) -> DataFrame:
    """One row per question: ``context`` and ``citations``, hits ordered by re-ranker score.

    Style ``source`` labels blocks with source, date and category and has a fixed text for a
    question without hits; style ``title`` labels title and chunk number and gives an empty
    string. ``hits`` is a ranked result (``rank``); a ranking longer than ``k`` is an error,
    since a prompt is built from a short list.
    """
    order = F.struct(-F.coalesce(F.col("reranker_score"), F.lit(0.0)), F.col("rank"))
    text = lambda c, default: F.coalesce(F.col(c).cast("string"), F.lit(default))
    if style == "source":
        fields = ["source_document", "effective_date", "category", "content"]
        packed = F.struct(order.alias("o"), *[text(c, "").alias(c) for c in fields])
        block = lambda i, h: F.concat(
            F.lit("[Document "), i, F.lit("]\nSource: "), h["source_document"], F.lit(" (effective "), h["effective_date"],
            F.lit(")\nCategory: "), h["category"], F.lit("\nContent:\n"), h["content"],
        )
        empty = NO_DOCUMENTS
        cite = lambda h: h["source_document"]
    elif style == "title":
        packed = F.struct(
            order.alias("o"),
            text("title", "Unknown").alias("title"),
            text("content", "").alias("content"),
            text("source_url", "").alias("source_url"),
            F.coalesce(F.col("chunk_index"), F.lit(0)).cast("int").alias("chunk_index"),
        )
        block = lambda i, h: F.concat(
            F.lit("[Document "), i, F.lit(": "), h["title"], F.lit(" (chunk "), h["chunk_index"].cast("string"), F.lit(")]\n"), h["content"],
        )
        empty = ""
        cite = lambda h: F.struct(h["title"].alias("title"), h["source_url"].alias("source_url"), h["chunk_index"].alias("chunk_index"))
    else:
        raise ValueError(f"unknown style {style!r}")
    checked = hits.where(F.when(F.col("rank") > k, F.raise_error(F.lit("hits must be a short ranking"))).otherwise(F.lit(True)))
    grouped = checked.groupBy("q_id").agg(F.sort_array(F.collect_list(packed)).alias("__h"))
    blocks = F.transform("__h", lambda h, i: block((i + 1).cast("string"), h))
    joined = questions.select("q_id").join(grouped, "q_id", "left")
    return joined.select(
        "q_id",
        F.coalesce(F.array_join(blocks, SEPARATOR), F.lit(empty)).alias("context"),
        F.coalesce(F.transform("__h", cite), F.array()).alias("citations"),
    )


def highlights(question: str | Column, text: str | Column, n: int = 3) -> Column:
    """Up to ``n`` sentences of a text that contain a term of the question."""
    question = F.col(question) if isinstance(question, str) else question
    text = F.col(text) if isinstance(text, str) else text
    sentences = F.filter(F.split(text, r"[.!?]+[ \t\r\n]+"), lambda s: F.arrays_overlap(terms(s), terms(question)))
    return F.slice(F.transform(sentences, strip), 1, n)


def top_k(df: DataFrame, part: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows per group by a total order; every task cuts to ``k`` before the shuffle."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
