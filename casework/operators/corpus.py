"""Corpus preparation: chunking, de-duplication, quality flags, ingestion summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.ordered import running
from casework.functions.scalars import chunk_id
from casework.functions.text import normalised, strip, words

# Fixed values.
CHUNK_SIZE, OVERLAP, OVERLAP_RATIO = 512, 64, 0.2
MIN_CHUNK_CHARS = 50
CHUNKS_PER_PAGE = 4
BATCH = 100
LONG_TEXT_WORDS = 2000


def _windows(tokens: Column, size: int, step: int) -> Column:
    """Token windows of a text; the last one ends at the last token."""
    n = F.size(tokens)
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / step).cast("int") + 1)
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(tokens, i * step + 1, F.lit(size)), " ")
    )


def _exploded(df: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per element of ``__c``.

    The outer form with a null check gives the same rows as the plain one, but keeps Catalyst
    from adding a ``size(array) > 0`` filter that would compute the whole array a second time.
    """
    rows = df.select(*columns, F.posexplode_outer("__c").alias("chunk_index", "content"))
    return rows.where(F.col("chunk_index").isNotNull())


def chunk_fixed(
    df: DataFrame,
    doc: str,
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    tokenise: Callable[[Column], Column] = words,
) -> DataFrame:
    """Overlapping windows; chunks of 50 stripped characters or fewer are dropped.

    Kept chunks are numbered from 0 in order. Filtering and numbering happen inside the row's
    array, so the operator is narrow: no shuffle, whatever the size of a document.
    """
    tokens = df.withColumn("__w", tokenise(F.col(text)))
    kept = F.filter(_windows(F.col("__w"), size, size - overlap), lambda c: F.length(strip(c)) > MIN_CHUNK_CHARS)
    rest = [c for c in df.columns if c != text]
    chunks = _exploded(tokens.withColumn("__c", kept), *rest)
    return chunks.withColumns(
        {
            "id": chunk_id(F.col(doc).cast("string"), "chunk_index"),
            "page_number": F.greatest(F.lit(1), (F.col("chunk_index") / CHUNKS_PER_PAGE).cast("int") + 1),
        }
    )


def chunk_ratio(
    df: DataFrame,
    doc: str,
    text: str,
    size: int = CHUNK_SIZE,
    ratio: float = OVERLAP_RATIO,
    tokenise: Callable[[Column], Column] = words,
) -> DataFrame:
    """Overlapping windows by overlap ratio; every chunk is kept, empty texts give none."""
    tokens = df.where(strip(text) != "").withColumn("__w", tokenise(F.col(text)))
    step = size - int(size * ratio)
    rest = [c for c in df.columns if c != text]
    n = F.size("__w")
    parts = tokens.withColumns({"__c": _windows(F.col("__w"), size, step), "__n": n})
    chunks = _exploded(parts, *rest, "__n", F.size("__c").alias("total_chunks"))
    return chunks.withColumns(
        {
            "id": chunk_id(F.col(doc).cast("string"), "chunk_index", "md5"),
            "token_count": F.least(F.lit(size), F.col("__n") - F.col("chunk_index") * step),
        }
    ).drop("__n")


def chunk_by_key(
    df: DataFrame, key: str, order: Sequence[Column], line: Column, max_lines: int = 1000, **split
) -> DataFrame:
    """One chunk per key holding its whole table as ordered lines.

    A key with more than ``max_lines`` lines continues in further chunks (``chunk_index``),
    so no row and no group grows without bound and no line is lost.
    """
    lines = df.select(F.col(key), *[c.alias(f"__o{i}") for i, c in enumerate(order)], line.alias("__line"))
    placed = running(lines, [key], [f"__o{i}" for i in range(len(order))] + ["__line"], __no=("number", None), **split)
    chunk = F.floor((F.col("__no") - 1) / max_lines).cast("long").alias("chunk_index")
    rows = F.sort_array(F.collect_list(F.struct("__no", "__line")))
    return (
        placed.groupBy(key, chunk)
        .agg(rows.alias("__rows"))
        .select(
            key,
            "chunk_index",
            F.size("__rows").cast("long").alias("lines"),
            F.array_join(F.transform("__rows", lambda r: r["__line"]), "\n").alias("content"),
        )
    )


def dedupe_docs(df: DataFrame, text: str, newest: Sequence[Column]) -> DataFrame:
    """One row per normalised text: the newest.

    One row per hash is kept in every task before the shuffle, so a text copied many times does
    not fill one task. Only the columns selected afterwards travel: keep ids to keep texts still.
    """
    hashed = df.withColumn("text_hash", F.md5(normalised(text)))
    w = Window.partitionBy("text_hash").orderBy(*newest)
    return hashed.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def quality_check(df: DataFrame, text: str, near_empty_chars: int = MIN_CHUNK_CHARS) -> DataFrame:
    """Flags: empty, near-empty, over 2,000 tokens, vague heading such as ``Section 3.2``."""
    stripped = strip(text)
    vague = F.regexp_replace(stripped, "\n(?s:.*)$", "").rlike(r"^[Ss]ection [0-9]+(\.[0-9]+)*[ \t\r]*$")
    flags = F.array_compact(
        F.array(
            F.when(F.length(stripped) == 0, "empty"),
            F.when((F.length(stripped) > 0) & (F.length(stripped) <= near_empty_chars), "near_empty"),
            F.when(F.size(words(text)) > LONG_TEXT_WORDS, "too_long"),
            F.when(vague, "vague_heading"),
        )
    )
    return df.withColumn("flags", flags)


def ingest_summary(documents: DataFrame, chunks: DataFrame, doc: str, seconds: float | None = None) -> DataFrame:
    """One row: documents seen, processed and failed, chunks created and indexed.

    ``chunks`` may carry an ``error`` column; a chunk with an error was created, not indexed.
    """
    indexed = F.col("error").isNull() if "error" in chunks.columns else F.lit(True)
    per_doc = chunks.groupBy(doc).agg(F.count(F.lit(1)).alias("__c"), F.count_if(indexed).alias("__i"))
    joined = documents.select(doc).join(per_doc, doc, "left")
    summary = joined.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("__c").alias("documents_processed"),
        F.count_if(F.col("__c").isNull()).alias("documents_failed"),
        F.coalesce(F.sum("__c"), F.lit(0)).alias("chunks_created"),
        F.coalesce(F.sum("__i"), F.lit(0)).alias("chunks_indexed"),
    )
    return summary if seconds is None else summary.withColumn("duration_seconds", F.lit(float(seconds)))


def failed_documents(documents: DataFrame, chunks: DataFrame, doc: str) -> DataFrame:
    """Names of documents that gave no chunk, as rows."""
    return documents.select(doc).join(chunks.select(doc).distinct(), doc, "left_anti")


def dry_run(chunks: DataFrame, doc: str, batch: int = BATCH) -> DataFrame:
    """Chunks per document plus a total row (null document), with the batches each needs."""
    n = F.count(F.lit(1))
    return chunks.rollup(doc).agg(n.alias("chunks"), F.ceil(n / batch).alias("batches"))
