"""Corpus pipeline: from raw documents to packed training windows.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``.

A rejected document goes; of linked documents the one with the smallest id stays; secrets are
replaced by their kind in brackets; the mixture repeats or cuts each (domain, language, source)
to its budget; the last stage gives pieces of windows of 2048 ids. Columns beside those of ``documents``
keep their names, types and values through all stages but the last, whatever they are called.
"""

from __future__ import annotations

from casework.llm import mixing, near, packing, quality, secrets
from casework.llm.common import materialise


#: Columns that the stages work on.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage):
    """``stage`` with all other columns under names that no operator uses, so that none is replaced."""

    def run(spark, docs, sf_dir):
        names = {c: f"extra_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        return stage(spark, docs.withColumnsRenamed(names), sf_dir).withColumnsRenamed({v: k for k, v in names.items()})

    return run


def quality_rules(spark, docs, sf_dir):
    led = quality.ledger(docs)
    return led.where(quality.passes(quality.POLICIES[quality.CURRENT])).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    return near.first_of_each(docs).select(*docs.columns)


def secret_scans(spark, docs, sf_dir):
    return secrets.redact(docs)


def source_mixing(spark, docs, sf_dir):
    return mixing.mixed_documents(docs)


def window_packing(spark, docs, sf_dir):
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", apart(quality_rules)),
    ("n-gram Jaccard join", apart(near_duplicates)),
    ("secret scans", apart(secret_scans)),
    ("mixing to target weights", apart(source_mixing)),
    ("packing", window_packing),
]

#: The last stage's ids come from a tokenizer, which SQL cannot express; the tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
