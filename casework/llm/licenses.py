"""License scan as an exact set-similarity join of text blocks against license templates.

A block is a line of a document; it matches a template when it holds at least ``THRESHOLD`` of
the template's distinct words. Only words of the templates can count, so blocks are cut down to
those first. Words are ordered by their frequency over the remaining blocks, rarest first. A
matching block must hold a word of the template's prefix (prefix filter), enough template words
at all (length filter), and enough words from the first common one on (positional filter). Each
(block, template) pair is produced at its first common word only and verified once.

The templates are a fixed parameter, so their prefixes (a few hundred rows) are broadcast. Blocks
are never grouped by word, so a word or line that many documents share lands in no single task.

Defined results: a null or empty text has no words, labels or places; equal rows get equal rows;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import materialise, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD_PERCENT = 80
#: Phrases counted word by word, with their labels. Fixed values.
PHRASES: tuple[tuple[str, str], ...] = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label and opening words of well-known license notices. Fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def _need(size: int, percent: int) -> int:
    return max(1, math.ceil(size * percent / 100))


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def blocks(docs: DataFrame, key: Sequence[str], text: str, templates=TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``*key, held``: per line with enough template words, those words."""
    sets = [set(t.split()) for _, t in templates]
    vocabulary, least = sorted(set().union(*sets)), min(_need(len(s), percent) for s in sets)
    lines = docs.select(*key, F.explode(F.split(F.col(text), "\n")).alias("line"))
    held = lines.select(*key, F.array_intersect(_array(vocabulary), words_of(F.col("line"))).alias("held"))
    return held.where(F.size("held") >= least)


def similar(found: DataFrame, key: Sequence[str], templates=TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``*key, label, score`` of every (block, template) pair reaching the threshold."""
    spark = found.sparkSession
    counts = {r.word: r["count"] for r in found.select(F.explode("held").alias("word")).groupBy("word").count().collect()}  # template words only
    order = sorted(set().union(*(t.split() for _, t in templates)), key=lambda w: (counts.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    prefixes, needs = [], []
    for number, (label, text) in enumerate(templates):
        own = sorted(set(text.split()), key=place.__getitem__)
        need = _need(len(own), percent)
        needs.append(need)
        prefixes += [(w, number, i, own, label, need) for i, w in enumerate(own[: len(own) - need + 1])]
    table = spark.createDataFrame(prefixes, "word string, template int, i int, own array<string>, label string, need int")
    ranked = found.select(*key, F.array_intersect(_array(order), F.col("held")).alias("held"))
    tokens = ranked.select(*key, "held", F.posexplode("held").alias("j", "word"))
    pairs = tokens.join(F.broadcast(table), "word")
    length = F.size("held") >= F.col("need")
    positional = 1 + F.least(F.size("own") - F.col("i") - 1, F.size("held") - F.col("j") - 1) >= F.col("need")
    first = ~F.arrays_overlap(F.slice("held", F.lit(1), F.col("j")), F.col("own"))
    overlap = F.size(F.array_intersect("held", "own"))
    checked = pairs.where(length & first & positional).withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
    return checked.select(*key, "label", (F.col("overlap") / F.size("own")).alias("score"))


def phrase_places(words: str, phrase: str) -> str:
    """SQL text: starts of ``phrase`` in the array of words named ``words``."""
    parts = phrase.split()
    test = " AND ".join(f"get({words}, i + {k}) = '{p}'" for k, p in enumerate(parts))
    return f"CASE WHEN size({words}) >= {len(parts)} THEN filter(sequence(0, size({words}) - {len(parts)}), i -> {test}) ELSE array() END"


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", templates=TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Per row: id, word count, phrase places, labels and the best containment."""
    rows = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("text")).withColumn("digest", F.md5("text"))
    key = ["doc_id", "digest"]
    hits = similar(materialise(blocks(rows, key, "text", templates, percent), "license-blocks"), key, templates, percent)
    hits = hits.groupBy(*key).agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    licensed = F.lower("text").contains("license")
    base = rows.select(
        *key, F.regexp_count("text", F.lit(WORD.replace("x3A-\\x60", "x3A-\\x40\\x5B-\\x60"))).cast("long").alias("n_words"),
        F.when(licensed, words_of(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    names = [f"p{i}" for i in range(len(PHRASES))]
    base = base.select(*key, "n_words", *[F.expr(phrase_places("words", p)).cast("array<int>").alias(n) for n, (p, _) in zip(names, PHRASES)])
    labelled = [F.when(F.size(n) > 0, F.lit(label)) for n, (_, label) in zip(names, PHRASES)]
    base = base.select(*key, "n_words", F.concat(*names).alias("places"), F.array_sort(F.array_distinct(F.filter(F.array(*labelled), lambda x: x.isNotNull()))).alias("base"))
    same = F.col("b.doc_id").eqNullSafe(F.col("h.h_id")) & (F.col("b.digest") == F.col("h.h_digest"))
    hits = hits.withColumnRenamed("doc_id", "h_id").withColumnRenamed("digest", "h_digest")
    joined = base.alias("b").join(hits.alias("h"), same, "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op2_licenses(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _templates_sql(templates: Sequence[tuple[str, str]] = TEMPLATES) -> str:
    return ", ".join(f"('{label}', string_split('{text}', ' '))" for label, text in templates)


def _phrases_sql(phrases: Sequence[tuple[str, str]] = PHRASES) -> str:
    return ", ".join(f"('{label}', string_split('{text}', ' '))" for text, label in phrases)


OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
t AS (SELECT label, list_distinct(own) AS own FROM (VALUES {_templates_sql()}) AS v(label, own)),
ph AS (SELECT * FROM (VALUES {_phrases_sql()}) AS v(label, own)),
b AS (SELECT rid, list_distinct(regexp_extract_all(unnest(string_split(text, chr(10))), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS held FROM d),
h AS (SELECT rid, label, len(list_intersect(held, own)) / len(own) AS score FROM b, t WHERE 100 * len(list_intersect(held, own)) >= {THRESHOLD_PERCENT} * len(own)),
hits AS (SELECT rid, max(score) AS best FROM h GROUP BY rid),
p AS (SELECT rid, label, i FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE contains(text, 'license')), ph WHERE list_slice(w, i, i + len(own) - 1) = own),
base AS (SELECT rid, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM p GROUP BY rid),
every AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM (SELECT rid, label FROM h UNION ALL SELECT rid, label FROM p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word, coalesce(base.l, '') AS base_labels,
  coalesce(every.l, '') AS labels, CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN every USING (rid) LEFT JOIN hits USING (rid)
"""
