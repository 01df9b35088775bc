"""Reading files, tables and evaluation sets."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.schemas import EVAL_CASE
from casework.session import materialise
from casework.sources.listing import list_files, opened

#: Bytes of files that one task reads, about.
TASK_BYTES = 64 << 20
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder of ``<name>.parquet`` files."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan spread over all cores, when the scan alone gives fewer tasks than cores.

    For CPU-heavy row work such as chunking. With enough input splits, as on large tables, it
    changes nothing and adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_files(spark: SparkSession, path: str, suffixes: Sequence[str] = (".txt",)) -> DataFrame:
    """Recursive scan to ``(path, name, text, size, modified)``.

    Suffixes match in any case; dot files, files in dot folders and other types drop out before any
    byte is read; names may start with ``_``. The path is relative to ``path``, undecodable bytes are
    dropped. The listing is written once; its files are then dealt to tasks of about ``TASK_BYTES``,
    so a folder with most of the files is read by many tasks. A file must fit in a task.
    """
    wanted = "|".join(re.escape(s.lower()) for s in suffixes)
    listed = materialise(list_files(spark, path).where(F.lower("name").rlike(f"({wanted})$")), "file-listing")
    size = listed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first().size
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path.rstrip("/"))
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                with store.open_input_stream(f"{root}/{row.column('path')[0].as_py()}") as f:
                    text = f.read().decode("utf-8", "ignore")
                yield row.add_column(2, "text", pa.array([text], pa.string()))

    dealt = listed.repartition(tasks, "path")
    return dealt.mapInArrow(read, "path string, name string, text string, size long, modified timestamp")


def scan_store(spark: SparkSession, path: str, suffixes: Sequence[str] = (".txt",)) -> DataFrame:
    """:func:`scan_files` for stores that only Spark's readers open; these hide names that start with ``_``.

    Empty files, undecodable bytes and the replacement character drop out.
    """
    wanted = "|".join(re.escape(s.lower()) for s in suffixes)
    root = re.escape(path.rstrip("/"))
    relative = F.regexp_replace(F.col("path"), f"^[a-z0-9]+:/*{root}/|^{root}/", "")
    relative = F.regexp_replace(relative, f"^.*?{root}/", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    kept = named.where(F.lower("name").rlike(f"({wanted})$") & ~F.col("name").startswith("."))
    return kept.select(
        relative.alias("path"),
        "name",
        F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit("")).alias("text"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def normalise_name(name: str) -> str:
    """Column name: stripped, lower case, spaces to ``_``, other non-word characters dropped."""
    return re.sub(r"[^\w]", "", name.strip().lower().replace(" ", "_"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header and normalised names; types are inferred unless a schema is given."""
    reader = spark.read.option("header", "true").option("quote", '"').option("escape", '"')
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
    return df.toDF(*[normalise_name(c) for c in df.columns])


def read_eval_set(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Evaluation cases from JSON with a nested ``cases`` array; missing flags are false.

    One document per file, or one per line (splittable) with ``multi_line=False``.
    """
    schema = T.StructType([T.StructField("cases", T.ArrayType(EVAL_CASE))])
    cases = spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path).select(F.inline("cases"))
    return cases.select(
        *[
            F.coalesce(F.col(f.name), F.lit(False)).alias(f.name) if f.dataType == T.BooleanType() else F.col(f.name)
            for f in EVAL_CASE.fields
        ]
    )


def load_star(
    fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]], how: str = "left"
) -> DataFrame:
    """Join dimensions ``(frame, fact_key, dimension_key)`` to a fact table in order.

    No broadcast is forced: file sizes and AQE decide at run time, so a dimension that has
    grown falls back to a shuffle join.
    """
    for dim, left, right in dimensions:
        fact = fact.join(dim, fact[left] == dim[right], how)
    return fact


def read_jdbc(
    spark: SparkSession, url: str, dbtable: str, column: str, lower: int, upper: int, partitions: int = 64, **options
) -> DataFrame:
    """Partitioned JDBC read on a numeric column."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=dbtable, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    )
    return reader.options(**options).load()
