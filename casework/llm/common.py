"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.session import materialise, scratch_path

__all__ = ["batches", "column_bytes", "materialise", "scratch_path", "slices", "table", "text_or_empty", "words"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(raw: bytes) -> list[bytes]:
    """Words of UTF-8 ``raw`` between the bytes 20 and 09 to 0D, with A-Z lower-cased."""
    return raw.lower().split()


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """Values of a text column as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(parts: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of at most ``rows`` rows, so that Python holds few values at a time."""
    for batch in parts:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts):
            yield fn(batch)

    return df.mapInArrow(run, schema)
