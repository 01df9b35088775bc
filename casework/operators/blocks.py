"""Training tables as blocks of numbers, and sums over them added up in tasks.

Iterative training of many models at once reads the same rows once per step. Rows are packed into
blocks of a few thousand (one binary matrix per block) and written once; a step sends the current
parameters of all models out, adds up one vector of statistics per task, adds those vectors in a few
tasks, and returns a handful of rows to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.session import materialise

#: Rows of a block, and tasks that add up the vectors of all others.
BLOCK_ROWS, ADDERS = 4096, 8
#: Blocks, or vectors of statistics, that a task is sent at a time.
SENT = 4


@contextmanager
def few_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs send tasks ``SENT`` rows at a time.

    Rows of these tables are large. Spark would gather ten thousand of them, as a rule a whole
    partition, before a task could begin, in the JVM and in Python.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SENT))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def buffers(column: pa.Array) -> Iterator[pa.Buffer]:
    """Values of a binary column, not copied."""
    return (v.as_buffer() for v in column)


def pack(df: DataFrame, features: str = "features", label: Column | None = None, fold: Column | None = None) -> DataFrame:
    """Written ``x, y, f``: blocks of feature rows (doubles), labels (doubles) and fold numbers (32 bits).

    Rows without features or with a null, NaN or infinite value or label are left out.
    """
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    values = vector_to_array(features) if is_vector else F.col(features).cast("array<double>")
    y = F.lit(0.0) if label is None else label.cast("double")
    f = F.lit(-1) if fold is None else fold.cast("int")
    slim = df.select(values.alias("x"), y.alias("y"), f.alias("f")).where("x is not null and y is not null and f is not null")
    slim = slim.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column(0).flatten().to_numpy().astype("<f8")
                y, f = part.column(1).to_numpy().astype("<f8"), part.column(2).to_numpy().astype("<i4")
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y, f)], names=["x", "y", "f"])

    return materialise(slim.mapInArrow(run, "x binary, y binary, f binary"), "training-blocks")


def _add(rows: DataFrame, size: int) -> np.ndarray:
    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in parts:
            for v in buffers(batch.column(0)):
                total += np.frombuffer(v, dtype="<f8")
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    with few_at_a_time(rows.sparkSession):
        got = rows.repartition(ADDERS).mapInArrow(add, "v binary").collect()
    return sum((np.frombuffer(bytes(r.v), dtype="<f8") for r in got), np.zeros(size))


def summed(blocks: DataFrame, fn: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], size: int, kind: str = "<f8") -> np.ndarray:
    """Sum over all blocks of the vector ``fn(x, y, f)`` of ``size`` doubles; ``kind`` is the type of stored ``x``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in parts:
            for x, y, f in zip(*(buffers(batch.column(i)) for i in range(3))):
                y = np.frombuffer(y, dtype="<f8")
                total += fn(np.frombuffer(x, dtype=kind).reshape(len(y), -1), y, np.frombuffer(f, dtype="<i4"))
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    return _add(blocks.mapInArrow(run, "v binary"), size)


def width(blocks: DataFrame) -> int:
    """Features of a row; 0 without rows."""
    first = blocks.select("x", "y").limit(1).collect()
    return len(first[0].x) // len(first[0].y) if first else 0


def moments(blocks: DataFrame, d: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, mean and population deviation (1 where a feature is constant) of every feature."""
    one = summed(blocks, lambda x, y, f: np.concatenate([[len(y)], x.sum(0)]), 1 + d)
    n, mean = one[0], one[1:] / max(one[0], 1)
    square = summed(blocks, lambda x, y, f: ((x - mean) ** 2).sum(0), d)
    spread = np.sqrt(square / max(n, 1))
    return n, mean, np.where(spread > 1e-12 * np.maximum(np.abs(mean), 1), spread, 1.0)
