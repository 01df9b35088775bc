"""Writing tables, logs, batches and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.numbering import numbered
from casework.session import materialise, scratch_path


def append_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows, one JSON object per line. Committed files are never rewritten."""
    df.write.mode("append").partitionBy(*partition_by).json(path)


def upsert(current: DataFrame, new: DataFrame, key: Sequence[str], load_order: Column | None = None) -> DataFrame:
    """``current`` with the rows of ``new`` added or replacing those of the same key.

    Within ``new`` the row with the greatest ``load_order`` wins. Only one row per key is kept,
    which Spark cuts down before the shuffle (window group limit), so a key repeated many
    times does not pile up in one task.
    """
    order = load_order if load_order is not None else F.lit(0)
    both = current.withColumns({"__new": F.lit(0), "__order": F.lit(None)}).unionByName(
        new.withColumns({"__new": F.lit(1), "__order": order})
    )
    newest = Window.partitionBy(*key).orderBy(F.col("__new").desc(), F.col("__order").desc_nulls_last())
    return both.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn", "__new", "__order")


def write_batches(df: DataFrame, sink: Callable[[pd.DataFrame], int], order: Sequence[str], size: int = 100) -> DataFrame:
    """Send rows to ``sink`` in batches of ``size``; written ``(batch, rows, succeeded, error)``, one row per batch.

    Batch ``b`` holds the rows ``b * size`` to ``(b + 1) * size - 1`` in ``order`` (a total order), however
    the input is partitioned; only the last batch may be smaller. ``sink`` runs in the tasks and returns the number
    of rows it accepted. A failed batch is reported with its error and does not stop the others. The
    result is committed with its task, so a batch counts once even when a task is retried; the
    sink may then see it twice and must be idempotent on the row key.
    """
    columns = df.columns
    numbers = numbered(df, [F.col(c) for c in order], "__number").withColumn("__batch", F.floor(F.col("__number") / size))
    # Rows of a batch meet in one task; a task takes whole stretches of the order.
    dealt = numbers.repartitionByRange("__batch").sortWithinPartitions("__number")

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = rest["__batch"].iloc[-1] if len(rest) else None
            for number, batch in rest[rest["__batch"] != last].groupby("__batch"):
                yield one(number, batch)
            rest = rest[rest["__batch"] == last]
        if rest is not None and len(rest):
            yield one(rest["__batch"].iloc[0], rest)

    def one(number: int, batch: pd.DataFrame) -> pd.DataFrame:
        try:
            accepted, error = int(sink(batch[columns].reset_index(drop=True))), None
        except Exception as failure:  # reported per batch
            accepted, error = 0, str(failure)
        return pd.DataFrame({"batch": [number], "rows": [len(batch)], "succeeded": [accepted], "error": [error]})

    return materialise(dealt.mapInPandas(send, "batch long, rows long, succeeded long, error string"), "batches")


def write_report(summary: DataFrame, results: DataFrame, path: str) -> None:
    """Evaluation report as JSON: one summary object and one line per result.

    Results stay a distributed table instead of one nested array, so a report of any length
    can be written. Latency is rounded to one digit.
    """
    summary.write.mode("overwrite").json(f"{path}/summary")
    columns = [F.round(c, 1).alias(c) if c == "latency_ms" else F.col(c) for c in results.columns]
    results.select(*columns).write.mode("overwrite").json(f"{path}/results")


def round_trip_csv(df: DataFrame, name: str = "csv") -> str:
    """Write ``df`` as CSV with a header to a scratch folder and return the path."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    return path
