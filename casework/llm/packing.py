"""Concatenate and cut: documents packed into fixed windows by two-pass prefix sums.

Pass one turns texts into ids and writes, per partition, the ids with each document's offset in
that partition. The partition totals (one row per partition) give every partition its global
offset. Pass two cuts documents where the global offset crosses a window; a document that
crosses leaves one boundary record per window. Both passes are narrow: no row is shuffled, and
the order is that of the written table, so a lost executor changes nothing.

Defined results: a null or empty text is its end token alone; repeated rows and ids are packed
each; null ids are carried; columns other than the id and the text are not read; an empty table
gives no piece. Only the last window can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm import wordbpe
from casework.llm.common import materialise, slices

LENGTH = 2048
END = 1
_PIECES = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def token_table(docs: DataFrame, id: str, text: str, path: str, end: int = END) -> DataFrame:
    """Written table ``part, local, id, ids``: ids with the end token, and their offset in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, total = wordbpe.encoder(path).text, TaskContext.get().partitionId(), 0
        tail = np.asarray([end], dtype="<u2").tobytes()
        for batch in slices(batches):
            ids = [encode(x or "") + tail for x in batch.column(1).to_pylist()]
            sizes = np.fromiter((len(x) // 2 for x in ids), dtype=np.int64, count=len(ids))
            ends = total + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part)), pa.array(ends - sizes), pa.array(sizes), batch.column(0), pa.array(ids, pa.binary())],
                names=["part", "local", "n", "id", "ids"],
            )
            total = int(ends[-1]) if len(ends) else total

    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return materialise(slim.mapInArrow(run, "part long, local long, n long, id long, ids binary"), "token-table")


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces ``id, start, length, ids, doc_tokens, sequence_id, offset``; ids are unsigned 16-bit."""
    tokens = token_table(docs, id, text, path or wordbpe.default_path())
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row per partition
    parts = np.asarray([r.part for r in totals], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum([r.n for r in totals])]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            part, local, _, doc, ids = (batch.column(i) for i in range(5))
            starts = base[np.searchsorted(parts, part.to_numpy())] + local.to_numpy()
            out: list[list] = [[] for _ in range(7)]
            for first, name, raw in zip(starts.tolist(), doc.to_pylist(), ids.to_pylist()):
                n, at = len(raw) // 2, 0
                while at < n:
                    sequence, offset = divmod(first + at, length)
                    take = min(n - at, length - offset)
                    for column, value in zip(out, (name, at, take, raw[2 * at : 2 * (at + take)], n, sequence, offset)):
                        column.append(value)
                    at += take
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return tokens.select("part", "local", "n", "id", "ids").mapInArrow(run, _PIECES)


def with_crc(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, the CRC of the ids as unsigned 32-bit little-endian numbers."""
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(x, dtype="<u2").astype("<u4").tobytes()) for x in batch.column(3).to_pylist()]
            columns = [pa.array(crc, pa.int64()) if n == "ids" else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=["ids_crc32" if n == "ids" else n for n in names])

    return pieces.select(*names).mapInArrow(run, _PIECES.replace("ids binary", "ids_crc32 long"))


def op9_packing(spark, sf_dir):
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return with_crc(pieces).withColumnRenamed("id", "doc_id")
