"""Versioned tables: loads are appended, a small manifest says which folders make up a version.

Nothing that exists is rewritten. A load is a folder of its own; publishing it writes one new manifest, a
text file with the list of folders, in a single create that fails when that version is already
there, so a reader sees a version whole or not at all and keeps reading it while newer ones appear. A row marked as deleted
hides older rows of its key. Compaction merges the loads of the newest version into one base, dealt into
ranges of the key, and publishes that; :func:`clean` removes folders that no kept version names.

The newest version of a key is the one with the greatest ``order`` columns, then the latest load. All rows of a
key that carry it stay, so a key may stand for one row (a catalogue entry) or for a group (the chunks
of a document).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns a load has beside its own.
DELETED, LOAD = "__deleted", "__load"

#: Names of batches a manifest remembers; a stream only ever retries its last one.
KEPT_BATCHES = 1000


class Conflict(RuntimeError):
    """Another writer has published this version."""


@dataclass(frozen=True)
class Manifest:
    """Number of a version, its folders in load order, the load number reached, and names of the batches it holds."""

    version: int
    folders: list[str]
    loads: int
    batches: list[str]


class VersionedTable:
    """Table at ``path`` with a ``key``; ``order`` names columns that decide between versions of a key before the load does."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str] = ()):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)
        jvm = spark.sparkContext._jvm
        self._path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Manifests.

    def versions(self) -> list[int]:
        """Numbers of all published versions, oldest first."""
        folder = self._path("versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest, the newest by default."""
        known = self.versions()
        if version is None:
            if not known:
                return Manifest(0, [], 0, [])
            version = known[-1]
        text = self.spark.read.text(f"{self.path}/versions/{version:012d}.json", wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def _publish(self, m: Manifest) -> Manifest:
        """Write a manifest under its number, whole: it is written aside and renamed, which fails when the number is taken."""
        aside, there = self._path("versions", f"_{uuid.uuid4().hex}"), self._path("versions", f"{m.version:012d}.json")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(m.__dict__).encode()))
        out.close()
        if self._fs.exists(there) or not self._fs.rename(aside, there):
            self._fs.delete(aside, False)
            raise Conflict(f"version {m.version} of {self.path} is already published")
        return m

    # Writing.

    def apply(self, rows: DataFrame, batch: str, deleted: DataFrame | None = None) -> Manifest:
        """Publish ``rows`` (and the keys of ``deleted`` as markers) as one load.

        ``batch`` names the load: one that the newest version already holds changes nothing, so a retried batch counts once.
        """
        last = self.manifest()
        if batch in last.batches:
            return last
        load = rows.withColumn(DELETED, F.lit(False))
        if deleted is not None:
            load = load.unionByName(deleted.select(self.key).distinct().withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
        folder = f"loads/{last.loads + 1:012d}-{uuid.uuid4().hex}"
        load.withColumn(LOAD, F.lit(last.loads + 1)).write.parquet(f"{self.path}/{folder}")
        return self._publish(Manifest(last.version + 1, [*last.folders, folder], last.loads + 1, [*last.batches, batch][-KEPT_BATCHES:]))

    def compact(self) -> Manifest:
        """Merge the loads of the newest version into one base of key ranges; markers that have done their work go."""
        last = self.manifest()
        if len(last.folders) < 2:
            return last
        folder = f"loads/{last.loads:012d}-{uuid.uuid4().hex}"
        merged = self._newest(last).where(~F.col(DELETED))
        merged.repartitionByRange(self.key).sortWithinPartitions(self.key).write.parquet(f"{self.path}/{folder}")
        return self._publish(Manifest(last.version + 1, [folder], last.loads, last.batches))

    def clean(self, keep: int = 1) -> list[str]:
        """Remove manifests before the last ``keep`` versions, and folders that no kept version names; their names."""
        known = self.versions()
        kept = {f for v in known[-keep:] for f in self.manifest(v).folders}
        old = {f for v in known[:-keep] for f in self.manifest(v).folders} - kept
        for v in known[:-keep]:
            self._fs.delete(self._path("versions", f"{v:012d}.json"), False)
        for folder in sorted(old):
            self._fs.delete(self._path(folder), True)
        return sorted(old)

    # Reading.

    def _newest(self, m: Manifest) -> DataFrame:
        # Loads may differ in columns that some of them lack.
        rows = self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{f}" for f in m.folders])
        if len(m.folders) == 1 and not self.order:
            return rows
        mark = F.struct(*self.order, LOAD)
        newest = rows.groupBy(F.col(self.key).alias("__k")).agg(F.max(mark).alias("__m"))
        same = F.col(self.key).eqNullSafe(F.col("__k")) & mark.eqNullSafe(F.col("__m"))
        return rows.join(newest, same, "left_semi")

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest by default. The folders are fixed now, whatever is published later."""
        m = self.manifest(version)
        if not m.folders:
            raise ValueError(f"{self.path} has no version yet")
        return self._newest(m).where(~F.col(DELETED)).drop(DELETED, LOAD)


