"""Tables of many small appends: published snapshots that readers pin and a compactor replaces."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOG = "version long, folders array<string>, upto long, epochs array<long>"


class Snapshot(NamedTuple):
    """A state of the table: its folders, the last epoch inside compacted ones, and the epochs after that."""

    version: int
    folders: list[str]
    upto: int
    epochs: list[int]


class SnapshotTable:
    """A table written by one job, an append per epoch.

    An append writes a folder of its own and then publishes a snapshot that lists it; a folder no snapshot lists
    does not exist for readers. ``compact`` folds all folders into one and publishes that in their place, so the
    number of folders stays below the epochs between two compactions. A reader keeps the folders of the snapshot
    it has read: nothing is overwritten, and ``vacuum`` deletes only what the last snapshots do not list. An epoch
    that comes again, before or after a compaction, is known and changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log/*")
        except AnalysisException:
            return None

    def newest(self) -> Snapshot | None:
        log = self._log()
        row = None if log is None else log.orderBy(F.desc("version")).first()
        return None if row is None else Snapshot(row[0], list(row[1]), row[2], list(row[3]))

    def read(self, schema: StructType | str, snapshot: Snapshot | None = None) -> DataFrame:
        """Rows of a snapshot, by default the newest; empty before the first one."""
        at = snapshot or self.newest()
        if at is None or not at.folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{f}" for f in at.folders))

    def _publish(self, snapshot: Snapshot) -> None:
        folders = F.array(*[F.lit(f) for f in snapshot.folders]).cast("array<string>")
        epochs = F.array(*[F.lit(e).cast("long") for e in snapshot.epochs]).cast("array<long>")
        row = self.spark.range(1).coalesce(1).select(
            F.lit(snapshot.version).cast("long").alias("version"), folders.alias("folders"),
            F.lit(snapshot.upto).cast("long").alias("upto"), epochs.alias("epochs"),
        )
        row.write.mode("overwrite").parquet(f"{self.path}/log/{snapshot.version:012d}")

    def append(self, rows: DataFrame, epoch: int) -> bool:
        """Add the rows of an epoch; False when it is there already."""
        old = self.newest() or Snapshot(-1, [], -1, [])
        if epoch <= old.upto or epoch in old.epochs:
            return False
        folder = f"epoch-{epoch:012d}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.path}/data/{folder}")
        self._publish(Snapshot(old.version + 1, [*old.folders, folder], old.upto, [*old.epochs, epoch]))
        return True

    def compact(self, schema: StructType | str, fold: Callable[[DataFrame], DataFrame], keep: int = 2) -> None:
        """Fold all folders into one, publish it, and delete what the last ``keep`` snapshots do not need."""
        old = self.newest()
        if old is None or len(old.folders) < 2:
            return
        upto = max([old.upto, *old.epochs])
        folder = f"upto-{upto:012d}-{uuid.uuid4().hex[:8]}"
        fold(self.read(schema, old)).write.parquet(f"{self.path}/data/{folder}")
        self._publish(Snapshot(old.version + 1, [folder], upto, []))
        self.vacuum(keep)

    def vacuum(self, keep: int = 2) -> None:
        """Delete older snapshots than the last ``keep``, and the folders that only they list."""
        log = self._log()
        if log is None:
            return
        # The log is bounded: a row per epoch since the last vacuum.
        rows = sorted(log.collect(), key=lambda r: r["version"])
        needed = {f for r in rows[-keep:] for f in r["folders"]}
        newest = max(e for r in rows[-keep:] for e in [r["upto"], *r["epochs"]])
        for r in rows[:-keep]:
            self._delete(f"log/{r['version']:012d}")
        for folder in self._children("data"):
            # A folder that is not published yet belongs to a later epoch than all published ones.
            if folder not in needed and int(folder.split("-")[1]) <= newest:
                self._delete(f"data/{folder}")

    def _fs(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _children(self, name: str) -> list[str]:
        fs, path = self._fs(name)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _delete(self, name: str) -> None:
        fs, path = self._fs(name)
        fs.delete(path, True)
