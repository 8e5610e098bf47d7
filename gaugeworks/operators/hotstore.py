"""The hot store as a table updated in place: a batch reads and replaces only the folders it touches."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.operators import hot

_OBJECTS = "entity_id long, tenant_id long, hot_attrs string, updated_at timestamp"
_FOLDED = "entity_id long, tenant_id long, folded string"
_LOG = "version long, epoch long, buckets long, folders map<long,string>"


class Version(NamedTuple):
    """A published state: its number, the last epoch in it, the number of buckets, and the folder of each bucket."""

    version: int
    epoch: int
    buckets: int
    folders: dict[int, str]


class HotStore:
    """Hot objects in buckets by hash of (tenant, entity), written by one job.

    A batch folds its deltas once, by bucket. The buckets found in that fold are read, merged and written to new
    folders; then a version is published that names the folder of every bucket. Readers keep the version they have
    read, nothing is overwritten, and a batch that dies before it publishes leaves no trace for readers. The work of a
    batch follows the buckets it touches, not the store: choose as many buckets as make one a file or two. An epoch
    that comes again changes nothing; epochs must grow.

    Empty deltas touch nothing. Rows without entity or tenant are entities of their own, as in ``upsert_hot``.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.path = path.rstrip("/")
        self._wanted = buckets

    # --- versions ---------------------------------------------------------------------------------
    def newest(self) -> Version:
        log = self._log()
        row = None if log is None else log.orderBy(F.desc("version")).first()
        return Version(-1, -1, self._wanted, {}) if row is None else Version(*row)

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log/*")
        except AnalysisException:
            return None

    def _publish(self, v: Version) -> None:
        # One row, as wide as there are buckets.
        row = self.spark.createDataFrame([tuple(v)], _LOG).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.path}/log/{v.version:012d}")

    # --- reading ----------------------------------------------------------------------------------
    def read(self, version: Version | None = None, only: list[int] | None = None) -> DataFrame:
        """Objects of a version, by default the newest; ``only`` limits the scan to some buckets."""
        at = version or self.newest()
        folders = [f for b, f in at.folders.items() if only is None or b in only]
        if not folders:
            return self.spark.createDataFrame([], _OBJECTS)
        return self.spark.read.schema(_OBJECTS).parquet(*(f"{self.path}/data/{f}" for f in folders))

    def lookup(self, tenant_id: int, entity_id: int) -> DataFrame:
        """The object of one entity: one bucket is read."""
        at = self.newest()
        key = [F.lit(v).cast("long").alias(k) for k, v in (("tenant_id", tenant_id), ("entity_id", entity_id))]
        bucket = self.spark.range(1).select(*key).select(_bucket(at.buckets)).first()[0]
        found = self.read(at, [bucket])
        return found.where((F.col("tenant_id") == tenant_id) & (F.col("entity_id") == entity_id))

    # --- writing ----------------------------------------------------------------------------------
    def upsert(self, deltas: DataFrame, epoch: int | None = None, *, as_of=None) -> list[int]:
        """Merge JSON deltas (see ``upsert_hot``); returns the buckets that were read and replaced."""
        old = self.newest()
        if epoch is not None and epoch <= old.epoch:
            return []
        name = f"v{old.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        self._by_bucket(hot.fold_deltas(deltas), old.buckets, f"folded/{name}")
        touched = self._buckets(f"folded/{name}")
        if touched:
            folded = self.spark.read.schema(_FOLDED).parquet(f"{self.path}/folded/{name}")
            now = timefn.ts(timefn.resolve_as_of(as_of))
            self._replace(hot.merge_folded(self.read(old, touched), folded, now), old, name, epoch)
        self._delete(f"folded/{name}")
        return touched

    def rebuild(self, objects: DataFrame) -> list[int]:
        """The store becomes exactly these objects, for instance those built from history."""
        old = self.newest()
        return self._replace(objects, old._replace(folders={}), f"v{old.version + 1:012d}-{uuid.uuid4().hex[:8]}", None)

    def reconcile(self, values: DataFrame, attributes: DataFrame, *, as_of=None, hours: int = 1) -> list[int]:
        """Repair the store from the last hours of history."""
        now = timefn.resolve_as_of(as_of)
        return self.upsert(hot.recent_deltas(values, attributes, as_of=now, hours=hours), as_of=now)

    def backfill(self, values: DataFrame, attributes: DataFrame, attribute_name: str, *, as_of=None) -> list[int]:
        """Bring a cold attribute into the store."""
        return self.upsert(hot.promoted_deltas(values, attributes, attribute_name), as_of=as_of)

    def _by_bucket(self, rows: DataFrame, buckets: int, name: str) -> None:
        numbered = rows.withColumn("bucket", _bucket(buckets))
        laid_out = numbered.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *hot.KEY)
        laid_out.write.partitionBy("bucket").parquet(f"{self.path}/{name}")

    def _replace(self, objects: DataFrame, old: Version, name: str, epoch: int | None) -> list[int]:
        self._by_bucket(objects, old.buckets, f"data/{name}")
        written = self._buckets(f"data/{name}")
        folders = old.folders | {b: f"{name}/bucket={b}" for b in written}
        self._publish(Version(old.version + 1, old.epoch if epoch is None else epoch, old.buckets, folders))
        return written

    # --- cleaning ---------------------------------------------------------------------------------
    def vacuum(self, keep: int = 2) -> None:
        """Forget older versions than the last ``keep``, and delete the folders that no other version names, those
        of failed batches among them."""
        log = self._log()
        # A row per batch since the last vacuum.
        rows = [] if log is None else sorted(log.collect(), key=lambda r: r["version"])
        if not rows:
            return
        needed = {f for r in rows[-keep:] for f in r["folders"].values()}
        for r in rows[:-keep]:
            self._delete(f"log/{r['version']:012d}")
        for part in ("data", "folded"):
            for name in self._children(part):
                # Folders of a later version than the newest belong to a batch that is being written.
                if int(name[1:].split("-")[0]) <= rows[-1]["version"]:
                    here = {f"{name}/bucket={b}" for b in self._buckets(f"{part}/{name}")}
                    for folder in here - needed:
                        self._delete(f"{part}/{folder}")
                    if not here & needed:
                        self._delete(f"{part}/{name}")

    def _fs(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _children(self, name: str) -> list[str]:
        fs, path = self._fs(name)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _buckets(self, name: str) -> list[int]:
        """Buckets a write has made, from the names of its folders."""
        return sorted(int(n.split("=")[1]) for n in self._children(name) if n.startswith("bucket="))

    def _delete(self, name: str) -> None:
        fs, path = self._fs(name)
        fs.delete(path, True)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("tenant_id", "entity_id"), F.lit(buckets)).alias("bucket")
