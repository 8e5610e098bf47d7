"""The outgoing change feed of a stream of versions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from gaugeworks.operators.cdc import changes_between
from gaugeworks.streaming.pipeline import trigger_of

_KEY = ["entity_id", "tenant_id"]
_STATE = "timer_ms long, last binary, waiting binary"
_PAIRS = "entity long, tenant long, nulls int, at_us long, hot_attrs string, previous_attrs string, is_late boolean"
_STORED = "entity_id long, tenant_id long, occurred_at timestamp, hot_attrs string, previous_attrs string"
_NO_TIME = -(2**63)
# Versions inside a bucket: ids without nulls, and which of them are null.
_IDS = ["entity", "tenant", "nulls"]
_ROWS = pa.schema([("entity", pa.int64()), ("tenant", pa.int64()), ("nulls", pa.int32()), ("at_us", pa.int64()), ("hot_attrs", pa.string())])


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _ROWS) as writer:
        writer.write_table(pa.Table.from_pandas(rows, _ROWS, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes | None) -> pd.DataFrame:
    table = _ROWS.empty_table() if data is None else pa.ipc.open_stream(bytes(data)).read_all()
    return table.to_pandas()


def _ranked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Number of the entity and rank of the object (missing ones first, then by content) of each row."""
    entity = rows.groupby(_IDS, sort=False).ngroup().to_numpy()
    there = rows["hot_attrs"].notna().to_numpy()
    content, _ = pd.factorize(rows["hot_attrs"].where(there, ""), sort=True)
    return entity, np.where(there, content + 1, 0)


def _released(last: pd.DataFrame, waiting: pd.DataFrame, fresh: pd.DataFrame, known: int):
    """What comes out of a bucket when every version up to ``known`` has come, its last versions, and those that wait."""
    rows = pd.concat([last, waiting, fresh], ignore_index=True)
    entity, rank = _ranked(rows)
    at, n = rows["at_us"].to_numpy(), len(last)
    # Fresh versions before the last one released of their entity, or without a time, are late.
    last_of = np.full(len(rows), -1)
    last_of[entity[:n]] = np.arange(n)
    before = last_of[entity]
    older = (at < at[before]) | ((at == at[before]) & (rank < rank[before]))
    late = (at == _NO_TIME) | ((before >= 0) & older)
    late[: n + len(waiting)] = False
    chosen = (at <= known) & ~late
    chosen[:n] = True
    order = np.flatnonzero(chosen)
    order = order[np.lexsort((rank[order], at[order], entity[order]))]  # stable: a last version precedes its equals
    follows = np.zeros(len(order), bool)
    follows[1:] = entity[order][1:] == entity[order][:-1]
    attrs = rows["hot_attrs"].to_numpy(object)[order]
    previous = np.where(follows, np.roll(attrs, 1), None) if len(order) else attrs
    ready = rows.iloc[order].assign(previous_attrs=previous, is_late=False)[order >= n]
    out = pd.concat([ready, rows[late].assign(previous_attrs=None, is_late=True)], ignore_index=True)
    ends = np.append(~follows[1:], True)[: len(order)]
    rest = ~(chosen | late)
    return out, rows.iloc[order[ends]], rows[rest]


class _InOrder(StatefulProcessor):
    """Per bucket of entities the last version released of each and the versions after the watermark."""

    def init(self, handle) -> None:
        self.handle = handle
        self.versions = handle.getValueState("versions", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([part[_ROWS.names] for part in rows], ignore_index=True)
        yield self._advance(fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._advance(_unpacked(None), timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())

    def _advance(self, fresh: pd.DataFrame, watermark_ms: int, expired_ms: int | None = None) -> pd.DataFrame:
        timer, last, waiting = self.versions.get() if self.versions.exists() else (None, None, None)
        known = max(watermark_ms, 0) * 1000  # every version up to here has come
        out, last, waiting = _released(_unpacked(last), _unpacked(waiting), fresh, known)
        due = None
        if len(waiting):
            due = max(-(-int(waiting["at_us"].min()) // 1000), watermark_ms + 1)
        if timer is not None and timer not in (due, expired_ms):
            self.handle.deleteTimer(timer)
        if due is not None and (due != timer or timer == expired_ms):
            self.handle.registerTimer(due)
        self.versions.update((due, _packed(last), _packed(waiting)))
        return out[[*_IDS, "at_us", "hot_attrs", "previous_attrs", "is_late"]]

    def close(self) -> None:
        pass


def versions_in_order(versions: DataFrame, delay: str = "10 minutes", buckets: int = 64) -> DataFrame:
    """Each version of a stream beside its predecessor's object, released once the watermark has passed it.

    ``versions`` has entity_id, tenant_id, hot_attrs and occurred_at, in any order within ``delay``; equal times
    are ordered by content, as in the batch feed. A version older than one already released for its entity, or
    without a time, is not lost: it comes out at once with ``is_late``. Later ones that still follow all released
    versions of their entity take their place. The wall clock plays no part.

    State per entity: its last version and those within the delay. It is held in ``buckets`` of entities, each of which
    one worker reads, orders and writes at once: choose as many as make a bucket some ten thousand versions within the
    delay; the number belongs to the checkpoint, as that of the shuffle partitions does.
    """
    at_us = F.coalesce(F.unix_micros("occurred_at"), F.lit(_NO_TIME))
    # The time goes on as a number: Spark would drop late rows of a watermarked column before they are seen.
    told = versions.withWatermark("occurred_at", delay).select(
        F.pmod(F.xxhash64(*_KEY), F.lit(buckets)).alias("bucket"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for c, name in zip(_KEY, _IDS, strict=False)],
        sum(F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(_KEY)).cast("int").alias("nulls"),
        at_us.alias("at_us"), "hot_attrs",
    )
    paired = told.groupBy("bucket").transformWithStateInPandas(_InOrder(), _PAIRS, "append", "eventTime")
    ids = [F.when(F.col("nulls").bitwiseAND(1 << i) == 0, F.col(name)).alias(c) for i, (c, name) in enumerate(zip(_KEY, _IDS, strict=False))]
    at = F.when(F.col("at_us") != _NO_TIME, F.timestamp_micros("at_us"))
    return paired.select(*ids, at.alias("occurred_at"), "hot_attrs", "previous_attrs", "is_late")


def start_change_feed(
    versions: DataFrame, path: str, checkpoint: str, *, delay: str = "10 minutes", interval: str | None = "30 seconds",
    buckets: int = 64,
) -> StreamingQuery:
    """Write the ordered pairs of a stream of versions; the sink's own log makes every epoch count once."""
    return (
        versions_in_order(versions, delay, buckets).writeStream.format("parquet").partitionBy("is_late")
        .option("checkpointLocation", checkpoint).trigger(**trigger_of(interval)).start(path)
    )


def _pairs(spark: SparkSession, path: str, late: bool) -> DataFrame:
    rows = spark.read.schema(f"{_STORED}, is_late boolean").parquet(path)
    return rows.where(F.col("is_late") if late else ~F.col("is_late")).drop("is_late")


def read_feed(spark: SparkSession, path: str, *, processed_at=None) -> DataFrame:
    """The feed released so far, in the columns of ``change_feed``."""
    return changes_between(_pairs(spark, path, False), processed_at=processed_at)


def read_late_versions(spark: SparkSession, path: str) -> DataFrame:
    """Versions that came after a newer one of their entity was released."""
    return _pairs(spark, path, True).drop("previous_attrs")
