"""Current state from change events, hot objects from deltas, and detection of missing heartbeats."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from gaugeworks.operators.cdc import newest_change
from gaugeworks.operators.hotstore import HotStore
from gaugeworks.streaming.pipeline import trigger_of


class ChangeLogState:
    """Latest row per key, kept as a base table and one small delta per micro-batch.

    A micro-batch writes only its own last change per key. Readers fold base and deltas; ``compact``
    folds them into a new base and publishes it in a manifest. Nothing is overwritten while it is read,
    and because the fold takes the newest change whatever the order, repeated or reordered batches give
    the same state. Deleted keys stay as tombstones until ``current`` drops them.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = list(key)

    def write_delta(self, changes: DataFrame, epoch: int) -> None:
        newest_change(changes, self.key).write.mode("overwrite").parquet(
            f"{self.path}/delta/epoch={epoch}"
        )

    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException:
            return None

    def _compacted(self) -> int:
        """Last epoch inside the newest published base, -1 without one."""
        manifest = self._read("manifest")
        return -1 if manifest is None else manifest.agg(F.max("upto")).first()[0]

    def folded(self) -> DataFrame:
        """Newest change of every key, deletes included."""
        upto = self._compacted()
        parts = []
        if upto >= 0:
            parts.append(self._read("base").where(F.col("upto") == upto).drop("upto"))
        delta = self._read("delta")
        if delta is not None:
            parts.append(delta.where(F.col("epoch") > upto).drop("epoch"))
        if not parts:
            raise FileNotFoundError(f"no state below {self.path}")
        return newest_change(reduce(lambda a, b: a.unionByName(b), parts), self.key)

    def current(self) -> DataFrame:
        """Rows that exist now."""
        return self.folded().where(F.col("op") != "d").drop("op", "ts_ms", "lsn")

    def compact(self) -> None:
        """Fold everything written so far into a new base."""
        delta = self._read("delta")
        if delta is None:
            return
        upto = delta.agg(F.max("epoch")).first()[0]
        self.folded().write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
        self.spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(
            f"{self.path}/manifest"
        )


def start_change_state(
    changes: DataFrame, state: ChangeLogState, checkpoint: str, *, interval: str | None = "30 seconds",
    compact_every: int = 100,
) -> StreamingQuery:
    """Fold a stream of changes (state columns, op, ts_ms, lsn) into a state table."""

    def write(batch: DataFrame, epoch: int) -> None:
        state.write_delta(batch, epoch)
        if compact_every and epoch and epoch % compact_every == 0:
            state.compact()

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


def start_hot_upserts(
    deltas: DataFrame, store: HotStore, checkpoint: str, *, interval: str | None = "30 seconds",
    vacuum_every: int = 20, as_of=None,
) -> StreamingQuery:
    """Merge a stream of JSON deltas into a hot store, each micro-batch into the buckets it touches. Of deltas in
    different micro-batches the one that comes later wins; ``as_of`` stamps the changed objects (default: now)."""

    def write(batch: DataFrame, epoch: int) -> None:
        store.upsert(batch, epoch, as_of=as_of)
        if vacuum_every and epoch and epoch % vacuum_every == 0:
            store.vacuum()

    return (
        deltas.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


_BEAT_OUTPUT = "source string, last_beat timestamp, status string"


def _watch(timeout_ms: int):
    def watch(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        if state.hasTimedOut:
            status = "NO_HEARTBEAT"
        else:
            for chunk in chunks:
                newest = chunk["timestamp"].max().value // 1000
                last = newest if last is None else max(last, newest)
            state.update((last,))
            status = "OK"
        state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(
            {"source": [key[0]], "last_beat": [pd.Timestamp(last * 1000)], "status": [status]}
        )

    return watch


def watch_heartbeats(beats: DataFrame, timeout_ms: int = 5000) -> DataFrame:
    """Status row per source on every beat, and one when no beat came for ``timeout_ms``.

    A plain aggregation says nothing while nothing arrives; a processing-time timer does. The state of a
    source is one number, whatever the number of beats.
    """
    return beats.groupBy("source").applyInPandasWithState(
        _watch(timeout_ms), _BEAT_OUTPUT, "last_us long", "update", GroupStateTimeout.ProcessingTimeTimeout
    )


_GAPS = "source string, last_beat timestamp, missing_at timestamp"
_PENDING = "told_us long, starts array<long>, ends array<long>"


def _joined_runs(starts: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs (first and last beat) after joining those no further apart than the limit."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.append(True, starts[1:] - ends[:-1] > limit)[: len(starts)]
    return starts[first], ends[np.append(first[1:], True)[: len(ends)]]


class _Silence(StatefulProcessor):
    """Per source the last beat whose silence was told, and the runs of beats since: within a run no gap exceeds the
    limit, and a beat that comes later can only join runs. So a source keeps at most a run per limit of the delay,
    whatever the number of beats."""

    def __init__(self, limit_us: int):
        self.limit = limit_us

    def init(self, handle) -> None:
        self.handle = handle
        self.beats = handle.getValueState("beats", _PENDING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = [part["timestamp"].to_numpy("datetime64[us]").astype(np.int64) for part in rows]
        yield self._advance(key, np.unique(np.concatenate(fresh)), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._advance(key, np.zeros(0, np.int64), timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, fresh: np.ndarray, watermark_ms: int) -> pd.DataFrame:
        told, starts, ends = self.beats.get() if self.beats.exists() else (None, [], [])
        known = max(watermark_ms, 0) * 1000  # every beat up to here has come
        if told is not None:
            fresh = fresh[fresh > told]
        runs = [np.concatenate([np.array(x or [], np.int64), fresh]) for x in (starts, ends)]
        starts, ends = _joined_runs(*runs, self.limit)
        over = ends + self.limit <= known
        silent, starts, ends = ends[over].tolist(), starts[~over].tolist(), ends[~over].tolist()
        self.beats.update((silent[-1] if silent else told, starts, ends))
        if ends:
            self.handle.registerTimer(max((ends[0] + self.limit) // 1000 + 1, watermark_ms + 1))
        return pd.DataFrame(
            {
                "source": pd.Series([key[0]] * len(silent), dtype=object),
                "last_beat": pd.to_datetime(silent, unit="us"),
                "missing_at": pd.to_datetime([t + self.limit for t in silent], unit="us"),
            }
        )

    def close(self) -> None:
        pass


def missing_heartbeats(beats: DataFrame, limit_seconds: float = 5, delay: str = "10 seconds") -> DataFrame:
    """A row for every silence of a source longer than the limit, in event time: its last beat and when it was due.

    A silence is told as soon as the watermark passes the time the next beat was due, also while the source stays
    silent, by an event-time timer; the wall clock plays no part, so a replay gives the same rows. Beats may come in
    any order within ``delay``; later ones are dropped, as the silence they would have filled was told. State per
    source are the runs of its beats within the delay that have no longer gap. A beat without time or source is no beat.
    """
    told = beats.where("source IS NOT NULL AND timestamp IS NOT NULL").select("source", "timestamp")
    return (
        told.withWatermark("timestamp", delay)
        .groupBy("source")
        .transformWithStateInPandas(_Silence(round(limit_seconds * 1_000_000)), _GAPS, "append", "eventTime")
    )
