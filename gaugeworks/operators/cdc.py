"""State from change events, and the outgoing change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import jsonfn, timefn
from gaugeworks.functions.relations import cuts_of_large_keys, previous_in_slices


def newest_change(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Last change per key by (ts_ms, lsn): combined on the map side, independent of arrival order."""
    row = F.struct("ts_ms", "lsn", *[c for c in changes.columns if c not in (*key, "ts_ms", "lsn")])
    newest = changes.groupBy(*key).agg(F.max(row).alias("_row")).select(*key, "_row.*")
    return newest.select(*changes.columns)


def apply_cdc(state: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """State after a batch of changes. ``changes`` has the state columns and op, ts_ms, lsn.

    The state must carry ts_ms and lsn: a change older than what is stored is ignored, whenever it arrives.
    A state with ``op`` keeps deleted keys as tombstones (read it with ``op <> 'd'``); without ``op`` a
    deleted key leaves the state, and an older change that comes after its delete would bring it back.
    """
    missing = {"ts_ms", "lsn"} - set(state.columns)
    if missing:
        raise ValueError(f"the state has no {sorted(missing)}: late changes could not be told from new ones")
    columns = state.columns
    known = state if "op" in columns else state.withColumn("op", F.lit("r"))
    folded = newest_change(known.unionByName(changes.select(*known.columns)), key)
    return folded if "op" in columns else folded.where("op <> 'd'").select(*columns)


def fold_changes(state: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Like ``apply_cdc`` on a state that keeps op, ts_ms and lsn, deleted keys included.

    The fold is associative: any split of the changes into batches, in any order, gives the same state.
    """
    return newest_change(state.unionByName(changes.select(*state.columns)), key)


def change_feed(
    versions: DataFrame, *, processed_at=None, slice_unit: str = "second",
    order: Sequence[str] = ("occurred_at", "hot_attrs"),
) -> DataFrame:
    """Events with the old and new value of every changed key.

    ``versions`` has entity_id, tenant_id, hot_attrs (JSON object) and occurred_at; versions of an entity
    are compared with their predecessor. The first version of an entity changes all its keys from null.
    """
    key, at = ["entity_id", "tenant_id"], F.col("occurred_at")
    cuts = cuts_of_large_keys(versions, key, at)
    paired = previous_in_slices(versions, key, list(order), ["hot_attrs"], at, cuts, unit=slice_unit)
    return changes_between(paired.withColumn("previous_attrs", F.col("_prev.hot_attrs")), processed_at=processed_at)


def changes_between(paired: DataFrame, *, processed_at=None) -> DataFrame:
    """Feed rows of versions that carry their predecessor's object as ``previous_attrs`` (null: none), batch or
    stream. A version that changes nothing, or has no object, gives no row."""
    now = timefn.ts(timefn.resolve_as_of(processed_at))
    new = jsonfn.as_text_map(F.col("hot_attrs"))
    old = F.coalesce(jsonfn.as_text_map(F.col("previous_attrs")), F.create_map().cast("map<string,string>"))

    def pair(_: Column, was: Column, now_: Column) -> Column:
        return F.struct(was.alias("old"), now_.alias("new"))

    def changed(_: Column, p: Column) -> Column:
        return ~p["old"].eqNullSafe(p["new"])

    changes = F.map_filter(F.map_zip_with(old, new, pair), changed)
    feed = paired.withColumn("_changes", changes).where(F.size("_changes") > 0)
    ordered = F.map_from_entries(F.array_sort(F.map_entries("_changes")))
    return feed.select(
        F.lit("entity.updated").alias("event_type"),
        "entity_id",
        "tenant_id",
        F.to_json(ordered, {"ignoreNullFields": "false"}).alias("changes"),
        "occurred_at",
        now.alias("processed_at"),
        timefn.epoch_seconds(F.col("occurred_at"), now).alias("lag_seconds"),
    )
