"""Attribute statistics kept up to date by signed deltas instead of rescans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.relations import join_null_safe
from gaugeworks.streaming.partials import Rollup
from gaugeworks.streaming.snapshots import SnapshotTable

_GROUP = ["tenant_id", "attribute_id"]


def _month():
    return timefn.year_month(F.col("ingested_at"))


def count_rollup() -> Rollup:
    """Readings per (tenant, attribute, entity, month) from rows with a ``sign``: 1 for a reading that came, -1 for one
    that was deleted. Counts add up in any order; the first and last time are those of what came, so they are exact
    where nothing was removed."""

    def partial(batch: DataFrame) -> DataFrame:
        came = F.when(F.col("sign") > 0, F.col("ingested_at"))
        return batch.groupBy(*_GROUP, "entity_id", _month().alias("year_month")).agg(
            F.sum(F.col("sign").cast("long")).alias("n"),
            F.min(came).alias("oldest"),
            F.max(came).alias("newest"),
            F.count(F.when(F.col("sign") < 0, 1)).alias("removed"),
        )

    merge = {"n": F.sum("n"), "oldest": F.min("oldest"), "newest": F.max("newest"), "removed": F.sum("removed")}
    return Rollup([*_GROUP, "entity_id", "year_month"], partial, merge)


def compact_counts(table: SnapshotTable) -> None:
    """Fold the stored deltas; an entity's month with nothing left goes."""
    newest = table.newest()
    if newest is not None:
        # The columns of a count need no reading.
        schema = table.spark.read.parquet(f"{table.path}/data/{newest.folders[0]}").schema
        table.compact(schema, lambda rows: count_rollup().fold(rows).where("n <> 0"))


def _edges(counts: DataFrame) -> DataFrame:
    """First and last month of every (tenant, attribute), their bounds, and whether deletes make these unsure."""
    monthly = (
        counts.where("n > 0 AND year_month IS NOT NULL")
        .groupBy(*_GROUP, "year_month")
        .agg(F.min("oldest").alias("oldest"), F.max("newest").alias("newest"), (F.max("removed") > 0).alias("unsure"))
    )
    row = F.struct("year_month", "oldest", "newest", "unsure")
    return monthly.groupBy(*_GROUP).agg(F.min(row).alias("first"), F.max(row).alias("last"))


def _unsure(edges: DataFrame) -> DataFrame:
    months = F.array(*[F.when(F.col(f"{e}.unsure"), F.col(f"{e}.year_month")) for e in ("first", "last")])
    return edges.select(*_GROUP, F.explode(F.array_distinct(F.array_compact(months))).alias("year_month"))


def months_to_look_up(counts: DataFrame) -> list[str]:
    """Months that hold the oldest or newest reading of some attribute and lost readings (at most all months)."""
    return sorted(r[0] for r in _unsure(_edges(counts)).select("year_month").distinct().collect())


def attribute_stats_of(counts: DataFrame, attributes: DataFrame, values: DataFrame) -> DataFrame:
    """The rows of ``attribute_stats``, from folded counts.

    Entities and readings come from the counts alone. A first or last time is looked up in ``values``, the history as
    it is now, only in months that ``months_to_look_up`` names: a delete elsewhere reads nothing. With a
    ``year_month`` column, other months are not scanned. Runs a job over the counts when called. Readings without a time
    are counted and have no bounds; those without an entity are counted as readings; unknown attributes are dropped.
    """
    per_entity = counts.groupBy(*_GROUP, "entity_id").agg(F.sum("n").alias("n")).where("n > 0")
    totals = per_entity.groupBy(*_GROUP).agg(
        F.count("entity_id").alias("distinct_entities"), F.sum("n").alias("total_values")
    )
    edges = _edges(counts)
    bounds = edges.select(
        *_GROUP, F.col("first.oldest").alias("oldest"), F.col("last.newest").alias("newest"),
        F.col("first.unsure").alias("_first"), F.col("last.unsure").alias("_last"),
    )
    months = months_to_look_up(counts)
    if months:
        dated = values if "year_month" in values.columns else values.withColumn("year_month", _month())
        there = dated.where(F.col("year_month").isin(months)).select(*_GROUP, "year_month", "ingested_at")
        seen = join_null_safe(there, _unsure(edges), [*_GROUP, "year_month"], "left_semi")
        found = seen.groupBy(*_GROUP).agg(F.min("ingested_at").alias("_oldest"), F.max("ingested_at").alias("_newest"))
        bounds = join_null_safe(bounds, found, _GROUP, "left").select(
            *_GROUP,
            F.when(F.col("_first"), F.col("_oldest")).otherwise(F.col("oldest")).alias("oldest"),
            F.when(F.col("_last"), F.col("_newest")).otherwise(F.col("newest")).alias("newest"),
        )
    named = join_null_safe(totals, bounds.select(*_GROUP, "oldest", "newest"), _GROUP, "left")
    return named.join(attributes.select("attribute_id", "attribute_name"), "attribute_id").select(
        "tenant_id", "attribute_id", "attribute_name", "distinct_entities", "total_values", "oldest", "newest"
    )
