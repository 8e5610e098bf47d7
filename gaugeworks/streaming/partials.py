"""Rollups of a stream without stream state: every micro-batch stores partial rows, readers fold them.

A partial row holds what can be merged: counts, sums, extremes, moments, and sketches for ranks (KLL) and distinct
values (HLL). Rows may come in any order and at any lateness: the group they belong to gets one more partial row.
Nothing is evicted or lost, no state grows with the number of groups, and compaction keeps the stored rows near
one per group.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gaugeworks.streaming.pipeline import trigger_of
from gaugeworks.streaming.snapshots import SnapshotTable

RANK_ERROR = 0.0265  # of a KLL sketch with the default k = 200, two-sided, at 99 % confidence
PERCENTILES = {"percentile_50": 0.5, "percentile_95": 0.95, "percentile_99": 0.99}


class Rollup(NamedTuple):
    """Keys of a rollup, how a micro-batch becomes partial rows, and how these merge."""

    keys: list[str]
    partial: Callable[[DataFrame], DataFrame]
    merge: dict[str, Column]

    def fold(self, rows: DataFrame) -> DataFrame:
        """One row per group, of the same columns and types."""
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        return rows.groupBy(*self.keys).agg(*[c.cast(kinds[n]).alias(n) for n, c in self.merge.items()])


def moments(value: Column) -> dict[str, Column]:
    """Partial columns of a number: what mean, deviation and extremes need. Null values do not count."""
    x = value.cast("double")
    return {
        "n": F.count(value),
        "total": F.sum(value).cast("decimal(38,5)"),
        "least": F.min(value),
        "largest": F.max(value),
        "spread": F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2")),
    }


def _joined(a: Column, b: Column) -> Column:
    """Count, mean and sum of squared differences of two parts taken together."""
    n, delta = a["n"] + b["n"], b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + delta * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"),
    )
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def merged_moments() -> dict[str, Column]:
    parts = F.array_sort(F.collect_list("spread"))  # as many as partial rows of the group
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2"))
    return {
        "n": F.sum("n"),
        "total": F.sum("total"),
        "least": F.min("least"),
        "largest": F.max("largest"),
        "spread": F.aggregate(parts, none, _joined),
    }


def mean_of() -> Column:
    return F.col("total").cast("double") / F.when(F.col("n") > 0, F.col("n"))


def deviation_of() -> Column:
    """Sample standard deviation; null below two values."""
    return F.when(F.col("n") > 1, F.sqrt(F.col("spread.m2") / (F.col("n") - 1)))


def count_rollup(at: str, width: str, name: str, *keys: str) -> Rollup:
    """Rows per window and keys, and a sketch of their entities."""

    def partial(batch: DataFrame) -> DataFrame:
        grouped = batch.groupBy(F.window(at, width).alias("w"), *keys)
        counted = grouped.agg(F.count("*").alias("events"), F.hll_sketch_agg("entity_id").alias("entities"))
        return counted.select(F.col("w.start").alias(name), *keys, "events", "entities")

    return Rollup([name, *keys], partial, {"events": F.sum("events"), "entities": F.hll_union_agg("entities")})


def hourly_rollup() -> Rollup:
    """Partial hours of the attribute statistics, sketches of ranks and entities included."""
    keys = ["hour", "tenant_id", "attribute_id", "attribute_name"]
    value = F.col("value_decimal")

    def partial(batch: DataFrame) -> DataFrame:
        return (
            batch.withColumn("hour", F.date_trunc("hour", "ingested_at"))
            .groupBy(*keys)
            .agg(
                F.count("*").alias("sample_count"),
                *[c.alias(n) for n, c in moments(value).items()],
                F.kll_sketch_agg_double(value.cast("double")).alias("ranks"),
                F.hll_sketch_agg("entity_id").alias("entities"),
            )
        )

    merge = {
        "sample_count": F.sum("sample_count"),
        **merged_moments(),
        "ranks": F.kll_merge_agg_double("ranks"),
        "entities": F.hll_union_agg("entities"),
    }
    return Rollup(keys, partial, merge)


def daily_from_hours(hours: DataFrame) -> DataFrame:
    """Days of the stored hours: the same columns, ``date`` in place of ``hour``. No reading is read again."""
    rollup = hourly_rollup()
    days = rollup._replace(keys=["date", *rollup.keys[1:]])
    return days.fold(hours.withColumn("date", F.to_date("hour")).drop("hour"))


def attribute_statistics(rows: DataFrame) -> DataFrame:
    """Folded partial rows as statistics. Percentiles and entities come from sketches and are named so; their error
    is that of the sketch (RANK_ERROR of the ranks, about 2 % of the entities), whatever was merged."""
    ranks = F.when(F.col("n") > 0, F.col("ranks"))
    keys = [c for c in rows.columns if c in ("hour", "date", "tenant_id", "attribute_id", "attribute_name")]
    return rows.select(
        *keys,
        "sample_count",
        F.hll_sketch_estimate("entities").alias("approx_entities"),
        mean_of().alias("avg_value"),
        F.col("least").alias("min_value"),
        F.col("largest").alias("max_value"),
        deviation_of().alias("stddev_value"),
        *[F.kll_sketch_get_quantile_double(ranks, F.lit(p)).alias(f"approx_{n}") for n, p in PERCENTILES.items()],
    )


def metric_rollup(metric: str, period_seconds: int) -> Rollup:
    """Partial rows of the statistics an alarm rule may use, per resource and period."""

    def partial(batch: DataFrame) -> DataFrame:
        period = F.floor(F.unix_seconds("ts") / F.lit(period_seconds)).cast("long")
        rows = batch.where(F.col("metric") == metric).groupBy("resource", period.alias("period"))
        return rows.agg(
            F.count("value").alias("n"), F.sum("value").alias("total"), F.min("value").alias("Minimum"), F.max("value").alias("Maximum")
        )

    merge = {"n": F.sum("n"), "total": F.sum("total"), "Minimum": F.min("Minimum"), "Maximum": F.max("Maximum")}
    return Rollup(["resource", "period"], partial, merge)


def start_partials(
    rows: DataFrame, rollup: Rollup, table: SnapshotTable, checkpoint: str, *, interval: str | None = "5 minutes",
    compact_every: int = 100,
) -> StreamingQuery:
    """Store the partial rows of every micro-batch; a repeated epoch changes nothing."""

    def write(batch: DataFrame, epoch: int) -> None:
        partial = rollup.partial(batch)
        table.append(partial, epoch)
        if compact_every and epoch % compact_every == compact_every - 1:
            table.compact(partial.schema, rollup.fold)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


def read_rollup(table: SnapshotTable, rollup: Rollup, like: DataFrame) -> DataFrame:
    """The current rollup, one row per group. ``like`` is a frame (or stream) of the rows that are rolled up."""
    return rollup.fold(table.read(rollup.partial(like).schema))
