"""Rollups kept fresh from a stream, and their tables of updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gaugeworks.functions.relations import exact_mean
from gaugeworks.streaming.pipeline import trigger_of, watermarked


def hourly_attribute_rollup(fact: DataFrame, watermark: str | None = None) -> DataFrame:
    """Hourly statistics per tenant and attribute.

    A stream cannot count distinct values exactly, so ``approx_entities`` is a sketch (about 5% error)
    under its own name; the batch rollup holds the exact count and the percentiles. Without a watermark
    late rows change their old hour; the state is then one row per hour and attribute.
    """
    value = F.col("value_decimal")
    return (
        watermarked(fact, "ingested_at", watermark)
        .groupBy(
            F.window("ingested_at", "1 hour").alias("w"), "tenant_id", "attribute_id", "attribute_name"
        )
        .agg(
            F.count("*").alias("sample_count"),
            F.approx_count_distinct("entity_id").alias("approx_entities"),
            exact_mean(value).alias("avg_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.stddev(value.cast("double")).alias("stddev_value"),
        )
        .select(F.col("w.start").alias("hour"), "*")
        .drop("w")
    )


def minute_throughput(values: DataFrame, watermark: str | None = None) -> DataFrame:
    """Events and approximate entities per minute and tenant."""
    return (
        watermarked(values, "ingested_at", watermark)
        .groupBy(F.window("ingested_at", "1 minute").alias("w"), "tenant_id")
        .agg(
            F.count("*").alias("events_per_minute"),
            F.approx_count_distinct("entity_id").alias("approx_entities"),
        )
        .select(F.col("w.start").alias("minute"), "tenant_id", "events_per_minute", "approx_entities")
    )


def metric_periods(
    points: DataFrame, metric: str, period_seconds: int, watermark: str | None = None
) -> DataFrame:
    """Per resource and period: the four statistics an alarm rule may use."""
    return (
        watermarked(points.where(F.col("metric") == metric), "ts", watermark)
        .groupBy(F.window("ts", f"{period_seconds} seconds").alias("w"), "resource")
        .agg(
            F.avg("value").alias("Average"),
            F.max("value").alias("Maximum"),
            F.min("value").alias("Minimum"),
            F.sum("value").alias("Sum"),
        )
        .select(
            "resource",
            F.floor(F.unix_seconds("w.start") / F.lit(period_seconds)).cast("long").alias("period"),
            "Average", "Maximum", "Minimum", "Sum",
        )
    )


def start_updates(
    rollup: DataFrame, path: str, checkpoint: str, interval: str | None = "5 minutes"
) -> StreamingQuery:
    """Store the changed groups of every micro-batch under its epoch."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        rollup.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current rollup: the last stored version of every group."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c not in keys and c != "epoch"]
    return (
        stored.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "epoch").alias("_row"))
        .select(*keys, "_row.*")
    )
