"""From readings to the fact table: enrich, deduplicate, batch, load."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gaugeworks import schemas
from gaugeworks.functions import timefn
from gaugeworks.functions.relations import join_null_safe, latest_by
from gaugeworks.operators.enrich import enrich_fact
from gaugeworks.operators.load import run_batch_load, run_fact_load

READING_KEY = ["tenant_id", "entity_id", "attribute_id", "ingested_at"]
WATERMARK = "10 minutes"


def trigger_of(interval: str | None) -> dict:
    """Trigger options: an interval for a running job, None to drain the source and stop."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def enrich_stream(
    values: DataFrame, dim_tenants: DataFrame, dim_attributes: DataFrame, dim_entities: DataFrame
) -> DataFrame:
    """Stream of readings joined with static dimensions; the batch operator serves both."""
    return enrich_fact(values, dim_tenants, dim_attributes, dim_entities)


def watermarked(df: DataFrame, at: str, watermark: str | None) -> DataFrame:
    """The stream with a watermark, or as it is: then no late row is dropped, and state keeps every group."""
    return df if watermark is None else df.withWatermark(at, watermark)


def deduplicate(readings: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row per (tenant, entity, attribute, time) within the watermark; state is bounded by it.

    Rows older than the watermark are dropped. Where input may be older than that, load it with
    ``start_merge_load``, which compares with the stored fact instead.
    """
    return readings.withWatermark("ingested_at", watermark).dropDuplicatesWithinWatermark(READING_KEY)


def batch_counts(readings: DataFrame, width: str = "30 seconds", watermark: str | None = None) -> DataFrame:
    """Readings per tenant in tumbling windows."""
    return (
        watermarked(readings, "ingested_at", watermark)
        .groupBy(F.window("ingested_at", width).alias("w"), "tenant_id")
        .agg(F.count("*").alias("events"))
        .select(F.col("w.start").alias("window_start"), "tenant_id", "events")
    )


def start_fact_load(
    fact: DataFrame, fact_path: str, audit_path: str, checkpoint: str, *, name: str = "load",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Load each micro-batch into the fact table, once.

    The epoch is both the batch id (skipped when the audit already lists it) and the load id (written
    over itself when the audit does not), so a repeated epoch changes nothing.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        label = f"{name}-{epoch:012d}"
        staged = batch.withColumn("batch_id", F.lit(label)).persist()
        try:
            run_fact_load(batch.sparkSession, staged, fact_path, audit_path, load_id=label)
        finally:
            staged.unpersist()

    return (
        fact.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


def start_merge_load(
    fact: DataFrame, fact_path: str, audit_path: str, checkpoint: str, *, name: str = "load",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Load each micro-batch so that every reading is in the fact once, in whatever order it comes.

    A batch is reduced to one row per reading key and compared with the stored fact, of which only the months
    and the time span of the batch are read. Late rows are thus merged, repeated ones dropped; there is no
    state to bound. A repeated epoch compares with the other loads and writes over itself. Of readings of one batch
    that share a key the largest by content stays, so a repeated epoch picks the same; null keys are keys.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        spark, label = batch.sparkSession, f"{name}-{epoch:012d}"
        fresh = latest_by(batch, READING_KEY, [c for c in batch.columns if c not in READING_KEY]).persist()
        try:
            low, high, months = fresh.agg(
                F.min("ingested_at"), F.max("ingested_at"), F.collect_set("year_month")
            ).first()
            try:
                known = spark.read.schema(f"{schemas.FACT}, load_id string").parquet(fact_path)
            except AnalysisException:
                known = None
            rows = fresh
            if known is not None:
                near = known.where(
                    (F.col("year_month").isin(months or []) | F.col("year_month").isNull())
                    & (F.col("ingested_at").between(low, high) | F.col("ingested_at").isNull())
                    & (F.col("load_id") != label)
                )
                rows = join_null_safe(fresh, near.select(*READING_KEY), READING_KEY, "left_anti")
            run_batch_load(spark, rows, fact_path, audit_path, batch_id=label)
        finally:
            fresh.unpersist()

    return (
        fact.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


def split_late(batch: DataFrame, high_water: dt.datetime | None, delay: dt.timedelta) -> tuple[DataFrame, DataFrame]:
    """Rows on time and rows older than the highest time of earlier batches minus the delay."""
    if high_water is None:
        return batch, batch.where(F.lit(False))
    late = F.col("ingested_at") < timefn.ts(timefn.resolve_as_of(high_water) - delay)
    return batch.where(~late), batch.where(late)


def _high_water(spark: SparkSession, path: str, epoch: int) -> dt.datetime | None:
    try:
        marks = spark.read.schema("high_water timestamp, epoch long").parquet(path)
    except AnalysisException:
        return None
    return marks.where(F.col("epoch") < epoch).agg(
        F.max(F.date_format("high_water", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    ).first()[0]


def start_late_routing(
    readings: DataFrame, on_time_path: str, late_path: str, marks_path: str, checkpoint: str, *,
    delay: dt.timedelta = dt.timedelta(minutes=10), interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Write readings on time to one table and late ones to a side table, so that none is lost.

    The high-water mark of each epoch is one stored row; all outputs are keyed by epoch and can be
    written again.
    """

    def route(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            mark = _high_water(spark, marks_path, epoch)
            on_time, late = split_late(kept, mark, delay)
            for rows, path in ((on_time, on_time_path), (late, late_path)):
                rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
            kept.agg(F.max("ingested_at").alias("high_water")).write.mode("overwrite").parquet(
                f"{marks_path}/epoch={epoch}"
            )
        finally:
            kept.unpersist()

    return (
        readings.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )
