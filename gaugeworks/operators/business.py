"""Usage, growth and cost per tenant."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.relations import ratio


def tenant_usage(
    fact: DataFrame, *, as_of=None, days: int = 30, sensor_type: str = "sensor",
    gateway_type: str = "gateway",
) -> DataFrame:
    """Entities, events, attributes and text volume per tenant.

    Facts are first summed per (tenant, entity, type, attribute), so the four distinct counts expand
    that small table instead of the facts. Text volume counts characters.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    summed = (
        timefn.since(fact, start)
        .groupBy("tenant_id", "tenant_name", "entity_id", "entity_type", "attribute_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.length("value")).alias("chars"),
            F.min("ingested_at").alias("first"),
            F.max("ingested_at").alias("last"),
        )
    )

    def entities_of(entity_type: str) -> Column:
        return F.count_distinct(F.when(F.col("entity_type") == entity_type, F.col("entity_id")))

    totals = summed.groupBy("tenant_id", "tenant_name").agg(
        F.count_distinct("entity_id").alias("total_entities"),
        entities_of(sensor_type).alias("sensor_count"),
        entities_of(gateway_type).alias("gateway_count"),
        F.sum("n").alias("total_events"),
        F.count_distinct("attribute_id").alias("distinct_attributes_used"),
        F.sum("chars").alias("total_text_bytes"),
        F.min("first").alias("earliest_event"),
        F.max("last").alias("latest_event"),
    )
    return (
        totals.withColumn("avg_events_per_day", F.col("total_events") / F.lit(float(days)))
        .withColumn("avg_events_per_hour", F.col("total_events") / F.lit(days * 24.0))
        .withColumn("total_text_mb", F.col("total_text_bytes") / F.lit(1024.0) / F.lit(1024.0))
        .withColumn(
            "active_hours",
            timefn.datediff_boundary("hour", F.col("earliest_event"), F.col("latest_event")),
        )
        .orderBy(F.desc("total_events"), "tenant_id")
    )


def growth_trends(fact: DataFrame, *, as_of=None, days: int = 90) -> DataFrame:
    """This month against the previous one per tenant and entity type.

    Means are over the daily counts of active entities, taken as doubles.
    """
    now = timefn.resolve_as_of(as_of)
    this_month = timefn.month_start(now)
    last_month = timefn.add_months(this_month, -1)
    keys = ["tenant_id", "tenant_name", "entity_type"]
    daily = (
        timefn.since(fact, now - dt.timedelta(days=days))
        .groupBy("ingested_date", *keys)
        .agg(
            F.count_distinct("entity_id").alias("active_entities"),
            F.count("*").alias("daily_events"),
        )
    )
    current = F.col("ingested_date") >= timefn.date(this_month)
    previous = (F.col("ingested_date") >= timefn.date(last_month)) & ~current
    means = daily.groupBy(*keys).agg(
        F.avg(F.when(current, F.col("active_entities"))).alias("current_month_avg_entities"),
        F.avg(F.when(previous, F.col("active_entities"))).alias("prev_month_avg_entities"),
        F.sum(F.when(current, F.col("daily_events"))).alias("current_month_events"),
        F.sum(F.when(previous, F.col("daily_events"))).alias("prev_month_events"),
    )
    growth = ratio(F.col("current_month_avg_entities"), F.col("prev_month_avg_entities"))
    return (
        means.where(F.col("current_month_avg_entities").isNotNull())
        .withColumn("mom_growth_percent", F.round((growth - 1) * 100, 2))
        .orderBy(F.desc_nulls_last("mom_growth_percent"), *keys)
    )


# Assumed row overhead (8 + 8 + 1 bytes) and prices of the cost model.
ROW_OVERHEAD_BYTES = 17
USD_PER_GB = 0.023
USD_PER_EVENT = 0.000001


def tenant_cost(
    fact: DataFrame, *, as_of=None, months: int = 3, usd_per_gb: float = USD_PER_GB,
    usd_per_event: float = USD_PER_EVENT,
) -> DataFrame:
    """Estimated storage and processing cost per tenant and month.

    Every row costs its text length plus a constant overhead, whichever value columns are filled.
    """
    start = timefn.add_months(timefn.resolve_as_of(as_of), -months)
    keys = ["tenant_id", "tenant_name", "ingested_month"]
    size = F.length(F.coalesce("value", F.lit(""))) + F.lit(ROW_OVERHEAD_BYTES)
    summed = (
        timefn.since(fact, start)
        .groupBy(*keys, "entity_id", "attribute_id")
        .agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    )
    totals = summed.groupBy(*keys).agg(
        F.sum("n").alias("event_count"),
        F.count_distinct("entity_id").alias("entity_count"),
        F.count_distinct("attribute_id").alias("attribute_count"),
        F.sum("bytes").alias("estimated_bytes"),
    )
    gigabytes = F.col("estimated_bytes") / F.lit(1024.0**3)
    return (
        totals.withColumn("storage_gb", gigabytes)
        .withColumn("storage_cost_usd", F.col("storage_gb") * F.lit(usd_per_gb))
        .withColumn("processing_cost_usd", F.col("event_count") * F.lit(usd_per_event))
        .withColumn("total_cost_usd", F.col("storage_cost_usd") + F.col("processing_cost_usd"))
        .drop("estimated_bytes")
        .orderBy("tenant_id", F.desc("ingested_month"))
    )
