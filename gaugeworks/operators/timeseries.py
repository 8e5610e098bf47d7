"""Time series over the fact table: daily statistics, hourly rates, decomposition."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.quantiles import exact_percentiles
from gaugeworks.functions.relations import exact_mean, join_null_safe


def _scope(fact: DataFrame, tenant_id, attribute: str | None) -> DataFrame:
    if tenant_id is not None:
        fact = fact.where(F.col("tenant_id") == F.lit(tenant_id))
    if attribute is not None:
        fact = fact.where(F.col("attribute_name") == attribute)
    return fact


def daily_attribute_stats(
    fact: DataFrame, *, as_of=None, months: int = 6, days: int | None = None,
    tenant_id=None, attribute: str | None = None,
) -> DataFrame:
    """Per day, tenant, entity type and category: entities, mean, spread, median and p95."""
    now = timefn.resolve_as_of(as_of)
    start = now - dt.timedelta(days=days) if days else timefn.add_months(now, -months)
    keys = ["day", "tenant_name", "entity_type", "attribute_category"]
    rows = (
        _scope(timefn.since(fact, start), tenant_id, attribute)
        .where(F.col("value_decimal").isNotNull())
        .select(
            F.date_trunc("day", "ingested_at").alias("day"),
            *keys[1:],
            "entity_id",
            "value_decimal",
        )
    )
    value = F.col("value_decimal")
    basic = rows.groupBy(*keys).agg(
        F.count_distinct("entity_id").alias("entity_count"),
        exact_mean(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.stddev(value.cast("double")).alias("stddev_value"),
    )
    ranks = exact_percentiles(rows, keys, value, {"median_value": 0.5, "p95_value": 0.95})
    return join_null_safe(basic, ranks, keys).orderBy(
        F.desc("day"), F.desc("entity_count"), "tenant_name", "entity_type", "attribute_category"
    )


def hourly_event_rate(
    fact: DataFrame, *, as_of=None, days: int = 7, tenant_id=None
) -> DataFrame:
    """Hourly counts with the mean of the last 24 rows and a traffic label.

    The frame counts rows, not hours: missing hours are not filled in. The tenant is part of the window
    key, which changes nothing when the query is scoped to one tenant.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    hourly = (
        _scope(timefn.since(fact, start), tenant_id, None)
        .groupBy(
            F.date_trunc("hour", "ingested_at").alias("hour"), "tenant_id", "tenant_name", "entity_type"
        )
        .agg(F.count("*").alias("event_count"), F.count_distinct("entity_id").alias("active_entities"))
    )
    frame = Window.partitionBy("tenant_id", "entity_type").orderBy("hour").rowsBetween(-23, 0)
    count, mean = F.col("event_count"), F.col("moving_avg_24h")
    return (
        hourly.withColumn("moving_avg_24h", F.avg("event_count").over(frame))
        .withColumn(
            "traffic_pattern",
            F.when(count > mean * 1.5, "peak").when(count < mean * 0.5, "low").otherwise("normal"),
        )
        .drop("tenant_id")
        .orderBy(F.desc("hour"), "entity_type", "tenant_name")
    )


def daily_attribute_distribution(
    fact: DataFrame, *, as_of=None, days: int = 90, min_events: int = 1000
) -> DataFrame:
    """Per day and attribute: volume, distinct entities and tenants, filled value columns.

    Rows are first summed per (day, attribute, tenant, entity): the two distinct counts then work on
    that much smaller table.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    keys = ["ingested_date", "attribute_name", "attribute_category"]
    filled = {
        "int_count": "value_int",
        "decimal_count": "value_decimal",
        "bool_count": "value_bool",
        "timestamp_count": "value_timestamp",
        "text_count": "value",
    }
    per_entity = (
        timefn.since(fact, start)
        .groupBy(*keys, "tenant_id", "entity_id")
        .agg(F.count("*").alias("n"), *[F.count(c).alias(name) for name, c in filled.items()])
    )
    return (
        per_entity.groupBy(*keys)
        .agg(
            F.sum("n").alias("total_events"),
            F.count_distinct("entity_id").alias("distinct_entities"),
            F.count_distinct("tenant_id").alias("distinct_tenants"),
            *[F.sum(name).alias(name) for name in filled],
        )
        .where(F.col("total_events") > min_events)
        .orderBy(F.desc("ingested_date"), F.desc("total_events"), "attribute_name")
    )


def decompose(
    fact: DataFrame, *, as_of=None, days: int = 30, tenant_id=None, attribute: str | None = None,
    series: Sequence[str] = ("entity_id", "entity_type"), densify: bool = False,
) -> DataFrame:
    """Hourly means with 24-row trend, remainder, calendar position and the value 168 rows back.

    ``series`` names the columns that identify one series. With ``densify`` missing hours become null
    rows, so 168 rows back is exactly one week.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    series = list(series)
    hourly = (
        _scope(timefn.since(fact, start), tenant_id, attribute)
        .where(F.col("value_decimal").isNotNull())
        .groupBy(F.date_trunc("hour", "ingested_at").alias("hour"), *series)
        .agg(exact_mean(F.col("value_decimal")).alias("actual_value"))
    )
    if densify:
        span = hourly.groupBy(*series).agg(F.min("hour").alias("a"), F.max("hour").alias("b"))
        grid = span.select(*series, F.explode(F.expr("sequence(a, b, INTERVAL 1 HOUR)")).alias("hour"))
        hourly = join_null_safe(grid, hourly, [*series, "hour"], "left")
    by_hour = Window.partitionBy(*series).orderBy("hour")
    trend = F.avg("actual_value").over(by_hour.rowsBetween(-23, 0))
    return (
        hourly.withColumn("trend_24h", trend)
        .withColumn("detrended", F.col("actual_value") - F.col("trend_24h"))
        .withColumn("day_of_week", timefn.dow0(F.col("hour")))
        .withColumn("hour_of_day", F.hour("hour"))
        .withColumn("same_hour_last_week", F.lag("actual_value", 168).over(by_hour))
        .select("hour", *series, "actual_value", "trend_24h", "detrended", "day_of_week",
                "hour_of_day", "same_hour_last_week")
        .orderBy(*series, F.desc("hour"))
    )


def daily_average(
    fact: DataFrame, *, as_of=None, months: int = 6, tenant_id=None, attribute: str | None = None
) -> DataFrame:
    """Mean value per day over the last months."""
    start = timefn.add_months(timefn.resolve_as_of(as_of), -months)
    return (
        _scope(timefn.since(fact, start), tenant_id, attribute)
        .groupBy(F.date_trunc("day", "ingested_at").alias("day"))
        .agg(exact_mean(F.col("value_decimal")).alias("avg_value"), F.count("value_decimal").alias("samples"))
        .orderBy("day")
    )
