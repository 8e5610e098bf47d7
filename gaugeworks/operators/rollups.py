"""Aggregate tables and cache payloads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.quantiles import exact_percentiles
from gaugeworks.functions.relations import join_null_safe, latest_by, ratio
from gaugeworks.operators.health import status_gaps
from gaugeworks.operators.load import write_partitioned


def attribute_stats(values: DataFrame, attributes: DataFrame) -> DataFrame:
    """Per tenant and attribute: entities, values, oldest and newest reading.

    Summed on ids first; the name is joined to the small result. Unknown attributes are dropped.
    """
    counted = values.groupBy("tenant_id", "attribute_id").agg(
        F.count_distinct("entity_id").alias("distinct_entities"),
        F.count("*").alias("total_values"),
        F.min("ingested_at").alias("oldest"),
        F.max("ingested_at").alias("newest"),
    )
    return counted.join(attributes.select("attribute_id", "attribute_name"), "attribute_id").select(
        "tenant_id", "attribute_id", "attribute_name", "distinct_entities", "total_values", "oldest",
        "newest",
    )


def status_seconds_by_day(status: DataFrame, first: dt.datetime, last: dt.datetime) -> DataFrame:
    """Seconds per (entity, tenant, date, status): gaps between status events, cut at midnight.

    A gap belongs to the status of the event that ends it. Only the part within [first, last) counts.
    """
    gaps = status_gaps(status)
    begin = F.greatest("prev_timestamp", timefn.ts(first))
    end = F.least("ingested_at", timefn.ts(last))
    clipped = gaps.select("entity_id", "tenant_id", "status", begin.alias("a"), end.alias("b")).where("a < b")
    days = F.expr("sequence(to_date(a), to_date(b), INTERVAL 1 DAY)")
    cut = clipped.withColumn("date", F.explode(days))
    midnight = F.col("date").cast("timestamp")
    seconds = timefn.datediff_boundary(
        "second",
        F.greatest(F.col("a"), midnight),
        F.least(F.col("b"), midnight + F.expr("INTERVAL 1 DAY")),
    )
    return cut.groupBy("entity_id", "tenant_id", "date").agg(
        F.sum(F.when(F.col("status") == "online", seconds).otherwise(F.lit(0))).alias("online_seconds"),
        F.sum(F.when(F.col("status") == "offline", seconds).otherwise(F.lit(0))).alias("offline_seconds"),
        F.sum(seconds).alias("total_seconds"),
    )


def daily_entity_stats(
    fact: DataFrame, status: DataFrame, entities: DataFrame, *, as_of=None, days: int = 2,
    names: Mapping[str, str] | None = None, error_category: str = "diagnostic",
) -> DataFrame:
    """Rows of the daily entity table for the last days (today and yesterday by default).

    The original leaves the body open; this is its definition here. Events: all readings of the day.
    Errors: readings of the diagnostic category. Temperature, cpu and memory: means of the named
    attributes. Uptime: seconds of gaps that end in "online", cut at midnight. A day has a row when the entity
    has a reading or a part of a gap in it. Of the status history before the first day the last event of
    each entity is kept, however old, so the opening gap is whole.

    ``status`` has entity_id, tenant_id, status, ingested_at; ``entities`` entity_id, tenant_id, entity_type.
    """
    now = timefn.resolve_as_of(as_of)
    last = now.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(days=1)
    first = last - dt.timedelta(days=days)
    named = {"temperature": "temperature_celsius", "cpu": "cpu_percent", "memory": "memory_percent"}
    named.update(names or {})
    value = F.col("value_decimal")

    def of(metric: str) -> Column:
        return F.when(F.col("attribute_name") == named[metric], value)

    keys = ["entity_id", "tenant_id", "date"]
    metrics = (
        timefn.since(fact, first, until=last)
        .withColumn("date", F.to_date("ingested_at"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_events"),
            F.count(F.when(F.col("attribute_category") == error_category, 1)).alias("total_errors"),
            F.avg(of("temperature")).cast("decimal(10,2)").alias("avg_temperature"),
            F.max(of("temperature")).cast("decimal(10,2)").alias("max_temperature"),
            F.min(of("temperature")).cast("decimal(10,2)").alias("min_temperature"),
            F.avg(of("cpu")).cast("decimal(10,2)").alias("avg_cpu_percent"),
            F.avg(of("memory")).cast("decimal(10,2)").alias("avg_memory_percent"),
        )
    )
    status = status.select("entity_id", "tenant_id", "status", "ingested_at")
    opening = latest_by(
        status.where(F.col("ingested_at") < timefn.ts(first)), ["entity_id", "tenant_id"], ["ingested_at"]
    )
    history = timefn.since(status, first, until=last).select(*opening.columns).unionByName(opening)
    spent = status_seconds_by_day(history, first, last)
    share = ratio(F.col("online_seconds") * F.lit(100.0), F.col("total_seconds"))
    return (
        metrics.join(spent, keys, "full_outer")
        .join(entities.select("entity_id", "tenant_id", "entity_type"), ["entity_id", "tenant_id"], "left")
        .fillna(0, ["total_events", "total_errors"])
        .withColumn("uptime_minutes", F.floor(F.col("online_seconds") / 60).cast("int"))
        .withColumn("downtime_minutes", F.floor(F.col("offline_seconds") / 60).cast("int"))
        .withColumn("uptime_percent", F.round(share, 2).cast("decimal(5,2)"))
        .withColumn("computed_at", timefn.ts(now))
        .select("entity_id", "tenant_id", "entity_type", "date", "total_events", "total_errors",
                "avg_temperature", "max_temperature", "min_temperature", "avg_cpu_percent",
                "avg_memory_percent", "uptime_minutes", "downtime_minutes", "uptime_percent",
                "computed_at")
    )


def hourly_attribute_stats(fact: DataFrame, *, as_of=None, hours: int = 1) -> DataFrame:
    """Rows of the hourly attribute table from the start of the hour ``hours`` ago."""
    now = timefn.resolve_as_of(as_of)
    first = now.replace(minute=0, second=0, microsecond=0) - dt.timedelta(hours=hours)
    keys = ["tenant_id", "attribute_id", "attribute_name", "hour"]
    value = F.col("value_decimal")
    rows = timefn.since(fact, first).withColumn("hour", F.date_trunc("hour", "ingested_at"))
    basic = rows.groupBy(*keys).agg(
        F.count("*").alias("sample_count"),
        F.count_distinct("entity_id").alias("distinct_entities"),
        F.avg(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.stddev(value.cast("double")).alias("stddev_value"),
    )
    ranks = exact_percentiles(
        rows, keys, value, {"percentile_50": 0.5, "percentile_95": 0.95, "percentile_99": 0.99}
    )
    joined = join_null_safe(basic, ranks, keys, "left")
    stored = [
        "avg_value", "min_value", "max_value", "stddev_value", "percentile_50", "percentile_95",
        "percentile_99",
    ]
    return joined.select(
        *keys,
        "sample_count",
        "distinct_entities",
        *[F.col(c).cast("decimal(20,5)").alias(c) for c in stored],
        timefn.ts(now).alias("computed_at"),
    )


def refresh_daily_entity_stats(
    path: str, fact: DataFrame, status: DataFrame, entities: DataFrame, *, as_of=None, days: int = 2, **options
) -> DataFrame:
    """Recompute the last days of the stored daily table, and all earlier days that a gap closed in them touches.

    Days are partitions and replaced as a whole, so a repeated refresh changes nothing. Returns the table.
    """
    now = timefn.resolve_as_of(as_of)
    last = now.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(days=1)
    first = last - dt.timedelta(days=days)
    status = status.select("entity_id", "tenant_id", "status", "ingested_at")
    before = latest_by(
        status.where(F.col("ingested_at") < timefn.ts(first)), ["entity_id", "tenant_id"], ["ingested_at"]
    )
    closed = before.join(timefn.since(status, first, until=last), ["entity_id", "tenant_id"], "left_semi")
    oldest = closed.agg(F.date_format(F.min("ingested_at"), "yyyy-MM-dd")).first()[0]
    if oldest is not None:
        days = max(days, (last.date() - dt.date.fromisoformat(oldest)).days)
    rows = daily_entity_stats(fact, status, entities, as_of=now, days=days, **options)
    write_partitioned(rows, path, ["date"], ["tenant_id", "entity_id"])
    return fact.sparkSession.read.schema(rows.schema).parquet(path)


def refresh_hourly_attribute_stats(path: str, fact: DataFrame, *, as_of=None, hours: int = 1) -> DataFrame:
    """Recompute the stored hourly table from the start of the day ``hours`` ago.

    Days are partitions and replaced as a whole, so whole days are computed. Returns the table.
    """
    now = timefn.resolve_as_of(as_of)
    hours = (now - dt.timedelta(hours=hours)).hour + hours
    rows = hourly_attribute_stats(fact, as_of=now, hours=hours).withColumn("date", F.to_date("hour"))
    write_partitioned(rows, path, ["date"], ["tenant_id", "attribute_id", "hour"])
    return fact.sparkSession.read.schema(rows.schema).parquet(path)


def refresh_attribute_stats(path: str, values: DataFrame, attributes: DataFrame) -> DataFrame:
    """Rebuild the stored statistics per tenant and attribute; tenants are partitions. Returns the table."""
    rows = attribute_stats(values, attributes)
    write_partitioned(rows, path, ["tenant_id"], ["attribute_id"])
    return values.sparkSession.read.schema(rows.schema).parquet(path)


def read_daily_rollup(daily: DataFrame, *, as_of=None, days: int = 30, tenant_id=None) -> DataFrame:
    """Daily dashboard: means of the daily entity means per date and type."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    rows = daily.where(F.col("date") >= timefn.ts(start))
    if tenant_id is not None:
        rows = rows.where(F.col("tenant_id") == F.lit(tenant_id))

    def mean(c: str) -> Column:
        return F.round(F.avg(c), 2)

    return (
        rows.groupBy("date", "entity_type")
        .agg(
            F.count_distinct("entity_id").alias("entity_count"),
            mean("avg_temperature").alias("avg_temp"),
            mean("max_temperature").alias("avg_max_temp"),
            mean("avg_cpu_percent").alias("avg_cpu"),
            mean("uptime_percent").alias("avg_uptime_pct"),
            F.sum("total_errors").alias("total_errors"),
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
        )
        .orderBy(F.desc("date"), "entity_type")
    )


def read_hourly_rollup(
    hourly: DataFrame, attributes: list[str], *, as_of=None, hours: int = 24, tenant_id=None
) -> DataFrame:
    """Hourly trend with an anomaly label."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(hours=hours)
    rows = hourly.where((F.col("hour") >= timefn.ts(start)) & F.col("attribute_name").isin(attributes))
    if tenant_id is not None:
        rows = rows.where(F.col("tenant_id") == F.lit(tenant_id))
    mean = F.col("avg_value").cast("double")
    label = (
        F.when(mean > F.col("percentile_95").cast("double") * 1.2, "high_anomaly")
        .when(mean < F.col("percentile_50").cast("double") * 0.5, "low_anomaly")
        .otherwise("normal")
    )
    return rows.select(
        "hour", "tenant_id", "attribute_name", "sample_count", "distinct_entities",
        F.round("avg_value", 2).alias("avg_value"),
        F.round("percentile_50", 2).alias("median_value"),
        F.round("percentile_95", 2).alias("p95_value"),
        F.round("stddev_value", 2).alias("stddev_value"),
        label.alias("anomaly_status"),
    ).orderBy(F.desc("hour"), "attribute_name", "tenant_id")


def payload_entity_list(entities: DataFrame, page_size: int = 10_000) -> DataFrame:
    """Entity id lists per tenant and type as JSON pages.

    A page covers a fixed range of ids, so its size is bounded by ``page_size`` however many entities a
    tenant has; the union of the pages is the whole list.
    """
    page = F.floor(F.col("entity_id") / F.lit(page_size)).cast("long")
    return (
        entities.select("tenant_id", "entity_type", page.alias("page"), "entity_id")
        .groupBy("tenant_id", "entity_type", "page")
        .agg(F.array_sort(F.collect_set("entity_id")).alias("ids"))
        .select(
            F.concat_ws(":", F.lit("entity:list"), "tenant_id", "entity_type").alias("cache_key"),
            "page",
            F.size("ids").alias("entity_count"),
            F.to_json("ids").alias("payload"),
        )
    )


def payload_alert_counts(
    fact: DataFrame, *, as_of=None, hours: int = 1, attribute: str = "alert_generated"
) -> DataFrame:
    """Alert count per tenant over the last hours as a cache payload."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(hours=hours)
    return (
        timefn.since(fact, start)
        .where(F.col("attribute_name") == attribute)
        .groupBy("tenant_id")
        .agg(F.count("*").alias("count"))
        .select(
            F.concat(F.lit("agg:alert_count:"), "tenant_id", F.lit(":last_hour")).alias("cache_key"),
            F.to_json(F.struct("count")).alias("payload"),
        )
    )
