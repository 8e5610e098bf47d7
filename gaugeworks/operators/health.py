"""Entity health: uptime, alerts, state summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.relations import cuts_of_large_keys, exact_mean, previous_in_slices, ratio


def status_gaps(status: DataFrame, slice_unit: str = "second") -> DataFrame:
    """Status events with the previous event of their entity (``prev_status``, ``prev_timestamp``).

    ``status`` has tenant_id, entity_id, status, ingested_at; an entity is known by tenant and id. The first event of an entity has no predecessor and is dropped. An
    entity with very many events is cut into time slices, which spread over many tasks.
    """
    key, at = ["tenant_id", "entity_id"], F.col("ingested_at")
    cuts = cuts_of_large_keys(status, key, at)
    lagged = previous_in_slices(
        status, key, ["ingested_at", "status"], ["status", "ingested_at"], at, cuts, unit=slice_unit
    )
    return (
        lagged.where(F.col("_prev.status").isNotNull())
        .withColumn("prev_status", F.col("_prev.status"))
        .withColumn("prev_timestamp", F.col("_prev.ingested_at"))
        .drop("_prev")
    )


def entity_uptime(
    fact: DataFrame, *, as_of=None, days: int = 30, tenant_id=None, attribute: str = "status",
    slice_unit: str = "second",
) -> DataFrame:
    """Seconds per status and uptime share per entity.

    Kept from the original: the gap before an event is charged to the new event's status, the first
    event of an entity counts for nothing, and time after the last event is not counted.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    rows = timefn.since(fact, start).where(F.col("attribute_name") == attribute)
    if tenant_id is not None:
        rows = rows.where(F.col("tenant_id") == F.lit(tenant_id))
    status = rows.select(
        "tenant_id", "entity_id", "tenant_name", "entity_type", F.col("value").alias("status"),
        "ingested_at",
    )
    seconds = timefn.datediff_boundary("second", F.col("prev_timestamp"), F.col("ingested_at"))
    gaps = status_gaps(status, slice_unit).withColumn("seconds", seconds)

    def spent(name: str) -> Column:
        return F.sum(F.when(F.col("status") == name, F.col("seconds")).otherwise(F.lit(0)))

    totals = gaps.groupBy("tenant_id", "entity_id", "tenant_name", "entity_type").agg(
        spent("online").alias("online_seconds"),
        spent("offline").alias("offline_seconds"),
        spent("warning").alias("warning_seconds"),
        F.sum("seconds").alias("total_seconds"),
        F.count(F.when(F.col("status") == "offline", 1)).alias("downtime_events"),
    )
    share = ratio(F.col("online_seconds") * F.lit(100.0), F.col("total_seconds"))
    return (
        totals.where(F.col("total_seconds") > 0)
        .withColumn("uptime_percent", F.round(share, 2))
        .select("entity_id", "tenant_name", "entity_type", "online_seconds", "offline_seconds",
                "warning_seconds", "total_seconds", "uptime_percent", "downtime_events")
        .orderBy("uptime_percent", "entity_id")
    )


def top_alerting_entities(
    fact: DataFrame, state: DataFrame, *, as_of=None, hours: int = 24, tenant_id=None,
    attribute: str = "alert_generated", limit: int = 100,
) -> DataFrame:
    """Entities with the most alerts in the last hours, with their current state.

    Alerts are summed per entity before the join with the state, which is on the entity id alone. Equal
    totals are ordered by entity id.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(hours=hours)
    alerts = timefn.since(fact, start).where(F.col("attribute_name") == attribute)
    if tenant_id is not None:
        alerts = alerts.where(F.col("tenant_id") == F.lit(tenant_id))
    summed = alerts.groupBy("entity_id", "tenant_name", "entity_type").agg(
        F.count("*").alias("total_alerts"),
        F.count_distinct("attribute_id").alias("distinct_alert_types"),
        F.min("ingested_at").alias("first_alert_at"),
        F.max("ingested_at").alias("latest_alert_at"),
    )
    span = timefn.datediff_boundary("minute", F.col("first_alert_at"), F.col("latest_alert_at"))
    current = state.select("entity_id", "status", "priority", "region", "environment")
    return (
        summed.join(current, "entity_id")
        .withColumn("alert_duration_minutes", span)
        .select("entity_id", "tenant_name", "entity_type", "status", "priority", "region",
                "environment", "total_alerts", "distinct_alert_types", "first_alert_at",
                "latest_alert_at", "alert_duration_minutes")
        .orderBy(F.desc("total_alerts"), "entity_id")
        .limit(limit)
    )


def health_summary(state: DataFrame, *, tenant_id=None) -> DataFrame:
    """State counts, alert and uptime figures per tenant, type, region and environment."""
    if tenant_id is not None:
        state = state.where(F.col("tenant_id") == F.lit(tenant_id))

    def in_state(name: str) -> Column:
        return F.count(F.when(F.col("status") == name, 1))

    return (
        state.groupBy("tenant_name", "entity_type", "region", "environment")
        .agg(
            F.count("*").alias("total_entities"),
            in_state("online").alias("online_count"),
            in_state("offline").alias("offline_count"),
            in_state("warning").alias("warning_count"),
            in_state("error").alias("error_count"),
            F.round(in_state("online") * F.lit(100.0) / F.count("*"), 1).alias("online_percent"),
            F.avg("alert_count").alias("avg_alerts_per_entity"),
            F.max("alert_count").alias("max_alerts"),
            exact_mean(F.col("uptime_percent")).alias("avg_uptime_percent"),
            F.min("uptime_percent").alias("min_uptime_percent"),
        )
        .orderBy(F.desc("total_entities"), "tenant_name", "entity_type", "region", "environment")
    )


def entity_health(dim_entities: DataFrame, state: DataFrame) -> DataFrame:
    """Current health label per entity; the first rule that holds decides, nulls mean healthy."""
    label = (
        F.when(F.col("status") == "offline", "critical")
        .when(F.col("alert_count") > 10, "warning")
        .when(F.col("error_count") > 5, "warning")
        .when(F.col("uptime_percent") < 95, "degraded")
        .otherwise("healthy")
    )
    current = state.select(
        "entity_id", "status", "priority", "last_seen", "alert_count", "error_count",
        "uptime_percent", "updated_at",
    )
    return (
        dim_entities.where("is_current")
        .join(current, "entity_id")
        .withColumn("health_status", label)
        .select("entity_id", "tenant_id", "tenant_name", "entity_type", "region", "environment",
                "status", "priority", "last_seen", "alert_count", "error_count", "uptime_percent",
                "health_status", "updated_at")
    )
