"""Operational reads: hot filters, entity detail, mixed hot/cold queries, attribute usage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions import jsonfn, timefn
from gaugeworks.functions.quantiles import exact_percentiles
from gaugeworks.functions.relations import exact_mean, join_null_safe
from gaugeworks.operators.eav import pivot_latest

_KEY = ["entity_id", "tenant_id"]


def _live(entities: DataFrame, tenant_id) -> DataFrame:
    live = entities.where(~F.col("is_deleted"))
    return live if tenant_id is None else live.where(F.col("tenant_id") == F.lit(tenant_id))


def hot_filter(
    entities: DataFrame, hot: DataFrame, *, pattern: Mapping, statuses: list[str], min_priority: int,
    tenant_id=None, limit: int = 100,
) -> DataFrame:
    """Entities whose hot object contains ``pattern``, with one of the statuses and enough priority.

    Newest update first. The document predicates run before the join.
    """
    doc = F.col("hot_attrs")
    matching = hot.where(
        jsonfn.contains(doc, dict(pattern))
        & jsonfn.text(doc, "status").isin(statuses)
        & (jsonfn.number(doc, "priority") >= min_priority)
    )
    return (
        _live(entities, tenant_id)
        .select(*_KEY, "entity_type")
        .join(matching, _KEY)
        .select(
            "entity_id",
            "entity_type",
            jsonfn.text(doc, "status").alias("status"),
            jsonfn.text(doc, "environment").alias("environment"),
            jsonfn.text(doc, "region").alias("region"),
            jsonfn.number(doc, "priority").alias("priority"),
            jsonfn.fragment(doc, "tags").alias("tags"),
            "updated_at",
        )
        .orderBy(F.desc("updated_at"), "entity_id")
        .limit(limit)
    )


def entity_detail(
    entities: DataFrame, hot: DataFrame, values: DataFrame,
    columns: Mapping[str, tuple[int, str]], *, tenant_id=None, entity_id: int | None = None,
) -> DataFrame:
    """Hot object of an entity with the newest values of some cold attributes as columns.

    ``columns`` maps an output name to (attribute id, value column). Without ``entity_id`` the detail of
    all entities is returned.
    """
    if tenant_id is not None:
        values = values.where(F.col("tenant_id") == F.lit(tenant_id))
    if entity_id is not None:
        at = F.col("entity_id") == F.lit(entity_id)
        entities, hot, values = entities.where(at), hot.where(at), values.where(at)
    latest = pivot_latest(values, columns)
    return (
        _live(entities, tenant_id)
        .select(*_KEY, "entity_type")
        .join(hot.select(*_KEY, "hot_attrs"), _KEY)
        .join(latest, _KEY, "left")
        .select("entity_id", "entity_type", "hot_attrs", *columns)
    )


def hottest_entities(
    entities: DataFrame, hot: DataFrame, values: DataFrame, attribute_id: int, *, as_of=None,
    hours: int = 24, threshold: float | None = 100, tenant_id=None, entity_type: str | None = None,
    region: str | None = None, limit: int = 50,
) -> DataFrame:
    """Entities with a recent reading above a threshold, hottest first.

    Shown is the newest reading *among those above* the threshold, which may be older than a newer,
    lower one. Without a threshold it is simply the newest reading.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(hours=hours)
    readings = timefn.since(values, start).where(F.col("attribute_id") == attribute_id)
    if tenant_id is not None:
        readings = readings.where(F.col("tenant_id") == F.lit(tenant_id))
    if threshold is not None:
        readings = readings.where(F.col("value_decimal") > threshold)
    newest = (
        readings.groupBy(*_KEY)
        .agg(
            F.max_by(
                F.struct("value_decimal", "ingested_at"), F.struct("ingested_at", "value_decimal")
            ).alias("r")
        )
        .select(*_KEY, F.col("r.value_decimal").alias("latest_value"), F.col("r.ingested_at").alias("latest_at"))
    )
    doc = F.col("hot_attrs")
    stored = hot if region is None else hot.where(jsonfn.text(doc, "region") == region)
    live = _live(entities, tenant_id)
    if entity_type is not None:
        live = live.where(F.col("entity_type") == entity_type)
    return (
        newest.join(live.select(*_KEY), _KEY)
        .join(stored.select(*_KEY, "hot_attrs"), _KEY)
        .select("entity_id", jsonfn.text(doc, "status").alias("status"), "latest_value", "latest_at")
        .orderBy(F.desc("latest_value"), "entity_id")
        .limit(limit)
    )


def _category_and_metric(
    values: DataFrame, attributes: DataFrame, category_attribute: int, start, tenant_id
) -> tuple[DataFrame, DataFrame]:
    recent = timefn.since(values, start)
    if tenant_id is not None:
        recent = recent.where(F.col("tenant_id") == F.lit(tenant_id))
    categories = (
        recent.where(F.col("attribute_id") == category_attribute)
        .groupBy(*_KEY, F.col("value").alias("category"))
        .agg(F.count("*").alias("copies"))
    )
    numeric = attributes.where(F.col("data_type") == "decimal").select("attribute_id", "attribute_name")
    metrics = recent.where(F.col("value_decimal").isNotNull()).join(numeric, "attribute_id")
    return categories, metrics


def category_metrics(
    values: DataFrame, attributes: DataFrame, category_attribute: int, *, as_of=None, days: int = 30,
    tenant_id=None, min_samples: int = 100,
) -> DataFrame:
    """Mean of each numeric attribute per category value.

    An entity with several category rows counts each of its samples once per row. That multiplication
    is done with counts: both sides are summed per entity before they meet, so no pair of rows is built.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    categories, metrics = _category_and_metric(values, attributes, category_attribute, start, tenant_id)
    per_entity = metrics.groupBy(*_KEY, "attribute_name").agg(
        F.count("*").alias("n"), F.sum("value_decimal").alias("total")
    )
    weighted = F.sum(F.col("total") * F.col("copies").cast("decimal(12,0)")).cast("double")
    return (
        categories.join(per_entity, _KEY)
        .groupBy("category", "attribute_name")
        .agg(
            F.sum(F.col("n") * F.col("copies")).alias("sample_count"),
            (weighted / F.sum(F.col("n") * F.col("copies"))).alias("mean"),
        )
        .where(F.col("sample_count") > min_samples)
        .select("category", "attribute_name", F.round("mean", 2).alias("average_value"), "sample_count")
        .orderBy("category", "attribute_name")
    )


def category_distribution(
    values: DataFrame, attributes: DataFrame, category_attribute: int, *, as_of=None, days: int = 30,
    tenant_id=None, min_samples: int = 100,
) -> DataFrame:
    """As ``category_metrics`` with distinct entities, extremes, median and p95.

    Percentiles are weighted by the number of category rows instead of repeating the samples.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    categories, metrics = _category_and_metric(values, attributes, category_attribute, start, tenant_id)
    per_value = metrics.groupBy(*_KEY, "attribute_name", "value_decimal").agg(F.count("*").alias("n"))
    joined = categories.join(per_value, _KEY).withColumn("weight", F.col("n") * F.col("copies"))
    keys = ["category", "attribute_name"]
    total = F.sum(F.col("value_decimal") * F.col("weight").cast("decimal(12,0)")).cast("double")
    basic = (
        joined.groupBy(*keys)
        .agg(
            F.count_distinct("entity_id").alias("entity_count"),
            (total / F.sum("weight")).alias("avg_value"),
            F.min("value_decimal").alias("min_value"),
            F.max("value_decimal").alias("max_value"),
            F.sum("weight").alias("sample_count"),
        )
        .where(F.col("sample_count") > min_samples)
    )
    ranks = exact_percentiles(
        joined, keys, F.col("value_decimal"), {"median": 0.5, "p95": 0.95}, weight=F.col("weight")
    )
    return join_null_safe(basic, ranks, keys).orderBy("category", F.desc("sample_count"), "attribute_name")


def entity_growth(entities: DataFrame, *, as_of=None, days: int = 90) -> DataFrame:
    """New entities per day with running total and mean of the last seven rows."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    daily = (
        entities.where((F.col("created_at") >= timefn.ts(start)) & ~F.col("is_deleted"))
        .groupBy(F.date_trunc("day", "created_at").alias("day"), "tenant_id", "entity_type")
        .agg(F.count("*").alias("new_entities"))
    )
    by_day = Window.partitionBy("tenant_id", "entity_type").orderBy("day")
    return (
        daily.withColumn("cumulative_total", F.sum("new_entities").over(by_day))
        .withColumn("moving_avg_7d", F.avg("new_entities").over(by_day.rowsBetween(-6, 0)))
        .orderBy("tenant_id", "entity_type", F.desc("day"))
    )


# --- attribute usage ---------------------------------------------------------------------------
def usage_snapshot(stats: DataFrame, *, as_of=None, hours: int = 1, limit: int = 50) -> DataFrame:
    """Most used attributes among those updated in the last hours."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(hours=hours)
    return (
        stats.where(F.col("newest") >= timefn.ts(start))
        .select("tenant_id", "attribute_id", "attribute_name", "total_values", "distinct_entities",
                F.col("newest").alias("newest_update"))
        .orderBy(F.desc("total_values"), "tenant_id", "attribute_id")
        .limit(limit)
    )


def usage_with_staleness(
    stats: DataFrame, *, as_of=None, tenant_id=None, limit: int = 50, warn_hours: float = 2,
    critical_hours: float = 6,
) -> DataFrame:
    """Attribute usage with its age, a badge for display and an alert level for operators."""
    now = timefn.ts(timefn.resolve_as_of(as_of))
    if tenant_id is not None:
        stats = stats.where(F.col("tenant_id") == F.lit(tenant_id))
    age = F.col("hours_stale")
    return (
        stats.withColumn("hours_stale", timefn.epoch_seconds(F.col("newest"), now) / F.lit(3600.0))
        .select(
            "tenant_id", "attribute_id", "attribute_name", "total_values", "distinct_entities",
            F.col("newest").alias("newest_update"), "hours_stale",
            F.when(age < 1, "Fresh").when(age < 6, "Slightly Stale").otherwise("Stale").alias("badge"),
            F.when(age > critical_hours, "critical").when(age > warn_hours, "warning")
            .otherwise("ok").alias("alert"),
        )
        .orderBy(F.desc("total_values"), "tenant_id", "attribute_id")
        .limit(limit)
    )


def usage_counts(
    values: DataFrame, stats: DataFrame, *, real_time: bool, as_of=None, days: int = 7, tenant_id=None
) -> DataFrame:
    """Entities and values per attribute: counted now over the last days, or read from the rollup."""
    if real_time:
        start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
        source = timefn.since(values, start).groupBy("tenant_id", "attribute_id").agg(
            F.count_distinct("entity_id").alias("distinct_entities"),
            F.count("*").alias("total_values"),
        )
    else:
        source = stats.select("tenant_id", "attribute_id", "distinct_entities", "total_values")
    return source if tenant_id is None else source.where(F.col("tenant_id") == F.lit(tenant_id))


def popular_attributes(stats: DataFrame, *, tenant_id=None, limit: int = 10) -> DataFrame:
    """Attributes with the most values."""
    if tenant_id is not None:
        stats = stats.where(F.col("tenant_id") == F.lit(tenant_id))
    return (
        stats.select("tenant_id", "attribute_id", "attribute_name", "total_values")
        .orderBy(F.desc("total_values"), "tenant_id", "attribute_id")
        .limit(limit)
    )


# --- hot store lookups -------------------------------------------------------------------------
def hot_entity(hot: DataFrame, tenant_id, entity_id: int) -> DataFrame:
    """The hot object of one entity."""
    return hot.where((F.col("tenant_id") == F.lit(tenant_id)) & (F.col("entity_id") == F.lit(entity_id)))


def hot_tenant_scan(hot: DataFrame, tenant_id=None) -> DataFrame:
    """All hot objects of a tenant."""
    return hot if tenant_id is None else hot.where(F.col("tenant_id") == F.lit(tenant_id))


def hot_containing(hot: DataFrame, pattern: Mapping, tenant_id=None) -> DataFrame:
    """Hot objects that contain a pattern."""
    return hot_tenant_scan(hot, tenant_id).where(jsonfn.contains(F.col("hot_attrs"), dict(pattern)))


def entities_by_status(
    entities: DataFrame, hot: DataFrame, status: str, *, tenant_id=None, limit: int = 100
) -> DataFrame:
    """Entities with a status, joined by the shared key columns."""
    found = hot_tenant_scan(hot, tenant_id).where(jsonfn.text(F.col("hot_attrs"), "status") == status)
    return (
        entities.select(*_KEY)
        .join(found.select(*_KEY, "hot_attrs"), _KEY)
        .select("entity_id", "hot_attrs")
        .orderBy("entity_id")
        .limit(limit)
    )
