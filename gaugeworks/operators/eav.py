"""Entity-attribute-value readings: exploding, typing, validating, latest values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions import timefn
from gaugeworks.functions.relations import latest_by, with_total

# The seven data types an attribute may have.
DATA_TYPES = ("string", "integer", "decimal", "boolean", "date", "timestamp", "json")

_RESERVED = ("entity_id", "tenant_id", "ingested_at")


def scan_values(
    values: DataFrame, tenant_id, attribute_ids: list[int], start, end, newest_first: bool = True
) -> DataFrame:
    """History of some attributes of a tenant in [start, end)."""
    lo, hi = timefn.resolve_as_of(start), timefn.resolve_as_of(end)
    picked = values.where(
        (F.col("tenant_id") == tenant_id)
        & F.col("attribute_id").isin(attribute_ids)
    )
    picked = timefn.since(picked, lo, until=hi)
    return picked.orderBy(F.desc("ingested_at"), "entity_id", "attribute_id") if newest_first else picked


def latest_value(values: DataFrame, tenant_id, entity_id: int, attribute_id: int) -> DataFrame:
    """Newest reading of one attribute of one entity."""
    return (
        values.where(
            (F.col("tenant_id") == tenant_id)
            & (F.col("entity_id") == entity_id)
            & (F.col("attribute_id") == attribute_id)
        )
        .orderBy(F.desc("ingested_at"), F.desc("value"))
        .limit(1)
    )


def explode_event(wide: DataFrame, attributes: DataFrame) -> DataFrame:
    """Wide JSON events -> one row per known attribute.

    Input columns: entity_id, tenant_id, ingested_at and ``event`` (a JSON object).
    """
    fields = wide.select(
        *_RESERVED, F.explode(F.from_json("event", "map<string,string>")).alias("attribute_name", "value")
    ).where(~F.col("attribute_name").isin(*_RESERVED))
    catalog = attributes.select("attribute_id", "attribute_name")
    return fields.join(catalog, "attribute_name").select(
        "entity_id", "tenant_id", "attribute_id", "value", "ingested_at"
    )


def _typed(value: Column, data_type: Column) -> dict[str, Column]:
    def when(name: str, to: str) -> Column:
        return F.when(data_type == name, value.try_cast(to))

    return {
        "value_int": when("integer", "long"),
        "value_decimal": when("decimal", "decimal(20,5)"),
        "value_bool": when("boolean", "boolean"),
        "value_date": when("date", "date"),
        "value_timestamp": when("timestamp", "timestamp"),
    }


def type_values(readings: DataFrame, attributes: DataFrame) -> DataFrame:
    """Put the text value into the column of its data type; the text stays in ``value``.

    A typed value that the readings carry already is kept.
    """
    catalog = attributes.select("attribute_id", "data_type")
    typed = _typed(F.col("value"), F.col("data_type"))
    return (
        readings.join(catalog, "attribute_id")
        .withColumns({n: F.coalesce(n, c) if n in readings.columns else c for n, c in typed.items()})
        .select(*schemas.columns(schemas.STAGED_VALUES))
    )


def validate_values(readings: DataFrame, attributes: DataFrame) -> DataFrame:
    """Add ``reason``: null for an accepted reading, otherwise why it goes to quarantine.

    One column instead of two frames: both outcomes come from a single pass, and
    ``accepted``/``quarantined`` are filters over it.
    """
    catalog = attributes.select("attribute_id", "data_type", "validation_regex")
    joined = readings.join(catalog, "attribute_id", "left")
    value, kind = F.col("value"), F.col("data_type")
    parsed = (
        F.when(kind == "integer", value.try_cast("long").isNotNull())
        .when(kind == "decimal", value.try_cast("decimal(20,5)").isNotNull())
        .when(kind == "boolean", value.try_cast("boolean").isNotNull())
        .when(kind == "date", value.try_cast("date").isNotNull())
        .when(kind == "timestamp", value.try_cast("timestamp").isNotNull())
        .when(kind == "json", F.try_parse_json(value).isNotNull())
        .otherwise(True)
    )
    pattern = F.col("validation_regex")
    reason = (
        F.when(kind.isNull(), "unknown_attribute")
        .when(~kind.isin(*DATA_TYPES), "unknown_data_type")
        .when(value.isNull(), None)
        .when(~parsed, F.concat(F.lit("not_"), kind))
        .when(pattern.isNotNull() & ~F.regexp_like(value, pattern), "pattern_mismatch")
    )
    return joined.withColumn("reason", reason).drop("validation_regex", "data_type")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNull()).drop("reason")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNotNull())


def pivot_latest(values: DataFrame, columns: Mapping[str, tuple[int, str]]) -> DataFrame:
    """Newest value of some attributes per entity as columns: {name: (attribute_id, value column)}.

    ``max_by`` per output column replaces "latest row, then pivot": one aggregation, no sort. When the
    newest row of an attribute has a null in the wanted column, the result is null, as in the original.
    """
    wanted = sorted({attribute for attribute, _ in columns.values()})
    rows = values.where(F.col("attribute_id").isin(wanted))

    def newest(attribute: int, column: str) -> Column:
        is_it = F.col("attribute_id") == attribute
        rank = F.when(is_it, F.struct("ingested_at", "value"))
        return F.max_by(F.when(is_it, F.struct(F.col(column).alias("x"))), rank)["x"]

    return rows.groupBy("tenant_id", "entity_id").agg(
        *[newest(a, c).alias(name) for name, (a, c) in columns.items()]
    )


def latest_per_entity_attribute(values: DataFrame, *, as_of=None, days: int = 7) -> DataFrame:
    """Newest value per (tenant, entity, attribute) in the last days.

    The tenant is part of the key here; equal times are resolved by the values themselves.
    """
    recent = timefn.since(values, timefn.resolve_as_of(as_of) - dt.timedelta(days=days))
    keys = ["entity_id", "tenant_id", "attribute_id"]
    return latest_by(recent, keys, ["ingested_at"])


def classify_hot_cold(
    accesses: DataFrame, *, hot_share: float = 0.8, cold_share: float = 0.2, max_bytes: int = 1024,
    max_cardinality: int = 1000,
) -> DataFrame:
    """Storage advice per attribute from access statistics.

    Input: attribute_id, queries, total_queries, bytes_per_entity, distinct_values. Hot: read by more
    than ``hot_share`` of the operational queries, small and of bounded cardinality; cold: below
    ``cold_share``; anything between is kept where it is.
    """
    share = F.try_divide(F.col("queries").cast("double"), F.col("total_queries"))
    fits = (F.col("bytes_per_entity") < max_bytes) & (F.col("distinct_values") <= max_cardinality)
    return accesses.withColumn("access_share", share).withColumn(
        "storage",
        F.when((F.col("access_share") > hot_share) & fits, "hot")
        .when(F.col("access_share") > hot_share, "cold_too_large")
        .when(F.col("access_share") < cold_share, "cold")
        .otherwise("keep"),
    )


def partition_skew(entities: DataFrame, n: int = 100) -> DataFrame:
    """Rows and share per hash partition of the entity id.

    The hash is the first eight hex digits of the MD5 of the id, which any engine can repeat.
    """
    digest = F.conv(F.substring(F.md5(F.col("entity_id").cast("string")), 1, 8), 16, 10).cast("long")
    counted = entities.groupBy(F.pmod(digest, F.lit(n)).alias("partition_no")).agg(F.count("*").alias("row_count"))
    return (
        with_total(counted, "row_count", "_all")
        .withColumn("percent", F.round(F.col("row_count") * 100.0 / F.col("_all"), 2))
        .drop("_all")
    )
