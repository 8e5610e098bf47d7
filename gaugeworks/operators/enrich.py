"""Fact enrichment with versioned dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions import timefn
from gaugeworks.operators.scd import scd2_asof


def enrich_fact(
    values: DataFrame, dim_tenants: DataFrame, dim_attributes: DataFrame, dim_entities: DataFrame
) -> DataFrame:
    """History rows -> denormalised fact rows.

    Each dimension is looked up as of the reading's time, so several versions of a key do not repeat
    the reading. Join strategy is left to the planner: it broadcasts a dimension only below its size
    threshold, and splits a hot key otherwise.
    """
    named = scd2_asof(values, dim_tenants, ["tenant_id"], "ingested_at", ["tenant_name"])
    typed = scd2_asof(
        named, dim_attributes, ["attribute_id"], "ingested_at",
        ["attribute_name", "attribute_category"],
    )
    placed = scd2_asof(typed, dim_entities, ["entity_id", "tenant_id"], "ingested_at", ["entity_type"])
    if "value_timestamp" in placed.columns and "value_date" in placed.columns:
        # The fact has no date column: a date value becomes a timestamp at midnight.
        placed = placed.withColumn(
            "value_timestamp", F.coalesce("value_timestamp", F.col("value_date").cast("timestamp"))
        )
    full = placed.withColumns(timefn.derived_time_columns(F.col("ingested_at")))
    extra = [c for c in ("event_id", "batch_id") if c in full.columns]
    return full.select(*extra, *schemas.FACT_COLUMNS)
