"""Row scoping and entity search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions import timefn


def tenant_scope(df: DataFrame, tenant_id=None, *, strict: bool = False) -> DataFrame:
    """Rows of one tenant. Without a tenant nothing is visible; ``strict`` raises instead."""
    if tenant_id is None:
        if strict:
            raise ValueError("tenant_id is required")
        return df.where(F.lit(False))
    return df.where(F.col("tenant_id") == F.lit(tenant_id))


def bounded_range(
    df: DataFrame,
    start=None,
    end=None,
    *,
    as_of=None,
    column: str = "ingested_at",
    max_days: int = 30,
    default_days: int = 7,
) -> DataFrame:
    """Time filter [start, end) that refuses an over-long range and fills in a missing one."""
    hi = timefn.resolve_as_of(end if end is not None else as_of)
    lo = timefn.resolve_as_of(start) if start is not None else hi - dt.timedelta(days=default_days)
    if lo > hi:
        raise ValueError("the range ends before it starts")
    if hi - lo > dt.timedelta(days=max_days):
        raise ValueError(f"time range exceeds {max_days} days")
    return timefn.since(df, lo, column, until=hi)


def find_entities(
    values: DataFrame, tenant_id, filters: str, *, as_of=None, recent_days: int = 7
) -> DataFrame:
    """Entities that match every filter of a JSON list of {attribute_id, value, operator}.

    Kept from the original: ``=`` compares the text, ``<`` and ``>`` compare the integer value only, any
    other operator never matches, any reading in the window counts, and the number of distinct matched
    attributes must equal the number of filters (two filters on one attribute never match).
    """
    spark = values.sparkSession
    since = timefn.resolve_as_of(as_of) - dt.timedelta(days=recent_days)
    listed = spark.range(1).select(
        F.from_json(F.lit(filters), schemas.FILTER_LIST).alias("_all")
    )
    wanted = listed.select(F.explode("_all").alias("f"), F.size("_all").alias("_needed")).select(
        F.col("f.attribute_id").cast("long").alias("_attribute"),
        F.col("f.value").alias("_value"),
        F.col("f.operator").alias("_op"),
        "_needed",
    )
    recent = timefn.since(tenant_scope(values, tenant_id), since).select("entity_id", "attribute_id", "value", "value_int")
    bound = F.col("_value").try_cast("long")
    hit = (
        ((F.col("_op") == "=") & (F.col("value") == F.col("_value")))
        | ((F.col("_op") == ">") & (F.col("value_int") > bound))
        | ((F.col("_op") == "<") & (F.col("value_int") < bound))
    )
    matched = recent.join(wanted, F.col("attribute_id") == F.col("_attribute")).where(hit)
    return (
        matched.groupBy("entity_id", "attribute_id")
        .agg(F.max("_needed").alias("_needed"))
        .groupBy("entity_id")
        .agg(F.count("*").alias("_found"), F.max("_needed").alias("_needed"))
        .where(F.col("_found") == F.col("_needed"))
        .select("entity_id")
    )
