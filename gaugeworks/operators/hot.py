"""The hot projection: one JSON object of frequently read attributes per entity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import jsonfn, timefn
from gaugeworks.functions.relations import latest_by
from gaugeworks.operators.load import write_partitioned

KEY = ["entity_id", "tenant_id"]


def _plain_number(value: Column) -> Column:
    """A number written out in digits with its sign and needless zeros trimmed; null for others and for numbers of
    more than 38 digits, which JSON readers would round."""
    text = F.trim(value)
    whole = F.regexp_extract(text, r"^[+-]?0*(\d*)", 1)
    fraction = F.regexp_extract(text, r"^[+-]?\d*\.(\d*?)0*$", 1)
    digits = F.concat(F.when(whole == "", "0").otherwise(whole), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)))
    sign = F.when(text.startswith("-") & (digits != "0"), "-").otherwise("")
    short = F.length(F.replace(digits, F.lit("."), F.lit(""))) <= 38
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$") & short, F.concat(sign, digits))


def _typed_value(data_type: Column, value: Column) -> Column:
    """Text value as a JSON fragment of its own type; numbers and booleans in one spelling, so that '+5',
    '007' and '10.50' are 5, 7 and 10.5, with all digits they have. Numbers with an exponent are written out as
    decimals of ten places where these hold them; what is no number stays text."""
    quoted = F.to_json(F.to_variant_object(F.struct(value.alias("v"))))
    as_text = F.regexp_extract(quoted, r'^\{"v":(.*)\}$', 1)
    other = value.try_cast("decimal(38,10)")
    exact = (other.cast("double") == value.try_cast("double")) & value.rlike("[eE]")
    plain = F.coalesce(_plain_number(value), F.when(exact, F.regexp_replace(other.cast("string"), r"\.?0+$", "")))
    numeric = data_type.isin("integer", "decimal") & plain.isNotNull()
    truth = value.try_cast("boolean")
    return (
        F.when(value.isNull(), "null")
        .when(numeric, plain)
        .when((data_type == "boolean") & truth.isNotNull(), truth.cast("string"))
        .when((data_type == "json") & F.try_parse_json(value).isNotNull(), value)
        .otherwise(as_text)
    )


def build_hot_projection(values: DataFrame, attributes: DataFrame) -> DataFrame:
    """Newest hot attribute values per entity as one JSON object with sorted keys.

    The newest value is found per (entity, attribute) first, so the object of an entity is collected
    from at most as many rows as there are hot attributes.
    """
    hot = attributes.where("is_hot").select("attribute_id", "attribute_name", "data_type")
    picked = (
        values.select(*KEY, "attribute_id", "value", "ingested_at")
        .join(hot, "attribute_id")
        .select(
            *KEY, "attribute_id", "attribute_name", "ingested_at",
            _typed_value(F.col("data_type"), F.col("value")).alias("fragment"),
        )
    )
    newest = latest_by(picked, [*KEY, "attribute_id"], ["ingested_at"])
    return _objects(newest, F.max("ingested_at"))


def _objects(rows: DataFrame, updated: Column) -> DataFrame:
    """(entity, attribute_name, fragment) rows -> one object per entity."""
    merged = rows.groupBy(*KEY).agg(
        jsonfn.object_agg(F.col("attribute_name"), F.col("fragment")).alias("hot_attrs"),
        updated.alias("updated_at"),
    )
    return merged.select(*KEY, "hot_attrs", "updated_at")


def fold_deltas(deltas: DataFrame) -> DataFrame:
    """One object per entity, ``folded``, from all its JSON deltas: key by key the newest (by ``occurred_at``, then
    by content) wins. An aggregation per key, so many deltas on one entity are combined before the shuffle.
    """
    exploded = deltas.select(
        *KEY, "occurred_at", F.explode_outer(jsonfn.as_typed_map(F.col("delta"))).alias("attribute_name", "_value")
    ).select(*KEY, "attribute_name", "occurred_at", F.to_json("_value").alias("fragment"))
    newest = latest_by(exploded, [*KEY, "attribute_name"], ["occurred_at"])
    return newest.groupBy(*KEY).agg(
        jsonfn.object_agg(F.col("attribute_name"), F.col("fragment")).alias("folded")
    )


def merge_folded(state: DataFrame, folded: DataFrame, now: Column) -> DataFrame:
    """The store after folded deltas: a delta's keys win, other keys stay, new entities are added."""
    joined = state.join(folded, KEY, "full_outer")
    return joined.select(
        *KEY,
        jsonfn.merge(F.col("hot_attrs"), F.col("folded")).alias("hot_attrs"),
        F.when(F.col("folded").isNotNull(), now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def upsert_hot(state: DataFrame, deltas: DataFrame, *, as_of=None) -> DataFrame:
    """Merge JSON deltas into the store: the delta's keys win, other keys stay, new entities are added.

    Several deltas of one entity in a batch are folded first. ``HotStore`` does the same in place, on the folders
    that a batch touches.
    """
    return merge_folded(state, fold_deltas(deltas), timefn.ts(timefn.resolve_as_of(as_of)))


def _as_deltas(objects: DataFrame) -> DataFrame:
    return objects.select(*KEY, F.col("hot_attrs").alias("delta"), F.col("updated_at").alias("occurred_at"))


def recent_deltas(values: DataFrame, attributes: DataFrame, *, as_of=None, hours: int = 1) -> DataFrame:
    """Deltas that rebuild the hot values of the last hours from history.

    The value is taken in the attribute's own type, so text attributes survive the repair.
    """
    now = timefn.resolve_as_of(as_of)
    recent = timefn.since(values, now - dt.timedelta(hours=hours)).where(
        F.col("ingested_at") <= timefn.ts(now)
    )
    return _as_deltas(build_hot_projection(recent, attributes))


def promoted_deltas(values: DataFrame, attributes: DataFrame, attribute_name: str) -> DataFrame:
    """Deltas that bring a cold attribute's newest value per entity. Entities without a value are left alone."""
    promoted = attributes.where(F.col("attribute_name") == attribute_name).withColumn(
        "is_hot", F.lit(True)
    )
    return _as_deltas(build_hot_projection(values, promoted))


def reconcile_hot(
    values: DataFrame, attributes: DataFrame, state: DataFrame, *, as_of=None, hours: int = 1
) -> DataFrame:
    """Rebuild the hot values of the last hours from history and merge them into the store."""
    now = timefn.resolve_as_of(as_of)
    return upsert_hot(state, recent_deltas(values, attributes, as_of=now, hours=hours), as_of=now)


def backfill_hot(
    values: DataFrame, attributes: DataFrame, state: DataFrame, attribute_name: str, *, as_of=None
) -> DataFrame:
    """Promote a cold attribute: its newest value per entity is merged into the store."""
    return upsert_hot(state, promoted_deltas(values, attributes, attribute_name), as_of=as_of)


def divergence_report(values: DataFrame, attributes: DataFrame, state: DataFrame) -> DataFrame:
    """Per hot attribute: entities whose stored value differs from history, and those missing.

    Both sides are compared as the JSON fragments of the attribute's type that a store is built of.
    """
    hot = attributes.where("is_hot").select("attribute_id", "attribute_name", "data_type")
    typed = values.select(*KEY, "attribute_id", "value", "ingested_at").join(hot, "attribute_id")
    newest = latest_by(
        typed.select(
            *KEY, "attribute_id", "attribute_name", "ingested_at",
            F.to_json(F.try_parse_json(_typed_value(F.col("data_type"), F.col("value")))).alias("_history"),
        ),
        [*KEY, "attribute_id", "attribute_name"],
        ["ingested_at"],
    ).select(*KEY, "attribute_name", "_history", F.lit(True).alias("_in_history"))
    stored = (
        state.select(
            *KEY, F.explode(jsonfn.as_typed_map(F.col("hot_attrs"))).alias("attribute_name", "_value")
        )
        .select(*KEY, "attribute_name", F.to_json("_value").alias("_stored"))
        .join(hot.select("attribute_name"), "attribute_name")
        .withColumn("_in_store", F.lit(True))
    )
    both = newest.join(stored, [*KEY, "attribute_name"], "full_outer")
    in_both = F.col("_in_history") & F.col("_in_store")
    return both.groupBy("attribute_name").agg(
        F.count(F.when(in_both & F.col("_history").eqNullSafe(F.col("_stored")), 1)).alias("matching"),
        F.count(F.when(in_both & ~F.col("_history").eqNullSafe(F.col("_stored")), 1)).alias("differing"),
        F.count(F.when(F.col("_in_store").isNull(), 1)).alias("missing_in_store"),
        F.count(F.when(F.col("_in_history").isNull(), 1)).alias("missing_in_history"),
    )


def refresh_hot_store(path: str, objects: DataFrame) -> DataFrame:
    """Write the hot objects as a stored table by tenant, entities in order; a repeated refresh replaces it."""
    write_partitioned(objects, path, ["tenant_id"], ["entity_id"])
    return objects.sparkSession.read.schema(objects.schema).parquet(path)


def refresh_current_state(path: str, hot: DataFrame, entities: DataFrame, tenants: DataFrame) -> DataFrame:
    """Write the typed current state as a stored table by tenant."""
    rows = flatten_current_state(hot, entities, tenants)
    write_partitioned(rows, path, ["tenant_id"], ["entity_id"])
    return hot.sparkSession.read.schema(rows.schema).parquet(path)


def flatten_current_state(hot: DataFrame, entities: DataFrame, tenants: DataFrame) -> DataFrame:
    """Hot objects as typed columns, one row per entity. The object is parsed once per row."""
    fields = hot.select(*KEY, "updated_at", jsonfn.as_text_map(F.col("hot_attrs")).alias("_m"))

    def field(name: str, to: str | None = None) -> Column:
        raw = F.element_at("_m", F.lit(name))
        return (raw.try_cast(to) if to else raw).alias(name)

    typed = fields.select(
        *KEY,
        field("status"),
        field("environment"),
        field("priority", "short"),
        field("region"),
        field("datacenter"),
        field("last_seen", "timestamp"),
        field("alert_count", "int"),
        field("error_count", "int"),
        field("uptime_percent", "decimal(5,2)"),
        "updated_at",
    )
    return (
        typed.join(entities.select(*KEY, "entity_type"), KEY)
        .join(tenants.select("tenant_id", "tenant_name"), "tenant_id")
        .select(
            "entity_id", "tenant_id", "tenant_name", "entity_type", "status", "environment",
            "priority", "region", "datacenter", "last_seen", "alert_count", "error_count",
            "uptime_percent", "updated_at",
        )
    )
