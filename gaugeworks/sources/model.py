"""The driver tables seen as a telemetry model (see FIXTURES.md).

A customer is an entity, its market segment the entity type, its region the tenant; an event is one
reading of the attribute named by the event type.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks import schemas
from gaugeworks.functions import jsonfn, timefn
from gaugeworks.operators.enrich import enrich_fact
from gaugeworks.operators.hot import refresh_current_state, refresh_hot_store
from gaugeworks.session import prepare, work_path

_DRIVER_SCHEMAS = {
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    ),
}

# The attribute catalog of the driver data.
# id, name, data type, indexed, hot, pattern, category, unit
ATTRIBUTE_ROWS = [
    (1, "click", "decimal", True, False, None, "performance", "ms"),
    (2, "error", "integer", True, False, r"^\d+(\.\d+)?$", "diagnostic", "code"),
    (3, "purchase", "decimal", True, False, None, "business", "usd"),
    (4, "signup", "boolean", False, False, None, "business", None),
    (5, "view", "decimal", True, False, None, "performance", "ms"),
    (6, "status", "string", True, True, "^(online|warning|offline)$", "state", None),
    (7, "priority", "integer", True, True, r"^\d+$", "state", None),
    (8, "environment", "string", True, True, None, "state", None),
    (9, "region", "string", True, True, None, "state", None),
]


def _sql(value: object) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A table held in the plan itself, so that its true size is known to the join planner."""
    body = ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def status_of(event_type: Column) -> Column:
    """Status an event stands for."""
    return (
        F.when(event_type.isin("click", "view", "purchase"), "online")
        .when(event_type == "signup", "warning")
        .when(event_type == "error", "offline")
    )


# Tables refreshed by this application: by name and folder, from which files, where, of which columns.
_STORED: dict[tuple[str, str, str], tuple[tuple, str, StructType]] = {}


class DriverModel:
    """Telemetry tables over one driver directory; every property is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = prepare(spark)
        self.directory = directory.rstrip("/")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(_DRIVER_SCHEMAS[table]).parquet(
            f"{self.directory}/{table}.parquet"
        )

    def event_stream(self, **options: str) -> DataFrame:
        """The events table as a file stream, be it one file or a folder of parts."""
        reader = self.spark.readStream.schema(_DRIVER_SCHEMAS["events"])
        return reader.options(**options).parquet(f"{self.directory}/events.parquet*")

    # --- dimensions -------------------------------------------------------------------------
    @cached_property
    def attributes(self) -> DataFrame:
        names = [
            "attribute_id", "attribute_name", "data_type", "is_indexed", "is_hot",
            "validation_regex", "attribute_category", "unit",
        ]
        return literal_table(self.spark, ATTRIBUTE_ROWS, names)

    @cached_property
    def tenants(self) -> DataFrame:
        return self.read("region").select(
            F.col("r_regionkey").cast("long").alias("tenant_id"),
            F.col("r_name").alias("tenant_name"),
        )

    @cached_property
    def entities(self) -> DataFrame:
        """entity, tenant, type, deleted flag (accounts deep in debt stand for deleted entities)."""
        nation = self.read("nation")
        return (
            self.read("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("entity_id"),
                F.col("n_regionkey").cast("long").alias("tenant_id"),
                F.col("c_mktsegment").alias("entity_type"),
                (F.col("c_acctbal") < -500).alias("is_deleted"),
            )
        )

    def _as_dimension(self, df: DataFrame) -> DataFrame:
        """A dimension with one open version per key."""
        return df.withColumns(
            {
                "valid_from": F.expr("TIMESTAMP '1970-01-01 00:00:00+00:00'"),
                "valid_to": F.expr(f"TIMESTAMP '{schemas.EOT}+00:00'"),
                "is_current": F.lit(True),
            }
        )

    @cached_property
    def dim_tenants(self) -> DataFrame:
        return self._as_dimension(self.tenants)

    @cached_property
    def dim_attributes(self) -> DataFrame:
        return self._as_dimension(self.attributes)

    @cached_property
    def dim_entities(self) -> DataFrame:
        return self._as_dimension(self.entities.drop("is_deleted"))

    # --- readings ---------------------------------------------------------------------------
    @staticmethod
    def readings(events: DataFrame) -> DataFrame:
        """Event rows as untyped readings (entity, attribute name, text value, time)."""
        return events.select(
            "event_id",
            F.col("user_id").alias("entity_id"),
            F.col("event_type").alias("attribute_name"),
            F.col("value").cast("string").alias("value"),
            F.when(
                F.col("event_type") == "error", F.get_json_object("props", "$.k").cast("long")
            ).alias("value_int"),
            F.when(
                F.col("event_type").isin("click", "purchase", "view"),
                F.col("value").cast("decimal(20,5)"),
            ).alias("value_decimal"),
            F.when(F.col("event_type") == "signup", F.col("value") > 50).alias("value_bool"),
            F.lit(None).cast("date").alias("value_date"),
            F.lit(None).cast("timestamp").alias("value_timestamp"),
            F.col("ts").alias("ingested_at"),
        )

    def owners(self) -> DataFrame:
        """Nation and type of every entity, the side that ``owned`` looks up."""
        return self.read("customer").select(
            F.col("c_custkey").alias("entity_id"), "c_nationkey", F.col("c_mktsegment").alias("entity_type")
        )

    def owned(self, rows: DataFrame, names: bool = True) -> DataFrame:
        """Add tenant and type of the entity to rows with an entity_id.

        Every dimension joins as a plain scan, so the planner sees its true size: nation and region are
        always broadcast, the customers only while they are small.
        """
        customer = self.owners()
        nation = self.read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("long").alias("tenant_id")
        )
        placed = rows.join(customer, "entity_id").join(nation, "c_nationkey").drop("c_nationkey")
        return placed.join(self.tenants, "tenant_id") if names else placed

    def values_of(self, events: DataFrame) -> DataFrame:
        """History rows: readings with tenant and attribute ids."""
        catalog = self.attributes.select("attribute_id", "attribute_name")
        typed = self.readings(events).join(catalog, "attribute_name")
        return self.owned(typed, names=False).select(
            "event_id", *schemas.columns(schemas.STAGED_VALUES)
        )

    @cached_property
    def values(self) -> DataFrame:
        return self.values_of(self.read("events"))

    def fact_of(self, events: DataFrame) -> DataFrame:
        """Fact rows in one pass over the readings: each dimension is joined once."""
        catalog = self.attributes.select("attribute_id", "attribute_name", "attribute_category")
        return (
            self.owned(self.readings(events).join(catalog, "attribute_name"))
            .withColumns(timefn.derived_time_columns(F.col("ingested_at")))
            .select("event_id", *schemas.FACT_COLUMNS)
        )

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_of(self.read("events"))

    @cached_property
    def enriched(self) -> DataFrame:
        """The same rows through the general enrichment operator."""
        return enrich_fact(
            self.values.drop("value_date"), self.dim_tenants, self.dim_attributes, self.dim_entities
        )

    @cached_property
    def status_fact(self) -> DataFrame:
        """Every event read as a status change of its entity."""
        return self.fact.withColumn("value", status_of(F.col("attribute_name"))).withColumn(
            "attribute_name", F.lit("status")
        )

    @cached_property
    def hot_values(self) -> DataFrame:
        """Hot attributes as history rows: four readings per event."""
        pairs = F.array(
            F.struct(F.lit(6).cast("long").alias("attribute_id"),
                     status_of(F.col("event_type")).alias("value")),
            F.struct(F.lit(7).cast("long").alias("attribute_id"),
                     F.get_json_object("props", "$.k").alias("value")),
            F.struct(F.lit(8).cast("long").alias("attribute_id"),
                     F.col("entity_type").alias("value")),
            F.struct(F.lit(9).cast("long").alias("attribute_id"),
                     F.col("tenant_name").alias("value")),
        )
        return (
            self.owned(self.read("events").withColumnRenamed("user_id", "entity_id"))
            .select("entity_id", "tenant_id", F.col("ts").alias("ingested_at"), F.explode(pairs).alias("p"))
            .select("entity_id", "tenant_id", "p.attribute_id", "p.value", "ingested_at")
        )

    # --- current state ----------------------------------------------------------------------
    def input_files(self) -> tuple:
        """Name, size and time of every file of the driver tables, as the file system lists them."""
        context = self.spark.sparkContext
        new_path, conf = context._jvm.org.apache.hadoop.fs.Path, context._jsc.hadoopConfiguration()
        found = []
        for table in sorted(_DRIVER_SCHEMAS):
            for pattern in (f"{self.directory}/{table}.parquet", f"{self.directory}/{table}.parquet/*"):
                path = new_path(pattern)
                for f in path.getFileSystem(conf).globStatus(path) or []:
                    found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return tuple(found)

    def stored_table(self, name: str, refresh: Callable[[str], DataFrame]) -> DataFrame:
        """A table that ``refresh`` has written below a path: written anew whenever the input files are others than
        those it was made from, else read."""
        key, files = (self.spark.sparkContext.applicationId, self.directory, name), self.input_files()
        if key not in _STORED or _STORED[key][0] != files:
            path = work_path(self.spark, name)
            _STORED[key] = (files, path, refresh(path).schema)
        _, path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    @property
    def hot_store(self) -> DataFrame:
        """The stored hot projection, one JSON object per entity."""
        return self.stored_table("hot-store", lambda path: refresh_hot_store(path, self.built_hot_store))

    @cached_property
    def built_hot_store(self) -> DataFrame:
        """One JSON object per entity, built from its newest event and its event totals."""
        per_entity = (
            self.read("events")
            .groupBy(F.col("user_id").alias("entity_id"))
            .agg(
                F.max_by(F.struct("event_type", "props"), F.struct("ts", "event_id")).alias("last"),
                F.max("ts").alias("updated_at"),
                F.count("*").alias("events"),
                F.count(F.when(F.col("event_type") == "error", 1)).alias("alerts"),
                F.count(
                    F.when(
                        (F.col("event_type") == "error")
                        & (F.get_json_object("props", "$.k").cast("int") >= 50), 1,
                    )
                ).alias("errors"),
                F.count(F.when(status_of(F.col("event_type")) == "online", 1)).alias("online"),
                F.array_sort(F.collect_set("event_type")).alias("tags"),
            )
        )
        document = jsonfn.build_object(
            status=status_of(F.col("last.event_type")),
            priority=F.get_json_object("last.props", "$.k").cast("int"),
            environment=F.col("entity_type"),
            region=F.col("tenant_name"),
            tags=F.col("tags"),
            alert_count=F.col("alerts"),
            error_count=F.col("errors"),
            uptime_percent=F.round(F.col("online") * F.lit(100.0) / F.col("events"), 2),
            last_seen=F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        )
        return self.owned(per_entity).select(
            "entity_id", "tenant_id", document.alias("hot_attrs"), "updated_at"
        )

    # --- order based views (growth and cost) ---------------------------------------------------
    @cached_property
    def order_entities(self) -> DataFrame:
        """Orders read as entities with a creation date."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("entity_id"),
            F.col("o_orderstatus").alias("tenant_id"),
            F.col("o_orderpriority").alias("entity_type"),
            F.col("o_orderdate").alias("created_at"),
            F.lit(False).alias("is_deleted"),
        )

    @cached_property
    def order_fact(self) -> DataFrame:
        """Orders read as facts of the ordering customer."""
        at = F.col("o_orderdate")
        return self.read("orders").select(
            F.col("o_custkey").alias("entity_id"),
            F.col("o_orderstatus").alias("tenant_id"),
            F.concat(F.lit("status-"), "o_orderstatus").alias("tenant_name"),
            F.col("o_orderpriority").alias("entity_type"),
            F.substring("o_orderpriority", 1, 1).cast("long").alias("attribute_id"),
            F.col("o_totalprice").cast("decimal(20,2)").cast("string").alias("value"),
            at.alias("ingested_at"),
            *[c.alias(n) for n, c in timefn.derived_time_columns(at).items()],
        )

    @property
    def current_state(self) -> DataFrame:
        """The stored current state, one typed row per entity."""
        return self.stored_table(
            "current-state",
            lambda path: refresh_current_state(path, self.hot_store, self.entities, self.tenants),
        )


class ShuffledModel(DriverModel):
    """The driver model for queries that look customers up again and again, such as a stream in every micro-batch.

    A broadcast passes through the driver each time, and the planner sizes it by the compressed file, which may be a
    small part of the rows. Here the customers are shuffled, so nothing that grows with them reaches the driver.
    """

    def owners(self) -> DataFrame:
        return super().owners().hint("merge")
