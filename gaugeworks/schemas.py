"""Table schemas. Fixed DDL strings: nothing is inferred from data."""

from __future__ import annotations

# --- operational tables ---------------------------------------------------------------------
TENANTS = "tenant_id long, tenant_name string, created_at timestamp, is_active boolean"
ATTRIBUTES = (
    "attribute_id long, attribute_name string, data_type string, is_indexed boolean, "
    "is_hot boolean, validation_regex string, created_at timestamp, updated_at timestamp"
)
ENTITIES = (
    "entity_id long, tenant_id long, entity_type string, created_at timestamp, "
    "updated_at timestamp, is_deleted boolean, version int"
)
VALUE_COLUMNS = (
    "value string, value_int long, value_decimal decimal(20,5), value_bool boolean, "
    "value_date date, value_timestamp timestamp"
)
VALUES = (
    f"entity_id long, tenant_id long, attribute_id long, {VALUE_COLUMNS}, "
    "ingested_at timestamp, created_at timestamp"
)
STAGED_VALUES = (
    f"entity_id long, tenant_id long, attribute_id long, {VALUE_COLUMNS}, ingested_at timestamp"
)
HOT_STORE = "entity_id long, tenant_id long, hot_attrs string, updated_at timestamp"
HEARTBEATS = "id int, timestamp timestamp, source string"
INGEST_FILE = (
    "entity_id long, tenant_id long, attribute_id long, value string, value_int long, "
    "value_decimal decimal(20,5), ingested_at timestamp"
)

# --- analytic tables ------------------------------------------------------------------------
SCD2_SUFFIX = "valid_from timestamp, valid_to timestamp, is_current boolean"
FACT = (
    "entity_id long, tenant_id long, attribute_id long, tenant_name string, entity_type string, "
    "attribute_name string, attribute_category string, value string, value_int long, "
    "value_decimal decimal(20,5), value_bool boolean, value_timestamp timestamp, "
    "ingested_at timestamp, ingested_date date, ingested_hour short, "
    "ingested_day_of_week short, ingested_week date, ingested_month date, year_month string"
)
STAGED_FACT = f"{FACT}, batch_id string"
LOAD_AUDIT = "batch_id string, loaded_at timestamp, rows_loaded long"

# --- messages -------------------------------------------------------------------------------
METRIC_POINTS = "metric string, resource string, ts timestamp, value double"
FILTER_LIST = "array<struct<attribute_id:string,value:string,operator:string>>"


def columns(ddl: str) -> list[str]:
    """Column names of a DDL string without nested types."""
    names, depth, word = [], 0, ""
    for ch in ddl + ",":
        depth += (ch in "(<") - (ch in ")>")
        if ch == "," and depth == 0:
            names.append(word.split()[0])
            word = ""
        else:
            word += ch
    return names


FACT_COLUMNS = columns(FACT)
EOT = "9999-12-31 23:59:59"  # fixed value: the open end of a dimension version
