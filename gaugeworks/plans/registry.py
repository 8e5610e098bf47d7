"""Registration of queries and helpers for the reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeworks.sources.model import DriverModel

AS_OF = "2024-01-31 00:00:00"  # the moment the event queries look back from
DIGITS = 8  # floats are compared after rounding to this many digits


class Entry(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(model) -> DataFrame`` under a name."""

    def register(fn: Callable[[DriverModel], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return tidy(fn(DriverModel(spark, directory)))

        REGISTRY[name] = Entry(run, sql)
        return fn

    return register


def tidy(df: DataFrame) -> DataFrame:
    """Output types both engines share: long, rounded double, string, boolean, date, timestamp."""
    out = []
    for field in df.schema.fields:
        c = f"`{field.name}`"
        if isinstance(field.dataType, (T.ShortType, T.IntegerType)):
            out.append(f"CAST({c} AS LONG) AS {c}")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            out.append(f"round(CAST({c} AS DOUBLE), {DIGITS}) AS {c}")
        else:
            out.append(c)
    return df.selectExpr(*out)


_VIEWS = {
    "ent": """
        SELECT c_custkey AS entity_id, CAST(n_regionkey AS BIGINT) AS tenant_id, r_name AS tenant_name,
               c_mktsegment AS entity_type, c_acctbal < -500 AS is_deleted
        FROM customer
        JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey""",
    "fact": """
        SELECT event_id, entity_id, tenant_id, tenant_name, entity_type,
               event_type AS attribute_name,
               CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                    WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT) AS attribute_id,
               CASE WHEN event_type IN ('click', 'view') THEN 'performance'
                    WHEN event_type = 'error' THEN 'diagnostic' ELSE 'business' END AS attribute_category,
               CAST(value AS VARCHAR) AS value,
               CASE WHEN event_type = 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS value_int,
               CASE WHEN event_type IN ('click', 'purchase', 'view') THEN CAST(value AS DECIMAL(20,5)) END
                   AS value_decimal,
               CASE WHEN event_type = 'signup' THEN value > 50 END AS value_bool,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k,
               CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 'online'
                    WHEN event_type = 'signup' THEN 'warning' ELSE 'offline' END AS status,
               ts AS ingested_at
        FROM events JOIN ent ON ent.entity_id = user_id""",
    "state": """
        SELECT entity_id, tenant_id, tenant_name, entity_type, arg_max(status, ingested_at) AS status,
               entity_type AS environment, arg_max(k, ingested_at) AS priority, tenant_name AS region,
               max(ingested_at) AS last_seen,
               count(*) FILTER (attribute_name = 'error') AS alert_count,
               count(*) FILTER (attribute_name = 'error' AND k >= 50) AS error_count,
               CAST(round(count(*) FILTER (status = 'online') * 100.0::DOUBLE / count(*), 2)
                    AS DECIMAL(5,2)) AS uptime_percent,
               list_sort(list_distinct(list(attribute_name))) AS tags
        FROM fact GROUP BY ALL""",
}
_NEEDS = {"ent": [], "fact": ["ent"], "state": ["ent", "fact"]}


def over(view: str, select: str, **ctes: str) -> str:
    """SQL over a model view, with further named subqueries in order."""
    names = [*_NEEDS[view], view]
    parts = [f"{n} AS ({_VIEWS[n]})" for n in names] + [f"{n} AS ({body})" for n, body in ctes.items()]
    return f"WITH {', '.join(parts)} {select}"


def num(expression: str) -> str:
    """A float compared after rounding."""
    return f"round(CAST({expression} AS DOUBLE), {DIGITS})"


def exact_round_mean(total: str, count: str, scale: int, digits: int) -> str:
    """Mean of non-negative decimals of a scale, rounded half up in integer arithmetic."""
    step = 10 ** (scale - digits)
    units = f"CAST(({total}) * {10**scale} AS HUGEINT)"
    return (
        f"(CASE WHEN {count} > 0 THEN ((2 * {units} + {count} * {step}) // (2 * {count} * {step}))"
        f"::DOUBLE / {10**digits} END)"
    )


NOW = f"TIMESTAMP '{AS_OF}'"
