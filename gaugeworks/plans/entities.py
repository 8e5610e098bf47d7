"""Readings, hot projection, scoping, loading and dimension queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions import jsonfn, timefn
from gaugeworks.operators import cdc, eav, hot, load, monitor, rollups, scd, scope
from gaugeworks.operators.hotstore import HotStore
from gaugeworks.plans.registry import AS_OF, NOW, num, over, query
from gaugeworks.session import work_path
from gaugeworks.sources import cdc as cdc_source
from gaugeworks.sources.model import status_of

# --- history scans and enrichment ----------------------------------------------------------------
query(
    "a1_scan_values",
    over(
        "fact",
        f"""SELECT entity_id, attribute_id, value, ingested_at FROM fact
        WHERE tenant_id = 1 AND attribute_id IN (1, 5)
            AND ingested_at >= TIMESTAMP '2024-01-10' AND ingested_at < TIMESTAMP '2024-01-25'""",
    ),
)(
    lambda m: eav.scan_values(m.values, 1, [1, 5], "2024-01-10", "2024-01-25").select(
        "entity_id", "attribute_id", "value", "ingested_at"
    )
)

_FACT_SQL = f"""entity_id, tenant_id, attribute_id, tenant_name, entity_type, attribute_name,
    attribute_category, value, value_int, {num('value_decimal')} AS value_decimal, value_bool,
    CAST(NULL AS TIMESTAMP) AS value_timestamp, ingested_at, CAST(ingested_at AS DATE) AS ingested_date,
    CAST(extract('hour' FROM ingested_at) AS BIGINT) AS ingested_hour,
    CAST(extract('dow' FROM ingested_at) AS BIGINT) AS ingested_day_of_week,
    CAST(date_trunc('week', ingested_at) AS DATE) AS ingested_week,
    CAST(date_trunc('month', ingested_at) AS DATE) AS ingested_month,
    strftime(ingested_at, '%Y-%m') AS year_month"""

query("a5_enrich_fact", over("fact", f"SELECT event_id, {_FACT_SQL} FROM fact"))(lambda m: m.enriched)


def _stored_fact(m):
    """Write the fact as the monthly columnar table and read it back with month pruning."""
    path = work_path(m.spark, "fact")
    load.write_fact(m.fact.drop("event_id"), path)
    return timefn.since(load.read_fact(m.spark, path), dt.datetime(2024, 1, 1))


query("a6_write_fact", over("fact", f"SELECT {_FACT_SQL} FROM fact"))(_stored_fact)


def _staging(m):
    """Facts with a batch id per 1000 events; every row is staged twice."""
    batch = F.concat(F.lit("b"), F.floor(F.col("event_id") / 1000).cast("string"))
    staged = m.fact.withColumn("batch_id", batch).drop("event_id")
    return staged.unionByName(staged)


def _audit(m):
    """Batches that begin before January 10 were loaded half an hour ago, the others two hours ago."""
    now = timefn.ts(timefn.resolve_as_of(AS_OF))
    early = F.col("begins") < F.expr("TIMESTAMP '2024-01-10 00:00:00+00:00'")
    loaded = F.when(early, now - F.expr("INTERVAL 30 MINUTES")).otherwise(now - F.expr("INTERVAL 2 HOURS"))
    return (
        _staging(m).groupBy("batch_id").agg(F.min("ingested_at").alias("begins"))
        .select("batch_id", loaded.alias("loaded_at"), F.lit(0).cast("long").alias("rows_loaded"))
    )


_LOADED = {
    "b": "SELECT *, 'b' || (event_id // 1000) AS batch_id FROM fact",
    "open_batches": """SELECT batch_id FROM b GROUP BY batch_id
        HAVING min(ingested_at) >= TIMESTAMP '2024-01-10'""",
}
query(
    "a4_load_fact",
    over("fact", f"SELECT {_FACT_SQL}, batch_id FROM b SEMI JOIN open_batches USING (batch_id)", **_LOADED),
)(lambda m: load.load_fact(_staging(m), _audit(m), as_of=AS_OF).rows)
query(
    "a4_load_audit",
    over(
        "fact",
        f"""SELECT batch_id, {NOW} AS loaded_at, count(*) AS rows_loaded
        FROM b SEMI JOIN open_batches USING (batch_id) GROUP BY batch_id""",
        **_LOADED,
    ),
)(lambda m: load.load_fact(_staging(m), _audit(m), as_of=AS_OF).audit)

_FLUSH = 4000
query(
    "a3_flush_moved",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, attribute_id, value, ingested_at FROM fact
        ORDER BY ingested_at, entity_id LIMIT {_FLUSH}""",
    ),
)(
    lambda m: load.flush_staging(m.values.drop("event_id"), as_of=AS_OF, limit=_FLUSH).moved.select(
        "entity_id", "tenant_id", "attribute_id", "value", "ingested_at"
    )
)
query(
    "a3_flush_remaining",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, attribute_id, value, ingested_at FROM fact
        ORDER BY ingested_at, entity_id OFFSET {_FLUSH}""",
    ),
)(
    lambda m: load.flush_staging(m.values.drop("event_id"), as_of=AS_OF, limit=_FLUSH).remaining.select(
        "entity_id", "tenant_id", "attribute_id", "value", "ingested_at"
    )
)


def _ingest_round_trip(m):
    """Write readings as ingest files and read them back."""
    from gaugeworks.session import work_path
    from gaugeworks.sources import ingest

    path = work_path(m.spark, "ingest")
    ingest.write_ingest(m.values.drop("event_id"), path)
    return ingest.well_formed(ingest.read_ingest(m.spark, path)).select(
        *schemas.columns(schemas.INGEST_FILE)
    )


query(
    "a2_read_ingest",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, attribute_id, value, value_int,
            {num('value_decimal')} AS value_decimal, ingested_at FROM fact""",
    ),
)(_ingest_round_trip)

query(
    "a9_archive_manifest",
    """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS row_count,
        CASE WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN 'archive' ELSE 'keep' END AS action
    FROM orders GROUP BY ALL""",
)(
    lambda m: load.archive_manifest(
        m.order_fact.select("ingested_at", "entity_id"), as_of="2001-07-20", keep_months=12
    )
)


def _archive(m):
    """Archive old order months, then count what is live and what is archived."""
    history = m.order_fact.select("tenant_id", "entity_id", "value", "ingested_at")
    archive = work_path(m.spark, "archive")
    manifest = load.archive_partitions(
        history, archive, work_path(m.spark, "manifest"), as_of="2001-07-20", keep_months=24
    )
    monthly = history.withColumn("year_month", timefn.year_month(F.col("ingested_at")))
    live = load.live_months(monthly, manifest)
    stored = m.spark.read.parquet(archive).select(*live.columns)
    return (
        live.withColumn("place", F.lit("live"))
        .unionByName(stored.withColumn("place", F.lit("archive")))
        .groupBy("place", "year_month")
        .agg(F.count("*").alias("row_count"))
    )


query(
    "a9_archive_partitions",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1999-07-01' THEN 'archive' ELSE 'live' END AS place,
        strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS row_count
    FROM orders GROUP BY ALL""",
)(_archive)


def _archive_again(m):
    """A second run a year later, when the months the first run archived have left live history but for late rows."""
    history = m.order_fact.select("tenant_id", "entity_id", "value", "ingested_at")
    paths = work_path(m.spark, "archive"), work_path(m.spark, "manifest")
    late = F.col("entity_id") % 10 == 0
    load.archive_partitions(history.where(~late), *paths, as_of="2000-07-20", keep_months=24)
    live = history.where((F.col("ingested_at") >= F.expr("TIMESTAMP '1998-07-01 00:00:00+00:00'")) | late)
    return load.archive_partitions(live, *paths, as_of="2001-07-20", keep_months=24)


query(
    "a9_archive_log",
    """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS row_count,
        CASE WHEN o_orderdate < TIMESTAMP '1999-07-01' THEN 'archive' ELSE 'keep' END AS action
    FROM orders GROUP BY ALL""",
)(_archive_again)


def _beats(m):
    return m.fact.select(F.col("tenant_name").alias("source"), F.col("ingested_at").alias("timestamp"))


def _pruned(m):
    kept = monitor.prune_heartbeats(work_path(m.spark, "beats"), _beats(m), as_of="2024-01-20 06:00:00")
    return kept.groupBy("source").agg(F.count("*").alias("beats"), F.min("timestamp").alias("oldest"))


query(
    "a9_heartbeat_retention",
    over(
        "fact",
        """SELECT tenant_name AS source, count(*) AS beats, min(ingested_at) AS oldest FROM fact
        WHERE ingested_at >= TIMESTAMP '2024-01-19 06:00:00' GROUP BY ALL""",
    ),
)(_pruned)

STATS_SQL = """SELECT tenant_id, attribute_id, attribute_name,
    count(DISTINCT entity_id) AS distinct_entities, count(*) AS total_values,
    min(ingested_at) AS oldest, max(ingested_at) AS newest FROM live GROUP BY ALL"""
query("a10_attribute_stats", over("fact", STATS_SQL, live="SELECT * FROM fact"))(
    lambda m: rollups.attribute_stats(m.values, m.attributes)
)

query(
    "a13_payload_entity_list",
    over(
        "ent",
        """SELECT 'entity:list:' || tenant_id || ':' || entity_type AS cache_key,
            entity_id // 10000 AS page, count(*) AS entity_count,
            '[' || string_agg(entity_id, ',' ORDER BY entity_id) || ']' AS payload
        FROM ent GROUP BY tenant_id, entity_type, entity_id // 10000""",
    ),
)(lambda m: rollups.payload_entity_list(m.entities))

query(
    "a13_payload_alert_counts",
    over(
        "fact",
        f"""SELECT 'agg:alert_count:' || tenant_id || ':last_hour' AS cache_key,
            '{{"count":' || count(*) || '}}' AS payload
        FROM fact WHERE attribute_name = 'error' AND ingested_at >= {NOW} - INTERVAL 24 HOUR
        GROUP BY tenant_id""",
    ),
)(lambda m: rollups.payload_alert_counts(m.fact, as_of=AS_OF, hours=24, attribute="error"))

# --- exploding, typing, validating ---------------------------------------------------------------


def _wide(m):
    """Events as wide JSON documents: the reading, and a field no attribute knows."""
    doc = F.to_json(
        F.map_from_arrays(
            F.array("attribute_name", F.lit("trace"), F.lit("entity_id")),
            F.array("value", F.lit("t-1"), F.col("entity_id").cast("string")),
        )
    )
    readings = m.readings(m.read("events")).select("entity_id", "ingested_at", doc.alias("event"))
    return m.owned(readings, names=False).drop("entity_type")


query(
    "b1_explode_event",
    over("fact", "SELECT entity_id, tenant_id, attribute_id, value, ingested_at FROM fact"),
)(lambda m: eav.explode_event(_wide(m), m.attributes))

query(
    "b2_type_values",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, attribute_id, value,
            CASE WHEN attribute_name = 'error' THEN try_cast(v AS BIGINT) END AS value_int,
            {num("CASE WHEN attribute_name IN ('click', 'purchase', 'view') THEN try_cast(v AS DECIMAL(20,5)) END")}
                AS value_decimal,
            CASE WHEN attribute_name = 'signup' THEN v = 'true' END AS value_bool,
            CAST(NULL AS DATE) AS value_date, CAST(NULL AS TIMESTAMP) AS value_timestamp, ingested_at
        FROM (SELECT * REPLACE (CASE WHEN attribute_name = 'error' THEN CAST(value_int AS VARCHAR)
                     WHEN attribute_name = 'signup' THEN CAST(value_bool AS VARCHAR) ELSE value END
                     AS value), value AS raw,
                  CASE WHEN attribute_name = 'error' THEN CAST(value_int AS VARCHAR)
                     WHEN attribute_name = 'signup' THEN CAST(value_bool AS VARCHAR) ELSE value END AS v
              FROM fact)""",
    ),
)(
    lambda m: eav.type_values(
        m.values.select(
            "entity_id", "tenant_id", "attribute_id",
            F.coalesce(F.col("value_int").cast("string"), F.col("value_bool").cast("string"), "value").alias("value"),
            "ingested_at",
        ),
        m.attributes,
    )
)

query(
    "b3_validate_values",
    over(
        "fact",
        """SELECT event_id, attribute_id, value, CASE
            WHEN attribute_name = 'error' AND instr(value, '.') > 0 AND NOT value LIKE '%.0' THEN 'not_integer'
            WHEN attribute_name = 'error' AND instr(value, '.') > 0 THEN 'not_integer'
            WHEN attribute_name = 'signup' THEN 'not_boolean' END AS reason
        FROM fact""",
    ),
)(
    lambda m: eav.validate_values(m.values.select("event_id", "attribute_id", "value"), m.attributes)
)

query(
    "b4_pivot_latest",
    over(
        "fact",
        f"""SELECT tenant_id, entity_id,
            {num("arg_max(value_decimal, ingested_at) FILTER (attribute_id = 1)")} AS click_value,
            arg_max(value_int, ingested_at) FILTER (attribute_id = 2) AS error_code,
            max(ingested_at) FILTER (attribute_id = 1) AS click_at
        FROM fact WHERE attribute_id IN (1, 2) GROUP BY ALL""",
    ),
)(
    lambda m: eav.pivot_latest(
        m.values,
        {"click_value": (1, "value_decimal"), "error_code": (2, "value_int"), "click_at": (1, "ingested_at")},
    )
)

_LATEST_SQL = over(
    "fact",
    f"""SELECT entity_id, tenant_id, attribute_id, attribute_name, value, value_int,
        {num('value_decimal')} AS value_decimal, value_bool, ingested_at
    FROM fact WHERE ingested_at >= {NOW} - INTERVAL 7 DAY
    QUALIFY row_number() OVER (PARTITION BY entity_id, attribute_id ORDER BY ingested_at DESC) = 1""",
)
_LATEST_COLUMNS = [
    "entity_id", "tenant_id", "attribute_id", "attribute_name", "value", "value_int", "value_decimal",
    "value_bool", "ingested_at",
]
for _name in ("b5_latest_per_entity_attribute", "c16_latest_telemetry"):
    query(_name, _LATEST_SQL)(
        lambda m: eav.latest_per_entity_attribute(m.fact.select(*_LATEST_COLUMNS), as_of=AS_OF)
    )

# --- hot projection --------------------------------------------------------------------------------


def _hot_json(status: str, priority: str, environment: str, region: str) -> str:
    return (
        f"""'{{"environment":"' || {environment} || '","priority":' || {priority} || ',"region":"' || """
        f"""{region} || '","status":"' || {status} || '"}}'"""
    )


_HOT_SQL = f"""SELECT entity_id, tenant_id,
    {_hot_json("arg_max(status, ingested_at)", "arg_max(k, ingested_at)", "entity_type", "tenant_name")}
        AS hot_attrs,
    max(ingested_at) AS updated_at
    FROM fact GROUP BY entity_id, tenant_id, entity_type, tenant_name"""
query("b6_build_hot_projection", over("fact", _HOT_SQL))(
    lambda m: hot.build_hot_projection(m.hot_values, m.attributes)
)


def _long_digits(m):
    """Readings of one attribute with more digits than a decimal of ten places holds, spelt in different ways."""
    hot_view = m.attributes.withColumn("is_hot", F.col("attribute_name") == "view")
    spelt = F.concat(F.lit("+0"), "event_id", F.lit("9876543210.1234567890123450"))
    values = m.values.select("entity_id", "tenant_id", "attribute_id", spelt.alias("value"), "ingested_at")
    return hot.build_hot_projection(values, hot_view)


query(
    "b6_hot_digits",
    over(
        "fact",
        """SELECT entity_id, tenant_id, max(ingested_at) AS updated_at,
            '{"view":' || CASE WHEN arg_max(event_id, ingested_at) = 0 THEN '' ELSE
            CAST(arg_max(event_id, ingested_at) AS VARCHAR) END || '9876543210.123456789012345}' AS hot_attrs
        FROM fact WHERE attribute_name = 'view' GROUP BY entity_id, tenant_id""",
    ),
)(_long_digits)


def _static_store(m):
    """A store that holds two attributes of every entity."""
    doc = jsonfn.build_object(environment=F.col("entity_type"), priority=F.lit("unset"))
    return m.entities.select(
        "entity_id", "tenant_id", doc.alias("hot_attrs"),
        F.expr("TIMESTAMP '2023-12-01 00:00:00+00:00'").alias("updated_at"),
    )


def hot_deltas(m):
    """One JSON delta per event; errors also carry their own key."""
    base = {"status": status_of(F.col("event_type")), "priority": F.get_json_object("props", "$.k").cast("int")}
    doc = F.when(
        F.col("event_type") == "error", jsonfn.build_object(**base, last_error=F.col("event_id"))
    ).otherwise(jsonfn.build_object(**base))
    events = m.read("events").select(
        F.col("user_id").alias("entity_id"), doc.alias("delta"), F.col("ts").alias("occurred_at")
    )
    return m.owned(events, names=False).drop("entity_type")


UPSERT_SQL = over(
    "fact",
    f"""SELECT entity_id, ent.tenant_id,
        '{{"environment":"' || ent.entity_type || '"' ||
        coalesce(',"last_error":' || last_error, '') || ',"priority":' ||
        coalesce(CAST(priority AS VARCHAR), '"unset"') ||
        coalesce(',"status":"' || status || '"', '') || '}}' AS hot_attrs,
        CASE WHEN l.entity_id IS NULL THEN TIMESTAMP '2023-12-01' ELSE {NOW} END AS updated_at
    FROM ent LEFT JOIN l USING (entity_id)""",
    l="""SELECT entity_id, arg_max(status, ingested_at) AS status, arg_max(k, ingested_at) AS priority,
        arg_max(event_id, ingested_at) FILTER (attribute_name = 'error') AS last_error
    FROM fact GROUP BY entity_id""",
)
query("b7_upsert_hot", UPSERT_SQL)(lambda m: hot.upsert_hot(_static_store(m), hot_deltas(m), as_of=AS_OF))

_RECONCILE_SQL = over(
    "fact",
    f"""SELECT entity_id, ent.tenant_id,
        CASE WHEN l.entity_id IS NULL THEN '{{"environment":"' || ent.entity_type || '","priority":"unset"}}'
             ELSE {_hot_json('status', 'priority', 'ent.entity_type', 'ent.tenant_name')} END AS hot_attrs,
        CASE WHEN l.entity_id IS NULL THEN TIMESTAMP '2023-12-01' ELSE {NOW} END AS updated_at
    FROM ent LEFT JOIN l USING (entity_id)""",
    l=f"""SELECT entity_id, arg_max(status, ingested_at) AS status, arg_max(k, ingested_at) AS priority
    FROM fact WHERE ingested_at >= {NOW} - INTERVAL 24 HOUR GROUP BY entity_id""",
)
query("b8_reconcile_hot", _RECONCILE_SQL)(
    lambda m: hot.reconcile_hot(m.hot_values, m.attributes, _static_store(m), as_of=AS_OF, hours=24)
)

_BACKFILL_SQL = over(
    "fact",
    f"""SELECT entity_id, ent.tenant_id,
        '{{' || coalesce('"click":' || click || ',', '') || '"environment":"' || ent.entity_type ||
            '","priority":"unset"}}' AS hot_attrs,
        CASE WHEN l.entity_id IS NULL THEN TIMESTAMP '2023-12-01' ELSE {NOW} END AS updated_at
    FROM ent LEFT JOIN l USING (entity_id)""",
    l="""SELECT entity_id, regexp_replace(arg_max(value, ingested_at), '\\.0$', '') AS click
    FROM fact WHERE attribute_name = 'click' GROUP BY entity_id""",
)
query("b9_backfill_hot", _BACKFILL_SQL)(
    lambda m: hot.backfill_hot(m.values, m.attributes, _static_store(m), "click", as_of=AS_OF)
)


def hot_store(m):
    """The static store as a table in eight buckets."""
    store = HotStore(m.spark, work_path(m.spark, "hot-buckets"), buckets=8)
    store.rebuild(_static_store(m))
    return store


def _after(store, change):
    change(store)
    return store.read()


query("b8_reconcile_store", _RECONCILE_SQL)(
    lambda m: _after(hot_store(m), lambda s: s.reconcile(m.hot_values, m.attributes, as_of=AS_OF, hours=24))
)

query("b9_backfill_store", _BACKFILL_SQL)(
    lambda m: _after(hot_store(m), lambda s: s.backfill(m.values, m.attributes, "click", as_of=AS_OF))
)


def _old_store(m):
    """A store some days old: entities without a reading by then hold what the static store has, a third of all
    entities another environment."""
    cutoff = F.expr("TIMESTAMP '2024-01-25 00:00:00+00:00'")
    old = hot.build_hot_projection(m.hot_values.where(F.col("ingested_at") < cutoff), m.attributes)
    deltas = old.select(
        "entity_id", "tenant_id", F.col("hot_attrs").alias("delta"), F.col("updated_at").alias("occurred_at")
    )
    moved = m.entities.where("entity_id % 3 = 0").select(
        "entity_id", "tenant_id", F.lit('{"environment":"moved"}').alias("delta"), cutoff.alias("occurred_at")
    )
    return hot.upsert_hot(_static_store(m), deltas.unionByName(moved), as_of=AS_OF)


query(
    "b10_divergence_report",
    over(
        "fact",
        """SELECT name AS attribute_name, count(*) FILTER (now_v = then_v) AS matching,
            count(*) FILTER (now_v <> then_v) AS differing,
            count(*) FILTER (now_v IS NOT NULL AND then_v IS NULL) AS missing_in_store,
            count(*) FILTER (now_v IS NULL AND then_v IS NOT NULL) AS missing_in_history
        FROM both_sides GROUP BY name""",
        per="""SELECT entity_id, any_value(ent.entity_type) AS kind, any_value(ent.tenant_name) AS place,
            arg_max(status, ingested_at) AS s1, CAST(arg_max(k, ingested_at) AS VARCHAR) AS p1,
            arg_max(status, ingested_at) FILTER (ingested_at < TIMESTAMP '2024-01-25') AS s0,
            CAST(arg_max(k, ingested_at) FILTER (ingested_at < TIMESTAMP '2024-01-25') AS VARCHAR) AS p0
        FROM ent LEFT JOIN fact USING (entity_id) GROUP BY entity_id""",
        both_sides="""SELECT 'status' AS name, s1 AS now_v, s0 AS then_v FROM per
        UNION ALL SELECT 'priority', p1, coalesce(p0, 'unset') FROM per
        UNION ALL SELECT 'environment', CASE WHEN s1 IS NOT NULL THEN kind END,
            CASE WHEN entity_id % 3 = 0 THEN 'moved' ELSE kind END FROM per
        UNION ALL SELECT 'region', CASE WHEN s1 IS NOT NULL THEN place END,
            CASE WHEN s0 IS NOT NULL THEN place END FROM per""",
    ),
)(lambda m: hot.divergence_report(m.hot_values, m.attributes, _old_store(m)))

query(
    "b15_flatten_current_state",
    over(
        "state",
        f"""SELECT entity_id, tenant_id, tenant_name, entity_type, status, environment, priority, region,
            CAST(NULL AS VARCHAR) AS datacenter, last_seen, alert_count, error_count,
            {num('uptime_percent')} AS uptime_percent, last_seen AS updated_at FROM state""",
    ),
)(lambda m: m.current_state)

# --- dimensions ------------------------------------------------------------------------------------


def _status_history(m):
    """Status of an entity over time; the event id settles equal times."""
    return m.status_fact.select(
        "entity_id", "tenant_id", F.col("value").alias("status"), F.col("ingested_at").alias("changed_at")
    )


def _status_dimension(m, until=None):
    history = _status_history(m)
    if until is not None:
        history = history.where(F.col("changed_at") < F.expr(f"TIMESTAMP '{until} 00:00:00+00:00'"))
    return scd.scd2_from_history(
        history, ["entity_id", "tenant_id"], ["status"], "changed_at"
    )


def _versions(until: str | None) -> dict[str, str]:
    bound = f"WHERE ingested_at < TIMESTAMP '{until}'" if until else ""
    return {
        "h": f"""SELECT *, lag(status) OVER (PARTITION BY entity_id ORDER BY ingested_at) AS before
            FROM fact {bound}""",
        "versions": f"""SELECT entity_id, tenant_id, status, ingested_at AS valid_from,
            coalesce(lead(ingested_at) OVER (PARTITION BY entity_id ORDER BY ingested_at),
                     TIMESTAMP '{schemas.EOT}') AS valid_to,
            lead(ingested_at) OVER (PARTITION BY entity_id ORDER BY ingested_at) IS NULL AS is_current
        FROM h WHERE before IS DISTINCT FROM status""",
    }


query("b11_scd2_from_history", over("fact", "SELECT * FROM versions", **_versions(None)))(_status_dimension)

query(
    "b11_scd2_merge",
    over(
        "fact",
        f"""SELECT v.entity_id, v.tenant_id, v.status, v.valid_from,
            CASE WHEN v.is_current AND n.status <> v.status THEN {NOW} ELSE v.valid_to END AS valid_to,
            v.is_current AND NOT coalesce(n.status <> v.status, false) AS is_current
        FROM versions v LEFT JOIN n USING (entity_id)
        UNION ALL
        SELECT n.entity_id, n.tenant_id, n.status, {NOW}, TIMESTAMP '{schemas.EOT}', true
        FROM n LEFT JOIN (SELECT * FROM versions WHERE is_current) v USING (entity_id)
        WHERE v.status IS DISTINCT FROM n.status""",
        **_versions("2024-01-20"),
        n="""SELECT entity_id, tenant_id, arg_max(status, ingested_at) AS status FROM fact
        WHERE ingested_at >= TIMESTAMP '2024-01-20' GROUP BY ALL""",
    ),
)(
    lambda m: scd.scd2_merge(
        _status_dimension(m, "2024-01-20"),
        _status_history(m).where("changed_at >= TIMESTAMP '2024-01-20 00:00:00+00:00'"),
        ["entity_id", "tenant_id"],
        ["status"],
        as_of=AS_OF,
        order=["changed_at"],
    )
)

query(
    "b11_scd2_asof",
    over(
        "fact",
        """SELECT f.event_id, f.entity_id, f.ingested_at, v.status FROM fact f
        ASOF JOIN versions v ON f.entity_id = v.entity_id AND f.ingested_at >= v.valid_from""",
        **_versions(None),
    ),
)(
    lambda m: scd.scd2_asof(
        m.fact.select("event_id", "entity_id", "tenant_id", "ingested_at"),
        _status_dimension(m),
        ["entity_id", "tenant_id"],
        "ingested_at",
        ["status"],
        few_versions=False,  # the status changes with almost every event
    ).drop("tenant_id")
)

# --- scope -----------------------------------------------------------------------------------------
query("b12_tenant_scope", over("fact", "SELECT event_id, entity_id FROM fact WHERE tenant_id = 2"))(
    lambda m: scope.tenant_scope(m.fact, 2).select("event_id", "entity_id")
)
query(
    "b13_bounded_range",
    over("fact", f"SELECT event_id, ingested_at FROM fact WHERE ingested_at >= {NOW} - INTERVAL 7 DAY"),
)(lambda m: scope.bounded_range(m.fact, as_of=AS_OF).select("event_id", "ingested_at"))

query(
    "b14_find_entities",
    over(
        "fact",
        f"""SELECT entity_id FROM fact
        WHERE tenant_id = 1 AND ingested_at >= {NOW} - INTERVAL 30 DAY
            AND ((attribute_id = 2 AND value_int > 60) OR (attribute_id = 4 AND value = '10.5')
                 OR (attribute_id = 2 AND value_int < 0))
        GROUP BY entity_id HAVING count(DISTINCT attribute_id) = 1""",
    ),
)(
    lambda m: scope.find_entities(
        m.values, 1, '[{"attribute_id": 2, "value": "60", "operator": ">"}]', as_of=AS_OF, recent_days=30
    )
)

# --- storage advice --------------------------------------------------------------------------------


def _accesses(m):
    """Every event counts as one read of its attribute; sizes come from the values."""
    per = m.values.groupBy("attribute_id").agg(
        F.count("*").alias("queries"),
        F.max(F.length("value")).alias("bytes_per_entity"),
        F.count_distinct("value").alias("distinct_values"),
    )
    total = per.agg((F.sum("queries") / 4).cast("long")).scalar()
    return per.withColumn("total_queries", total)


query(
    "b16_classify_hot_cold",
    over(
        "fact",
        f"""SELECT attribute_id, queries, bytes_per_entity, distinct_values, total_queries,
            {num('queries::DOUBLE / total_queries')} AS access_share,
            CASE WHEN queries::DOUBLE / total_queries > 0.8 AND distinct_values <= 1300 THEN 'hot'
                 WHEN queries::DOUBLE / total_queries > 0.8 THEN 'cold_too_large'
                 WHEN queries::DOUBLE / total_queries < 0.2 THEN 'cold' ELSE 'keep' END AS storage
        FROM (SELECT attribute_id, count(*) AS queries, max(length(value)) AS bytes_per_entity,
                count(DISTINCT value) AS distinct_values FROM fact GROUP BY ALL),
             (SELECT CAST(floor(count(*) / 4) AS BIGINT) AS total_queries FROM fact)""",
    ),
)(lambda m: eav.classify_hot_cold(_accesses(m), max_cardinality=1300))

query(
    "b17_partition_skew",
    over(
        "ent",
        f"""SELECT partition_no, row_count, {num('round(row_count * 100.0::DOUBLE / sum(row_count) OVER (), 2)')} AS percent
        FROM (SELECT CAST('0x' || substr(md5(CAST(entity_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS partition_no,
            count(*) AS row_count FROM ent GROUP BY 1)""",
    ),
)(lambda m: eav.partition_skew(m.entities))

_JSON_SQL = """SELECT entity_id, status, CAST(priority AS BIGINT) AS priority,
    '[' || array_to_string(list_transform(tags, lambda x: '"' || x || '"'), ',') || ']' AS tags,
    status = 'online' AS is_online, list_contains(tags, 'error') AS tagged_error,
    true AS has_priority, false AS has_datacenter, true AS has_any, false AS has_all,
    '{"a":{"x":1},"priority":' || priority || ',"status":"' || status || '"}' AS merged,
    len(tags) AS tag_count
    FROM state"""


@query("b18_json_tools", over("state", _JSON_SQL))
def _json_tools(m):
    doc = F.col("hot_attrs")
    small = jsonfn.build_object(
        status=jsonfn.text(doc, "status"), priority=jsonfn.number(doc, "priority")
    )
    return m.hot_store.select(
        "entity_id",
        jsonfn.text(doc, "status").alias("status"),
        jsonfn.number(doc, "priority").alias("priority"),
        jsonfn.fragment(doc, "tags").alias("tags"),
        jsonfn.contains(doc, {"status": "online"}).alias("is_online"),
        jsonfn.contains(doc, {"tags": ["error"]}).alias("tagged_error"),
        jsonfn.has_key(doc, "priority").alias("has_priority"),
        jsonfn.has_key(doc, "datacenter").alias("has_datacenter"),
        jsonfn.has_any(doc, ["priority", "datacenter"]).alias("has_any"),
        jsonfn.has_all(doc, ["priority", "datacenter"]).alias("has_all"),
        jsonfn.merge(small, F.lit('{"a": {"x": 1}}')).alias("merged"),
        F.size(F.from_json(jsonfn.fragment(doc, "tags"), "array<string>")).alias("tag_count"),
    )


# --- change events ---------------------------------------------------------------------------------
CDC_ROW = "entity_id long, tenant_id long, status string, value double"


def change_messages(m):
    """Every event as a change of its entity's row; a signup deletes the row."""
    row = F.struct(
        "entity_id", "tenant_id", F.col("event_type").alias("status"), F.col("value").alias("value")
    )
    gone = F.col("event_type") == "signup"
    millis = F.unix_millis("ts")
    source = F.struct(
        F.lit("1").alias("version"), F.lit("postgresql").alias("connector"), F.lit("m").alias("name"),
        millis.alias("ts_ms"), F.lit("m").alias("db"), F.lit("public").alias("schema"),
        F.lit("entity_status").alias("table"), F.col("event_id").alias("lsn"),
    )
    message = F.struct(
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), source.alias("source"),
        F.when(gone, "d").otherwise("u").alias("op"), (millis + 123).alias("ts_ms"),
    )
    owned = m.owned(m.read("events").withColumnRenamed("user_id", "entity_id"), names=False)
    return owned.select(F.to_json(message).alias("value"))


query(
    "a7_read_cdc",
    over(
        "fact",
        """SELECT entity_id, tenant_id, attribute_name AS status, CAST(value AS DOUBLE) AS value,
            CASE WHEN attribute_name = 'signup' THEN 'd' ELSE 'u' END AS op,
            epoch_us(ingested_at) // 1000 AS ts_ms, event_id AS lsn FROM fact""",
    ),
)(lambda m: cdc_source.unwrap(cdc_source.parse_changes(change_messages(m), CDC_ROW)))

query(
    "a8_apply_cdc",
    over(
        "fact",
        """SELECT ent.entity_id, ent.tenant_id, coalesce(l.status, 'new') AS status,
            coalesce(l.value, 0) AS value
        FROM ent LEFT JOIN l USING (entity_id) WHERE l.status IS DISTINCT FROM 'signup'""",
        l="""SELECT entity_id, arg_max(attribute_name, ingested_at) AS status,
            CAST(arg_max(value, ingested_at) AS DOUBLE) AS value FROM fact GROUP BY entity_id""",
    ),
)(
    lambda m: cdc.apply_cdc(
        _first_state(m),
        cdc_source.unwrap(cdc_source.parse_changes(change_messages(m), CDC_ROW)),
        ["entity_id", "tenant_id"],
    ).drop("ts_ms", "lsn")
)


def _first_state(m):
    return m.entities.select(
        "entity_id", "tenant_id", F.lit("new").alias("status"), F.lit(0.0).alias("value"),
        F.lit(0).cast("long").alias("ts_ms"), F.lit(0).cast("long").alias("lsn"),
    )


@query(
    "a8_apply_cdc_out_of_order",
    over(
        "fact",
        """SELECT ent.entity_id, ent.tenant_id, coalesce(l.status, 'new') AS status, coalesce(l.value, 0) AS value
        FROM ent LEFT JOIN l USING (entity_id) WHERE l.status IS DISTINCT FROM 'signup'""",
        l="""SELECT entity_id, arg_max(attribute_name, ingested_at) AS status,
            CAST(arg_max(value, ingested_at) AS DOUBLE) AS value FROM fact GROUP BY entity_id""",
    ),
)
def _late_changes(m):
    """The newest changes are stored first; older ones, deletes among them, arrive afterwards."""
    changes = cdc_source.unwrap(cdc_source.parse_changes(change_messages(m), CDC_ROW))
    state, key = _first_state(m).withColumn("op", F.lit("r")), ["entity_id", "tenant_id"]
    cuts = [F.expr(f"unix_millis(TIMESTAMP '2024-01-{day} 00:00:00+00:00')") for day in ("20", "08")]
    at = F.col("ts_ms")
    for part in (at >= cuts[0], (at < cuts[0]) & (at >= cuts[1]), at < cuts[1]):
        state = cdc.apply_cdc(state, changes.where(part), key)
    return state.where("op <> 'd'").drop("op", "ts_ms", "lsn")


def change_feed_sql(condition: str) -> str:
    """The feed of every entity's versions that meet a condition."""
    return over(
        "fact",
        f"""SELECT 'entity.updated' AS event_type, entity_id, tenant_id,
            '{{' || array_to_string(list_filter([
                CASE WHEN p0 IS DISTINCT FROM k THEN '"priority":{{"old":' ||
                    coalesce('"' || p0 || '"', 'null') || ',"new":"' || k || '"}}' END,
                CASE WHEN s0 IS DISTINCT FROM status THEN '"status":{{"old":' ||
                    coalesce('"' || s0 || '"', 'null') || ',"new":"' || status || '"}}' END],
                lambda x: x IS NOT NULL), ',') || '}}' AS changes,
            ingested_at AS occurred_at, {NOW} AS processed_at,
            {num(f"(epoch_us({NOW}) - epoch_us(ingested_at)) / 1000000.0")} AS lag_seconds
        FROM v WHERE (p0 IS DISTINCT FROM k OR s0 IS DISTINCT FROM status) AND {condition}""",
        v="""SELECT *, lag(k) OVER (PARTITION BY entity_id ORDER BY ingested_at) AS p0,
            lag(status) OVER (PARTITION BY entity_id ORDER BY ingested_at) AS s0 FROM fact""",
    )


def entity_versions(m):
    """Every event as a version of its entity's object."""
    owned = m.owned(m.read("events").withColumnRenamed("user_id", "entity_id"), names=False)
    return owned.select(
        "entity_id", "tenant_id", F.col("ts").alias("occurred_at"),
        jsonfn.build_object(
            status=status_of(F.col("event_type")),
            priority=F.get_json_object("props", "$.k").cast("int"),
        ).alias("hot_attrs"),
    )


query("d9_change_feed", change_feed_sql("true"))(lambda m: cdc.change_feed(entity_versions(m), processed_at=AS_OF))
