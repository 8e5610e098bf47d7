"""Operational reads, usage, monitoring and capacity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import eav, monitor, operational, rollups
from gaugeworks.plans.registry import AS_OF, NOW, num, over, query

# --- hot and cold reads ------------------------------------------------------------------------------
_TAGS = "'[' || array_to_string(list_transform(tags, lambda x: '\"' || x || '\"'), ',') || ']'"


def _hot_document(prefix: str = "") -> str:
    """The document of the hot store, rebuilt in SQL."""
    p = prefix
    return (
        f"""'{{"alert_count":' || {p}alert_count || ',"environment":"' || {p}environment || """
        f"""'","error_count":' || {p}error_count || ',"last_seen":"' || strftime({p}last_seen, """
        f"""'%Y-%m-%d %H:%M:%S.%f') || '","priority":' || {p}priority || ',"region":"' || {p}region || """
        f"""'","status":"' || {p}status || '","tags":' || {_TAGS} || ',"uptime_percent":' || """
        f"""CAST(CAST({p}uptime_percent AS DOUBLE) AS VARCHAR) || '}}'"""
    )


query(
    "c18_hot_filter",
    over(
        "state",
        f"""SELECT entity_id, s.entity_type, s.status, s.environment, s.region,
            CAST(s.priority AS BIGINT) AS priority, {_TAGS} AS tags, s.last_seen AS updated_at
        FROM ent JOIN state s USING (entity_id, tenant_id)
        WHERE s.environment = 'MACHINERY' AND s.status IN ('online', 'warning') AND s.priority >= 8
            AND NOT ent.is_deleted
        ORDER BY s.last_seen DESC, entity_id LIMIT 100""",
    ),
)(
    lambda m: operational.hot_filter(
        m.entities, m.hot_store, pattern={"environment": "MACHINERY"},
        statuses=["online", "warning"], min_priority=8,
    )
)

_DETAIL = {
    "error_text": (2, "value"),
    "click_value": (1, "value_decimal"),
    "click_at": (1, "ingested_at"),
}
query(
    "c19_entity_detail",
    over(
        "state",
        f"""SELECT entity_id, s.entity_type, {_hot_document('s.')} AS hot_attrs, error_text,
            {num('click_value')} AS click_value, click_at
        FROM ent JOIN state s USING (entity_id, tenant_id) LEFT JOIN cold USING (entity_id)
        WHERE NOT ent.is_deleted""",
        cold="""SELECT entity_id, arg_max(value, ingested_at) FILTER (attribute_id = 2) AS error_text,
            arg_max(value_decimal, ingested_at) FILTER (attribute_id = 1) AS click_value,
            max(ingested_at) FILTER (attribute_id = 1) AS click_at
        FROM fact GROUP BY entity_id""",
    ),
)(lambda m: operational.entity_detail(m.entities, m.hot_store, m.values, _DETAIL))


def _hottest(threshold: str) -> str:
    return over(
        "state",
        f"""SELECT entity_id, s.status, {num('v')} AS latest_value, seen_at AS latest_at
        FROM newest JOIN state s USING (entity_id) JOIN ent USING (entity_id)
        WHERE NOT ent.is_deleted ORDER BY v DESC, entity_id LIMIT 50""",
        newest=f"""SELECT entity_id, arg_max(value_decimal, ingested_at) AS v, max(ingested_at) AS seen_at
        FROM fact WHERE attribute_name = 'click' AND ingested_at >= {NOW} - INTERVAL 24 HOUR {threshold}
        GROUP BY entity_id""",
    )


query("c20_hottest_entities", _hottest("AND value_decimal > 100"))(
    lambda m: operational.hottest_entities(m.entities, m.hot_store, m.values, 1, as_of=AS_OF)
)
query("c20_newest_reading", _hottest(""))(
    lambda m: operational.hottest_entities(
        m.entities, m.hot_store, m.values, 1, as_of=AS_OF, threshold=None
    )
)


def _with_categories(m):
    """History with a category row (the entity type) beside every reading."""
    columns = ["entity_id", "tenant_id", "attribute_id", "value", "value_decimal", "ingested_at"]
    categories = m.hot_values.where(F.col("attribute_id") == 8).withColumn(
        "value_decimal", F.lit(None).cast("decimal(20,5)")
    )
    return m.values.select(*columns).unionByName(categories.select(*columns))


_CATEGORY = {
    "cat": """SELECT entity_id, entity_type AS category, count(*) AS copies FROM recent GROUP BY ALL""",
    "samples": """SELECT category, attribute_name, entity_id, value_decimal, copies
        FROM recent JOIN cat USING (entity_id) WHERE value_decimal IS NOT NULL""",
    "repeated": "SELECT *, unnest(range(copies)) AS copy FROM samples",
}
_RECENT = f"SELECT * FROM fact WHERE ingested_at >= {NOW} - INTERVAL 30 DAY"
query(
    "c21_category_metrics",
    over(
        "fact",
        """SELECT category, attribute_name,
            round(sum(value_decimal)::DOUBLE / count(*), 2) AS average_value, count(*) AS sample_count
        FROM repeated GROUP BY ALL HAVING count(*) > 10""",
        recent=_RECENT,
        **_CATEGORY,
    ),
)(
    lambda m: operational.category_metrics(
        _with_categories(m), m.attributes, 8, as_of=AS_OF, min_samples=10
    )
)
query(
    "c22_category_distribution",
    over(
        "fact",
        f"""SELECT category, attribute_name, count(DISTINCT entity_id) AS entity_count,
            round(sum(value_decimal)::DOUBLE / count(*), 6) AS avg_value,
            {num('min(value_decimal)')} AS min_value, {num('max(value_decimal)')} AS max_value,
            {num('quantile_cont(value_decimal::DOUBLE, 0.5)')} AS median,
            {num('quantile_cont(value_decimal::DOUBLE, 0.95)')} AS p95, count(*) AS sample_count
        FROM repeated GROUP BY ALL HAVING count(*) > 10""",
        recent=_RECENT,
        **_CATEGORY,
    ),
)(
    lambda m: operational.category_distribution(
        _with_categories(m), m.attributes, 8, as_of=AS_OF, min_samples=10
    ).withColumn("avg_value", F.round("avg_value", 6))
)

query(
    "c23_entity_growth",
    f"""SELECT day, tenant_id, entity_type, new_entities,
        CAST(sum(new_entities) OVER (PARTITION BY tenant_id, entity_type ORDER BY day) AS BIGINT)
            AS cumulative_total,
        {num('avg(new_entities) OVER (PARTITION BY tenant_id, entity_type ORDER BY day ROWS 6 PRECEDING)')}
            AS moving_avg_7d
    FROM (SELECT date_trunc('day', o_orderdate) AS day, o_orderstatus AS tenant_id,
            o_orderpriority AS entity_type, count(*) AS new_entities
          FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-02' - INTERVAL 90 DAY GROUP BY ALL)""",
)(lambda m: operational.entity_growth(m.order_entities, as_of="2001-08-02"))

# --- attribute usage -----------------------------------------------------------------------------------
_STATS = """SELECT tenant_id, attribute_id, attribute_name,
    count(DISTINCT entity_id) AS distinct_entities, count(*) AS total_values,
    min(ingested_at) AS oldest, max(ingested_at) AS newest FROM fact GROUP BY ALL"""


def _stats(m):
    return m.stored_table(
        "attribute-stats", lambda path: rollups.refresh_attribute_stats(path, m.values, m.attributes)
    )


query(
    "c24_usage_snapshot",
    over(
        "fact",
        f"""SELECT tenant_id, attribute_id, attribute_name, total_values, distinct_entities,
            newest AS newest_update
        FROM s WHERE newest >= {NOW} - INTERVAL 24 HOUR
        ORDER BY total_values DESC, tenant_id, attribute_id LIMIT 50""",
        s=_STATS,
    ),
)(lambda m: operational.usage_snapshot(_stats(m), as_of=AS_OF, hours=24))

query(
    "c25_usage_with_staleness",
    over(
        "fact",
        f"""SELECT tenant_id, attribute_id, attribute_name, total_values, distinct_entities,
            newest AS newest_update, {num('h')} AS hours_stale,
            CASE WHEN h < 1 THEN 'Fresh' WHEN h < 6 THEN 'Slightly Stale' ELSE 'Stale' END AS badge,
            CASE WHEN h > 6 THEN 'critical' WHEN h > 2 THEN 'warning' ELSE 'ok' END AS alert
        FROM (SELECT *, (epoch_us({NOW}) - epoch_us(newest))::DOUBLE / 1000000 / 3600 AS h FROM s)
        ORDER BY total_values DESC, tenant_id, attribute_id LIMIT 50""",
        s=_STATS,
    ),
)(lambda m: operational.usage_with_staleness(_stats(m), as_of=AS_OF))

query(
    "c26_usage_real_time",
    over(
        "fact",
        f"""SELECT tenant_id, attribute_id, count(DISTINCT entity_id) AS distinct_entities,
            count(*) AS total_values
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 7 DAY GROUP BY ALL""",
    ),
)(lambda m: operational.usage_counts(m.values, _stats(m), real_time=True, as_of=AS_OF))
query(
    "c26_usage_cached",
    over("fact", "SELECT tenant_id, attribute_id, distinct_entities, total_values FROM s", s=_STATS),
)(lambda m: operational.usage_counts(m.values, _stats(m), real_time=False))

query(
    "c27_popular_attributes",
    over(
        "fact",
        """SELECT tenant_id, attribute_id, attribute_name, total_values FROM s
        ORDER BY total_values DESC, tenant_id, attribute_id LIMIT 10""",
        s=_STATS,
    ),
)(lambda m: operational.popular_attributes(_stats(m)))

query(
    "c28_latest_value",
    over(
        "fact",
        """SELECT entity_id, attribute_id, value, ingested_at FROM fact
        WHERE tenant_id = 0 AND entity_id = 8 AND attribute_id = 1
        ORDER BY ingested_at DESC LIMIT 1""",
    ),
)(
    lambda m: eav.latest_value(m.values, 0, 8, 1).select(
        "entity_id", "attribute_id", "value", "ingested_at"
    )
)
query(
    "c28_cold_scan",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, {num('value_decimal')} AS value_decimal, ingested_at FROM fact
        WHERE attribute_id = 5 AND tenant_id = 3 AND ingested_at >= {NOW} - INTERVAL 7 DAY
            AND ingested_at < {NOW}""",
    ),
)(
    lambda m: eav.scan_values(m.values, 3, [5], "2024-01-24", "2024-01-31").select(
        "entity_id", "tenant_id", "value_decimal", "ingested_at"
    )
)

query(
    "c29_hot_entity",
    over(
        "state",
        f"""SELECT entity_id, tenant_id, {_hot_document()} AS hot_attrs, last_seen AS updated_at
        FROM state WHERE tenant_id = 0 AND entity_id = 8""",
    ),
)(lambda m: operational.hot_entity(m.hot_store, 0, 8))
query(
    "c29_hot_tenant_scan",
    over(
        "state",
        f"""SELECT entity_id, tenant_id, {_hot_document()} AS hot_attrs, last_seen AS updated_at
        FROM state WHERE tenant_id = 2""",
    ),
)(lambda m: operational.hot_tenant_scan(m.hot_store, 2))
query(
    "c29_hot_containing",
    over(
        "state",
        f"""SELECT entity_id, tenant_id, {_hot_document()} AS hot_attrs, last_seen AS updated_at
        FROM state WHERE status = 'online' AND list_contains(tags, 'error')""",
    ),
)(lambda m: operational.hot_containing(m.hot_store, {"status": "online", "tags": ["error"]}))
query(
    "c29_entities_by_status",
    over(
        "state",
        f"""SELECT entity_id, {_hot_document()} AS hot_attrs FROM state WHERE status = 'online'
        ORDER BY entity_id LIMIT 100""",
    ),
)(lambda m: operational.entities_by_status(m.entities, m.hot_store, "online"))

# --- freshness and heartbeats ----------------------------------------------------------------------------
query(
    "c15_tenant_freshness",
    over(
        "fact",
        f"""SELECT tenant_id, tenant_name, latest_event_time, events_last_hour,
            active_entities_last_hour, date_diff('second', latest_event_time, {NOW}) AS lag_seconds,
            date_diff('minute', latest_event_time, {NOW}) AS lag_minutes,
            CASE WHEN date_diff('minute', latest_event_time, {NOW}) < 5 THEN 'healthy'
                 WHEN date_diff('minute', latest_event_time, {NOW}) < 15 THEN 'degraded'
                 ELSE 'stale' END AS freshness_status
        FROM (SELECT tenant_id, tenant_name, max(ingested_at) AS latest_event_time,
                count(*) AS events_last_hour, count(DISTINCT entity_id) AS active_entities_last_hour
              FROM fact WHERE ingested_at >= {NOW} - INTERVAL 1 HOUR GROUP BY ALL)""",
    ),
)(lambda m: monitor.tenant_freshness(m.fact, as_of=AS_OF))


def _beats(m):
    """Events as heartbeats: the source is the event type."""
    return m.read("events").select(
        F.col("event_id").cast("int").alias("id"), F.col("ts").alias("timestamp"),
        F.col("event_type").alias("source"),
    )


query(
    "a14_latest_heartbeat",
    "SELECT event_type AS source, max(ts) AS timestamp FROM events GROUP BY ALL",
)(lambda m: monitor.latest_heartbeat(_beats(m)))

_BEAT_AT = "2024-01-30 23:57:15"
query(
    "d8_heartbeat_status",
    f"""SELECT coalesce(lag, -1) AS lag_ms, CASE WHEN lag IS NULL THEN 'NO_HEARTBEAT'
            WHEN lag > 5000 THEN 'CRITICAL' WHEN lag > 3000 THEN 'WARNING' ELSE 'OK' END AS status
    FROM (SELECT CAST(round((epoch_us(TIMESTAMP '{_BEAT_AT}') - epoch_us(max(ts))) / 1000.0) AS BIGINT)
            AS lag FROM events WHERE event_type = 'click')""",
)(lambda m: monitor.heartbeat_status(_beats(m), as_of=_BEAT_AT, source="click"))
query(
    "d8_lagging_sources",
    f"""SELECT event_type AS source, max(ts) AS timestamp,
        {num(f"(epoch_us({NOW}) - epoch_us(max(ts))) / 1000000.0")} AS lag_seconds
    FROM events GROUP BY event_type
    HAVING epoch_us({NOW}) - epoch_us(max(ts)) > 200 * 1000000""",
)(lambda m: monitor.lagging_sources(_beats(m), as_of=AS_OF, max_lag_seconds=200))

# --- throughput, staging, capacity ------------------------------------------------------------------------
_MINUTES = f"""SELECT date_trunc('minute', ingested_at) AS minute, tenant_id,
    count(*) AS events_per_minute, count(DISTINCT entity_id) AS unique_entities
    FROM fact WHERE ingested_at >= {NOW} - INTERVAL 1440 MINUTE GROUP BY ALL"""
query("d7_write_throughput", over("fact", _MINUTES))(
    lambda m: monitor.write_throughput(m.values, as_of=AS_OF, minutes=1440)
)
query(
    "d7_throughput_totals",
    over(
        "fact",
        f"""SELECT minute, CAST(sum(events_per_minute) AS BIGINT) AS total_events,
            max(events_per_minute) AS peak_tenant_events
        FROM t WHERE minute >= {NOW} - INTERVAL 600 MINUTE GROUP BY minute""",
        t=_MINUTES,
    ),
)(
    lambda m: monitor.throughput_totals(
        monitor.write_throughput(m.values, as_of=AS_OF, minutes=1440), as_of=AS_OF, minutes=600
    )
)

query(
    "e1_staging_health",
    over(
        "fact",
        f"""SELECT count(*) AS pending_events, min(ingested_at) AS oldest_event,
            max(ingested_at) AS newest_event,
            {num("(epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) / 1000000.0")}
                AS age_span_seconds,
            count(*) > 1000000 AS backlog_alert,
            epoch_us({NOW}) - epoch_us(min(ingested_at)) > 60000000 AS age_alert
        FROM fact""",
    ),
)(lambda m: monitor.staging_health(m.values, as_of=AS_OF))

query(
    "e2_capacity_projection",
    over(
        "fact",
        f"""SELECT {num('avg(n)')} AS avg_daily_events, max(n) AS peak_daily_events,
            {num('stddev_samp(n)')} AS stddev_daily_events,
            CAST(round(avg(n) * 90) AS BIGINT) AS projected_events,
            CAST(round(avg(n) * 90 * 200) AS BIGINT) AS projected_storage_bytes
        FROM (SELECT date_trunc('day', ingested_at) AS day, count(*) AS n FROM fact
              WHERE ingested_at >= {NOW} - INTERVAL 30 DAY GROUP BY ALL)""",
    ),
)(lambda m: monitor.capacity_projection(m.values, as_of=AS_OF))
query(
    "e2_daily_activity",
    over(
        "fact",
        f"""SELECT date_trunc('day', ingested_at) AS day, count(*) AS daily_events,
            count(DISTINCT entity_id) AS daily_entities, count(DISTINCT tenant_id) AS active_tenants
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 30 DAY GROUP BY ALL""",
    ),
)(lambda m: monitor.daily_activity(m.values, as_of=AS_OF))

query(
    "e3_tenant_resources",
    over(
        "fact",
        f"""SELECT *, round(total_events::DOUBLE / sum(total_events) OVER (), 4) AS traffic_share,
            total_events > 0.2 * sum(total_events) OVER () AS hot_tenant
        FROM (SELECT tenant_id, count(*) AS total_events, count(DISTINCT entity_id) AS unique_entities,
                count(DISTINCT attribute_id) AS unique_attributes,
                CAST(sum(length(coalesce(value, ''))) AS BIGINT) AS data_size_estimate,
                min(ingested_at) AS first_event, max(ingested_at) AS last_event
              FROM fact WHERE ingested_at >= {NOW} - INTERVAL 7 DAY GROUP BY ALL)
        ORDER BY total_events DESC, tenant_id LIMIT 50""",
    ),
)(lambda m: monitor.tenant_resources(m.values, as_of=AS_OF, hot_share=0.2))

query(
    "e4_health_snapshot",
    over(
        "fact",
        f"""SELECT '{{"timestamp":"{AS_OF}","staging_rows":' || (SELECT count(*) FROM fact) ||
            ',"recent_throughput_per_sec":' ||
            (SELECT count(*) // 60 FROM fact WHERE ingested_at >= {NOW} - INTERVAL 1 MINUTE) ||
            ',"replica_lag_ms":' ||
            (SELECT coalesce((epoch_us({NOW}) - epoch_us(max(ts))) / 1000.0::DOUBLE, -1) FROM events
             WHERE event_type = 'view') || '}}' AS health""",
    ),
)(lambda m: monitor.health_snapshot(m.values, m.values, _beats(m), as_of=AS_OF, source="view"))

# --- metrics, alarms, labels ---------------------------------------------------------------------------------
query(
    "e5_metric_right_sizing",
    over(
        "fact",
        f"""SELECT resource, hour, {num('avg_value')} AS avg_value,
            max(avg_value) OVER (PARTITION BY resource) < 400 AS always_low
        FROM (SELECT tenant_name AS resource, date_trunc('hour', ingested_at) AS hour,
                avg(value::DOUBLE) AS avg_value
              FROM fact WHERE attribute_name = 'view' AND ingested_at >= {NOW} - INTERVAL 7 DAY
              GROUP BY ALL)""",
    ),
)(
    lambda m: monitor.metric_right_sizing(
        monitor.metric_points(m.fact), "view", as_of=AS_OF, days=7, low=400
    )
)

query(
    "d10_alarm_periods",
    over(
        "fact",
        """SELECT resource, period_start, round(stat, 8) AS stat, breach,
            CASE WHEN breach AND coalesce(before, false) AND coalesce(before2, false) THEN 'ALARM'
                 ELSE 'OK' END AS state
        FROM (SELECT *, any_value(breach) OVER (PARTITION BY resource ORDER BY period_start
                    RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS before,
                any_value(breach) OVER (PARTITION BY resource ORDER BY period_start
                    RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND INTERVAL 2 HOUR PRECEDING) AS before2
              FROM (SELECT tenant_name AS resource, date_trunc('hour', ingested_at) AS period_start,
                        max(value::DOUBLE) AS stat, max(value::DOUBLE) > 20 AS breach
                    FROM fact WHERE attribute_name = 'click' GROUP BY ALL))""",
    ),
)(
    lambda m: monitor.alarm_periods(
        monitor.metric_points(m.fact), metric="click", period_seconds=3600, statistic="Maximum",
        comparison=">", threshold=20.0, evaluation_periods=3,
    )
)


def _results(m):
    return m.fact.where(F.col("attribute_name") == "view").select(
        "event_id", F.col("tenant_name").alias("source"), F.col("ingested_at").alias("served_at")
    )


def _samples(m):
    return m.fact.where(F.col("attribute_name") == "error").select(
        F.col("tenant_name").alias("source"), F.col("ingested_at").alias("served_at"),
        (F.col("value_int") * 100).alias("lag_ms"),
    )


query(
    "d11_label_results",
    over(
        "fact",
        """SELECT event_id, r.source, served_at, lag_ms, format('{:.3f}', coalesce(lag_ms, 0) / 1000.0::DOUBLE)
            AS lag_seconds, 'eventual' AS consistency,
            CAST(floor(epoch_us(served_at) / 1000000) AS BIGINT) AS data_timestamp, 'false' AS cache_hit
        FROM (SELECT event_id, tenant_name AS source, ingested_at AS served_at FROM fact
              WHERE attribute_name = 'view') r
        ASOF LEFT JOIN (SELECT tenant_name AS source, ingested_at AS sampled_at, value_int * 100 AS lag_ms
              FROM fact WHERE attribute_name = 'error') s
        ON r.source = s.source AND r.served_at >= s.sampled_at""",
    ),
)(lambda m: monitor.label_results(_results(m), _samples(m), consistency="eventual"))


def _lags(m):
    """Measured lags per read path: the event type stands for the path."""
    path = F.create_map(*[F.lit(x) for x in (
        "click", "cache", "error", "primary", "purchase", "replica", "signup", "stream", "view", "warehouse"
    )])
    return m.read("events").select(
        "event_id", path[F.col("event_type")].alias("read_path"),
        (F.get_json_object("props", "$.k").cast("long") * 1000).alias("lag_ms"),
    )


query(
    "d12_check_budget",
    """WITH b(event_type, read_path, consistency, target_lag_ms, max_lag_ms) AS (VALUES
        ('click', 'cache', 'strong', 0::BIGINT, 100::BIGINT),
        ('error', 'primary', 'strong', 0, 50), ('purchase', 'replica', 'eventual', 3000, 5000),
        ('signup', 'stream', 'eventual', 30000, 120000),
        ('view', 'warehouse', 'eventual', 300000, 900000)),
    l AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) * 1000 AS lag_ms FROM events)
    SELECT event_id, read_path, lag_ms, consistency, target_lag_ms, max_lag_ms,
        CASE WHEN lag_ms <= target_lag_ms THEN 'within_target' WHEN lag_ms <= max_lag_ms
             THEN 'within_budget' ELSE 'exceeded' END AS budget_status
    FROM l JOIN b USING (event_type)""",
)(lambda m: monitor.check_budget(_lags(m)))

query(
    "e6_cache_hit_rate",
    f"""SELECT hits, misses, {num('hits::DOUBLE / (hits + misses)')} AS hit_rate,
        hits::DOUBLE / (hits + misses) > 0.8 AS meets_target
    FROM (SELECT count(*) FILTER (event_type IN ('click', 'view')) AS hits,
            count(*) FILTER (event_type NOT IN ('click', 'view')) AS misses FROM events)""",
)(
    lambda m: monitor.cache_hit_rate(
        m.read("events").select(F.col("event_type").isin("click", "view").alias("hit"))
    )
)
