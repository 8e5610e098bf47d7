"""Analytic queries: time series, health, statistics, business figures, rollup reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import business, health, rollups, stats, timeseries
from gaugeworks.plans.registry import AS_OF, NOW, exact_round_mean, num, over, query
from gaugeworks.session import work_path


def _percentile(p: float, c: str = "value_decimal") -> str:
    return num(f"quantile_cont(CAST({c} AS DOUBLE), {p})")


# --- time series -------------------------------------------------------------------------------
query(
    "c1_daily_attribute_stats",
    over(
        "fact",
        f"""SELECT date_trunc('day', ingested_at) AS day, tenant_name, entity_type, attribute_category,
            count(DISTINCT entity_id) AS entity_count,
            {num('sum(value_decimal)::DOUBLE / count(value_decimal)')} AS avg_value,
            {num('min(value_decimal)')} AS min_value, {num('max(value_decimal)')} AS max_value,
            {num('stddev_samp(value_decimal::DOUBLE)')} AS stddev_value,
            {_percentile(0.5)} AS median_value, {_percentile(0.95)} AS p95_value
        FROM fact
        WHERE ingested_at >= {NOW} - INTERVAL 6 MONTH AND value_decimal IS NOT NULL
        GROUP BY ALL""",
    ),
)(lambda m: timeseries.daily_attribute_stats(m.fact, as_of=AS_OF))

query(
    "c2_hourly_event_rate",
    over(
        "fact",
        f"""SELECT hour, tenant_name, entity_type, event_count, active_entities,
            {num('mean')} AS moving_avg_24h,
            CASE WHEN event_count > mean * 1.5 THEN 'peak' WHEN event_count < mean * 0.5 THEN 'low'
                 ELSE 'normal' END AS traffic_pattern
        FROM (SELECT *, avg(event_count) OVER (PARTITION BY tenant_name, entity_type ORDER BY hour
                        ROWS 23 PRECEDING) AS mean FROM hourly)""",
        hourly=f"""SELECT date_trunc('hour', ingested_at) AS hour, tenant_name, entity_type,
            count(*) AS event_count, count(DISTINCT entity_id) AS active_entities
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 7 DAY GROUP BY ALL""",
    ),
)(lambda m: timeseries.hourly_event_rate(m.fact, as_of=AS_OF))

query(
    "c3_daily_attribute_distribution",
    over(
        "fact",
        f"""SELECT CAST(ingested_at AS DATE) AS ingested_date, attribute_name, attribute_category,
            count(*) AS total_events, count(DISTINCT entity_id) AS distinct_entities,
            count(DISTINCT tenant_id) AS distinct_tenants, count(value_int) AS int_count,
            count(value_decimal) AS decimal_count, count(value_bool) AS bool_count,
            CAST(0 AS BIGINT) AS timestamp_count, count(value) AS text_count
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 90 DAY
        GROUP BY ALL HAVING count(*) > 5""",
    ),
)(lambda m: timeseries.daily_attribute_distribution(m.fact, as_of=AS_OF, min_events=5))


def _decomposition(series: str) -> str:
    return over(
        "fact",
        f"""SELECT hour, {series}, {num('actual_value')} AS actual_value,
            {num('avg(actual_value) OVER last24')} AS trend_24h,
            {num('actual_value - avg(actual_value) OVER last24')} AS detrended,
            CAST(extract('dow' FROM hour) AS BIGINT) AS day_of_week,
            CAST(extract('hour' FROM hour) AS BIGINT) AS hour_of_day,
            {num('lag(actual_value, 168) OVER ordered')} AS same_hour_last_week
        FROM hourly
        WINDOW ordered AS (PARTITION BY {series} ORDER BY hour),
               last24 AS (PARTITION BY {series} ORDER BY hour ROWS 23 PRECEDING)""",
        hourly=f"""SELECT date_trunc('hour', ingested_at) AS hour, {series},
            sum(value_decimal)::DOUBLE / count(value_decimal) AS actual_value
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 30 DAY AND value_decimal IS NOT NULL
        GROUP BY ALL""",
    )


query("c9_decomposition_by_entity", _decomposition("entity_id, entity_type"))(
    lambda m: timeseries.decompose(m.fact, as_of=AS_OF)
)
query("c9_decomposition_by_tenant", _decomposition("tenant_id"))(
    lambda m: timeseries.decompose(m.fact, as_of=AS_OF, series=["tenant_id"])
)

query(
    "c9_decomposition_dense",
    over(
        "fact",
        f"""SELECT hour, tenant_id, {num('actual_value')} AS actual_value,
            {num('avg(actual_value) OVER (PARTITION BY tenant_id ORDER BY hour ROWS 23 PRECEDING)')}
                AS trend_24h,
            {num('actual_value - avg(actual_value) OVER (PARTITION BY tenant_id ORDER BY hour ROWS 23 PRECEDING)')}
                AS detrended,
            CAST(extract('dow' FROM hour) AS BIGINT) AS day_of_week,
            CAST(extract('hour' FROM hour) AS BIGINT) AS hour_of_day,
            {num('lag(actual_value, 168) OVER (PARTITION BY tenant_id ORDER BY hour)')} AS same_hour_last_week
        FROM filled""",
        hourly=f"""SELECT date_trunc('hour', ingested_at) AS hour, tenant_id,
            sum(value_decimal)::DOUBLE / count(value_decimal) AS actual_value
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 30 DAY AND value_decimal IS NOT NULL
        GROUP BY ALL""",
        grid="""SELECT tenant_id, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour
        FROM hourly GROUP BY tenant_id""",
        filled="SELECT * FROM grid LEFT JOIN hourly USING (tenant_id, hour)",
    ),
)(lambda m: timeseries.decompose(m.fact, as_of=AS_OF, series=["tenant_id"], densify=True))

query(
    "c30_daily_average",
    over(
        "fact",
        f"""SELECT date_trunc('day', ingested_at) AS day,
            {num('sum(value_decimal)::DOUBLE / count(value_decimal)')} AS avg_value,
            count(value_decimal) AS samples
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 6 MONTH AND attribute_name = 'view'
        GROUP BY ALL""",
    ),
)(lambda m: timeseries.daily_average(m.fact, as_of=AS_OF, attribute="view"))

# --- health ------------------------------------------------------------------------------------
query(
    "c4_entity_uptime",
    over(
        "fact",
        """SELECT entity_id, tenant_name, entity_type,
            CAST(sum(CASE WHEN status = 'online' THEN s ELSE 0 END) AS BIGINT) AS online_seconds,
            CAST(sum(CASE WHEN status = 'offline' THEN s ELSE 0 END) AS BIGINT) AS offline_seconds,
            CAST(sum(CASE WHEN status = 'warning' THEN s ELSE 0 END) AS BIGINT) AS warning_seconds,
            CAST(sum(s) AS BIGINT) AS total_seconds,
            round(CAST(sum(CASE WHEN status = 'online' THEN s ELSE 0 END) * 100.0 AS DOUBLE) / sum(s), 2)
                AS uptime_percent,
            count(*) FILTER (status = 'offline') AS downtime_events
        FROM gaps WHERE s IS NOT NULL GROUP BY ALL HAVING sum(s) > 0""",
        gaps=f"""SELECT *, date_diff('second', lag(ingested_at) OVER (PARTITION BY entity_id
            ORDER BY ingested_at), ingested_at) AS s
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 30 DAY""",
    ),
)(lambda m: health.entity_uptime(m.status_fact, as_of=AS_OF))

query(
    "c5_top_alerting_entities",
    over(
        "state",
        f"""SELECT f.entity_id, f.tenant_name, f.entity_type, s.status, s.priority, s.region,
            s.environment, count(*) AS total_alerts,
            count(DISTINCT f.attribute_id) AS distinct_alert_types,
            min(f.ingested_at) AS first_alert_at, max(f.ingested_at) AS latest_alert_at,
            date_diff('minute', min(f.ingested_at), max(f.ingested_at)) AS alert_duration_minutes
        FROM fact f JOIN state s USING (entity_id)
        WHERE f.attribute_name = 'error' AND f.ingested_at >= {NOW} - INTERVAL 24 HOUR
        GROUP BY ALL ORDER BY total_alerts DESC, entity_id LIMIT 100""",
    ),
)(
    lambda m: health.top_alerting_entities(
        m.fact, m.current_state, as_of=AS_OF, attribute="error"
    )
)

query(
    "c6_health_summary",
    over(
        "state",
        f"""SELECT tenant_name, entity_type, region, environment, count(*) AS total_entities,
            count(*) FILTER (status = 'online') AS online_count,
            count(*) FILTER (status = 'offline') AS offline_count,
            count(*) FILTER (status = 'warning') AS warning_count,
            count(*) FILTER (status = 'error') AS error_count,
            round(count(*) FILTER (status = 'online') * 100.0::DOUBLE / count(*), 1) AS online_percent,
            {num('avg(alert_count)')} AS avg_alerts_per_entity, max(alert_count) AS max_alerts,
            {num('sum(uptime_percent)::DOUBLE / count(*)')} AS avg_uptime_percent,
            {num('min(uptime_percent)')} AS min_uptime_percent
        FROM state GROUP BY ALL""",
    ),
)(lambda m: health.health_summary(m.current_state))

query(
    "c17_entity_health",
    over(
        "state",
        f"""SELECT entity_id, tenant_id, tenant_name, entity_type, region, environment, status, priority,
            last_seen, alert_count, error_count, {num('uptime_percent')} AS uptime_percent,
            CASE WHEN status = 'offline' THEN 'critical' WHEN alert_count > 10 OR error_count > 5
                 THEN 'warning' WHEN uptime_percent < 95 THEN 'degraded' ELSE 'healthy' END
                AS health_status,
            last_seen AS updated_at
        FROM state""",
    ),
)(
    lambda m: health.entity_health(
        m.dim_entities.join(m.tenants, "tenant_id").withColumns(
            {"region": F.col("tenant_name"), "environment": F.col("entity_type")}
        ),
        m.current_state,
    )
)

# --- statistics --------------------------------------------------------------------------------
query(
    "c7_attribute_distribution",
    over(
        "fact",
        f"""SELECT attribute_name, attribute_category, entity_type, n AS sample_count,
            entities AS entity_count, mean_value, stddev_value, variance_value, min_value, max_value,
            range_value, median_value, p01, p05, p25, p50, p75, p95, p99, mode_value
        FROM (SELECT attribute_name, attribute_category, entity_type, count(*) AS n,
                count(DISTINCT entity_id) AS entities,
                {num('sum(value_decimal)::DOUBLE / count(*)')} AS mean_value,
                {num('stddev_samp(value_decimal::DOUBLE)')} AS stddev_value,
                {num('var_samp(value_decimal::DOUBLE)')} AS variance_value,
                {num('min(value_decimal)')} AS min_value, {num('max(value_decimal)')} AS max_value,
                {num('max(value_decimal) - min(value_decimal)')} AS range_value,
                {_percentile(0.5)} AS median_value, {_percentile(0.01)} AS p01,
                {_percentile(0.05)} AS p05, {_percentile(0.25)} AS p25, {_percentile(0.5)} AS p50,
                {_percentile(0.75)} AS p75, {_percentile(0.95)} AS p95, {_percentile(0.99)} AS p99
              FROM recent GROUP BY ALL HAVING count(*) > 10)
        JOIN (SELECT attribute_name, entity_type, {num('value_decimal')} AS mode_value
              FROM (SELECT attribute_name, entity_type, value_decimal, count(*) AS c
                    FROM recent GROUP BY ALL)
              QUALIFY row_number() OVER (PARTITION BY attribute_name, entity_type
                                         ORDER BY c DESC, value_decimal) = 1)
        USING (attribute_name, entity_type)""",
        recent=f"""SELECT * FROM fact WHERE ingested_at >= {NOW} - INTERVAL 7 DAY
            AND attribute_category = 'performance' AND value_decimal IS NOT NULL""",
    ),
)(lambda m: stats.attribute_distribution(m.fact, as_of=AS_OF, min_samples=10))


def _correlation(days: int, band: int, minimum: int) -> str:
    return over(
        "fact",
        f"""SELECT a.attribute_name AS attr1_name, b.attribute_name AS attr2_name, count(*) AS pair_count,
            {num('corr(a.v, b.v)')} AS correlation, {num('covar_pop(a.v, b.v)')} AS covariance,
            {num('regr_slope(b.v, a.v)')} AS regression_slope,
            {num('regr_intercept(b.v, a.v)')} AS regression_intercept,
            {num('power(corr(a.v, b.v), 2)')} AS r_squared
        FROM r a JOIN r b ON a.entity_id = b.entity_id AND a.tenant_id = b.tenant_id
            AND abs(date_diff('second', a.ingested_at, b.ingested_at)) < {band}
            AND a.attribute_name < b.attribute_name
        WHERE a.ingested_at >= {NOW} - INTERVAL {days} DAY
        GROUP BY ALL HAVING count(*) > {minimum}""",
        r="""SELECT *, value_decimal::DOUBLE AS v FROM fact
            WHERE attribute_name IN ('click', 'purchase', 'view') AND value_decimal IS NOT NULL""",
    )


query("c8_attribute_correlation", _correlation(7, 3600, 3))(
    lambda m: stats.attribute_correlation(
        m.fact, ["click", "purchase", "view"], as_of=AS_OF, band_seconds=3600, min_pairs=3
    )
)
query("c8_attribute_correlation_month", _correlation(30, 3600, 10))(
    lambda m: stats.attribute_correlation(
        m.fact, ["click", "purchase", "view"], as_of=AS_OF, days=30, band_seconds=3600, min_pairs=10
    )
)

query(
    "c31_baseline_outliers",
    over(
        "fact",
        f"""SELECT attribute_name, entity_type, baseline_mean, baseline_stddev, baseline_median,
            baseline_p99, samples, outliers, recent_mean, recent_median,
            recent_mean > baseline_mean + 3 * baseline_stddev AS mean_alert,
            abs(recent_median - baseline_median) > 0.25 * abs(baseline_median) AS shift_alert
        FROM (SELECT attribute_name, entity_type,
                {num('any_value(b.baseline_mean)')} AS baseline_mean,
                {num('any_value(b.baseline_stddev)')} AS baseline_stddev,
                {num('any_value(b.baseline_median)')} AS baseline_median,
                {num('any_value(b.baseline_p99)')} AS baseline_p99,
                count(*) AS samples, count(*) FILTER (f.value_decimal::DOUBLE > b.baseline_p99) AS outliers,
                {num('avg(f.value_decimal::DOUBLE)')} AS recent_mean,
                {_percentile(0.5, 'f.value_decimal')} AS recent_median
              FROM fact f JOIN b USING (attribute_name, entity_type)
              WHERE f.ingested_at >= {NOW} - INTERVAL 1 DAY AND f.value_decimal IS NOT NULL
              GROUP BY ALL)""",
        b=f"""SELECT attribute_name, entity_type,
            sum(value_decimal)::DOUBLE / count(*) AS baseline_mean,
            stddev_samp(value_decimal::DOUBLE) AS baseline_stddev,
            quantile_cont(value_decimal::DOUBLE, 0.5) AS baseline_median,
            quantile_cont(value_decimal::DOUBLE, 0.99) AS baseline_p99
        FROM fact WHERE value_decimal IS NOT NULL AND ingested_at < {NOW} - INTERVAL 1 DAY
            AND ingested_at >= {NOW} - INTERVAL 8 DAY
        GROUP BY ALL""",
    ),
)(lambda m: stats.baseline_outliers(m.fact, as_of=AS_OF))

# --- business ----------------------------------------------------------------------------------
query(
    "c10_tenant_usage",
    over(
        "fact",
        f"""SELECT tenant_id, tenant_name, count(DISTINCT entity_id) AS total_entities,
            count(DISTINCT entity_id) FILTER (entity_type = 'AUTOMOBILE') AS sensor_count,
            count(DISTINCT entity_id) FILTER (entity_type = 'MACHINERY') AS gateway_count,
            count(*) AS total_events, count(DISTINCT attribute_id) AS distinct_attributes_used,
            CAST(sum(length(value)) AS BIGINT) AS total_text_bytes,
            min(ingested_at) AS earliest_event, max(ingested_at) AS latest_event,
            {num('count(*)::DOUBLE / 30')} AS avg_events_per_day,
            {num('count(*)::DOUBLE / 720')} AS avg_events_per_hour,
            {num('sum(length(value))::DOUBLE / 1024 / 1024')} AS total_text_mb,
            date_diff('hour', min(ingested_at), max(ingested_at)) AS active_hours
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL 30 DAY GROUP BY ALL""",
    ),
)(
    lambda m: business.tenant_usage(
        m.fact, as_of=AS_OF, sensor_type="AUTOMOBILE", gateway_type="MACHINERY"
    )
)

_ORDERS_AT = "2001-07-20 00:00:00"
_ORDERS = """
    WITH f AS (SELECT o_custkey AS entity_id, o_orderstatus AS tenant_id,
            'status-' || o_orderstatus AS tenant_name, o_orderpriority AS entity_type,
            CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS attribute_id,
            CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS value, o_orderdate AS ingested_at
        FROM orders)"""

query(
    "c11_growth_trends",
    f"""{_ORDERS}, daily AS (
            SELECT CAST(ingested_at AS DATE) AS d, tenant_id, tenant_name, entity_type,
                count(DISTINCT entity_id) AS entities, count(*) AS events
            FROM f WHERE ingested_at >= TIMESTAMP '{_ORDERS_AT}' - INTERVAL 90 DAY GROUP BY ALL),
        months AS (
            SELECT tenant_id, tenant_name, entity_type,
                avg(entities) FILTER (d >= DATE '2001-07-01') AS cur,
                avg(entities) FILTER (d >= DATE '2001-06-01' AND d < DATE '2001-07-01') AS prev,
                CAST(sum(events) FILTER (d >= DATE '2001-07-01') AS BIGINT) AS current_month_events,
                CAST(sum(events) FILTER (d >= DATE '2001-06-01' AND d < DATE '2001-07-01') AS BIGINT)
                    AS prev_month_events
            FROM daily GROUP BY ALL)
    SELECT tenant_id, tenant_name, entity_type, {num('cur')} AS current_month_avg_entities,
        {num('prev')} AS prev_month_avg_entities, current_month_events, prev_month_events,
        round((cur / nullif(prev, 0) - 1) * 100, 2) AS mom_growth_percent
    FROM months WHERE cur IS NOT NULL""",
)(lambda m: business.growth_trends(m.order_fact, as_of=_ORDERS_AT))

query(
    "c12_tenant_cost",
    f"""{_ORDERS}, t AS (
            SELECT tenant_id, tenant_name, CAST(date_trunc('month', ingested_at) AS DATE) AS ingested_month,
                count(*) AS event_count, count(DISTINCT entity_id) AS entity_count,
                count(DISTINCT attribute_id) AS attribute_count,
                sum(length(coalesce(value, '')) + 17)::DOUBLE / 1073741824.0::DOUBLE AS gb
            FROM f WHERE ingested_at >= TIMESTAMP '{_ORDERS_AT}' - INTERVAL 3 MONTH GROUP BY ALL)
    SELECT tenant_id, tenant_name, ingested_month, event_count, entity_count, attribute_count,
        {num('gb')} AS storage_gb, {num('gb * 0.023::DOUBLE')} AS storage_cost_usd,
        {num('event_count * 0.000001::DOUBLE')} AS processing_cost_usd,
        {num('gb * 0.023::DOUBLE + event_count * 0.000001::DOUBLE')} AS total_cost_usd
    FROM t""",
)(lambda m: business.tenant_cost(m.order_fact, as_of=_ORDERS_AT))

# --- rollups -----------------------------------------------------------------------------------
_NAMES = {"temperature": "click", "cpu": "view", "memory": "purchase"}


def _mean(attribute: str) -> str:
    only = f"FILTER (attribute_name = '{attribute}')"
    return exact_round_mean(f"sum(value_decimal) {only}", f"count(*) {only}", 5, 2)


def _daily_ctes(days: int) -> dict[str, str]:
    last = f"({NOW} + INTERVAL 1 DAY)"
    first = f"({last} - INTERVAL {days} DAY)"
    return {
        "g": f"""SELECT entity_id, tenant_id, status, ingested_at AS b,
                lag(ingested_at) OVER (PARTITION BY entity_id ORDER BY ingested_at) AS a
            FROM fact WHERE ingested_at < {last}""",
        "d": f"SELECT unnest(generate_series({first}, {last} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day",
        "up": """SELECT entity_id, tenant_id, CAST(day AS DATE) AS date, status,
                date_diff('second', greatest(a, day), least(b, day + INTERVAL 1 DAY)) AS s
            FROM g JOIN d ON a < day + INTERVAL 1 DAY AND b > day WHERE a IS NOT NULL""",
        "spent": """SELECT entity_id, tenant_id, date,
                sum(CASE WHEN status = 'online' THEN s ELSE 0 END) AS on_s,
                sum(CASE WHEN status = 'offline' THEN s ELSE 0 END) AS off_s, sum(s) AS all_s
            FROM up GROUP BY ALL""",
        "m": f"""SELECT entity_id, tenant_id, CAST(ingested_at AS DATE) AS date,
                count(*) AS total_events, count(*) FILTER (attribute_name = 'error') AS total_errors,
                {_mean('click')} AS avg_temperature,
                max(value_decimal) FILTER (attribute_name = 'click') AS max_temperature,
                min(value_decimal) FILTER (attribute_name = 'click') AS min_temperature,
                {_mean('view')} AS avg_cpu_percent, {_mean('purchase')} AS avg_memory_percent
            FROM fact WHERE ingested_at >= {first} AND ingested_at < {last} GROUP BY ALL""",
        "grid": "SELECT ent.*, CAST(day AS DATE) AS date FROM ent CROSS JOIN d",
        "daily": """SELECT grid.entity_id, grid.tenant_id, grid.entity_type, grid.date,
                coalesce(total_events, 0) AS total_events, coalesce(total_errors, 0) AS total_errors,
                m.* EXCLUDE (entity_id, tenant_id, date, total_events, total_errors), CAST(floor(on_s / 60) AS BIGINT) AS uptime_minutes,
                CAST(floor(off_s / 60) AS BIGINT) AS downtime_minutes,
                round(CAST(on_s * 100 AS DOUBLE) / nullif(all_s, 0), 2) AS uptime_percent
            FROM grid LEFT JOIN m USING (entity_id, tenant_id, date)
            LEFT JOIN spent USING (entity_id, tenant_id, date)
            WHERE total_events IS NOT NULL OR all_s IS NOT NULL""",
    }


def _daily(m, days: int):
    status = m.status_fact.select("entity_id", "tenant_id", F.col("value").alias("status"), "ingested_at")
    return rollups.daily_entity_stats(
        m.fact, status, m.entities, as_of=AS_OF, days=days, names=_NAMES
    )


def _status(m):
    return m.status_fact.select("entity_id", "tenant_id", F.col("value").alias("status"), "ingested_at")


def _stored_daily(m):
    return m.stored_table(
        "daily-rollup",
        lambda path: rollups.refresh_daily_entity_stats(
            path, m.fact, _status(m), m.entities, as_of=AS_OF, days=31, names=_NAMES
        ),
    )


def _refreshed_daily(m):
    """All days, then the last two once more: the second refresh changes nothing."""
    path = work_path(m.spark, "daily-rollup")
    for days in (31, 2):
        out = rollups.refresh_daily_entity_stats(
            path, m.fact, _status(m), m.entities, as_of=AS_OF, days=days, names=_NAMES
        )
    return out.drop("entity_type", "max_temperature", "min_temperature", "avg_cpu_percent", "avg_memory_percent", "computed_at")


query(
    "a11_daily_entity_stats",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, entity_type, date, total_events, total_errors,
            {num('avg_temperature')} AS avg_temperature, {num('max_temperature')} AS max_temperature,
            {num('min_temperature')} AS min_temperature, {num('avg_cpu_percent')} AS avg_cpu_percent,
            {num('avg_memory_percent')} AS avg_memory_percent, uptime_minutes, downtime_minutes,
            uptime_percent FROM daily""",
        **_daily_ctes(2),
    ),
)(lambda m: _daily(m, 2).drop("computed_at"))

def _daily_mean(c: str) -> str:
    return exact_round_mean(f"sum(CAST({c} AS DECIMAL(10,2)))", f"count({c})", 2, 2)


query(
    "c13_daily_rollup_read",
    over(
        "fact",
        f"""SELECT date, entity_type, count(DISTINCT entity_id) AS entity_count,
            {_daily_mean('avg_temperature')} AS avg_temp, {_daily_mean('max_temperature')} AS avg_max_temp,
            {_daily_mean('avg_cpu_percent')} AS avg_cpu, {_daily_mean('uptime_percent')} AS avg_uptime_pct,
            CAST(sum(total_errors) AS BIGINT) AS total_errors, min(date) AS start_date,
            max(date) AS end_date
        FROM daily WHERE date >= DATE '2024-01-01' GROUP BY ALL""",
        **_daily_ctes(31),
    ),
)(lambda m: rollups.read_daily_rollup(_stored_daily(m), as_of=AS_OF))

query(
    "a11_daily_entity_refresh",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, date, total_events, total_errors, {num('avg_temperature')} AS avg_temperature,
            uptime_minutes, downtime_minutes, uptime_percent FROM daily""",
        **_daily_ctes(31),
    ),
)(lambda m: _refreshed_daily(m))


def _hourly_ctes(hours: int) -> dict[str, str]:
    def d(e: str) -> str:
        return f"CAST({e} AS DECIMAL(20,5))"

    return {
        "h": f"""SELECT tenant_id, attribute_id, attribute_name, date_trunc('hour', ingested_at) AS hour,
            count(*) AS sample_count, count(DISTINCT entity_id) AS distinct_entities,
            {exact_round_mean('sum(value_decimal)', 'count(value_decimal)', 5, 5)} AS avg_value,
            min(value_decimal) AS min_value, max(value_decimal) AS max_value,
            {d('stddev_samp(value_decimal::DOUBLE)')} AS stddev_value,
            {d('quantile_cont(value_decimal::DOUBLE, 0.5)')} AS percentile_50,
            {d('quantile_cont(value_decimal::DOUBLE, 0.95)')} AS percentile_95,
            {d('quantile_cont(value_decimal::DOUBLE, 0.99)')} AS percentile_99
        FROM fact WHERE ingested_at >= {NOW} - INTERVAL {hours} HOUR GROUP BY ALL"""
    }


_HOURLY_COLUMNS = [
    "avg_value", "min_value", "max_value", "stddev_value", "percentile_50", "percentile_95", "percentile_99",
]

query(
    "a12_hourly_attribute_stats",
    over(
        "fact",
        f"""SELECT tenant_id, attribute_id, attribute_name, hour, sample_count, distinct_entities,
            {', '.join(f'{num(c)} AS {c}' for c in _HOURLY_COLUMNS)} FROM h""",
        **_hourly_ctes(24 * 30),
    ),
)(lambda m: rollups.hourly_attribute_stats(m.fact, as_of=AS_OF, hours=24 * 30).drop("computed_at"))

query(
    "c14_hourly_rollup_read",
    over(
        "fact",
        """SELECT hour, tenant_id, attribute_name, sample_count, distinct_entities,
            round(CAST(avg_value AS DECIMAL(20,5)), 2)::DOUBLE AS avg_value, round(percentile_50, 2)::DOUBLE AS median_value,
            round(percentile_95, 2)::DOUBLE AS p95_value, round(stddev_value, 2)::DOUBLE AS stddev_value,
            CASE WHEN avg_value::DOUBLE > percentile_95::DOUBLE * 1.2::DOUBLE THEN 'high_anomaly'
                 WHEN avg_value::DOUBLE < percentile_50::DOUBLE * 0.5::DOUBLE THEN 'low_anomaly'
                 ELSE 'normal' END AS anomaly_status
        FROM h WHERE attribute_name IN ('click', 'purchase', 'view')""",
        **_hourly_ctes(24),
    ),
)(
    lambda m: rollups.read_hourly_rollup(
        m.stored_table("hourly-rollup", lambda path: rollups.refresh_hourly_attribute_stats(path, m.fact, as_of=AS_OF, hours=24)),
        ["click", "purchase", "view"],
        as_of=AS_OF,
    )
)
