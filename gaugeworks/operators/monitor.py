"""Throughput, lag, freshness, alarms and capacity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.relations import asof_backward, ratio, with_total


# --- freshness -----------------------------------------------------------------------------------
def tenant_freshness(
    fact: DataFrame, *, as_of=None, hours: int = 1, tenants: DataFrame | None = None
) -> DataFrame:
    """Lag and label per tenant over the last hours.

    Tenants silent for longer are absent, as in the original; pass ``tenants`` to list them as silent.
    """
    now = timefn.resolve_as_of(as_of)
    keys = ["tenant_id", "tenant_name"]
    seen = (
        timefn.since(fact, now - dt.timedelta(hours=hours))
        .groupBy(*keys)
        .agg(
            F.max("ingested_at").alias("latest_event_time"),
            F.count("*").alias("events_last_hour"),
            F.count_distinct("entity_id").alias("active_entities_last_hour"),
        )
    )
    if tenants is not None:
        seen = tenants.select(*keys).join(seen, keys, "left")
    latest, at = F.col("latest_event_time"), timefn.ts(now)
    minutes = F.col("lag_minutes")
    label = (
        F.when(minutes.isNull(), "silent").when(minutes < 5, "healthy").when(minutes < 15, "degraded")
        .otherwise("stale")
    )
    return (
        seen.withColumn("lag_seconds", timefn.datediff_boundary("second", latest, at))
        .withColumn("lag_minutes", timefn.datediff_boundary("minute", latest, at))
        .withColumn("freshness_status", label)
        .orderBy(F.desc_nulls_first("lag_seconds"), "tenant_id")
    )


# Read path, consistency level, target lag and largest allowed lag in milliseconds.
FRESHNESS_BUDGETS = [
    ("cache", "strong", 0, 100),
    ("primary", "strong", 0, 50),
    ("replica", "eventual", 3_000, 5_000),
    ("stream", "eventual", 30_000, 120_000),
    ("warehouse", "eventual", 300_000, 900_000),
]


def budget_table(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{p}', '{c}', {t}L, {m}L)" for p, c, t, m in FRESHNESS_BUDGETS)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(read_path, consistency, target_lag_ms, max_lag_ms)"
    )


def check_budget(lags: DataFrame) -> DataFrame:
    """Compare measured lags (read_path, lag_ms) with the budget of their read path."""
    lag = F.col("lag_ms")
    return lags.join(budget_table(lags.sparkSession), "read_path").withColumn(
        "budget_status",
        F.when(lag.isNull(), "unknown")
        .when(lag <= F.col("target_lag_ms"), "within_target")
        .when(lag <= F.col("max_lag_ms"), "within_budget")
        .otherwise("exceeded"),
    )


def label_results(
    results: DataFrame, samples: DataFrame, *, consistency: str, cache_hit: bool = False
) -> DataFrame:
    """Attach the freshness label to results (source, served_at, ...).

    The lag is the newest sample (source, served_at, lag_ms) of the same source at or before the result.
    """
    labelled = asof_backward(results, samples, ["source"], "served_at", ["lag_ms"])
    seconds = F.coalesce("lag_ms", F.lit(0)) / F.lit(1000.0)
    return (
        labelled.withColumn("lag_seconds", F.format_string("%.3f", seconds))
        .withColumn("consistency", F.lit(consistency))
        .withColumn("data_timestamp", F.unix_seconds("served_at"))
        .withColumn("cache_hit", F.lit(str(cache_hit).lower()))
    )


# --- heartbeats ------------------------------------------------------------------------------------
def latest_heartbeat(beats: DataFrame) -> DataFrame:
    """Newest heartbeat per source."""
    return beats.groupBy("source").agg(F.max("timestamp").alias("timestamp"))


def retained_heartbeats(beats: DataFrame, *, as_of=None, hours: int = 24) -> DataFrame:
    """Heartbeats of the last hours; older ones have no reader any more."""
    now = timefn.resolve_as_of(as_of)
    return beats.where(F.col("timestamp") >= timefn.ts(now - dt.timedelta(hours=hours)))


def prune_heartbeats(path: str, beats: DataFrame, *, as_of=None, hours: int = 24) -> DataFrame:
    """Store the heartbeats that are retained in a folder of their own; returns them.

    The table is small, as its retention bounds it; readers go on with the folder they have.
    """
    now = timefn.resolve_as_of(as_of)
    kept = retained_heartbeats(beats, as_of=now, hours=hours)
    kept.write.mode("overwrite").parquet(f"{path}/at={now:%Y%m%dT%H%M%S%f}")
    return beats.sparkSession.read.schema(kept.schema).parquet(f"{path}/at={now:%Y%m%dT%H%M%S%f}")


def _lag_label(lag_ms: Column) -> Column:
    return (
        F.when(lag_ms.isNull(), "NO_HEARTBEAT").when(lag_ms > 5000, "CRITICAL").when(lag_ms > 3000, "WARNING")
        .otherwise("OK")
    )


def heartbeat_status(beats: DataFrame, *, as_of=None, source: str = "primary") -> DataFrame:
    """One row: lag of a source in whole milliseconds and its label; -1 without any heartbeat.

    A heartbeat from the future (clock skew) has a negative lag and is OK.
    """
    now = timefn.ts(timefn.resolve_as_of(as_of))
    newest = beats.where(F.col("source") == source).agg(F.max("timestamp").alias("at"))
    lag = F.round((F.unix_micros(now) - F.unix_micros("at")) / F.lit(1000)).cast("long")
    return newest.select(F.coalesce(lag, F.lit(-1)).alias("lag_ms"), _lag_label(lag).alias("status"))


def lagging_sources(beats: DataFrame, *, as_of=None, max_lag_seconds: float = 5) -> DataFrame:
    """Sources whose newest heartbeat is older than the limit."""
    now = timefn.ts(timefn.resolve_as_of(as_of))
    return (
        latest_heartbeat(beats)
        .withColumn("lag_seconds", timefn.epoch_seconds(F.col("timestamp"), now))
        .where(F.col("lag_seconds") > max_lag_seconds)
    )


# --- throughput and staging --------------------------------------------------------------------------
def write_throughput(values: DataFrame, *, as_of=None, minutes: int = 60) -> DataFrame:
    """Events and entities per minute and tenant."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(minutes=minutes)
    return (
        timefn.since(values, start)
        .groupBy(F.date_trunc("minute", "ingested_at").alias("minute"), "tenant_id")
        .agg(
            F.count("*").alias("events_per_minute"),
            F.count_distinct("entity_id").alias("unique_entities"),
        )
        .orderBy(F.desc("minute"), "tenant_id")
    )


def throughput_totals(throughput: DataFrame, *, as_of=None, minutes: int = 5) -> DataFrame:
    """Total and largest tenant's events per minute over the last minutes."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(minutes=minutes)
    return (
        throughput.where(F.col("minute") >= timefn.ts(start))
        .groupBy("minute")
        .agg(
            F.sum("events_per_minute").alias("total_events"),
            F.max("events_per_minute").alias("peak_tenant_events"),
        )
        .orderBy(F.desc("minute"))
    )


def staging_health(
    staging: DataFrame, *, as_of=None, max_rows: int = 1_000_000, max_age_seconds: float = 60
) -> DataFrame:
    """Backlog of the staging table with its alert flags."""
    now = timefn.ts(timefn.resolve_as_of(as_of))
    return (
        staging.agg(
            F.count("*").alias("pending_events"),
            F.min("ingested_at").alias("oldest_event"),
            F.max("ingested_at").alias("newest_event"),
        )
        .withColumn("age_span_seconds", timefn.epoch_seconds(F.col("oldest_event"), F.col("newest_event")))
        .withColumn("backlog_alert", F.col("pending_events") > max_rows)
        .withColumn(
            "age_alert",
            F.coalesce(timefn.epoch_seconds(F.col("oldest_event"), now) > max_age_seconds, F.lit(False)),
        )
    )


def capacity_projection(
    values: DataFrame, *, as_of=None, days: int = 30, horizon_days: int = 90, bytes_per_event: int = 200
) -> DataFrame:
    """Mean, peak and spread of daily events, projected forward."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    daily = (
        timefn.since(values, start)
        .groupBy(F.date_trunc("day", "ingested_at").alias("day"))
        .agg(F.count("*").alias("daily_events"))
    )
    mean = F.avg("daily_events")
    return daily.agg(
        mean.alias("avg_daily_events"),
        F.max("daily_events").alias("peak_daily_events"),
        F.stddev("daily_events").alias("stddev_daily_events"),
        F.round(mean * horizon_days).cast("long").alias("projected_events"),
        F.round(mean * horizon_days * bytes_per_event).cast("long").alias("projected_storage_bytes"),
    )


def daily_activity(values: DataFrame, *, as_of=None, days: int = 30) -> DataFrame:
    """Events, entities and tenants per day: the input of the capacity projection."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    return (
        timefn.since(values, start)
        .groupBy(F.date_trunc("day", "ingested_at").alias("day"), "tenant_id", "entity_id")
        .agg(F.count("*").alias("n"))
        .groupBy("day")
        .agg(
            F.sum("n").alias("daily_events"),
            F.count_distinct("entity_id").alias("daily_entities"),
            F.count_distinct("tenant_id").alias("active_tenants"),
        )
        .orderBy("day")
    )


def tenant_resources(
    values: DataFrame, *, as_of=None, days: int = 7, hot_share: float = 0.4, limit: int = 50
) -> DataFrame:
    """Busiest tenants with their share of the traffic and a hot-tenant flag."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    summed = (
        timefn.since(values, start)
        .groupBy("tenant_id", "entity_id", "attribute_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.length(F.coalesce("value", F.lit("")))).alias("chars"),
            F.min("ingested_at").alias("first"),
            F.max("ingested_at").alias("last"),
        )
    )
    totals = summed.groupBy("tenant_id").agg(
        F.sum("n").alias("total_events"),
        F.count_distinct("entity_id").alias("unique_entities"),
        F.count_distinct("attribute_id").alias("unique_attributes"),
        F.sum("chars").alias("data_size_estimate"),
        F.min("first").alias("first_event"),
        F.max("last").alias("last_event"),
    )
    everything = F.col("_all")
    return (
        with_total(totals, "total_events", "_all")
        .withColumn("traffic_share", F.round(F.col("total_events") / everything, 4))
        .withColumn("hot_tenant", F.col("total_events") > everything * hot_share)
        .drop("_all")
        .orderBy(F.desc("total_events"), "tenant_id")
        .limit(limit)
    )


def health_snapshot(
    staging: DataFrame, values: DataFrame, beats: DataFrame, *, as_of=None, source: str = "primary"
) -> DataFrame:
    """One JSON document: staged rows, events per second over the last minute, heartbeat lag.

    Each figure is an aggregate of its own input, read as a scalar subquery.
    """
    now = timefn.resolve_as_of(as_of)
    at = timefn.ts(now)
    recent = timefn.since(values, now - dt.timedelta(minutes=1))
    newest = F.max(F.unix_micros("timestamp"))
    lag = F.coalesce((F.unix_micros(at) - newest) / F.lit(1000), F.lit(-1.0))
    figures = {
        "staging_rows": staging.agg(F.count("*")),
        "recent_throughput_per_sec": recent.agg(F.floor(F.count("*") / F.lit(60)).cast("long")),
        "replica_lag_ms": beats.where(F.col("source") == source).agg(lag),
    }
    stamp = F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    row = F.struct(stamp, *[df.scalar().alias(name) for name, df in figures.items()])
    return staging.sparkSession.range(1).select(F.to_json(row).alias("health"))


# --- metrics and alarms --------------------------------------------------------------------------------
_STATISTICS = {"Average": F.avg, "Maximum": F.max, "Minimum": F.min, "Sum": F.sum}


def metric_right_sizing(
    points: DataFrame, metric: str, *, as_of=None, days: int = 7, low: float = 40
) -> DataFrame:
    """Hourly mean of a metric per resource, with a flag for resources that could be smaller.

    ``always_low`` holds when every hour of the resource is below the limit.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    hourly = (
        points.where((F.col("metric") == metric) & (F.col("ts") >= timefn.ts(start)))
        .groupBy("resource", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.avg("value").alias("avg_value"))
    )
    peak = F.max("avg_value").over(Window.partitionBy("resource"))  # one row per hour
    return hourly.withColumn("always_low", peak < low).orderBy("resource", F.desc("hour"))


def period_stats(points: DataFrame, *, metric: str, period_seconds: int, statistic: str) -> DataFrame:
    """Statistic of a metric per resource and period (``period`` counts periods since the epoch)."""
    period = F.floor(F.unix_seconds("ts") / F.lit(period_seconds)).cast("long")
    return (
        points.where(F.col("metric") == metric)
        .groupBy("resource", period.alias("period"))
        .agg(_STATISTICS[statistic]("value").alias("stat"))
    )


def evaluate_alarm(
    periods: DataFrame, *, period_seconds: int, comparison: str, threshold: float, evaluation_periods: int
) -> DataFrame:
    """State of an alarm rule per resource and period.

    A period is in ALARM when it and the ``evaluation_periods - 1`` periods before it all breach. A
    period without data does not breach, so a run of breaches is broken by a gap: among breaching
    periods, the one ``n - 1`` rows back must lie exactly ``n - 1`` periods earlier.
    """
    stat = F.col("stat")
    tests = {">": stat > threshold, "<": stat < threshold, ">=": stat >= threshold, "<=": stat <= threshold}
    back = evaluation_periods - 1
    run = Window.partitionBy("resource", "breach").orderBy("period")  # one row per period
    earlier = F.lag("period", back).over(run) if back else F.col("period")
    alarm = F.col("breach") & (F.coalesce(earlier, F.lit(-1)) == F.col("period") - back)
    return (
        periods.withColumn("breach", F.coalesce(tests[comparison], F.lit(False)))
        .withColumn("state", F.when(alarm, "ALARM").otherwise("OK"))
        .select(
            "resource",
            F.timestamp_seconds(F.col("period") * period_seconds).alias("period_start"),
            "stat",
            "breach",
            "state",
        )
    )


def alarm_periods(
    points: DataFrame, *, metric: str, period_seconds: int, statistic: str, comparison: str,
    threshold: float, evaluation_periods: int,
) -> DataFrame:
    """Evaluate an alarm rule over metric points."""
    stats = period_stats(points, metric=metric, period_seconds=period_seconds, statistic=statistic)
    return evaluate_alarm(
        stats, period_seconds=period_seconds, comparison=comparison, threshold=threshold,
        evaluation_periods=evaluation_periods,
    )


# The alarm rules of the platform (metric, period s, statistic, comparison, threshold,
# evaluation periods). Replica lag is in seconds here.
ALARM_RULES = {
    "database_cpu": ("CPUUtilization", 300, "Average", ">", 80.0, 2),
    "database_storage": ("FreeStorageSpace", 300, "Average", "<", 10737418240.0, 1),
    "replica_lag": ("ReplicaLag", 60, "Maximum", ">", 5.0, 2),
    "replica_lag_critical": ("ReplicaLag", 60, "Maximum", ">", 10.0, 1),
    "cache_cpu": ("CacheCPUUtilization", 300, "Average", ">", 75.0, 2),
    "consumer_lag": ("ConsumerLag", 300, "Sum", ">", 50000.0, 3),
}


def alarm_by_rule(points: DataFrame, rule: str) -> DataFrame:
    """Evaluate one of the named rules."""
    metric, period, statistic, comparison, threshold, periods = ALARM_RULES[rule]
    return alarm_periods(
        points, metric=metric, period_seconds=period, statistic=statistic, comparison=comparison,
        threshold=threshold, evaluation_periods=periods,
    )


def cache_hit_rate(requests: DataFrame) -> DataFrame:
    """Hit rate over a request log (column ``hit``) with the 80% target."""
    counted = requests.agg(
        F.count(F.when(F.col("hit"), 1)).alias("hits"), F.count(F.when(~F.col("hit"), 1)).alias("misses")
    )
    rate = ratio(F.col("hits").cast("double"), (F.col("hits") + F.col("misses")).cast("double"))
    return counted.withColumn("hit_rate", rate).withColumn("meets_target", F.col("hit_rate") > 0.8)


def metric_points(fact: DataFrame) -> DataFrame:
    """Fact values as metric points: metric = attribute, resource = tenant."""
    return fact.select(
        F.col("attribute_name").alias("metric"),
        F.col("tenant_name").alias("resource"),
        F.col("ingested_at").alias("ts"),
        F.col("value").try_cast("double").alias("value"),
    )


