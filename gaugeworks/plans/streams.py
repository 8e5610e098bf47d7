"""Streaming queries: the events table is drained as a file stream and the result table is returned."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.plans.entities import (
    CDC_ROW, STATS_SQL, UPSERT_SQL, change_feed_sql, change_messages, entity_versions, hot_deltas, hot_store,
)
from gaugeworks.plans.registry import AS_OF, num, over, query
from gaugeworks.session import work_path
from gaugeworks.sources import cdc as cdc_source
from gaugeworks.sources.model import DriverModel, ShuffledModel
from gaugeworks.streaming import attribute_counts, feed, partials, pipeline, state
from gaugeworks.streaming.snapshots import SnapshotTable


CUTS = ("2024-01-23", "2024-01-16", "2024-01-08")  # the newest part of the events arrives first
ROWS_PER_FILE = 250_000  # of the largest part
FILLED = 10_000  # rows for each file of the smallest part, dealt in turn, so that none stays unwritten


class StreamModel(ShuffledModel):
    """The driver model with the events table as a stream, as it is stored."""

    def read(self, table: str):
        return self.event_stream() if table == "events" else super().read(table)


class PartsModel(ShuffledModel):
    """The driver model with the events as a stream of parts, a micro-batch each: all parts are written as the same
    number of files, which is what a micro-batch takes. Large parts are thus many files, and the micro-batches are the
    same at every size of the table."""

    def conditions(self) -> list[Column]:
        """The rows of each part, in the order in which parts arrive."""
        raise NotImplementedError

    @cached_property
    def parts(self) -> tuple[str, int]:
        folder, events, conditions = work_path(self.spark, "events-in"), DriverModel.read(self, "events"), self.conditions()
        rows = events.agg(*[F.count_if(c) for c in conditions]).first()
        files = max(1, min(max(rows) // ROWS_PER_FILE, min(rows) // FILLED))
        for i, condition in enumerate(conditions):
            events.where(condition).repartition(files).write.parquet(f"{folder}/{i}")
        return folder, files

    def read(self, table: str):
        if table != "events":
            return DriverModel.read(self, table)
        folder, files = self.parts
        reader = self.spark.readStream.schema(DriverModel.read(self, "events").schema)
        return reader.options(maxFilesPerTrigger=str(files), recursiveFileLookup="true").parquet(folder)


class DisorderModel(PartsModel):
    """The events in parts of four days; every fifth event comes with the part after its own."""

    def conditions(self):
        day = F.datediff("ts", F.lit("2024-01-01"))
        part = F.floor(day / 4) + F.when(F.pmod("event_id", F.lit(5)) == 0, 1).otherwise(0)
        part = F.greatest(part, F.lit(0))
        return [part == i for i in range(8)] + [part >= 8]


class LateStreamModel(PartsModel):
    """The events in four parts, newest first."""

    def conditions(self):
        at = F.col("ts")
        cuts = [F.expr(f"TIMESTAMP '{c} 00:00:00+00:00'") for c in CUTS]
        return [at >= cuts[0], *[(at < b) & (at >= a) for b, a in zip(cuts, cuts[1:], strict=False)], at < cuts[-1]]


def _stream(m: DriverModel) -> LateStreamModel:
    return LateStreamModel(m.spark, m.directory)


def _drain(query_handle) -> None:
    query_handle.awaitTermination()


_FACT = f"""SELECT entity_id, tenant_id, attribute_id, tenant_name, entity_type, attribute_name, value,
    {num('value_decimal')} AS value_decimal, ingested_at FROM fact"""
_FACT_COLUMNS = [
    "entity_id", "tenant_id", "attribute_id", "tenant_name", "entity_type", "attribute_name", "value",
    "value_decimal", "ingested_at",
]


@query("d1_stream_enrichment", over("fact", _FACT))
def _enrichment(m):
    s = StreamModel(m.spark, m.directory)
    enriched = pipeline.enrich_stream(
        s.values.drop("value_date"), m.dim_tenants, m.dim_attributes, m.dim_entities
    )
    out = work_path(m.spark, "enriched")
    _drain(
        enriched.select(*_FACT_COLUMNS).writeStream.format("parquet")
        .option("checkpointLocation", work_path(m.spark, "ckpt"))
        .trigger(availableNow=True).start(out)
    )
    return m.spark.read.parquet(out)


class CopiedStreamModel(PartsModel):
    """The events in two parts, newest first, and both once more: four micro-batches."""

    def conditions(self):
        newest = F.col("ts") >= F.expr(f"TIMESTAMP '{CUTS[1]} 00:00:00+00:00'")
        return [newest, ~newest, newest, ~newest]


@query("d2_stream_dedup", over("fact", _FACT))
def _dedup(m):
    """Every reading arrives again in a later micro-batch, older ones after newer ones; the fact holds it once."""
    fact = CopiedStreamModel(m.spark, m.directory).fact.drop("event_id")
    fact_path, audit_path = work_path(m.spark, "fact"), work_path(m.spark, "audit")
    _drain(
        pipeline.start_merge_load(
            fact, fact_path, audit_path, work_path(m.spark, "ckpt"), interval=None
        )
    )
    from gaugeworks.operators.load import read_fact

    return read_fact(m.spark, fact_path).select(*_FACT_COLUMNS)


def _rolled_up(m, rows, rollup):
    """Partial rows of every micro-batch, folded; compacted on the way."""
    table = SnapshotTable(m.spark, work_path(m.spark, "partials"))
    _drain(partials.start_partials(rows, rollup, table, work_path(m.spark, "ckpt"), interval=None, compact_every=3))
    return partials.read_rollup(table, rollup, rows)


query(
    "d3_stream_batches",
    over(
        "fact",
        """SELECT time_bucket(INTERVAL 30 SECOND, ingested_at) AS window_start, tenant_id,
            count(*) AS events FROM fact GROUP BY ALL""",
    ),
)(
    lambda m: _rolled_up(
        m, _stream(m).values, partials.count_rollup("ingested_at", "30 seconds", "window_start", "tenant_id")
    ).drop("entities")
)

_GONE = "event_id % 10 = 0 OR ingested_at < TIMESTAMP '2024-01-03 00:00:00'"


@query("a10_stats_from_deltas", over("fact", STATS_SQL, live=f"SELECT * FROM fact WHERE NOT ({_GONE})"))
def _stats_from_deltas(m):
    """Readings arrive in disorder; then a tenth of them and all of the first days are deleted."""
    table, rollup = SnapshotTable(m.spark, work_path(m.spark, "counts")), attribute_counts.count_rollup()
    history = ShuffledModel(m.spark, m.directory).values
    came, gone = _stream(m).values.withColumn("sign", F.lit(1)), history.where(_GONE).withColumn("sign", F.lit(-1))
    _drain(partials.start_partials(came, rollup, table, work_path(m.spark, "ckpt"), interval=None))
    table.append(rollup.partial(gone), 1_000_000)
    attribute_counts.compact_counts(table)
    live = history.where(f"NOT ({_GONE})")
    return attribute_counts.attribute_stats_of(partials.read_rollup(table, rollup, gone), m.attributes, live)


query(
    "d4_stream_late_routing",
    over(
        "fact",
        f"""SELECT event_id, ingested_at, CASE WHEN ingested_at >= TIMESTAMP '{CUTS[0]}' OR ingested_at >=
            (SELECT max(ingested_at) FROM fact) - INTERVAL 10 MINUTE THEN 'on_time' ELSE 'late' END AS route
        FROM fact""",
    ),
)(lambda m: _routed(m))


def _routed(m):
    """All parts after the first are older than the mark it sets."""
    on_time, late = work_path(m.spark, "on-time"), work_path(m.spark, "late")
    readings = _stream(m).values.select("event_id", "ingested_at")
    _drain(
        pipeline.start_late_routing(
            readings, on_time, late, work_path(m.spark, "marks"), work_path(m.spark, "ckpt"), interval=None
        )
    )
    parts = [m.spark.read.parquet(p).withColumn("route", F.lit(r)) for p, r in ((on_time, "on_time"), (late, "late"))]
    return parts[0].unionByName(parts[1]).drop("epoch")


query(
    "d5_cdc_current_state",
    over(
        "fact",
        """SELECT * FROM (SELECT entity_id, tenant_id, arg_max(attribute_name, ingested_at) AS status,
            CAST(arg_max(value, ingested_at) AS DOUBLE) AS value FROM fact GROUP BY ALL)
        WHERE status <> 'signup'""",
    ),
)(lambda m: _cdc_state(m))


def _cdc_state(m):
    changes = cdc_source.unwrap(cdc_source.parse_changes(change_messages(_stream(m)), CDC_ROW))
    table = state.ChangeLogState(m.spark, work_path(m.spark, "state"), ["entity_id", "tenant_id"])
    _drain(state.start_change_state(changes, table, work_path(m.spark, "ckpt"), interval=None))
    table.compact()
    return table.current()


query(
    "d6_stream_hourly_rollup",
    over(
        "fact",
        f"""SELECT date_trunc('hour', ingested_at) AS hour, tenant_id, attribute_id, attribute_name,
            count(*) AS sample_count, {num('min(value_decimal)')} AS min_value,
            {num('max(value_decimal)')} AS max_value,
            {num('CAST(sum(value_decimal) AS DOUBLE) / count(value_decimal)')} AS avg_value,
            {num('stddev_samp(value_decimal::DOUBLE)')} AS stddev_value FROM fact GROUP BY ALL""",
    ),
)(
    lambda m: partials.attribute_statistics(_rolled_up(m, _stream(m).fact, partials.hourly_rollup())).select(
        "hour", "tenant_id", "attribute_id", "attribute_name", "sample_count", "min_value", "max_value",
        "avg_value", "stddev_value",
    )
)


def _sketched_days(m):
    """Days added up from the hours of the stream, against exact ranks and counts of the readings."""
    hours = _rolled_up(m, _stream(m).fact, partials.hourly_rollup())
    keys = ["date", "tenant_id", "attribute_id"]
    days = partials.attribute_statistics(partials.daily_from_hours(hours))
    fact = ShuffledModel(m.spark, m.directory).fact
    readings = fact.select(F.to_date("ingested_at").alias("date"), *keys[1:], "entity_id", F.col("value_decimal").cast("double").alias("v"))
    # Between the share of values below a percentile and that of values up to it lies the rank asked for.
    joined = readings.join(days, keys)
    close = {}
    for name, p in partials.PERCENTILES.items():
        n = F.count("v")
        below = F.count(F.when(F.col("v") < F.col(f"approx_{name}"), 1)) / n
        upto = F.count(F.when(F.col("v") <= F.col(f"approx_{name}"), 1)) / n
        room = F.lit(partials.RANK_ERROR) + 1 / n
        close[name] = F.when(n > 0, (below <= p + room) & (upto >= p - room))
    entities = F.abs(F.count_distinct("entity_id") / F.max("approx_entities") - 1) <= 0.1
    return joined.groupBy(*keys).agg(
        F.max("sample_count").alias("sample_count"),
        *[c.alias(f"{n}_close") for n, c in close.items()],
        entities.alias("entities_close"),
    )


query(
    "d6_stream_sketches",
    over(
        "fact",
        """SELECT CAST(ingested_at AS DATE) AS date, tenant_id, attribute_id, count(*) AS sample_count,
            CASE WHEN count(value_decimal) > 0 THEN true END AS percentile_50_close,
            CASE WHEN count(value_decimal) > 0 THEN true END AS percentile_95_close,
            CASE WHEN count(value_decimal) > 0 THEN true END AS percentile_99_close,
            true AS entities_close FROM fact GROUP BY ALL""",
    ),
)(_sketched_days)

query(
    "d7_stream_throughput",
    over(
        "fact",
        """SELECT date_trunc('minute', ingested_at) AS minute, tenant_id,
            count(*) AS events_per_minute FROM fact GROUP BY ALL""",
    ),
)(
    lambda m: _rolled_up(
        m, _stream(m).values, partials.count_rollup("ingested_at", "1 minute", "minute", "tenant_id")
    ).select("minute", "tenant_id", F.col("events").alias("events_per_minute"))
)

query(
    "d8_stream_missing",
    over(
        "fact",
        """SELECT source, last_beat, last_beat + INTERVAL 6 HOUR AS missing_at FROM (
            SELECT tenant_name AS source, ingested_at AS last_beat,
                lead(ingested_at) OVER (PARTITION BY tenant_name ORDER BY ingested_at) AS next_beat,
                max(ingested_at) OVER () - INTERVAL 9 DAY AS known
            FROM (SELECT DISTINCT tenant_name, ingested_at FROM fact
                  WHERE attribute_name = 'error' AND entity_type = 'BUILDING'))
        WHERE last_beat + INTERVAL 6 HOUR < coalesce(least(next_beat, known), known)""",
    ),
)(lambda m: _missing(m))


def _missing(m):
    """Errors of one kind of entity as beats of their tenant, in files that overlap in time."""
    fact = DisorderModel(m.spark, m.directory).fact
    beats = fact.where("attribute_name = 'error' AND entity_type = 'BUILDING'")
    beats = beats.select(F.col("tenant_name").alias("source"), F.col("ingested_at").alias("timestamp"))
    out = work_path(m.spark, "missing")
    _drain(
        state.missing_heartbeats(beats, 6 * 3600, "9 days").writeStream.format("parquet")
        .option("checkpointLocation", work_path(m.spark, "ckpt")).trigger(availableNow=True).start(out)
    )
    return m.spark.read.schema("source string, last_beat timestamp, missing_at timestamp").parquet(out)


class DailyModel(LateStreamModel):
    """The same parts, oldest first."""

    def conditions(self):
        return super().conditions()[::-1]


@query("b7_hot_store_stream", UPSERT_SQL)
def _hot_store(m):
    """Deltas in order of time, a micro-batch per part, merged into the buckets they touch."""
    store = hot_store(m)
    deltas = hot_deltas(DailyModel(m.spark, m.directory))
    _drain(
        state.start_hot_upserts(
            deltas, store, work_path(m.spark, "ckpt"), interval=None, vacuum_every=2, as_of=AS_OF
        )
    )
    return store.read()


# Versions up to this moment are released when the stream of the disordered model has been read.
_RELEASED = "(SELECT date_trunc('millisecond', max(ingested_at)) FROM fact) - INTERVAL 9 DAY"


def _buckets(m) -> int:
    """Buckets of some fifty thousand events."""
    return max(8, m.read("events").count() // 50_000)


@query("d9_stream_change_feed", change_feed_sql(f"ingested_at <= {_RELEASED}"))
def _feed(m):
    """Versions of entities in files that overlap in time."""
    out = work_path(m.spark, "feed")
    versions = entity_versions(DisorderModel(m.spark, m.directory))
    _drain(feed.start_change_feed(versions, out, work_path(m.spark, "ckpt"), delay="9 days", interval=None, buckets=_buckets(m)))
    return feed.read_feed(m.spark, out, processed_at=AS_OF)


@query(
    "d9_stream_late_versions",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, ingested_at AS occurred_at FROM (
            SELECT *, max(ingested_at) FILTER (ingested_at <= (SELECT date_trunc('millisecond', max(ingested_at))
                FROM fact)) OVER (PARTITION BY entity_id) AS newest FROM fact)
        WHERE (ingested_at < TIMESTAMP '{CUTS[2]}' AND newest >= TIMESTAMP '{CUTS[2]}')
            OR (ingested_at >= TIMESTAMP '{CUTS[2]}' AND ingested_at < TIMESTAMP '{CUTS[1]}'
                AND newest >= TIMESTAMP '{CUTS[1]}')""",
    ),
)
def _late_versions(m):
    """The two newest files are released together, so versions in the files after them are late where their entity
    has a version released."""
    out = work_path(m.spark, "feed")
    versions = entity_versions(_stream(m))
    _drain(feed.start_change_feed(versions, out, work_path(m.spark, "ckpt"), delay="0 seconds", interval=None, buckets=_buckets(m)))
    return feed.read_late_versions(m.spark, out).drop("hot_attrs")


query(
    "d10_stream_alarm",
    over(
        "fact",
        """SELECT resource, period_start, round(stat, 8) AS stat, stat > 20 AS breach,
            CASE WHEN stat > 20 AND coalesce(any_value(stat) OVER (PARTITION BY resource
                    ORDER BY period_start RANGE BETWEEN INTERVAL 1 HOUR PRECEDING
                    AND INTERVAL 1 HOUR PRECEDING), 0) > 20 THEN 'ALARM' ELSE 'OK' END AS state
        FROM (SELECT tenant_name AS resource, date_trunc('hour', ingested_at) AS period_start,
                max(value::DOUBLE) AS stat FROM fact WHERE attribute_name = 'click' GROUP BY ALL)""",
    ),
)(lambda m: _stream_alarm(m))


def _stream_alarm(m):
    from gaugeworks.operators import monitor

    points = monitor.metric_points(_stream(m).fact)
    stats = _rolled_up(m, points, partials.metric_rollup("click", 3600))
    return monitor.evaluate_alarm(
        stats.select("resource", "period", F.col("Maximum").alias("stat")),
        period_seconds=3600, comparison=">", threshold=20.0, evaluation_periods=2,
    )


def _ingested(m):
    """Ingest files, some of them with broken lines, as a stream: (history path, quarantine path)."""
    from gaugeworks.operators.eav import type_values
    from gaugeworks.sources import ingest

    landing = work_path(m.spark, "landing")
    ingest.write_ingest(m.values.drop("event_id"), f"{landing}/good")
    broken = m.read("events").where("event_type = 'error'")
    broken.select(F.concat(F.lit("broken line "), "event_id").alias("line")).write.text(f"{landing}/bad")
    nameless = m.read("events").where("event_type = 'signup'")
    text = F.concat(F.lit("\\N\t7\t4\tsignup "), "event_id", F.lit("\t\\N\t1.50000\t2024-01-05 10:00:00"))
    nameless.select(text.alias("line")).write.text(f"{landing}/nameless")
    history, quarantine = work_path(m.spark, "history"), work_path(m.spark, "quarantine")

    def load(batch, epoch):
        """Both sinks are keyed by the epoch, so a repeated one writes over itself."""
        typed = type_values(ingest.well_formed(batch), m.attributes)
        typed.write.mode("overwrite").parquet(f"{history}/epoch={epoch}")
        ingest.malformed(batch).write.mode("overwrite").parquet(f"{quarantine}/epoch={epoch}")

    lines = ingest.read_ingest(m.spark, landing, streaming=True, recursiveFileLookup="true")
    _drain(
        lines.writeStream.foreachBatch(load).option("checkpointLocation", work_path(m.spark, "ckpt"))
        .trigger(availableNow=True).start()
    )
    return history, quarantine


query(
    "a2_ingest_stream",
    over(
        "fact",
        f"""SELECT entity_id, tenant_id, attribute_id, value, value_int, {num('value_decimal')} AS value_decimal,
            ingested_at FROM fact""",
    ),
)(
    lambda m: m.spark.read.schema(schemas.STAGED_VALUES).parquet(_ingested(m)[0]).select(
        "entity_id", "tenant_id", "attribute_id", "value", "value_int", "value_decimal", "ingested_at"
    )
)

query(
    "a2_ingest_quarantine",
    """SELECT 'broken line ' || event_id AS line FROM events WHERE event_type = 'error' UNION ALL
    SELECT '\\N' || chr(9) || '7' || chr(9) || '4' || chr(9) || 'signup ' || event_id || chr(9) || '\\N' || chr(9)
        || '1.50000' || chr(9) || '2024-01-05 10:00:00' FROM events WHERE event_type = 'signup'""",
)(lambda m: m.spark.read.schema("line string").parquet(_ingested(m)[1]).select("line"))
