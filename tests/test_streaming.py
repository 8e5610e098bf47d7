"""Streams fed file by file against the batch result."""

import datetime as dt
import json
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeworks.operators import cdc
from gaugeworks.sources import cdc as cdc_source
from gaugeworks.streaming import partials, pipeline, rollups, state
from gaugeworks.streaming.snapshots import SnapshotTable

SCHEMA = "entity_id long, tenant_id long, attribute_id long, value string, ingested_at timestamp"
BASE = dt.datetime(2024, 1, 5, 10, 0, 0)


def _feed(spark, folder, batches, schema=SCHEMA):
    """One parquet file per batch, in order; read back as a stream of one file per micro-batch."""
    for i, data in enumerate(batches):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{i:03d}")
        time.sleep(0.02)
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
        .option("recursiveFileLookup", "true").parquet(str(folder))
    )


def _at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def _drain(df, path, checkpoint, mode="append"):
    q = (
        df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    q.awaitTermination()


def test_duplicates_over_batches_are_dropped(spark, tmp_path):
    batches = [
        [(1, 1, 1, "a", _at(0)), (1, 1, 1, "a", _at(0)), (2, 1, 1, "b", _at(1))],
        [(1, 1, 1, "a", _at(0)), (1, 2, 1, "a", _at(0)), (2, 1, 1, "c", _at(2))],
    ]
    stream = _feed(spark, tmp_path / "in", batches)
    _drain(pipeline.deduplicate(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "entity_id", "tenant_id", "value")
    assert got == [(1, 1, "a"), (1, 2, "a"), (2, 1, "b"), (2, 1, "c")]


def test_late_rows_go_to_the_side_table(spark, tmp_path):
    batches = [
        [(1, 1, 1, "a", _at(0)), (2, 1, 1, "b", _at(3600))],
        [(3, 1, 1, "late", _at(2999)), (4, 1, 1, "edge", _at(3000)), (5, 1, 1, "new", _at(4000))],
        [(6, 1, 1, "late too", _at(3399))],
    ]
    stream = _feed(spark, tmp_path / "in", batches)
    paths = [str(tmp_path / p) for p in ("on", "late", "marks", "ck")]
    pipeline.start_late_routing(stream, *paths, interval=None).awaitTermination()
    assert rows(spark.read.parquet(paths[1]), "entity_id") == [(3,), (6,)]
    assert rows(spark.read.parquet(paths[0]), "entity_id") == [(1,), (2,), (4,), (5,)]


def test_tumbling_counts_equal_batch(spark, tmp_path):
    data = [(i % 7, i % 2, 1, "x", _at(i * 11)) for i in range(200)]
    stream = _feed(spark, tmp_path / "in", [data[:70], data[70:130], data[130:]])
    out = str(tmp_path / "out")
    rollups.start_updates(pipeline.batch_counts(stream), out, str(tmp_path / "ck"), interval=None).awaitTermination()
    got = rollups.read_updates(spark, out, ["window_start", "tenant_id"])
    batch = spark.createDataFrame(data, SCHEMA)
    expected = batch.groupBy(F.window("ingested_at", "30 seconds").alias("w"), "tenant_id").count()
    assert rows(got, "window_start", "tenant_id", "events") == rows(expected, "w.start", "tenant_id", "count")


def _message(entity, status, op, ts_ms, lsn):
    row = {"entity_id": entity, "status": status}
    return json.dumps(
        {"before": row if op == "d" else None, "after": None if op == "d" else row,
         "source": {"ts_ms": ts_ms, "lsn": lsn, "table": "entities"}, "op": op, "ts_ms": ts_ms + 1}
    )


@pytest.mark.parametrize("compact_every", [0, 1])
def test_change_state_survives_disorder_and_compaction(spark, tmp_path, compact_every):
    row = "entity_id long, status string"
    messages = [
        [_message(1, "a", "c", 10, 1), _message(2, "b", "c", 11, 2)],
        [_message(1, "c", "u", 30, 5), _message(2, "b", "d", 25, 4)],
        [_message(1, "old", "u", 20, 3), _message(2, "older", "u", 24, 3), _message(3, "n", "c", 40, 6)],
    ]
    stream = _feed(spark, tmp_path / "in", [[(m,) for m in b] for b in messages], "value string")
    changes = cdc_source.unwrap(cdc_source.parse_changes(stream, row))
    table = state.ChangeLogState(spark, str(tmp_path / "state"), ["entity_id"])
    state.start_change_state(
        changes, table, str(tmp_path / "ck"), interval=None, compact_every=compact_every
    ).awaitTermination()
    assert rows(table.current()) == [(1, "c"), (3, "n")]
    table.compact()
    assert rows(table.current()) == [(1, "c"), (3, "n")]
    everything = spark.createDataFrame([(m,) for b in messages for m in b], "value string")
    flat = cdc_source.unwrap(cdc_source.parse_changes(everything, row))
    start = spark.createDataFrame([], f"{row}, ts_ms long, lsn long")
    assert rows(cdc.apply_cdc(start, flat, ["entity_id"]), "entity_id", "status") == rows(table.current())


def test_fact_load_from_a_restarted_stream_is_exactly_once(spark, tmp_path):
    from gaugeworks.operators.load import read_fact
    from gaugeworks.sources.model import DriverModel

    model = DriverModel(spark, "/root/testdata/sf0.001")
    events = model.read("events")
    parts = [events.where("event_id < 400"), events.where("event_id >= 400")]
    folder = tmp_path / "in"
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{folder}/{i}")
    args = [str(tmp_path / p) for p in ("fact", "audit", "ck")]

    def run():
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(str(folder))
        fact = pipeline.deduplicate(model.fact_of(stream).drop("event_id"))
        pipeline.start_fact_load(fact, *args, interval=None).awaitTermination()

    run()
    run()  # nothing new: the second run loads nothing
    events.where("event_id >= 900").coalesce(1).write.parquet(f"{folder}/2")  # replayed file, all duplicates
    run()
    loaded = read_fact(spark, args[0])
    assert loaded.count() == events.count()
    assert rows(loaded, "entity_id", "ingested_at") == rows(model.fact, "entity_id", "ingested_at")


def test_merge_load_takes_late_and_repeated_rows_once(spark, tmp_path):
    from gaugeworks.operators.load import read_fact
    from gaugeworks.sources.model import DriverModel

    model = DriverModel(spark, "/root/testdata/sf0.001")
    events = model.read("events")
    folder = tmp_path / "in"
    for i, part in enumerate(("ts >= '2024-01-20'", "ts < '2024-01-10'", "ts >= '2024-01-05' AND ts < '2024-01-22'")):
        events.where(part).coalesce(1).write.parquet(f"{folder}/{i}")
        time.sleep(0.02)
    stream = (
        spark.readStream.schema(events.schema).options(recursiveFileLookup="true", maxFilesPerTrigger="1").parquet(str(folder))
    )
    args = [str(tmp_path / p) for p in ("fact", "audit", "ck")]
    pipeline.start_merge_load(model.fact_of(stream).drop("event_id"), *args, interval=None).awaitTermination()
    loaded = read_fact(spark, args[0])
    assert rows(loaded, "entity_id", "ingested_at") == rows(model.fact, "entity_id", "ingested_at")


def test_event_stream_reads_a_file_and_a_folder(spark, tmp_path):
    from gaugeworks.sources.model import DriverModel

    events = DriverModel(spark, "/root/testdata/sf0.001").read("events")
    events.repartition(3).write.parquet(str(tmp_path / "t" / "events.parquet"))
    for k, directory in enumerate(("/root/testdata/sf0.001", str(tmp_path / "t"))):
        out = str(tmp_path / f"out{k}")
        _drain(DriverModel(spark, directory).event_stream().select("event_id"), out, str(tmp_path / f"ck{k}"))
        assert spark.read.parquet(out).count() == events.count()


def test_missing_heartbeat_is_reported(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "source string, timestamp timestamp"
    spark.createDataFrame([("p", BASE), ("p", _at(5))], schema).coalesce(1).write.parquet(f"{folder}/0")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(folder))
    q = (
        state.watch_heartbeats(stream, timeout_ms=300).writeStream.outputMode("update").format("memory")
        .queryName("beats").trigger(processingTime="200 milliseconds").start()
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            seen = rows(spark.table("beats"), "status", "last_beat")
            if len(seen) >= 2:
                break
            time.sleep(0.3)
    finally:
        q.stop()
    assert ("OK", _at(5)) in seen and ("NO_HEARTBEAT", _at(5)) in seen


BEATS = "source string, timestamp timestamp"


def _silences(stream, tmp_path, **options):
    out = str(tmp_path / "out")
    _drain(state.missing_heartbeats(stream, **options), out, str(tmp_path / "ck"))
    return rows(stream.sparkSession.read.schema(state._GAPS).parquet(out))


def test_silences_are_told_in_event_time(spark, tmp_path):
    batches = [
        [("a", _at(0)), ("a", _at(9)), ("b", _at(1))],
        [("a", _at(4)), ("a", _at(13)), ("b", _at(7)), ("a", _at(9))],  # 4 fills the gap of 0 to 9 in time
        [("a", _at(30)), (None, _at(31)), ("c", None)],
        [("a", _at(60)), ("a", _at(2))],  # 2 is far too late and changes nothing
    ]
    got = _silences(_feed(spark, tmp_path / "in", batches, BEATS), tmp_path)
    # The watermark ends at 50: b is silent after 7 although nothing comes of it, a after 13 and 30.
    want = [("a", _at(13), _at(18)), ("a", _at(30), _at(35)), ("b", _at(1), _at(6)), ("b", _at(7), _at(12))]
    assert got == sorted(want, key=repr)


def test_silences_survive_a_restart(spark, tmp_path):
    folder = tmp_path / "in"
    stream = _feed(spark, folder, [[("a", _at(0))], [("a", _at(3)), ("b", _at(40))]], BEATS)
    assert _silences(stream, tmp_path) == [("a", _at(3), _at(8))]
    spark.createDataFrame([("a", _at(50)), ("b", _at(90))], BEATS).coalesce(1).write.parquet(f"{folder}/002")
    want = [("a", _at(3), _at(8)), ("a", _at(50), _at(55)), ("b", _at(40), _at(45))]
    assert _silences(stream, tmp_path) == want


def _table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "table"))


def test_snapshots_stay_few_and_readers_keep_theirs(spark, tmp_path):
    table, schema = _table(spark, tmp_path), "k long, n long"
    fold = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    assert table.read(schema).count() == 0
    most, pinned = 0, None
    for epoch in range(40):
        assert table.append(spark.range(2).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n")), epoch)
        if epoch == 18:
            pinned = table.read(schema)
        if epoch % 10 == 9:
            table.compact(schema, fold)
        if epoch == 19:  # compacted, but the snapshot read before is whole
            assert rows(fold(pinned)) == [(0, 19), (1, 19)]
        most = max(most, len(table._children("data")))
    assert most <= 23 and len(table._children("log")) <= 12
    assert rows(fold(table.read(schema))) == [(0, 40), (1, 40)]
    assert not table.append(spark.range(1).selectExpr("id AS k", "5L AS n"), 39)  # a repeated epoch, compacted or not
    table.append(spark.range(1).selectExpr("id AS k", "1L AS n"), 40)
    assert not table.append(spark.range(1).selectExpr("id AS k", "5L AS n"), 40)
    # A folder that was written but not published is no part of the table.
    spark.range(1).selectExpr("id AS k", "99L AS n").write.parquet(f"{table.path}/data/epoch-{41:012d}-dead")
    assert rows(fold(table.read(schema))) == [(0, 41), (1, 40)]
    assert table.append(spark.range(1).selectExpr("id AS k", "1L AS n"), 41)
    table.vacuum(1)
    assert not [f for f in table._children("data") if f.endswith("dead")]
    assert rows(fold(table.read(schema))) == [(0, 42), (1, 40)]


FACT = "entity_id long, tenant_id long, attribute_id long, attribute_name string, value_decimal decimal(20,5), ingested_at timestamp"


def _readings(n):
    from decimal import Decimal

    month = 30 * 24 * 3600
    value = lambda i: None if i % 5 == 0 else Decimal(10**9) + Decimal(i * i % 97) / 7
    return [
        (i % 11, i % 2, i % 3, f"a{i % 3}", value(i), _at((i % 4) * month + i % 7000)) for i in range(n)
    ]


def test_partial_rollups_need_no_order_and_no_state(spark, tmp_path):
    data = _readings(900)
    newest_first = sorted(data, key=lambda r: r[5], reverse=True)
    batches = [newest_first[k : k + 180] for k in range(0, 900, 180)]
    stream = _feed(spark, tmp_path / "in", batches, FACT)
    rollup, table = partials.hourly_rollup(), _table(spark, tmp_path)
    q = partials.start_partials(stream, rollup, table, str(tmp_path / "ck"), interval=None, compact_every=2)
    q.awaitTermination()
    assert q.lastProgress["stateOperators"] == []
    got = partials.attribute_statistics(partials.read_rollup(table, rollup, stream))
    batch = spark.createDataFrame(data, FACT)
    direct = partials.attribute_statistics(rollup.fold(rollup.partial(batch)))
    exact = ["hour", "tenant_id", "attribute_id", "sample_count", "avg_value", "min_value", "max_value", "approx_entities"]
    assert rows(got, *exact) == rows(direct, *exact)
    plain = batch.groupBy(F.date_trunc("hour", "ingested_at").alias("hour"), "tenant_id", "attribute_id").agg(
        F.stddev(F.col("value_decimal").cast("double")).alias("s"), F.count_distinct("entity_id").alias("d")
    )
    both = got.join(plain, ["hour", "tenant_id", "attribute_id"]).collect()
    assert len(both) == got.count()
    for r in both:
        assert r["approx_entities"] == r["d"]  # small counts are exact
        assert (r["s"] is None) == (r["stddev_value"] is None) or r["s"] == 0
        assert r["s"] is None or abs(r["s"] - r["stddev_value"]) <= 1e-6 * max(1, r["s"])


def test_sketched_days_equal_days_made_directly(spark):
    data = spark.createDataFrame(_readings(4000), FACT)
    rollup = partials.hourly_rollup()
    days = partials.attribute_statistics(partials.daily_from_hours(rollup.fold(rollup.partial(data))))
    keys = ["date", "tenant_id", "attribute_id"]
    seen = data.withColumn("date", F.to_date("ingested_at")).join(days, keys).groupBy(*keys)
    v = F.col("value_decimal").cast("double")
    n = F.count(v)
    for name, p in partials.PERCENTILES.items():
        q = F.col(f"approx_{name}")
        below, upto = F.count(F.when(v < q, 1)) / n, F.count(F.when(v <= q, 1)) / n
        for r in seen.agg(below.alias("b"), upto.alias("u"), n.alias("n")).collect():
            assert r["b"] <= p + partials.RANK_ERROR + 1 / r["n"] and r["u"] >= p - partials.RANK_ERROR - 1 / r["n"]
    assert days.agg(F.sum("sample_count")).first()[0] == 4000


def test_merge_load_takes_null_keys_and_conflicting_readings_once(spark, tmp_path):
    from gaugeworks.operators.load import read_fact
    from gaugeworks.sources.model import DriverModel

    model = DriverModel(spark, "/root/testdata/sf0.001")
    some = model.fact.drop("event_id").limit(3).withColumn("entity_type", F.lit("x"))
    nameless = some.withColumn("attribute_id", F.lit(None).cast("long"))
    other = some.withColumn("value", F.concat(F.lit("~"), "value"))  # same key, larger content
    folder = tmp_path / "in"
    for i in range(3):
        some.unionByName(nameless).unionByName(other).coalesce(1).write.parquet(f"{folder}/{i}")
        time.sleep(0.02)
    stream = spark.readStream.schema(some.schema).options(recursiveFileLookup="true", maxFilesPerTrigger="1").parquet(str(folder))
    args = [str(tmp_path / p) for p in ("fact", "audit", "ck")]
    pipeline.start_merge_load(stream, *args, interval=None).awaitTermination()
    loaded = read_fact(spark, args[0])
    assert loaded.count() == 6
    assert loaded.where("attribute_id IS NOT NULL AND value LIKE '~%'").count() == 3


def test_merge_load_computes_the_rows_to_write_once(spark, tmp_path, monkeypatch):
    from gaugeworks import schemas
    from gaugeworks.sources.model import DriverModel

    model = DriverModel(spark, "/root/testdata/sf0.001")
    readings, folder, calls = model.fact.drop("event_id"), tmp_path / "in", spark.sparkContext.accumulator(0)
    for i in range(2):
        readings.where("entity_id % 2 <= " + str(i)).coalesce(1).write.parquet(f"{folder}/{i}")
        time.sleep(0.02)

    @F.udf("string")
    def seen(value):
        calls.add(1)
        return value

    # Nothing is kept, so that every use of the rows shows.
    monkeypatch.setattr(type(readings), "persist", lambda self, *level: self)
    monkeypatch.setattr(
        pipeline, "latest_by", lambda df, keys, order, latest=pipeline.latest_by: latest(df, keys, order).withColumn("value", seen("value"))
    )
    stream = spark.readStream.schema(readings.schema).options(recursiveFileLookup="true", maxFilesPerTrigger="1").parquet(str(folder))
    args = [str(tmp_path / p) for p in ("fact", "audit", "ck")]
    pipeline.start_merge_load(stream, *args, interval=None).awaitTermination()
    even = readings.where("entity_id % 2 = 0").count()
    # The second batch brings the first one's rows again.
    audit = spark.read.schema(schemas.LOAD_AUDIT).parquet(args[1])
    assert rows(audit, "batch_id", "rows_loaded") == [("load-000000000000", even), ("load-000000000001", readings.count() - even)]
    assert calls.value <= even + readings.count()
