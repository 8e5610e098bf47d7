"""Golden micro-tables for the behaviour that is easy to get wrong."""

import datetime as dt
import itertools
import json
from decimal import Decimal

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeworks.operators import business, cdc, eav, health, hot, load, monitor, operational, rollups, scd, scope
from gaugeworks.operators import stats, timeseries

AS_OF = "2024-01-10 12:00:00"


def _fact(table, *rows_):
    """entity, tenant, attribute name, value, decimal value, time."""
    return table(*rows_, names="entity_id, tenant_id, attribute_name, value, value_decimal, ingested_at").withColumns(
        {
            "tenant_name": F.concat(F.lit("t"), F.col("tenant_id")),
            "entity_type": F.lit("sensor"),
            "attribute_id": F.lit(1),
        }
    )


# --- uptime --------------------------------------------------------------------------------------
def test_uptime_charges_the_gap_to_the_new_status(table):
    fact = _fact(
        table,
        "1, 1, 'status', 'online', NULL, timestamp'2024-01-10 10:00:00'",
        "1, 1, 'status', 'offline', NULL, timestamp'2024-01-10 10:59:30'",
        "1, 1, 'status', 'online', NULL, timestamp'2024-01-10 11:00:10'",
        "2, 1, 'status', 'online', NULL, timestamp'2024-01-10 11:00:00'",
    )
    out = health.entity_uptime(fact, as_of=AS_OF).collect()
    assert len(out) == 1  # an entity with one event has no gap
    r = out[0]
    assert (r.offline_seconds, r.online_seconds, r.total_seconds) == (3570, 40, 3610)
    assert r.uptime_percent == 1.11 and r.downtime_events == 1


def test_daily_stats_cut_gaps_at_midnight(table):
    status = table(
        "1, 1, 'online', timestamp'2024-01-08 22:00:00'",
        "1, 1, 'online', timestamp'2024-01-10 01:00:00'",
        names="entity_id, tenant_id, status, ingested_at",
    )
    out = rollups.status_seconds_by_day(status, dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 11))
    assert rows(out, "date", "online_seconds") == [
        (dt.date(2024, 1, 10), 3600), (dt.date(2024, 1, 9), 86400),
    ]


# --- correlation ------------------------------------------------------------------------------------
def _pairs_by_brute_force(data, names, start, band):
    pairs = {}
    for a, b in itertools.product(data, data):
        if (a[0], a[1]) == (b[0], b[1]) and a[2] < b[2] and a[2] in names and b[2] in names:
            if a[4] is None or b[4] is None or a[5] < start:
                continue
            sa, sb = int(a[5].timestamp()), int(b[5].timestamp())
            if abs(sa - sb) < band:
                pairs.setdefault((a[2], b[2]), []).append((a[4], b[4]))
    return pairs


@pytest.mark.parametrize("band", [1, 60, 7200])
def test_band_correlation_equals_all_pairs(spark, band):
    rng = np.random.default_rng(band)
    names = ["cpu", "disk", "mem"]
    base = dt.datetime(2024, 1, 9, 23, 50, tzinfo=dt.timezone.utc)
    data = []
    for i in range(500):
        entity = 1 if rng.random() < 0.4 else int(rng.integers(2, 6))
        at = base + dt.timedelta(seconds=float(rng.integers(0, 2_400_000)) / 1000)
        value = None if i % 23 == 0 else float(np.round(rng.normal(10, 3), 2))
        data.append((entity, int(rng.integers(1, 3)), str(rng.choice(names + ["other"])), None, value, at))
    fact = spark.createDataFrame(
        [(*r[:3], r[4], r[5]) for r in data],
        "entity_id long, tenant_id long, attribute_name string, v double, ingested_at timestamp",
    ).withColumn("value_decimal", F.col("v").cast("decimal(20,5)"))
    start = base + dt.timedelta(minutes=5)
    as_of = start + dt.timedelta(days=7)
    got = {
        (r.attr1_name, r.attr2_name): r
        for r in stats.attribute_correlation(fact, names, as_of=as_of, band_seconds=band, min_pairs=0).collect()
    }
    expected = {k: np.array(v) for k, v in _pairs_by_brute_force(data, names, start, band).items()}
    assert set(got) == set(expected)
    for key, xy in expected.items():
        r = got[key]
        assert r.pair_count == len(xy)
        if len(xy) > 2:
            x, y = xy[:, 0], xy[:, 1]
            np.testing.assert_allclose(r.correlation, np.corrcoef(x, y)[0, 1], rtol=1e-9)
            slope, intercept = np.polyfit(x, y, 1)
            np.testing.assert_allclose(
                [r.covariance, r.regression_slope, r.regression_intercept],
                [np.cov(x, y, bias=True)[0, 1], slope, intercept], rtol=1e-8,
            )


def test_band_edges(table):
    fact = _fact(
        table,
        "1, 1, 'a', '1', 1.0, timestamp'2024-01-10 00:00:00'",
        "1, 1, 'b', '1', 2.0, timestamp'2024-01-10 00:00:59'",  # inside
        "1, 1, 'b', '1', 3.0, timestamp'2024-01-10 00:01:00'",  # outside
        "1, 2, 'b', '1', 4.0, timestamp'2024-01-10 00:00:00'",  # other tenant
        "1, 1, 'b', NULL, NULL, timestamp'2024-01-10 00:00:01'",  # no value
        "1, 1, 'b', '1', 5.0, timestamp'2024-01-09 23:59:30'",  # the day before
    )
    out = stats.attribute_correlation(fact, ["a", "b"], as_of=AS_OF, min_pairs=0)
    assert rows(out, "attr1_name", "attr2_name", "pair_count") == [("a", "b", 2)]


# --- series ---------------------------------------------------------------------------------------
def test_row_frames_ignore_missing_hours(table):
    fact = _fact(
        table,
        *[f"1, 1, 'x', '1', {v}, timestamp'2024-01-10 0{h}:10:00'" for h, v in ((0, 1.0), (1, 2.0), (5, 6.0))],
    )
    out = timeseries.decompose(fact, as_of=AS_OF, series=["entity_id"])
    assert rows(out, "actual_value", "trend_24h") == [(1.0, 1.0), (2.0, 1.5), (6.0, 3.0)]
    dense = timeseries.decompose(fact, as_of=AS_OF, series=["entity_id"], densify=True)
    assert dense.count() == 6
    rate = timeseries.hourly_event_rate(fact, as_of=AS_OF)
    assert {r.traffic_pattern for r in rate.collect()} == {"normal"}


# --- find entities ----------------------------------------------------------------------------------
FILTERS = [
    ([{"attribute_id": 1, "value": "on", "operator": "="}], [10]),
    ([{"attribute_id": 2, "value": "5", "operator": ">"}], [10]),
    ([{"attribute_id": 1, "value": "on", "operator": "="}, {"attribute_id": 2, "value": "50", "operator": "<"}], [10]),
    ([{"attribute_id": 2, "value": "5", "operator": ">"}, {"attribute_id": 2, "value": "50", "operator": "<"}], []),
    ([{"attribute_id": 1, "value": "on", "operator": ">="}], []),
    ([{"attribute_id": 3, "value": "1", "operator": ">"}], []),  # decimal value only
    ([], []),
]


@pytest.mark.parametrize("filters,expected", FILTERS)
def test_find_entities(table, filters, expected):
    values = table(
        "10, 1, 1, 'on', NULL, timestamp'2024-01-09'",
        "10, 1, 1, 'off', NULL, timestamp'2024-01-10'",  # any reading counts, not the newest
        "10, 1, 2, '7', 7L, timestamp'2024-01-09'",
        "10, 1, 3, '2.5', NULL, timestamp'2024-01-09'",
        "11, 2, 1, 'on', NULL, timestamp'2024-01-09'",
        "12, 1, 1, 'on', NULL, timestamp'2023-12-01'",
        names="entity_id, tenant_id, attribute_id, value, value_int, ingested_at",
    )
    out = scope.find_entities(values, 1, json.dumps(filters), as_of=AS_OF)
    assert [r[0] for r in rows(out)] == expected


def test_tenant_scope(table):
    df = table("1", "2", names="tenant_id")
    assert rows(scope.tenant_scope(df, 1)) == [(1,)]
    assert scope.tenant_scope(df).count() == 0
    with pytest.raises(ValueError):
        scope.tenant_scope(df, strict=True)


def test_bounded_range(table):
    df = table("timestamp'2024-01-02'", "timestamp'2024-01-09'", names="ingested_at")
    assert scope.bounded_range(df, as_of=AS_OF).count() == 1
    assert scope.bounded_range(df, "2024-01-01", "2024-01-10").count() == 2
    with pytest.raises(ValueError):
        scope.bounded_range(df, "2023-01-01", "2024-01-01")


# --- hot store ------------------------------------------------------------------------------------------
def test_deltas_of_a_batch_fold_in_time_order(table):
    state = table("1L, 1L, '{\"a\":1,\"b\":2}', timestamp'2024-01-01'", names="entity_id, tenant_id, hot_attrs, updated_at")
    deltas = table(
        "1L, 1L, '{\"b\":4,\"c\":{\"x\":1}}', timestamp'2024-01-09 02:00:00'",
        "1L, 1L, '{\"b\":3,\"d\":null}', timestamp'2024-01-09 01:00:00'",
        "2L, 1L, '{\"z\":\"q\"}', timestamp'2024-01-09'",
        "3L, 1L, '{}', timestamp'2024-01-09'",
        names="entity_id, tenant_id, delta, occurred_at",
    )
    out = hot.upsert_hot(state, deltas, as_of=AS_OF)
    assert rows(out, "entity_id", "hot_attrs") == [
        (1, '{"a":1,"b":4,"c":{"x":1},"d":null}'), (2, '{"z":"q"}'), (3, "{}"),
    ]


def test_hot_projection_keeps_types(table):
    attributes = table(
        "1L, 'n', 'integer', true", "2L, 's', 'string', true", "3L, 'b', 'boolean', true",
        "4L, 'j', 'json', true", "5L, 'cold', 'string', false",
        names="attribute_id, attribute_name, data_type, is_hot",
    )
    at = "timestamp'2024-01-09'"
    values = table(
        f"1L, 1L, 1L, '8', {at}", f"1L, 1L, 2L, 'say \"8\"', {at}", f"1L, 1L, 3L, 'true', {at}",
        f"1L, 1L, 4L, '[1,2]', {at}", f"1L, 1L, 5L, 'x', {at}", "1L, 1L, 1L, '9', timestamp'2024-01-08'",
        names="entity_id, tenant_id, attribute_id, value, ingested_at",
    )
    out = hot.build_hot_projection(values, attributes).first()
    assert out.hot_attrs == '{"b":true,"j":[1,2],"n":8,"s":"say \\"8\\""}'


# --- typing and validation ----------------------------------------------------------------------------
def test_validation_reasons(table):
    attributes = table(
        "1L, 'integer', NULL", "2L, 'decimal', NULL", "3L, 'date', NULL", "4L, 'string', '^a+$'",
        "5L, 'blob', NULL", "6L, 'json', NULL", "7L, 'timestamp', NULL",
        names="attribute_id, data_type, validation_regex",
    )
    readings = table(
        "1L, '12'", "1L, 'x'", "2L, '1.5'", "2L, '--'", "3L, '2024-02-30'", "4L, 'aaa'", "4L, 'b'", "5L, 'x'",
        "6L, '{\"a\":1}'", "6L, '{'", "7L, '2024-01-01 00:00:00'", "9L, 'x'", "1L, NULL",
        names="attribute_id, value",
    )
    checked = eav.validate_values(readings, attributes)
    reasons = {(r.attribute_id, r.value): r.reason for r in checked.collect()}
    assert reasons[(1, "x")] == "not_integer" and reasons[(2, "--")] == "not_decimal"
    assert reasons[(3, "2024-02-30")] == "not_date" and reasons[(4, "b")] == "pattern_mismatch"
    assert reasons[(5, "x")] == "unknown_data_type" and reasons[(9, "x")] == "unknown_attribute"
    assert reasons[(6, "{")] == "not_json"
    assert eav.accepted(checked).count() + eav.quarantined(checked).count() == 13
    assert eav.accepted(checked).count() == 6


def test_pivot_shows_the_newest_row_even_when_null(table):
    values = table(
        "1, 1, 7, 'x', 1.0, timestamp'2024-01-01'", "1, 1, 7, 'y', NULL, timestamp'2024-01-02'",
        "1, 1, 8, 'z', 3.0, timestamp'2024-01-01'",
        names="tenant_id, entity_id, attribute_id, value, value_decimal, ingested_at",
    )
    out = eav.pivot_latest(values, {"a": (7, "value_decimal"), "b": (8, "value_decimal"), "c": (7, "value")})
    r = out.first()
    assert r.a is None and float(r.b) == 3.0 and r.c == "y"


# --- loading ------------------------------------------------------------------------------------------
def _staged(spark, batches):
    """One fact row per (batch, entity)."""
    from gaugeworks import schemas

    base = spark.createDataFrame(batches, "batch_id string, entity_id long")
    at = F.expr("timestamp'2024-01-05 10:00:00'")
    filled = base.withColumns({"tenant_id": F.lit(1), "ingested_at": at, "year_month": F.lit("2024-01")})
    types = dict(f.strip().rsplit(" ", 1) for f in schemas.STAGED_FACT.replace("decimal(20,5)", "decimal").split(","))
    return filled.select(
        *[(F.col(c) if c in filled.columns else F.lit(None)).cast(t.replace("decimal", "decimal(20,5)")).alias(c)
          for c, t in types.items()]
    )


def test_load_skips_recent_batches_and_quarantines_untracked(spark, table):
    staging = _staged(spark, [("b1", 1), ("b2", 2), ("b2", 2), ("b3", 3), (None, 4)])
    audit = table(
        "'b1', timestamp'2024-01-10 11:30:00', 1L", "'b3', timestamp'2024-01-10 10:30:00', 1L",
        names="batch_id, loaded_at, rows_loaded",
    )
    out = load.load_fact(staging, audit, as_of=AS_OF)
    assert rows(out.rows, "entity_id") == [(2,), (3,)]  # b3 was loaded over an hour ago: it loads again
    assert rows(out.audit, "batch_id", "rows_loaded") == [("b2", 1), ("b3", 1)]
    assert rows(out.quarantine, "entity_id") == [(4,)]


def test_loading_twice_equals_loading_once(spark, tmp_path):
    fact, audit = str(tmp_path / "fact"), str(tmp_path / "audit")
    staging = _staged(spark, [("b1", 1), ("b2", 2)])
    for moment in ("2024-01-10 12:00:00", "2024-01-10 12:00:30"):
        load.run_fact_load(spark, staging, fact, audit, as_of=moment)
    assert rows(load.read_fact(spark, fact), "entity_id") == [(1,), (2,)]
    assert spark.read.parquet(audit).count() == 2
    more = _staged(spark, [("b2", 2), ("b4", 4)])
    load.run_fact_load(spark, more, fact, audit, as_of="2024-01-10 12:01:00")
    assert rows(load.read_fact(spark, fact), "entity_id") == [(1,), (2,), (4,)]


def test_a_load_that_died_before_the_audit_can_be_repeated(spark, tmp_path):
    fact, audit = str(tmp_path / "fact"), str(tmp_path / "audit")
    staging = _staged(spark, [("b1", 1), ("b2", 2)])
    empty = spark.sql("SELECT '' AS batch_id, now() AS loaded_at, 0L AS rows_loaded WHERE false")
    half = load.load_fact(staging, empty, as_of=AS_OF)
    load.write_fact(
        half.rows.drop("batch_id").withColumn("load_id", F.lit("e1")), fact, partitions=("year_month", "load_id")
    )
    load.run_fact_load(spark, staging, fact, audit, as_of=AS_OF, load_id="e1")
    assert rows(load.read_fact(spark, fact), "entity_id") == [(1,), (2,)]


def test_flush_moves_the_oldest_and_keeps_the_rest(table):
    names = "tenant_id, entity_id, attribute_id, value, ingested_at"
    staging = table(
        "1, 1, 1, 'a', timestamp'2024-01-01'", "1, 1, 1, 'a', timestamp'2024-01-01'",
        "1, 1, 1, 'a', timestamp'2024-01-01'", "1, 2, 1, 'b', timestamp'2024-01-02'",
        "1, 3, 1, 'c', NULL", names=names,
    )
    out = load.flush_staging(staging, as_of=AS_OF, limit=2)
    assert out.moved.count() == 1  # two equal rows collapse to one history key
    assert rows(out.remaining, "value") == [("a",), ("b",), ("c",)]
    everything = load.flush_staging(staging, as_of=AS_OF, limit=10)
    assert everything.remaining.count() == 0
    assert rows(everything.moved.where("value = 'c'"), "ingested_at") == [(dt.datetime(2024, 1, 10, 12),)]


def test_archive_splits_by_month(spark, table, tmp_path):
    values = table(
        "1, 1, timestamp'2022-11-05'", "1, 1, timestamp'2023-02-05'", "1, 1, timestamp'2024-01-05'",
        names="tenant_id, entity_id, ingested_at",
    )
    manifest = load.archive_partitions(values, str(tmp_path / "a"), str(tmp_path / "m"), as_of=AS_OF)
    assert rows(manifest, "year_month", "action") == [
        ("2022-11", "archive"), ("2023-02", "keep"), ("2024-01", "keep"),
    ]
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1


def test_archive_log_keeps_months_that_left_live_history(spark, table, tmp_path):
    names = "tenant_id, entity_id, ingested_at"
    paths = str(tmp_path / "a"), str(tmp_path / "m")
    first = table("1, 1, timestamp'2022-11-05'", "1, 2, timestamp'2022-11-06'", "1, 1, timestamp'2024-01-05'", names=names)
    load.archive_partitions(first, *paths, as_of=AS_OF)
    # Its live folder was dropped; one late row of it came since, beside one that is archived already.
    second = table("1, 2, timestamp'2022-11-06'", "1, 3, timestamp'2022-11-07'", "1, 1, timestamp'2024-01-05'", names=names)
    later = AS_OF.replace("2024-", "2025-") if isinstance(AS_OF, str) else AS_OF.replace(year=AS_OF.year + 1)
    for _ in range(2):  # the second run is repeated
        manifest = load.archive_partitions(second, *paths, as_of=later)
        assert rows(manifest, "year_month", "row_count", "action")[0] == ("2022-11", 3, "archive")
    assert rows(spark.read.parquet(paths[0]).where("year_month = '2022-11'"), "entity_id") == [(1,), (2,), (3,)]
    third = load.archive_partitions(second.where("false"), *paths, as_of=f"{str(later)[:4]}-12-01 00:00:00")
    assert ("2022-11", 3, "archive") in rows(third, "year_month", "row_count", "action")


def test_hot_numbers_keep_their_digits(table):
    values = ["0.123456789012345", "-007.50", "+12345678901234567890123456789012345678", "-0", ".5", "5.", "1e3", "1e-12",
              "9" * 39, "abc", "1_0"]
    want = ["0.123456789012345", "-7.5", "12345678901234567890123456789012345678", "0", "0.5", "5", "1000", '"1e-12"',
            '"' + "9" * 39 + '"', '"abc"', '"1_0"']
    df = table(*[f"{i}, '{v}'" for i, v in enumerate(values)], names="i, v")
    got = df.select("i", hot._typed_value(F.lit("decimal"), F.col("v")).alias("f")).orderBy("i").collect()
    assert [r["f"] for r in got] == want


def test_every_broken_ingest_line_is_in_quarantine(spark, tmp_path):
    from gaugeworks.sources import ingest

    lines = ["\\N\t2\t3\tplain\t7\t1.50000\t2024-01-05 10:00:00", "broken", "1\t2\t3\tgood\t\\N\t\\N\t\\N"]
    (tmp_path / "f.tsv").write_text("\n".join(lines))
    read = ingest.read_ingest(spark, str(tmp_path / "f.tsv"))
    assert sorted(r[0] for r in rows(ingest.malformed(read))) == sorted(lines[:2])
    assert rows(ingest.well_formed(read), "value") == [("good",)]


def test_stored_tables_follow_their_input(spark, tmp_path):
    import shutil

    from gaugeworks.sources.model import DriverModel

    source = "/root/testdata/sf0.001"
    for name in ("region", "nation", "customer", "events"):
        shutil.copy(f"{source}/{name}.parquet", tmp_path / f"{name}.parquet")
    alerts = lambda: DriverModel(spark, str(tmp_path)).current_state.agg(F.count("*"), F.sum("alert_count")).first()
    before = alerts()
    assert alerts() == before
    shutil.copy("/root/testdata/sf0.01/events.parquet", tmp_path / "events.parquet")
    spark.catalog.clearCache()
    after = alerts()
    events = spark.read.parquet(str(tmp_path / "events.parquet"))
    assert after != before and after[1] <= events.where("event_type = 'error'").count()


def test_ingest_file_rules(spark, tmp_path):
    from gaugeworks.sources import ingest

    lines = [
        "1\t2\t3\tplain\t\\N\t\\N\t2024-01-05 10:00:00",
        "1\t2\t3\t\t7\t1.5\t2024-01-05 10:00:00.123456",
        '1\t2\t3\tsays "hi"\\x\t\\N\t\\N\t\\N',
        "1\t2\t3\ttab\tinside\t\\N\t\\N\t2024-01-05 10:00:00",
        "x\t2\t3\ty\t\\N\t\\N\t2024-01-05 10:00:00",
    ]
    (tmp_path / "f.tsv").write_text("\n".join(lines))
    read = ingest.read_ingest(spark, str(tmp_path / "f.tsv"))
    good = rows(ingest.well_formed(read), "value", "value_int", "value_decimal", "ingested_at")
    assert [(g[0], g[1]) for g in good] == [("plain", None), ('says "hi"\\x', None), (None, 7)]
    assert good[2][3] == dt.datetime(2024, 1, 5, 10, 0, 0, 123456)
    assert sorted(r[0] for r in rows(ingest.malformed(read))) == sorted(lines[3:])


# --- dimensions and changes -------------------------------------------------------------------------
def test_scd2_merge_and_lookup(table):
    end = "timestamp'9999-12-31 23:59:59'"
    dim = table(
        f"1, 'a', timestamp'2024-01-01', {end}, true", f"2, 'b', timestamp'2024-01-01', {end}, true",
        "4, 'd', timestamp'2023-01-01', timestamp'2024-01-01', false",
        names="k, s, valid_from, valid_to, is_current",
    )
    changes = table("1, 'a', 1", "1, 'x', 2", "2, 'b', 1", "3, 'c', 1", "4, 'e', 1", names="k, s, n")
    merged = scd.scd2_merge(dim, changes, ["k"], ["s"], as_of="2024-01-05", order=["n"])
    got = rows(merged, "k", "s", "valid_from", "is_current")
    assert got == sorted(
        [(1, "a", dt.datetime(2024, 1, 1), False), (1, "x", dt.datetime(2024, 1, 5), True),
         (2, "b", dt.datetime(2024, 1, 1), True), (3, "c", dt.datetime(2024, 1, 5), True),
         (4, "d", dt.datetime(2023, 1, 1), False), (4, "e", dt.datetime(2024, 1, 5), True)], key=repr
    )
    facts = table(
        "1, timestamp'2023-12-31'", "1, timestamp'2024-01-02'", "1, timestamp'2024-01-05'", "1, timestamp'2024-01-09'",
        names="k, t",
    )
    for few in (True, False):
        found = scd.scd2_asof(facts, merged, ["k"], "t", ["s"], "left", few_versions=few)
        assert [r[1] for r in sorted(rows(found, "t", "s"))] == [None, "a", "x", "x"]
        inner = scd.scd2_asof(facts, merged, ["k"], "t", ["s"], few_versions=few)
        assert inner.count() == 3


def test_scd2_history_never_overlaps(spark):
    rng = np.random.default_rng(5)
    data = [(int(k), str(rng.choice(["a", "b"])), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(m)))
            for k, m in zip(rng.integers(0, 5, 400), rng.permutation(20_000)[:400])]
    history = spark.createDataFrame(data, "k long, s string, t timestamp")
    dim = scd.scd2_from_history(history, ["k"], ["s"], "t")
    by_key = {}
    for r in dim.orderBy("k", "valid_from").collect():
        before = by_key.get(r.k)
        if before is not None:
            assert before.valid_to == r.valid_from and before.s != r.s and not before.is_current
        by_key[r.k] = r
    assert all(r.is_current for r in by_key.values())


def test_changes_fold_the_same_in_any_split(spark, table):
    names = "k, v, op, ts_ms, lsn"
    state = table("1, 'a', 'r', 0L, 0L", "2, 'b', 'r', 0L, 0L", names=names)
    changes = table(
        "1, 'x', 'u', 5L, 2L", "1, 'y', 'u', 5L, 1L", "2, 'b', 'd', 6L, 3L", "3, 'c', 'c', 1L, 4L",
        "3, 'cc', 'u', 2L, 5L", "2, 'late', 'u', 4L, 9L", names=names,
    )
    once = rows(cdc.fold_changes(state, changes, ["k"]))
    for cut in range(1, 6):
        listed = changes.collect()
        first = spark.createDataFrame(listed[cut:], changes.schema)
        second = spark.createDataFrame(listed[:cut], changes.schema)
        assert rows(cdc.fold_changes(cdc.fold_changes(state, first, ["k"]), second, ["k"])) == once
    applied = cdc.apply_cdc(state.drop("op"), changes, ["k"])
    assert rows(applied, "k", "v") == [(1, "x"), (3, "cc")]
    with pytest.raises(ValueError, match="late"):
        cdc.apply_cdc(state.select("k", "v"), changes, ["k"])


def test_late_change_is_ignored(table):
    names = "k, v, op, ts_ms, lsn"
    state = table("1, 'new', 'u', 100L, 10L", "2, 'gone', 'd', 100L, 11L", names=names)
    late = table("1, 'old', 'u', 50L, 5L", "2, 'old', 'u', 50L, 6L", names=names)
    assert rows(cdc.apply_cdc(state, late, ["k"])) == rows(state)


def test_daily_rows_of_days_with_downtime_only(table):
    """Offline from the first of January to noon of the third: the second has no reading, but a row."""
    status = table(
        "1L, 1L, 'online', timestamp'2023-11-01 00:00:00'", "1L, 1L, 'offline', timestamp'2024-01-03 12:00:00'",
        names="entity_id, tenant_id, status, ingested_at",
    )
    fact = status.selectExpr(
        "entity_id", "tenant_id", "'status' AS attribute_name", "'state' AS attribute_category",
        "CAST(NULL AS decimal(20,5)) AS value_decimal", "ingested_at", "date_format(ingested_at, 'yyyy-MM') AS year_month",
    )
    entities = table("1L, 1L, 'sensor'", names="entity_id, tenant_id, entity_type")
    out = rollups.daily_entity_stats(fact, status, entities, as_of=dt.datetime(2024, 1, 3, 18), days=3)
    got = rows(out.selectExpr("string(date)", "entity_type", "total_events", "downtime_minutes"))
    assert got == [("2024-01-01", "sensor", 0, 1440), ("2024-01-02", "sensor", 0, 1440), ("2024-01-03", "sensor", 1, 720)]


def test_hot_numbers_keep_their_value(table):
    attributes = table("1L, 'n', 'integer', true", "2L, 'd', 'decimal', true", "3L, 'b', 'boolean', true",
                       names="attribute_id, attribute_name, data_type, is_hot")
    at = "timestamp'2024-01-09'"
    values = table(
        f"1L, 1L, 1L, '007', {at}", f"1L, 1L, 2L, '+10.50', {at}", f"1L, 1L, 3L, 'yes', {at}", f"2L, 1L, 1L, '100', {at}",
        f"2L, 1L, 2L, 'n/a', {at}", names="entity_id, tenant_id, attribute_id, value, ingested_at",
    )
    store = hot.build_hot_projection(values, attributes)
    assert rows(store, "hot_attrs") == [('{"b":true,"d":10.5,"n":7}',), ('{"d":"n/a","n":100}',)]
    report = hot.divergence_report(values, attributes, store)
    assert rows(report, "differing", "missing_in_store", "missing_in_history") == [(0, 0, 0)] * 3


@pytest.mark.parametrize("offset", [0, 10**6, 10**8])
def test_correlation_far_from_zero(spark, offset):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=300), 5)
    y = np.round(2 * x + rng.normal(size=300), 5)
    made = [(k, name, Decimal(str(round(v + offset, 5))), k) for k in range(300) for name, v in (("a", x[k]), ("b", y[k]))]
    fact = spark.createDataFrame(made, "entity_id long, attribute_name string, value_decimal decimal(20,5), s long").selectExpr(
        "entity_id", "1L AS tenant_id", "attribute_name", "value_decimal",
        "timestamp_seconds(unix_seconds(timestamp'2024-01-09 00:00:00') + s * 100) AS ingested_at", "'2024-01' AS year_month",
    )
    r = stats.attribute_correlation(fact, ["a", "b"], as_of=dt.datetime(2024, 1, 10), min_pairs=1).first()
    slope, _ = np.polyfit(x, y, 1)
    assert abs(r.correlation - np.corrcoef(x, y)[0, 1]) < 1e-9 and abs(r.regression_slope - slope) < 1e-9
    assert abs(r.covariance - np.cov(x, y, bias=True)[0, 1]) < 1e-9


# --- operational ----------------------------------------------------------------------------------------
def test_hottest_shows_the_newest_among_those_above(table):
    values = table(
        "1L, 1L, 77, 120.0, timestamp'2024-01-10 10:00:00'", "1L, 1L, 77, 90.0, timestamp'2024-01-10 11:00:00'",
        names="entity_id, tenant_id, attribute_id, value_decimal, ingested_at",
    )
    entities = table("1L, 1L, 'sensor', false", names="entity_id, tenant_id, entity_type, is_deleted")
    store = table("1L, 1L, '{\"status\":\"online\",\"region\":\"r\"}'", names="entity_id, tenant_id, hot_attrs")
    args = dict(as_of=AS_OF, entity_type="sensor", region="r")
    above = operational.hottest_entities(entities, store, values, 77, **args).first()
    newest = operational.hottest_entities(entities, store, values, 77, threshold=None, **args).first()
    assert float(above.latest_value) == 120 and float(newest.latest_value) == 90
    assert operational.hottest_entities(entities, store, values, 77, as_of=AS_OF, region="other").count() == 0


def test_category_rows_multiply_samples(table):
    attributes = table("2L, 'category', 'string'", "3L, 'temp', 'decimal'", names="attribute_id, attribute_name, data_type")
    at = "timestamp'2024-01-09'"
    values = table(
        f"1L, 1L, 2L, 'a', NULL, {at}", f"1L, 1L, 2L, 'a', NULL, {at}", f"2L, 1L, 2L, 'a', NULL, {at}",
        f"1L, 1L, 3L, '1', cast(1 as decimal(20,5)), {at}", f"1L, 1L, 3L, '3', cast(3 as decimal(20,5)), {at}",
        f"2L, 1L, 3L, '7', cast(7 as decimal(20,5)), {at}",
        names="entity_id, tenant_id, attribute_id, value, value_decimal, ingested_at",
    )
    plain = operational.category_metrics(values, attributes, 2, as_of=AS_OF, min_samples=0).first()
    assert (plain.sample_count, plain.average_value) == (5, 3.0)
    full = operational.category_distribution(values, attributes, 2, as_of=AS_OF, min_samples=0).first()
    assert (full.entity_count, full.median, full.sample_count) == (2, 3.0, 5)


def test_health_label_order(table):
    state = table(
        "1, 'offline', 0, 0, 10.0", "2, 'online', 11, 0, 99.0", "3, 'online', 10, 6, 99.0",
        "4, 'online', 10, 5, 94.99", "5, 'online', 10, 5, 95.0", "6, NULL, NULL, NULL, NULL",
        names="entity_id, status, alert_count, error_count, uptime_percent",
    ).withColumns({c: F.lit(None).cast("string") for c in ("priority", "last_seen", "updated_at")})
    dim = state.select("entity_id").withColumns(
        {"is_current": F.lit(True), **{c: F.lit("x") for c in ("tenant_id", "tenant_name", "entity_type", "region", "environment")}}
    )
    labels = [r[1] for r in sorted(rows(health.entity_health(dim, state), "entity_id", "health_status"))]
    assert labels == ["critical", "warning", "warning", "degraded", "healthy", "healthy"]


def test_cost_has_a_constant_row_overhead(table):
    fact = _fact(table, "1, 1, 'x', 'abc', NULL, timestamp'2024-01-09'", "1, 1, 'x', NULL, NULL, timestamp'2024-01-09'")
    out = business.tenant_cost(fact.withColumn("ingested_month", F.lit("m")), as_of=AS_OF).first()
    assert out.storage_gb == pytest.approx((3 + 17 + 17) / 1024**3)


# --- freshness, heartbeats, alarms ------------------------------------------------------------------------
def test_freshness_labels(table):
    fact = _fact(
        table,
        *[f"1, {m}, 'x', '1', NULL, timestamp'2024-01-10 12:00:00' - INTERVAL {m} MINUTES" for m in (4, 5, 14, 15)],
        "1, 99, 'x', '1', NULL, timestamp'2024-01-10 10:00:00'",
    )
    out = {r.tenant_id: r.freshness_status for r in monitor.tenant_freshness(fact, as_of=AS_OF).collect()}
    assert out == {4: "healthy", 5: "degraded", 14: "degraded", 15: "stale"}
    tenants = fact.select("tenant_id", "tenant_name").distinct()
    full = {r.tenant_id: r.freshness_status for r in monitor.tenant_freshness(fact, as_of=AS_OF, tenants=tenants).collect()}
    assert full[99] == "silent"


@pytest.mark.parametrize(
    "lag,status",
    [(None, "NO_HEARTBEAT"), (0, "OK"), (3000, "OK"), (3001, "WARNING"), (5000, "WARNING"), (5001, "CRITICAL")],
)
def test_heartbeat_thresholds(spark, lag, status):
    now = dt.datetime(2024, 1, 10, 12)
    data = [] if lag is None else [(1, now - dt.timedelta(milliseconds=lag), "primary")]
    beats = spark.createDataFrame(data, "id int, timestamp timestamp, source string")
    out = monitor.heartbeat_status(beats, as_of=now).first()
    assert (out.lag_ms, out.status) == (-1 if lag is None else lag, status)


def test_alarm_needs_consecutive_periods(table):
    points = table(
        *[f"'m', 'r', timestamp'2024-01-01 00:00:00' + INTERVAL {p} MINUTES, {v}D"
          for p, v in ((0, 9), (1, 9), (2, 1), (3, 9), (5, 9), (6, 9), (7, 9))],
        names="metric, resource, ts, value",
    )
    out = monitor.alarm_periods(
        points, metric="m", period_seconds=60, statistic="Average", comparison=">", threshold=5, evaluation_periods=2
    )
    states = [r.state for r in out.orderBy("period_start").collect()]
    assert states == ["OK", "ALARM", "OK", "OK", "OK", "ALARM", "ALARM"]
    lag = points.withColumn("metric", F.lit("ReplicaLag"))
    assert monitor.alarm_by_rule(lag, "replica_lag").where("state = 'ALARM'").count() == 3


def test_budget_and_hit_rate(spark, table):
    lags = table("'cache', 0L", "'cache', 100L", "'cache', 101L", "'warehouse', NULL", names="read_path, lag_ms")
    out = [r[0] for r in rows(monitor.check_budget(lags), "budget_status")]
    assert out == ["exceeded", "unknown", "within_budget", "within_target"]
    empty = spark.createDataFrame([], "hit boolean")
    assert monitor.cache_hit_rate(empty).first().hit_rate is None


def test_partition_skew_covers_all_rows(spark):
    out = eav.partition_skew(spark.range(20_000).withColumnRenamed("id", "entity_id"), n=20)
    counts = [r.row_count for r in out.collect()]
    assert sum(counts) == 20_000 and len(counts) == 20 and max(counts) < 1.25 * min(counts)


def test_entity_list_pages_are_bounded_and_complete(spark):
    entities = spark.range(25_000).select(
        F.col("id").alias("entity_id"), F.lit(1).alias("tenant_id"), F.lit("s").alias("entity_type")
    )
    pages = rollups.payload_entity_list(entities, page_size=1000).collect()
    assert len(pages) == 25 and max(p.entity_count for p in pages) == 1000
    assert sorted(i for p in pages for i in json.loads(p.payload)) == list(range(25_000))
