"""The change feed of a stream against the batch feed."""

import datetime as dt
import random

from conftest import rows
from test_streaming import _at, _feed

from gaugeworks.operators import cdc
from gaugeworks.streaming import feed

VERSIONS = "entity_id long, tenant_id long, hot_attrs string, occurred_at timestamp"
AS_OF = "2024-01-06 00:00:00"


def _run(stream, tmp_path, **options):
    out = str(tmp_path / "out")
    feed.start_change_feed(stream, out, str(tmp_path / "ck"), interval=None, **options).awaitTermination()
    spark = stream.sparkSession
    return feed.read_feed(spark, out, processed_at=AS_OF), feed.read_late_versions(spark, out)


def test_disorder_within_the_delay_changes_nothing(spark, tmp_path):
    pick = random.Random(3)
    versions = [
        (pick.randrange(4), 1, pick.choice(['{"a":1}', '{"a":2,"b":null}', '{"b":"x"}', "{}", None]), _at(i // 2))
        for i in range(400)
    ]
    # Each version comes at most 30 seconds after newer ones; the last one moves the mark past all of them.
    moved = sorted(versions, key=lambda v: v[3] + dt.timedelta(seconds=pick.randrange(30)))
    batches = [moved[i : i + 50] for i in range(0, 400, 50)] + [[(9, 9, '{"z":1}', _at(1000))]]
    got, late = _run(_feed(spark, tmp_path / "in", batches, VERSIONS), tmp_path, delay="60 seconds")
    want = cdc.change_feed(spark.createDataFrame(versions, VERSIONS), processed_at=AS_OF)
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want)
    assert late.count() == 0


def test_late_versions_go_aside(spark, tmp_path):
    batches = [
        [(1, 1, '{"a":1}', _at(0)), (1, 1, '{"a":2}', _at(5)), (None, 1, '{"a":0}', _at(1)), (2, 1, None, _at(1))],
        [(1, 1, '{"a":3}', _at(100)), (1, 1, '{"a":9}', None)],
        [(1, 1, '{"a":7}', _at(2)), (1, 1, '{"a":4}', _at(50)), (2, 1, '{"a":1}', _at(3)), (3, 1, "{}", _at(200))],
        [(1, 1, '{"a":5}', _at(40))],
    ]
    got, late = _run(_feed(spark, tmp_path / "in", batches, VERSIONS), tmp_path, delay="10 seconds")
    # 2 and 50 are past the mark when they come, but nothing after them is released yet; 40 is older than 50.
    assert rows(late, "hot_attrs", "occurred_at") == sorted([('{"a":9}', None), ('{"a":5}', _at(40))], key=repr)
    change = lambda old, new: f'{{"a":{{"old":{old},"new":"{new}"}}}}'
    assert rows(got, "entity_id", "occurred_at", "changes") == sorted(
        [
            (1, _at(0), change("null", 1)), (1, _at(2), change('"1"', 7)), (1, _at(5), change('"7"', 2)),
            (1, _at(50), change('"2"', 4)), (1, _at(100), change('"4"', 3)), (2, _at(3), change("null", 1)), (None, _at(1), change("null", 0)),
        ], key=repr,
    )


def test_a_restart_goes_on_where_it_stopped(spark, tmp_path):
    folder = tmp_path / "in"
    stream = _feed(spark, folder, [[(1, 1, '{"a":1}', _at(0))], [(2, 1, '{"a":1}', _at(50))]], VERSIONS)
    got, _ = _run(stream, tmp_path, delay="10 seconds")
    assert rows(got, "entity_id") == [(1,)]
    more = [(1, 1, '{"a":2}', _at(45)), (2, 1, '{"a":2}', _at(44)), (4, 1, '{"a":2}', _at(90))]
    spark.createDataFrame(more, VERSIONS).coalesce(1).write.parquet(f"{folder}/002")
    got, late = _run(stream, tmp_path, delay="10 seconds")
    assert rows(got, "entity_id", "occurred_at") == [(1, _at(0)), (1, _at(45)), (2, _at(44)), (2, _at(50))]
    assert late.count() == 0


def test_state_follows_buckets_not_entities(spark, tmp_path):
    ids = [None, *range(2**60 + 1, 2**60 + 800)]
    versions = [(i, 1, f'{{"a":{n}}}', _at(n)) for n in range(2) for i in ids]
    stream = _feed(spark, tmp_path / "in", [versions[:800], versions[800:] + [(0, 0, '{"z":1}', _at(500))]], VERSIONS)
    out = str(tmp_path / "out")
    handle = feed.start_change_feed(stream, out, str(tmp_path / "ck"), interval=None, delay="60 seconds")
    handle.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in handle.recentProgress if p["stateOperators"]]
    assert kept and max(kept) < 400
    want = cdc.change_feed(spark.createDataFrame(versions, VERSIONS), processed_at=AS_OF)
    assert rows(feed.read_feed(spark, out, processed_at=AS_OF)) == rows(want)
