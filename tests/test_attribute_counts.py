"""Attribute statistics from signed deltas against a rebuild."""

import datetime as dt
import random
import re

from conftest import rows

from gaugeworks.operators import rollups
from gaugeworks.streaming import attribute_counts as ac
from gaugeworks.streaming import partials
from gaugeworks.streaming.snapshots import SnapshotTable

VALUES = "entity_id long, tenant_id long, attribute_id long, ingested_at timestamp"
SIGNED = f"{VALUES}, sign int"


def _attributes(spark):
    return spark.createDataFrame([(i, f"a{i}") for i in range(4)], "attribute_id long, attribute_name string")


def _time(i):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)


def _table(spark, tmp_path, batches):
    table, rollup = SnapshotTable(spark, str(tmp_path / "counts")), ac.count_rollup()
    for epoch, batch in enumerate(batches):
        partial = rollup.partial(spark.createDataFrame(batch, SIGNED))
        table.append(partial, epoch)
        table.append(partial, epoch)  # a repeated epoch
    return table, lambda: partials.read_rollup(table, rollup, spark.createDataFrame([], SIGNED))


def test_inserts_and_deletes_equal_a_rebuild(spark, tmp_path):
    pick = random.Random(11)
    ids = lambda n: pick.choice([*range(n), None])
    live, batches = [], []
    for _ in range(8):
        came = [(ids(6), ids(2), pick.choice([0, 1, 2, 9]), pick.choice([_time(pick.randrange(4000)), None]))
                for _ in range(60)]
        pick.shuffle(live)
        gone, live = live[:30], live[30:] + came
        batches.append([(*v, 1) for v in came] + [(*v, -1) for v in gone])
    # All readings of the first month go.
    gone = [v for v in live if v[3] is not None and v[3] < _time(31 * 24)]
    live = [v for v in live if v not in gone]
    batches = [[(*v, -1) for v in gone], *batches]  # and that is told first
    now = spark.createDataFrame(live, VALUES)
    table, counts = _table(spark, tmp_path, batches)
    want = rows(rollups.attribute_stats(now, _attributes(spark)))
    assert rows(ac.attribute_stats_of(counts(), _attributes(spark), now)) == want
    ac.compact_counts(table)
    assert len(table._children("data")) <= 10
    got = ac.attribute_stats_of(counts(), _attributes(spark), now)
    assert rows(got) == want and got.dtypes == rollups.attribute_stats(now, _attributes(spark)).dtypes


def test_only_edge_months_that_lost_readings_are_read(spark, tmp_path):
    months = [_time(31 * 24 * m) for m in range(5)]
    came = [(e, 1, 1, t + dt.timedelta(minutes=e)) for t in months for e in range(3)]
    stored = str(tmp_path / "values")

    def run(name, gone):
        live = [v for v in came if v not in gone]
        path = f"{stored}-{name}"
        frame = spark.createDataFrame(live, VALUES).withColumn("year_month", ac._month())
        frame.write.partitionBy("year_month").parquet(path)
        values = spark.read.schema(f"{VALUES}, year_month string").parquet(path)
        batches = [[(*v, 1) for v in came], [(*v, -1) for v in gone]] if gone else [[(*v, 1) for v in came]]
        table, counts = _table(spark, tmp_path / name, batches)
        got = ac.attribute_stats_of(counts(), _attributes(spark), values)
        assert rows(got) == rows(rollups.attribute_stats(values, _attributes(spark)))
        plan = got._jdf.queryExecution().executedPlan().toString()
        scanned = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
        return ac.months_to_look_up(counts()), [f for f in scanned if "year_month" in f]

    assert run("none", []) == ([], [])
    assert run("middle", came[6:8]) == ([], [])
    assert run("whole", came[:3])[0] == []  # the month is gone, the next one is whole
    lost = [(1, 1, 1, months[0] + dt.timedelta(minutes=1))]
    assert run("entity", lost)[0] == []  # that entity has nothing left in the month, the others lost nothing
    again = [came[0], (0, 1, 1, months[4])]
    came.append((0, 1, 1, months[0] + dt.timedelta(minutes=9)))
    found, filters = run("edge", again)
    assert found == [f"{months[0]:%Y-%m}"]
    assert filters and all(f"= {found[0]}" in f for f in filters)


def test_empty(spark, tmp_path):
    table, counts = _table(spark, tmp_path, [])
    ac.compact_counts(table)
    none = spark.createDataFrame([], VALUES)
    assert ac.attribute_stats_of(counts(), _attributes(spark), none).count() == 0
