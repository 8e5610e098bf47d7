"""The hot store in buckets against the whole-table upsert."""

import random

from conftest import rows
from test_streaming import _at, _feed

from gaugeworks.operators import hot
from gaugeworks.operators.hotstore import HotStore
from gaugeworks.streaming import state

AS_OF = "2024-01-06 00:00:00"
OBJECTS = "entity_id long, tenant_id long, hot_attrs string, updated_at timestamp"
DELTAS = "entity_id long, tenant_id long, delta string, occurred_at timestamp"


def _objects(spark, n):
    return spark.createDataFrame([(i, i % 3, f'{{"a":{i},"b":"x"}}', _at(0)) for i in range(n)], OBJECTS)


def _named(df, version):
    """Bucket folders of the store that a plan scans."""
    files = [f.replace("file://", "") for f in df.inputFiles()]
    return {f for f in version.folders.values() if any(f"/data/{f}/" in x for x in files)}


def test_batches_equal_the_whole_table_upsert(spark, tmp_path):
    pick = random.Random(5)
    whole, store = _objects(spark, 60), HotStore(spark, str(tmp_path / "store"), buckets=16)
    store.rebuild(whole)
    for epoch in range(6):
        deltas = [
            (pick.randrange(70), pick.randrange(3), pick.choice(['{"a":1}', '{"c":null,"b":2}', "{}", '{"d":{"e":1}}']),
             _at(pick.randrange(50))) for _ in range(pick.choice([1, 4, 30]))
        ]
        batch = spark.createDataFrame(deltas, DELTAS)
        whole = spark.createDataFrame(hot.upsert_hot(whole, batch, as_of=AS_OF).collect(), OBJECTS)
        store.upsert(batch, epoch, as_of=AS_OF)
        store.upsert(batch, epoch, as_of="2024-02-01 00:00:00")  # the epoch is known
        assert rows(store.read()) == rows(whole)
    assert rows(store.lookup(1, 1)) == rows(whole.where("entity_id = 1 AND tenant_id = 1"))


def test_a_batch_reads_and_replaces_only_touched_buckets(spark, tmp_path):
    store = HotStore(spark, str(tmp_path / "store"), buckets=32)
    store.rebuild(_objects(spark, 2000))
    old, pinned = store.newest(), store.read()
    before = rows(pinned)
    batch = spark.createDataFrame([(7, 1, '{"a":0}', _at(1)), (7, 1, '{"c":1}', _at(2)), (9, 0, '{"a":0}', _at(1))], DELTAS)
    touched = store.upsert(batch, 0, as_of=AS_OF)
    new = store.newest()
    assert 1 <= len(touched) <= 2
    assert len(_named(store.read(old, touched), old)) == len(touched)
    assert {b for b in new.folders if new.folders[b] != old.folders[b]} == set(touched)
    assert rows(store.read(old)) == before == rows(pinned)
    assert len(set(rows(store.read())) - set(before)) == 2
    assert len(_named(store.lookup(1, 7), new)) == 1
    assert store.upsert(batch.limit(0), 1) == [] and store.newest() == new


def test_vacuum_keeps_what_versions_name(spark, tmp_path):
    store = HotStore(spark, str(tmp_path / "store"), buckets=4)
    assert store.read().count() == 0 and store.newest().version == -1
    store.vacuum()
    store.rebuild(_objects(spark, 40))
    spark.range(1).selectExpr("id", "1 AS bucket").write.partitionBy("bucket").parquet(
        f"{store.path}/data/v{1:012d}-dead"
    )
    for epoch in range(12):
        store.upsert(spark.createDataFrame([(epoch, epoch % 3, '{"n":1}', _at(1))], DELTAS), epoch, as_of=AS_OF)
    want, pinned = rows(store.read()), store.read(store.newest())
    store.vacuum(keep=1)
    assert rows(pinned) == want == rows(store.read())
    assert len(store._children("log")) == 1 and len(store._children("data")) <= 4 and not store._children("folded")
    assert not [f for f in store._children("data") if f.endswith("dead")]
    store.rebuild(_objects(spark, 3))
    assert rows(store.read()) == rows(_objects(spark, 3))


def test_null_ids_and_empty_objects(spark, tmp_path):
    whole = spark.createDataFrame([(None, 1, '{"a":1}', _at(0)), (1, None, "{}", None), (2, 2, None, _at(0))], OBJECTS)
    batch = spark.createDataFrame([(None, 1, '{"a":2}', _at(1)), (2, 2, '{"a":2}', None), (1, None, None, _at(1))], DELTAS)
    store = HotStore(spark, str(tmp_path / "store"))
    store.rebuild(whole)
    store.upsert(batch, as_of=AS_OF)
    assert rows(store.read()) == rows(hot.upsert_hot(whole, batch, as_of=AS_OF))


def test_stream_of_deltas_survives_a_restart(spark, tmp_path):
    store, folder = HotStore(spark, str(tmp_path / "store"), buckets=4), tmp_path / "in"
    store.rebuild(_objects(spark, 5))
    stream = _feed(spark, folder, [[(1, 1, '{"a":10}', _at(1))], [(1, 1, '{"a":11,"z":1}', _at(2))]], DELTAS)
    run = lambda: state.start_hot_upserts(stream, store, str(tmp_path / "ck"), interval=None, vacuum_every=1, as_of=AS_OF)
    run().awaitTermination()
    spark.createDataFrame([(4, 1, '{"a":12}', _at(3))], DELTAS).coalesce(1).write.parquet(f"{folder}/002")
    run().awaitTermination()
    got = dict(rows(store.read(), "entity_id", "hot_attrs"))
    assert got[1] == '{"a":11,"b":"x","z":1}' and got[4] == '{"a":12,"b":"x"}' and got[2] == '{"a":2,"b":"x"}'
    assert len(store._children("log")) <= 3
