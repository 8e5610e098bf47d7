"""The driver events as a stream of parts."""

import shutil

import pytest
from pyspark.sql import functions as F

from gaugeworks.plans import streams

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture
def split_events(spark, tmp_path):
    """The smallest tables with the events in five files."""
    for name in ("region", "nation", "customer"):
        shutil.copyfile(f"{SOURCE}/{name}.parquet", tmp_path / f"{name}.parquet")
    spark.read.parquet(f"{SOURCE}/events.parquet").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("rows_per_file", [100, 250_000])
@pytest.mark.parametrize("kind", [streams.LateStreamModel, streams.DailyModel, streams.CopiedStreamModel, streams.DisorderModel])
def test_a_part_is_a_micro_batch(spark, tmp_path, split_events, monkeypatch, kind, rows_per_file):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", rows_per_file, raising=False)
    monkeypatch.setattr(streams, "FILLED", 10, raising=False)
    model, seen = kind(spark, split_events), []

    def look(batch, epoch):
        times = batch.select("event_id", F.unix_micros("ts"))
        seen.append(sorted(tuple(r) for r in times.collect()))

    handle = model.read("events").writeStream.foreachBatch(look).option("checkpointLocation", str(tmp_path / "ck"))
    handle.trigger(availableNow=True).start().awaitTermination()
    events = spark.read.parquet(f"{SOURCE}/events.parquet")
    want = [
        sorted(tuple(r) for r in events.where(c).select("event_id", F.unix_micros(F.col("ts").cast("timestamp"))).collect())
        for c in model.conditions()
    ]
    assert seen == want


def test_runs_of_beats_replace_beats():
    import random

    import numpy as np

    from gaugeworks.streaming.state import _joined_runs

    pick = random.Random(7)
    for _ in range(50):
        beats = np.array(sorted(pick.sample(range(400), 60)), np.int64)
        starts = ends = np.zeros(0, np.int64)
        for part in np.array_split(np.array(pick.sample(beats.tolist(), 60), np.int64), 6):
            starts, ends = _joined_runs(np.concatenate([starts, part]), np.concatenate([ends, part]), 9)
        gap = np.diff(beats) > 9
        assert starts.tolist() == beats[np.append(True, gap)].tolist()
        assert ends.tolist() == beats[np.append(gap, True)].tolist()
    assert [len(x) for x in _joined_runs(starts[:0], ends[:0], 9)] == [0, 0]


@pytest.mark.parametrize("kind", [streams.LateStreamModel, streams.DailyModel])
def test_a_large_part_is_read_by_many_tasks(spark, tmp_path, split_events, monkeypatch, kind):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 50, raising=False)
    monkeypatch.setattr(streams, "FILLED", 10, raising=False)
    files = []

    def look(batch, epoch):
        files.append(batch.select(F.input_file_name()).distinct().count())

    handle = kind(spark, split_events).read("events").writeStream.foreachBatch(look)
    handle.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert len(files) == 4 and len(set(files)) == 1 and files[0] > 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", [streams.StreamModel, streams.LateStreamModel, streams.DailyModel, streams.CopiedStreamModel, streams.DisorderModel])
def test_customers_of_a_micro_batch_do_not_pass_the_driver(spark, tmp_path, split_events, kind):
    writer = kind(spark, split_events).fact.writeStream.foreachBatch(lambda batch, epoch: batch.count())
    handle = writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    handle.awaitTermination()
    plan = handle._jsq.explainInternal(False)
    assert "SortMergeJoin [entity_id" in plan and "BroadcastHashJoin [entity_id" not in plan


@pytest.mark.parametrize("name", ["d6_stream_sketches", "a10_stats_from_deltas"])
def test_customers_of_the_history_do_not_pass_the_driver(spark, name):
    from gaugeworks.plans import load_all

    assert "BroadcastHashJoin [entity_id" not in _plan(load_all()[name].run(spark, SOURCE))
