"""Time, JSON, ordered and statistical building blocks against plain definitions."""

import datetime as dt

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeworks.functions import jsonfn, quantiles, relations, timefn


def test_boundary_difference_counts_boundaries(table):
    df = table(
        "timestamp'2024-01-01 10:59:00', timestamp'2024-01-01 11:01:00'",
        "timestamp'2024-01-01 11:01:00', timestamp'2024-01-01 10:59:00'",
        "timestamp'1969-12-31 23:59:59.5', timestamp'1970-01-01 00:00:00.1'",
        names="a, b",
    )
    out = df.select(
        *[timefn.datediff_boundary(u, F.col("a"), F.col("b")).alias(u) for u in
          ("second", "minute", "hour", "day", "month")]
    )
    assert rows(out) == sorted([(120, 2, 1, 0, 0), (-120, -2, -1, 0, 0), (1, 1, 1, 1, 1)], key=repr)


def test_month_arithmetic_clamps_the_day():
    assert timefn.add_months(dt.datetime(2024, 3, 31), -1) == dt.datetime(2024, 2, 29)
    assert timefn.add_months(dt.datetime(2024, 1, 15), -13) == dt.datetime(2022, 12, 15)
    aware = dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert timefn.resolve_as_of(aware) == dt.datetime(2024, 1, 1)


def test_calendar_columns(table):
    df = table("timestamp'2024-01-07 05:00:00'", names="t")  # a Sunday
    out = df.select(*[c.alias(n) for n, c in timefn.derived_time_columns(F.col("t")).items()]).first()
    assert out.ingested_day_of_week == 0 and out.ingested_week == dt.date(2024, 1, 1)
    assert out.year_month == "2024-01" and out.ingested_hour == 5


def test_month_predicate_only_on_stored_months(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-05' AS ingested_at, '2024-01' AS year_month")
    df.write.partitionBy("year_month").parquet(str(tmp_path / "t"))
    stored = timefn.since(spark.read.parquet(str(tmp_path / "t")), dt.datetime(2024, 1, 1))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    derived = df.drop("year_month").withColumns(
        {"year_month": timefn.derived_time_columns(F.col("ingested_at"))["year_month"]}
    )
    assert "2024-01'" not in timefn.since(derived, dt.datetime(2024, 1, 1))._jdf.queryExecution().toString()


MERGES = [
    ('{"zone":"north","valve":true,"level":2}', '{"level":7.5,"tags":["x"]}',
     '{"level":7.5,"tags":["x"],"valve":true,"zone":"north"}'),
    ('{"a":1}', '{"a":null}', '{"a":null}'),
    ('{"a":{"x":1,"y":2}}', '{"a":{"z":3}}', '{"a":{"z":3}}'),
    ('{"a":1}', '{"a":"1"}', '{"a":"1"}'),
    (None, '{"b":2,"a":[1,"x"]}', '{"a":[1,"x"],"b":2}'),
    ('{"k\\"q":"it\'s"}', '{}', '{"k\\"q":"it\'s"}'),
]


@pytest.mark.parametrize("old,new,expected", MERGES)
def test_merge(spark, old, new, expected):
    df = spark.createDataFrame([(old, new)], "old string, new string")
    assert df.select(jsonfn.merge(F.col("old"), F.col("new"))).first()[0] == expected


CONTAINS = [
    ({"env": "prod"}, True), ({"env": "test"}, False), ({"n": 8}, True), ({"n": "8"}, False),
    ({"n": 8.0}, True), ({"s": "8"}, True), ({"s": 8}, False), ({"tags": ["b"]}, True),
    ({"tags": ["b", "a"]}, True), ({"tags": ["c"]}, False), ({"o": {"x": {"y": True}}}, True),
    ({"o": {"x": {"y": False}}}, False), ({"o": {}}, True), ({"n": {}}, False), ({"missing": None}, False),
    ({"nul": None}, True), ({}, True), ({"list": [{"k": 1}]}, True), ({"list": [{"k": 2}]}, False),
]
DOC = (
    '{"env":"prod","n":8,"s":"8","tags":["a","b"],"o":{"x":{"y":true},"z":1},"nul":null,'
    '"list":[{"k":1,"m":2}]}'
)


@pytest.mark.parametrize("pattern,expected", CONTAINS)
def test_contains(spark, pattern, expected):
    df = spark.createDataFrame([(DOC,)], "d string")
    assert df.select(jsonfn.contains(F.col("d"), pattern)).first()[0] is expected


def test_json_reads(spark):
    df = spark.createDataFrame([(DOC,)], "d string")
    d = F.col("d")
    out = df.select(
        jsonfn.text(d, "n"), jsonfn.fragment(d, "s"), jsonfn.fragment(d, "tags"), jsonfn.number(d, "s"),
        jsonfn.number(d, "env"), jsonfn.has_key(d, "nul"), jsonfn.has_key(d, "x"),
        jsonfn.has_any(d, ["x", "n"]), jsonfn.has_all(d, ["x", "n"]),
    ).first()
    assert tuple(out) == ("8", '"8"', '["a","b"]', 8, None, True, False, True, False)
    elements = df.select(jsonfn.array_elements(jsonfn.fragment(d, "tags"), "array<string>"))
    assert rows(elements) == [("a",), ("b",)]


def _events(spark, n=4000, seed=3):
    """Readings where one key owns a third of the rows, with ties and nulls."""
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    secs = rng.integers(0, 200_000, n)
    vals = np.round(rng.normal(50, 20, n), 2)
    data = [
        (int(k), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(s)), float(v) if i % 17 else None, i)
        for i, (k, s, v) in enumerate(zip(keys, secs, vals))
    ]
    return spark.createDataFrame(data, "k long, t timestamp, v double, id long")


@pytest.mark.parametrize(("unit", "limit"), [("second", 10**6), ("second", 2), ("minute", 20), ("hour", 200)])
def test_sliced_lag_equals_lag(spark, unit, limit):
    df = _events(spark)
    df = df.unionByName(df.limit(30).withColumns({"k": F.lit(None).cast("long"), "id": -F.col("id")}))
    cuts = relations.cuts_of_large_keys(df, ["k"], F.col("t"), limit)
    assert (cuts is None) == (limit == 10**6)
    sliced = relations.previous_in_slices(df, ["k"], ["t", "id"], ["v", "id"], F.col("t"), cuts, unit=unit)
    plain = df.withColumn("_prev", F.lag(F.struct("v", "id")).over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(sliced, "id", "_prev.v", "_prev.id") == rows(plain, "id", "_prev.v", "_prev.id")


def test_latest_by_equals_row_number(spark):
    df = _events(spark)
    w = Window.partitionBy("k").orderBy(F.desc("t"), F.desc_nulls_last("v"), F.desc("id"))
    ranked = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(relations.latest_by(df, ["k"], ["t"])) == rows(ranked)


def test_slices_of_a_hot_key_stay_small(spark):
    """Nine of ten rows belong to one key, most of them in one hour: no slice and no list of edge rows is large."""
    df = spark.range(20_000).selectExpr(
        "IF(id % 10 = 0, id, 0) AS k",
        "timestamp_seconds(1704067200 + IF(id % 5 = 0, (id * 7) % 3600, (id * 13) % 864000)) AS t", "id",
    )
    cuts = relations.cuts_of_large_keys(df, ["k"], F.col("t"), 500)
    cut = relations.sliced(df, ["k"], F.col("t"), cuts)
    slices = cut.groupBy("k", "_slice").agg(F.count("*").alias("n"))
    assert slices.where("_slice IS NULL").agg(F.max("n")).first()[0] <= 500
    assert slices.where("_slice IS NOT NULL").agg(F.max("n")).first()[0] <= 500
    assert slices.where("_slice IS NOT NULL").count() < 3600 + 240
    assert cut.where("_slice IS NOT NULL").select("k").distinct().count() == 1
    for known in (cuts, None):
        got = relations.previous_in_slices(df, ["k"], ["t", "id"], ["id"], F.col("t"), known)
        lag = F.lag("id").over(Window.partitionBy("k").orderBy("t", "id"))
        assert rows(got.select("id", "_prev.id")) == rows(df.select("id", lag.alias("p")))


def test_asof_ties_do_not_depend_on_the_input_order(spark):
    left = spark.sql("SELECT 1 AS k, timestamp'2024-01-01 10:00:00' AS t")
    made = [("b",), ("a",), ("c",)]
    for order in (made, made[::-1]):
        right = spark.createDataFrame(order, "x string").coalesce(1).selectExpr("1 AS k", "timestamp'2024-01-01 10:00:00' AS t", "x")
        assert relations.asof_backward(left, right, ["k"], "t", ["x"]).first().x == "c"


@pytest.mark.parametrize("limit", [10**6, 10, 300])
def test_asof_backward_equals_last_value(spark, limit):
    df = _events(spark)
    left = df.where("id % 2 = 0").select("k", "t", "id")
    right = df.where("id % 2 = 1").select("k", "t", F.col("id").alias("rid"))
    got = relations.asof_backward(left, right, ["k"], "t", ["rid"], "minute", limit)
    pairs = left.join(right.withColumnRenamed("t", "rt"), "k").where("rt <= t")
    best = pairs.groupBy("id").agg(F.max(F.struct("rt", "rid"))["rid"].alias("rid"))
    expected = left.join(best, "id", "left")
    assert rows(got, "id", "rid") == rows(expected, "id", "rid")


def test_buckets_follow_the_order_of_values(spark):
    values = sorted({s * m * 2.0**e for e in range(-40, 60, 3) for m in (1, 1 - 2**-53, 1.3, 1 + 2**-52) for s in (1, -1)} | {0.0})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.b for r in df.orderBy("v").select(quantiles.bucket_of(F.col("v")).alias("b")).collect()]
    assert got == sorted(got)


@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (-1e-6, 0.0), (1.0, 1e9), (1e12, -3e14)])
def test_percentiles(spark, scale, shift):
    df = _events(spark).withColumn("v", F.col("v") * scale + shift)
    probs = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = quantiles.exact_percentiles(df, ["k"], F.col("v"), probs)
    expected = df.where("v IS NOT NULL").groupBy("k").agg(
        *[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()]
    )
    a, b = got.orderBy("k").toPandas(), expected.orderBy("k").toPandas()
    assert list(a["k"]) == list(b["k"])
    np.testing.assert_allclose(a[list(probs)], b[list(probs)], rtol=1e-12)


def test_no_piece_of_a_narrow_band_is_large(spark):
    """A million distinct values of 1.7e9 and above lie in two buckets; what is ordered stays small."""
    counts = spark.range(1_000_000).selectExpr("id % 2 AS k", "1.7e9D + id / 3 AS v", "1L AS c")
    held = quantiles.pieces(counts, ["k"], {"a": 0.5, "b": 0.99})
    sizes = held.groupBy("k", "_bucket", "_piece").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= quantiles.PIECE_ROWS and sizes[1] <= 8
    got = rows(quantiles.percentiles_of_counts(counts, ["k"], {"a": 0.5, "b": 0.99}))
    for k, a, b in got:
        v = 1.7e9 + np.arange(k, 1_000_000, 2) / 3
        assert np.allclose([a, b], np.percentile(v, [50, 99]), rtol=0, atol=1e-6)


def test_weighted_percentiles_equal_repeated_rows(spark):
    df = _events(spark, 600).withColumn("w", F.col("id") % 4)
    repeated = df.where("w > 0").withColumn("x", F.explode(F.sequence(F.lit(1), F.col("w"))))
    probs = {"a": 0.3, "b": 0.9}
    got = quantiles.exact_percentiles(
        df.where("w > 0"), ["k"], F.col("v"), probs, weight=F.col("w")
    )
    expected = quantiles.exact_percentiles(repeated, ["k"], F.col("v"), probs)
    assert rows(got) == rows(expected)


def test_null_keys_are_groups(table):
    df = table("NULL, 1.0D", "NULL, 3.0D", "'a', 5.0D", names="k, v")
    out = quantiles.exact_percentiles(df, ["k"], F.col("v"), {"m": 0.5})
    assert rows(out) == sorted([(None, 2.0), ("a", 5.0)], key=repr)


def test_approximate_percentiles_stay_within_rank_error(spark):
    df = _events(spark)
    out = quantiles.approx_percentiles(df.where("k = 0"), ["k"], F.col("v"), {"m": 0.5}, accuracy=1000)
    values = sorted(r.v for r in df.where("k = 0 AND v IS NOT NULL").collect())
    rank = np.searchsorted(values, out.first().m) / len(values)
    assert abs(rank - 0.5) < 0.01


def test_mode_takes_the_smallest_on_a_tie(table):
    df = table("1, 5.0D", "1, 5.0D", "1, 2.0D", "1, 2.0D", "1, 9.0D", names="k, v")
    counts = quantiles.value_counts(df, ["k"], F.col("v"))
    assert rows(quantiles.mode_of_counts(counts, ["k"])) == [(1, 2.0)]
