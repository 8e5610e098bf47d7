"""Links of embeddings against all pairs, the lattice's parts, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import lattice

NAMES = "vec_id long, embedding array<double>, label int"


def brute(rows, similarity=lattice.SIMILARITY):
    """(n_links, component) by row number of rows with distinct ids."""

    def usable(e, label):
        return label is not None and e and all(v is not None and math.isfinite(v) for v in e) and any(e)

    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    groups = {}
    for i, (_, e, label) in enumerate(rows):
        if usable(e, label):
            groups.setdefault((label, len(e)), []).append(i)
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], float)
        x /= np.abs(x).max(1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= similarity, 1)), strict=True):
            links[members[a]] += 1
            links[members[b]] += 1
            parent[find(members[a])] = find(members[b])
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return {row[0]: (links[i], least[find(i)]) for i, row in enumerate(rows)}


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.similar_vectors(df).collect()}


def unit(rng, n, dim=64):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def near(rng, u, cosine):
    w = rng.normal(size=len(u))
    w -= (w @ u) * u
    return cosine * u + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


@pytest.fixture(scope="module")
def planted():
    """Pairs just above the limit, groups of close vectors with equal ones and odd lengths, a label of each kind."""
    rng = np.random.default_rng(1)
    rows = []
    for k, u in enumerate(unit(rng, 300)):
        rows.append((u, k % 3))
        rows.append((near(rng, u, rng.uniform(0.93, 0.95)) * rng.choice((1e-3, 1, 40)), k % 3))
    for k, size in enumerate((300, 60, 20, 5)):
        centre = unit(rng, 1)[0]
        group = [near(rng, centre, rng.uniform(0.985, 0.999)) for _ in range(size)]
        rows += [(x, k % 2) for x in group + group[:4]]
        rows += [(near(rng, centre, 0.95), k % 2), (near(rng, centre, 0.97), k % 2), (centre, 7)]
    return [(i, x.tolist(), label) for i, (x, label) in enumerate(rows)]


def test_recall_of_planted_pairs(spark, planted):
    got, want = found(spark.createDataFrame(planted, NAMES)), brute(planted)
    assert all(got[i][0] <= n for i, (n, _) in want.items())
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())
    pairs = [got[i] == want[i] for i in range(600)]
    assert sum(pairs) >= 0.9 * 600


def test_blocks_and_balls_find_what_plain_comparison_finds(spark, planted, monkeypatch):
    df = spark.createDataFrame(planted, NAMES)
    plain = found(df)
    monkeypatch.setattr(lattice, "BLOCK", 16)
    assert found(df) == plain
    monkeypatch.setattr(lattice, "BALL", 10**9)  # no balls: every pair is made, and the lattice may miss a few
    pairs = found(df)
    assert all(n <= plain[i][0] for i, (n, _) in pairs.items())
    assert sum(n for n, _ in pairs.values()) >= 0.99 * sum(n for n, _ in plain.values())


def test_dense_groups_make_few_pairs(spark):
    rng = np.random.default_rng(2)
    centre = unit(rng, 1)[0]
    rows = [(i, near(rng, centre, 0.9925).tolist(), 1) for i in range(1_000)]
    df = spark.createDataFrame(rows, NAMES)
    nodes = lattice.vector_rows(df).withColumn("node", F.col("vec_id"))
    keyed = lattice.hashed(nodes)
    ball = lattice.balls(nodes, keyed, lattice.SIMILARITY)
    assert lattice.loose_links(nodes, keyed, ball, lattice.SIMILARITY).count() < 0.1 * 500 * 999
    got, want = found(df), brute(rows)
    assert sum(got[i] == want[i] for i in want) >= 990


def test_labels_and_lengths_are_kept_apart(spark):
    rng = np.random.default_rng(3)
    centre = unit(rng, 1)[0]
    rows = [(i, near(rng, centre, 0.995).tolist(), i % 2) for i in range(80)]
    rows += [(100 + i, [*near(rng, centre, 0.995).tolist(), 0.0], 0) for i in range(20)]
    got = found(spark.createDataFrame(rows, NAMES))
    assert got == brute(rows)


def test_odd_rows(spark):
    x, y = [1.0, 2.0, 0.0], [1e200, 2e200, 0.0]
    rows = [
        (1, x, 0), (2, x, 0), (2, x, 0), (None, y, 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0, 0.0], 0),
        (6, [1.0, None, 0.0], 0), (7, [1.0, float("nan"), 0.0], 0), (8, [float("inf"), 0.0, 0.0], 0), (9, x, None),
        (10, [1.0, 2.0], 0), (11, [2e-320, 4e-320, 0.0], 0), (12, [-1.0, -2.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, NAMES)
    for name in ("node", "unit", "same", "key", "keys", "u", "ball", "cell", "copies", "n_links"):
        df = df.withColumn(name, F.lit(name))
    got = sorted([(r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in lattice.similar_vectors(df).collect()])
    linked = [(0, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False)]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert got == [*linked, *alone, (11, 4, 1, False), (12, 0, 12, True)]
    assert lattice.similar_vectors(df.where("false")).count() == 0
    only = lattice.similar_vectors(df.where("vec_id IS NULL")).collect()
    assert [tuple(r) for r in only] == [(None, 0, None, True)]


def test_nearest_lattice_point():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)) * 3
    points = lattice.nearest(x)
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS**2).sum(1), 2)
    whole = np.all(points == np.rint(points), axis=1)
    assert np.all(whole | np.all(points - 0.5 == np.rint(points - 0.5), axis=1)) and np.all(points.sum(1) % 2 == 0)
    distance = ((x - points) ** 2).sum(1)
    around = ((x[:, None] - points[:, None] - lattice.ROOTS) ** 2).sum(2)
    assert np.all(distance <= around.min(1) + 1e-9)
