"""Near duplicates among embeddings by lattice hashing.

A table projects the unit vectors at random to two times eight coordinates and decodes each eight to the nearest
point of the E8 lattice; the two points name the cell. A vector is entered under its own cell and under the
cells where one of the two points is a neighbouring lattice point, so that close vectors on either side of a
cell border meet as well. Rows that share a key are compared by their vectors in eight bits, whose error is
known and allowed for; the pairs that remain are verified by the cosine of the vectors themselves.

A dense group would make all its pairs. It is taken out first: cells of a finer lattice with many members
give centres, and a vector within half of the limiting angle of its centre joins the ball of that centre. By
the triangle inequality any two members of a ball are linked, so a ball is counted, not compared; only pairs of
which the two belong to different balls, or to none, are made. A key with very many rows is cut into blocks of
rows, and pairs of blocks are compared in tasks of their own.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.chunks import mixed
from gaugeworks.llm.common import stored
from gaugeworks.llm.graph import components

SIMILARITY = 0.93
TABLES, PROBES, CELL = 4, 1, 2.6
FINE_TABLES, FINE_PROBES, FINE_CELL = 4, 2, 1.8
BALL = 8  # members of a fine cell that has a centre
MERGE = math.radians(6)  # centres this close are one
BLOCK = 4_096  # rows of a key compared in one go
ROWS_PER_BUCKET = 200_000
SEED = 42
POINTS = 2  # lattice points of a cell


def _roots() -> np.ndarray:
    """The 240 shortest vectors of the E8 lattice."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            whole.append(v)
    halves = [s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + halves, float)


ROOTS = _roots()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    r = np.rint(x)
    off = x - r
    odd = np.flatnonzero(r.sum(1).astype(np.int64) & 1)
    at = np.abs(off[odd]).argmax(1)
    r[odd, at] += np.where(off[odd, at] >= 0, 1, -1)
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points: whole coordinates of even sum, or those moved by one half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - b) ** 2).sum(1) < ((x - a) ** 2).sum(1))[:, None], b, a)


def lattice_keys(units: np.ndarray, salt: np.ndarray, tables: int, probes: int, cell: float) -> np.ndarray:
    """Keys of unit vectors, a row each: per table its own cell, then the probed ones. Equal salts share keys."""
    n, dim = units.shape
    rng = np.random.default_rng([SEED, dim, tables, round(cell * 1000)])
    planes = rng.normal(size=(dim, tables * POINTS * 8)) / cell
    weights = rng.integers(0, 2**63, (tables, POINTS, 8), np.uint64) * np.uint64(2) + np.uint64(1)
    steps = (2 * ROOTS).astype(np.int64).view(np.uint64)
    x = units @ planes
    out = []
    for t in range(tables):
        own = mixed(salt ^ mixed(np.full(n, t + 1, np.uint64)))
        sums, moves = np.zeros(n, np.uint64), []
        for p in range(POINTS):
            lo = (t * POINTS + p) * 8
            part = x[:, lo : lo + 8]
            point = nearest(part)
            sums += (2 * point).astype(np.int64).view(np.uint64) @ weights[t, p]
            far = (part - point) @ ROOTS.T  # larger: nearer to that neighbour
            best = np.argpartition(-far, min(probes, 239), axis=1)[:, :probes]
            moves += [steps[best[:, k]] @ weights[t, p] for k in range(probes)]
        out += [mixed(own ^ mixed(sums + move)) for move in [np.zeros(n, np.uint64), *moves]]
    return np.stack(out, 1) if n else np.zeros((0, tables * (1 + POINTS * probes)), np.uint64)


def unit_rows(column: pa.Array) -> list[bytes | None]:
    """Unit vectors in double precision as bytes; None for null and zero vectors and those with null or
    non-finite components."""
    out: list[bytes | None] = []
    for value in column:
        x = None if not value.is_valid or value.values is None or value.values.null_count else value.values
        x = None if x is None else x.to_numpy(zero_copy_only=False).astype(float)
        top = np.abs(x).max() if x is not None and len(x) and np.isfinite(x).all() else 0.0
        if top > 0:
            x = x / top  # neither squares nor their sum leave the range
            out.append((x / np.linalg.norm(x)).tobytes())
        else:
            out.append(None)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, from bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), -1)


def _lengths(column: pa.Array):
    """Row numbers by length of the vectors."""
    sizes = np.array([len(v) for v in column.to_pylist()], np.int64)
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def vector_rows(vectors: DataFrame) -> DataFrame:
    """Stored (vec_id, label, unit, same): the unit vector, and a 128-bit hash of label and vector; both are
    null where a vector links with nothing."""

    def run(batches):
        for batch in batches:
            labels = batch.column(1).to_pylist()
            units = [None if label is None else u for label, u in zip(labels, unit_rows(batch.column(2)), strict=True)]
            same = [
                None if u is None else hashlib.md5(f"{len(label)} {label}".encode() + u).digest()
                for label, u in zip(labels, units, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(units, pa.binary()), pa.array(same, pa.binary())],
                names=["vec_id", "label", "unit", "same"],
            )

    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding"
    )
    return stored(own.mapInArrow(run, "vec_id long, label string, unit binary, same binary"), "lattice-rows")


def _salt(labels: list[str], dim: int) -> np.ndarray:
    made = {x: int.from_bytes(hashlib.md5(f"{dim} {x}".encode()).digest()[:8], "little") for x in set(labels)}
    return np.array([made[x] for x in labels], np.uint64)


def hashed(nodes: DataFrame) -> DataFrame:
    """Stored (node, small, step, slack, keys, fine, salt): the vector in eight bits, its step, the length of what
    that leaves out, the keys, the keys of the finer lattice (own cells first in each table), and what tells
    labels and lengths apart."""

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            for rows in _lengths(column):
                take = pa.array(rows)
                units = _matrix(column.take(take))
                salt = _salt(batch.column(1).take(take).to_pylist(), units.shape[1])
                step = np.abs(units).max(1) / 127
                small = np.rint(units / step[:, None]).astype(np.int8)
                slack = np.linalg.norm(units - small * step[:, None], axis=1)
                keys = lattice_keys(units, salt, TABLES, PROBES, CELL).view(np.int64)
                fine = lattice_keys(units, salt, FINE_TABLES, FINE_PROBES, FINE_CELL).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        pa.array([r.tobytes() for r in small], pa.binary()),
                        pa.array(step),
                        pa.array(slack),
                        pa.array(list(keys), pa.list_(pa.int64())),
                        pa.array(list(fine), pa.list_(pa.int64())),
                        pa.array(salt.view(np.int64)),
                    ],
                    names=["node", "small", "step", "slack", "keys", "fine", "salt"],
                )

    schema = "node long, small binary, step double, slack double, keys array<long>, fine array<long>, salt long"
    return stored(nodes.select("node", "label", "unit").mapInArrow(run, schema), "lattice-keys")


def _cosines(df: DataFrame, keep: str, least: float) -> DataFrame:
    """Rows of df, its columns ``keep`` (longs), whose vectors ``unit`` and ``other`` have that cosine or more."""
    names = keep.split()

    def run(batches):
        for batch in batches:
            x, y = batch.column(len(names)), batch.column(len(names) + 1)
            near = np.zeros(batch.num_rows, bool)
            for rows in _lengths(x):
                take = pa.array(rows)
                near[rows] = np.einsum("ij,ij->i", _matrix(x.take(take)), _matrix(y.take(take))) >= least
            yield batch.select(list(range(len(names)))).filter(pa.array(near))

    return df.select(*names, "unit", "other").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def balls(nodes: DataFrame, keyed: DataFrame, similarity: float) -> DataFrame:
    """Stored (node, ball) of the nodes that lie within half the limiting angle of a centre; ball is negative."""
    width = 1 + POINTS * FINE_PROBES
    own = F.transform(F.sequence(F.lit(0), F.lit(FINE_TABLES - 1)), lambda t: F.col("fine")[t * width])
    cells = keyed.select("node", F.explode(own).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    cells = stored(cells.where(F.col("n") >= BALL), "lattice-cells")
    near = keyed.select("node", "salt", F.explode("fine").alias("cell"), own.alias("own"))
    near = near.join(cells, "cell").withColumn("inside", F.array_contains("own", F.col("cell")))
    near = near.groupBy("node", "salt").agg(F.collect_list(F.struct("cell", "inside")).alias("cells"))  # few per node
    near = stored(near.join(nodes.select("node", "unit"), "node"), "lattice-dense")

    def partial(batches):
        for batch in batches:
            sums: dict[tuple[int, int], list] = {}
            for cells_of, unit, salt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(unit, float)
                for c in cells_of:
                    if c["inside"]:
                        have = sums.setdefault((c["cell"], salt), [0, np.zeros(len(x))])
                        have[0] += 1
                        have[1] += x
            rows = [(cell, salt, n, x.tobytes()) for (cell, salt), (n, x) in sums.items()]
            kinds = [pa.int64()] * 3 + [pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cell", "salt", "n", "total"])

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(t, float) for t in pdf["total"]], axis=0)
        size = np.linalg.norm(total)
        units = [(total / size).tobytes()] if size > 0 else []
        first = pdf[["cell", "salt"]][: len(units)]
        return first.assign(n=pdf["n"].sum(), centre=units)

    sums = near.select("cells", "unit", "salt").mapInArrow(partial, "cell long, salt long, n long, total binary")
    found = sums.groupBy("cell", "salt").applyInPandas(centre, "cell long, salt long, n long, centre binary")
    centres = stored(found, "lattice-centres")
    centres = merged(centres)
    reach = math.cos(math.acos(similarity) / 2 - 1e-6)
    told = near.select("node", "unit", F.explode("cells.cell").alias("cell")).join(centres, "cell")
    # A node may join its cell's centre or the one that stands for it.
    either = told.select("node", "unit", F.explode(F.array(F.struct("cell", "n", "centre"), "master")).alias("c"))
    either = either.select("node", F.col("c.cell").alias("cell"), F.col("c.n").alias("n"), "unit", F.col("c.centre").alias("other"))
    joined = _cosines(either, "node cell n", reach).groupBy("node").agg(F.max(F.struct("n", "cell")).alias("c"))
    # Cell keys are any 64 bits, nodes are not negative.
    ball = F.when(F.col("c.cell") < 0, F.col("c.cell")).otherwise(-1 - F.col("c.cell"))
    return stored(joined.select("node", ball.alias("ball")), "lattice-balls")


def merged(centres: DataFrame) -> DataFrame:
    """Centres (cell, salt, n, centre) as (cell, n, centre, master): the largest centre that shares a key and lies
    within MERGE of it."""

    def run(batches):
        for batch in batches:
            for rows in _lengths(batch.column(2)):
                take = pa.array(rows)
                units = _matrix(batch.column(2).take(take))
                salt = batch.column(3).take(take).to_numpy(zero_copy_only=False).view(np.uint64)
                keys = lattice_keys(units, salt, TABLES, PROBES, CELL).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(take) for k in range(3)), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["cell", "n", "centre", "keys"],
                )

    keyed = centres.select("cell", "n", "centre", "salt").mapInArrow(run, "cell long, n long, centre binary, keys array<long>")
    keyed = stored(keyed.withColumn("key", F.explode("keys")).drop("keys"), "lattice-centre-keys")
    largest = keyed.groupBy("key").agg(F.max(F.struct("n", "cell", "centre")).alias("top"))
    pairs = keyed.join(largest, "key").where("top.cell <> cell")
    pairs = pairs.select("cell", F.col("top.cell").alias("to"), F.col("centre").alias("unit"), F.col("top.centre").alias("other"))
    near = _cosines(pairs.distinct(), "cell to", math.cos(MERGE))
    to = centres.select(F.col("cell").alias("to"), F.struct("n", F.col("cell"), "centre").alias("m"))
    best = near.join(to, "to").groupBy("cell").agg(F.max("m").alias("m"))
    mine = F.struct("n", "cell", "centre")
    out = centres.join(best, "cell", "left").withColumn("m", F.greatest(F.coalesce("m", mine), mine))
    return out.select("cell", "n", "centre", F.struct("m.cell", "m.n", "m.centre").alias("master"))


def close_rows(pdf: pd.DataFrame, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of different units that may have that cosine, among rows of equal (task, dim)."""
    dims = np.array([len(s) for s in pdf["small"]])
    order = np.lexsort((pdf["side"], dims, pdf["bx"], pdf["by"], pdf["key"]))
    pdf, dims = pdf.iloc[order], dims[order]
    columns = [pdf[c].to_numpy() for c in ("key", "bx", "by")] + [dims]
    node, unit, side, slack = (pdf[c].to_numpy() for c in ("node", "u", "side", "slack"))
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    start = np.flatnonzero(np.concatenate([[True], new])) if len(pdf) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(pdf)))
    a, b = [node[:0]], [node[:0]]
    for s, n in zip(start[size > 1], size[size > 1], strict=True):
        part = slice(s, s + n)
        if (unit[part] == unit[s]).all():
            continue
        x = np.frombuffer(b"".join(pdf["small"].iloc[part]), np.int8).reshape(n, -1)
        x = x * pdf["step"].to_numpy()[part, None].astype(np.float32)
        across = columns[1][s] != columns[2][s]
        middle = int((side[part] == 0).sum()) if across else 0
        u, e, ids = unit[part], slack[part], node[part]
        for lo in range(0, middle if across else n, 1_024):
            hi = min(lo + 1_024, middle if across else n)
            first = middle if across else lo
            allowed = e[lo:hi, None] + e[None, first:] + e[lo:hi, None] * e[None, first:] + 1e-4
            hit = (x[lo:hi] @ x[first:].T >= similarity - allowed) & (u[lo:hi, None] != u[None, first:])
            i, j = np.nonzero(hit)
            a.append(ids[lo + i])
            b.append(ids[first + j])
    a, b = np.concatenate(a), np.concatenate(b)
    found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return found[:, 0], found[:, 1]


def loose_links(nodes: DataFrame, keyed: DataFrame, ball: DataFrame, similarity: float) -> DataFrame:
    """Stored (a, b) of linked nodes that are not of one ball, a < b."""
    rows = keyed.drop("fine").join(ball, "node", "left").withColumn("u", F.coalesce("ball", "node")).drop("ball")
    rows = stored(rows, "lattice-units")
    single = rows.select(F.explode("keys").alias("key"), "u").groupBy("key", "u").agg(F.count("*").alias("n"))
    busy = single.groupBy("key").agg(
        F.sum("n").alias("total"), F.count("*").alias("units"), F.max(F.struct("n", "u")).alias("top")
    )
    # Keys with more than a block of rows; the rows of their largest unit need not be compared with each other.
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    busy = busy.where(F.col("total") > BLOCK).select(
        "key",
        F.col("top.u").alias("top_u"),
        blocks(F.col("total") - F.col("top.n")).alias("others"),
        blocks(F.col("top.n")).alias("tops"),
    )
    busy = stored(busy, "lattice-busy")
    spread = rows.withColumn("key", F.explode("keys")).drop("keys").join(busy, "key", "left")
    alone = F.col("others").isNull()
    h = F.xxhash64("node")
    mine = (
        F.when(alone, 0)
        .when(F.col("u") == F.col("top_u"), F.col("others") + F.pmod(h, F.col("tops")))
        .otherwise(F.pmod(h, F.col("others")))
        .cast("int")
    )
    last = F.when(alone, 0).when(mine >= F.col("others"), F.col("others") - 1).otherwise(F.col("others") + F.col("tops") - 1)
    spread = spread.where(alone | (F.col("others") > 0)).withColumn("mine", mine)
    spread = spread.withColumn("partner", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    spread = spread.select(
        "key",
        F.least("mine", "partner").alias("bx"),
        F.greatest("mine", "partner").alias("by"),
        (F.col("mine") > F.col("partner")).cast("int").alias("side"),
        "node", "u", "small", "step", "slack",
    )
    width = TABLES * (1 + POINTS * PROBES)
    buckets = max(1, rows.count() * width // ROWS_PER_BUCKET)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = close_rows(pdf, similarity)
        return pd.DataFrame({"a": a, "b": b})

    bucket = F.pmod(F.xxhash64("key", "bx", "by"), F.lit(buckets)).alias("bucket")
    pairs = stored(spread.groupBy(bucket).applyInPandas(meet, "a long, b long").distinct(), "lattice-pairs")
    side = lambda c, u: nodes.select(F.col("node").alias(c), F.col("unit").alias(u), F.col("label").alias(f"label_{c}"))
    both = pairs.join(side("a", "unit"), "a").join(side("b", "other"), "b").where("label_a = label_b")
    return stored(_cosines(both, "a b", similarity), "lattice-links")


def similar_vectors(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Two vectors are linked when their labels are equal and their cosine, in double precision, is at least
    ``similarity``; a link of the result always holds, and links the lattice misses are few (the tests measure
    the share found). Null vectors, zero vectors, vectors with null or non-finite components and those without a
    label link with nothing; vectors of different lengths neither. Equal vectors are one row until the end; a
    repeated row, with the same vec_id or not, counts as a vector of its own. A missing vec_id stays missing and
    names a component only if no other does. An empty table gives no rows; further columns are not read.
    """
    rows = vector_rows(vectors)
    nodes = rows.where("same IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    nodes = nodes.groupBy("same").agg(
        F.min("row").alias("node"),
        F.count("*").alias("copies"),
        F.min("vec_id").alias("first_id"),
        F.any_value("label").alias("label"),
        F.any_value("unit").alias("unit"),
    )
    nodes = stored(nodes, "lattice-nodes")
    keyed = hashed(nodes)
    ball = balls(nodes, keyed, similarity)
    links = loose_links(nodes, keyed, ball, similarity)

    own = nodes.select("node", "same", "copies", "first_id").join(ball, "node", "left")
    members = own.where("ball IS NOT NULL").groupBy("ball").agg(F.sum("copies").alias("in_ball"), F.min("node").alias("head"))
    own = stored(own.join(members, "ball", "left"), "lattice-members")
    copies = lambda c: own.select(F.col("node").alias(c), F.col("copies").alias(f"copies_{c}"))
    weighed = links.join(copies("a"), "a").join(copies("b"), "b")
    outside = (
        weighed.select(F.col("a").alias("node"), F.col("copies_b").alias("n"))
        .unionByName(weighed.select(F.col("b").alias("node"), F.col("copies_a").alias("n")))
        .groupBy("node")
        .agg(F.sum("n").alias("outside"))
    )
    edges = links.unionByName(own.where("head <> node").select(F.col("node").alias("a"), F.col("head").alias("b")))
    rooted = own.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = rooted.join(least, "root").join(outside, "node", "left")
    told = told.select(
        "same",
        (F.coalesce("in_ball", "copies") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
        "component_id",
    )
    joined = rows.select("vec_id", "same").join(told, "same", "left")
    component = F.when(F.col("same").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
