"""Prefix trie of conversations by van Emde Boas recursion.

A node of the trie is a distinct sequence of first turns. Its name is its depth and the exclusive or of two
64-bit hashes of every (turn, place) in it, so the name of a long prefix is put together from parts in any
order. Sequences are cut at half depth: the name of the cut prefix is an aggregate over the upper half, and the
lower half goes on from it. Upper and lower halves are cut again, all of a round in one job, until a part has
``1 << leaf_bits`` turns, which a window names directly. A conversation of any length is thus divided over
tasks; only those longer than such a part take part in rounds.

Totals go the other way round the same cuts. In a round all nodes below a cut prefix are summed by its name,
which prunes the lower tree, and the sum is grafted on the prefix' node; upper and lower parts are then
independent. At the end every node knows the cut trees below its part, and hands its value to its ancestors of
the part, fewer than ``1 << leaf_bits``.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored

LEAF_BITS = 3
EVERY = 100  # conversations that share the first turns of one
HEADS = 6
CHUNK_CHARS = 1 << 20

NAME = ["depth", "n1", "n2"]
_NO_IDS = hashlib.sha256(b"").hexdigest()
_CUT = "array<struct<level:int,depth:bigint,n1:bigint,n2:bigint>>"


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _up(place: str, bits: int) -> Column:
    return F.shiftright(F.col(place), bits)


def _bit(place: str, bit: int) -> Column:
    return _up(place, bit).bitwiseAND(F.lit(1)) == 1


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Stored (conv_id, place, t1, t2, chars, part, row): turns in order, numbered from 0 within a conversation.

    The order is that of turn (null first), role, text. A long conversation spans range partitions; each counts
    its own rows, and the counts of the partitions before are added.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    # Equal rows, whose order is no matter, are told apart so that they too spread over partitions.
    turns = turns.withColumn("copy", F.monotonically_increasing_id())
    ranged = stored(
        turns.repartitionByRange(*order, "copy")
        .sortWithinPartitions(*order, "copy")
        .select(
            "conv_id",
            F.xxhash64("role", "text").alias("t1"),
            F.xxhash64(F.lit("second"), "role", "text").alias("t2"),
            F.length("text").cast("long").alias("chars"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "trie-turns",
    )
    spans = ranged.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part")
    spans = spans.select(
        "conv_id",
        "part",
        (F.sum("n").over(before) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    return ranged.join(spans, ["conv_id", "part"]).withColumn("place", F.col("row") + F.col("shift"))


def rebuilt(conversations: DataFrame, every: int = EVERY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations with shared beginnings, as (conv_id, n) and (conv_id, place, t1, t2, chars, n).

    A conversation starts with the first h turns of that whose id is rounded down to a multiple of ``every``,
    h being crc32 of its id modulo ``heads``, and goes on with its own turns after the first h.
    """
    placed = placed_turns(conversations)
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    own = placed.groupBy("conv_id").agg(F.first("n_turns").alias("own_n"))
    own = own.withColumns({"h": head, "base": F.col("conv_id") - F.col("conv_id") % every})
    bases = own.select(F.col("conv_id").alias("base"), F.col("own_n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = stored(
        own.join(bases, "base", "left").select(
            "conv_id", "base", taken.alias("taken"), (taken + F.greatest(F.col("own_n") - F.col("h"), F.lit(0))).alias("n")
        ),
        "trie-conversations",
    )
    bases = placed.where((F.col("conv_id") % every == 0) & (F.col("place") < heads - 1))
    shared = bases.select(F.col("conv_id").alias("base"), "place", "t1", "t2", "chars").join(convs, "base")
    # Of the own turns h is known again from the id; what the base gives is not, but for short bases.
    rest = placed.where(F.col("place") >= head).join(convs.select("conv_id", "taken", "n"), "conv_id")
    columns = ["conv_id", "place", "t1", "t2", "chars", "n"]
    sequences = (
        shared.where("place < taken").select(*columns)
        .unionByName(rest.withColumn("place", F.col("place") - head + F.col("taken")).select(*columns))
    )
    return convs.select("conv_id", "n"), sequences


def _started(parts: DataFrame, leaf_bits: int) -> tuple[DataFrame, int]:
    """(conv_id, part, s1, s2, cuts) of parts (conv_id, part, b1, b2, last) of long sequences, and the rounds.

    s1, s2 name the prefix before the part; cuts are the cut prefixes on the way to it, by round.
    """
    top = parts.agg(F.max("last")).first()[0]
    rounds = int(top).bit_length() if top else 0
    zero = F.lit(0).cast("long")
    parts = parts.withColumns({"s1": zero, "s2": zero, "cuts": F.array().cast(_CUT)})
    active = parts.where("false")
    for bit in reversed(range(rounds)):
        entering = parts.where(F.length(F.bin("last")) == bit + 1)
        now = active.unionByName(entering).withColumn("tree", _up("part", bit + 1))
        upper = (
            now.where(~_bit("part", bit))
            .where((F.col("tree") * 2 + 1) * (1 << bit) <= F.col("last"))
            .groupBy("conv_id", "tree")
            .agg(F.bit_xor("b1").alias("u1"), F.bit_xor("b2").alias("u2"))
        )
        depth = F.shiftleft(_up("part", bit), bit + leaf_bits)
        lower = now.where(_bit("part", bit)).join(upper, ["conv_id", "tree"])
        lower = lower.withColumns({"s1": _xor("s1", "u1"), "s2": _xor("s2", "u2")})
        cut = F.struct(F.lit(bit).alias("level"), depth.alias("depth"), F.col("s1").alias("n1"), F.col("s2").alias("n2"))
        lower = lower.withColumn("cuts", F.array_append("cuts", cut))
        active = stored(lower.select(parts.columns).unionByName(now.where(~_bit("part", bit)).select(parts.columns)), "trie-cuts")
    return active.select("conv_id", "part", "s1", "s2", "cuts"), rounds


def named_rows(sequences: DataFrame, leaf_bits: int = LEAF_BITS) -> tuple[DataFrame, int]:
    """Stored rows of all turns with the names of their node, its parent, its ancestors of the same part and
    its cut prefixes, and the number of rounds of cuts."""
    rows = sequences.withColumns(
        {
            "x1": F.xxhash64("t1", "t2", "place"),
            "x2": F.xxhash64(F.lit("second"), "t2", "t1", "place"),
            "part": _up("place", leaf_bits),
        }
    )
    inside = Window.partitionBy("conv_id", "part").orderBy("place")
    rows = rows.withColumns({"r1": F.bit_xor("x1").over(inside), "r2": F.bit_xor("x2").over(inside)})
    earlier = F.struct((F.col("place") + 1).alias("depth"), F.col("r1").alias("n1"), F.col("r2").alias("n2"))
    rows = rows.withColumn("above", F.collect_list(earlier).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    rows = stored(rows.select("conv_id", "place", "part", "n", "chars", "x1", "x2", "r1", "r2", "above"), "trie-rows")

    long = rows.where(F.col("n") > 1 << leaf_bits).groupBy("conv_id", "part")
    parts = long.agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.max("n").alias("n"))
    parts = stored(parts.withColumn("last", F.shiftright(F.col("n") - 1, leaf_bits)).drop("n"), "trie-parts")
    starts, rounds = _started(parts, leaf_bits)
    zero = F.lit(0).cast("long")
    first = rows.where("part = 0").withColumns({"s1": zero, "s2": zero, "cuts": F.array().cast(_CUT)})
    later = rows.where("part > 0").join(starts, ["conv_id", "part"])
    lifted = F.transform(
        "above",
        lambda a: F.struct(
            a["depth"].alias("depth"), a["n1"].bitwiseXOR(F.col("s1")).alias("n1"), a["n2"].bitwiseXOR(F.col("s2")).alias("n2")
        ),
    )
    named = first.unionByName(later.select(first.columns)).select(
        "conv_id",
        "chars",
        (F.col("place") + 1).alias("depth"),
        _xor("r1", "s1").alias("n1"),
        _xor("r2", "s2").alias("n2"),
        _xor("r1", "s1").bitwiseXOR(F.col("x1")).alias("p1"),
        _xor("r2", "s2").bitwiseXOR(F.col("x2")).alias("p2"),
        (F.col("place") + 1 == F.col("n")).alias("ends"),
        lifted.alias("above"),
        "cuts",
    )
    return stored(named, "trie-named"), rounds


def subtree_totals(nodes: DataFrame, rounds: int, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """Sums of leaf and saved over the subtree of every node that has turns, as (depth, n1, n2, leaves, saved)."""
    values = nodes.select(*NAME, "leaf", "saved", "above", "cuts")
    # The deepest place of all may end the last part: it takes part from the first round on.
    level = F.least(F.length(F.bin(_up("depth", leaf_bits))), F.lit(rounds)) - 1
    deep = values.where("false")
    for bit in reversed(range(rounds)):
        now = deep.unionByName(values.where((F.col("depth") >= 1 << leaf_bits) & (level == bit)))
        grafts = (
            now.withColumn("cut", F.try_element_at(F.filter("cuts", lambda c: c["level"] == bit), F.lit(1)))
            .where("cut IS NOT NULL")
            .groupBy("cut.depth", "cut.n1", "cut.n2")
            .agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        )
        plus = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        deep = stored(now.join(grafts, NAME, "left").select(*NAME, plus("leaf"), plus("saved"), "above", "cuts"), "trie-grafts")
    if rounds:
        values = deep.unionByName(values.where(F.col("depth") < 1 << leaf_bits))
    own = F.array(F.struct(*NAME))
    spread = values.select(F.explode(F.concat("above", own)).alias("at"), "leaf", "saved")
    return spread.groupBy("at.depth", "at.n1", "at.n2").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))


def id_hashes(ends: DataFrame) -> DataFrame:
    """(depth, n1, n2, ends_sha256) of rows (depth, n1, n2, conv_id): SHA-256 of a node's ids, ascending.

    SHA-256 is sequential. Ranges of ids become texts of up to CHUNK_CHARS side by side; a node's texts then
    pass in order through one hash state, as a stream.
    """

    def runs(batches):
        names, first, ids, size = None, None, [], 0
        done: list[tuple] = []
        for batch in batches:
            for *name, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != names or size > CHUNK_CHARS:
                    if ids:
                        done.append((*names, first, ",".join(ids)))
                    names, first, ids, size = name, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield _batch(done, "first", pa.int64(), "ids")
            done = []
        if ids:
            yield _batch([(*names, first, ",".join(ids))], "first", pa.int64(), "ids")

    def digests(batches):
        names, state = None, None
        for batch in batches:
            done = []
            for *name, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != names:
                    if state:
                        done.append((*names, None, state.hexdigest()))
                    names, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(done, "first", pa.int64(), "ends_sha256")
        if state:
            yield _batch([(*names, None, state.hexdigest())], "first", pa.int64(), "ends_sha256")

    key = "depth long, n1 long, n2 long, first long"
    ranged = ends.select(*NAME, "conv_id").repartitionByRange(*NAME, "conv_id").sortWithinPartitions(*NAME, "conv_id")
    texts = ranged.mapInArrow(runs, f"{key}, ids string")
    return texts.repartition(*NAME).sortWithinPartitions(*NAME, "first").mapInArrow(digests, f"{key}, ends_sha256 string").drop("first")


def _batch(rows: list[tuple], fourth: str, kind: pa.DataType, fifth: str) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [kind, pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[*NAME, fourth, fifth])


def prefix_trie(convs: DataFrame, sequences: DataFrame, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """The nodes of the trie over sequences: convs (conv_id, n) and their turns (conv_id, place, t1, t2, chars, n).

    One row per distinct prefix and one for the root: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. No conversations give no rows.
    """
    rows, rounds = named_rows(sequences, leaf_bits)
    nodes = rows.groupBy(*NAME).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum(F.col("ends").cast("long")).alias("n_ends"),
        F.max("chars").alias("chars"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.any_value("above").alias("above"),
        F.any_value("cuts").alias("cuts"),
    )
    saved = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf")
    nodes = stored(nodes.select(*NAME, "n_convs", "conv_id", "p1", "p2", leaf, saved, "above", "cuts"), "trie-nodes")

    zero = F.lit(0).cast("long")
    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root_of = {c: zero.alias(c) for c in NAME}
    totals = subtree_totals(nodes, rounds, leaf_bits)
    whole = nodes.agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")).select(
        *root_of.values(), F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", zero).alias("saved")
    )
    ends = rows.where("ends").select(*NAME, "conv_id").unionByName(
        convs.where("n = 0").select(*root_of.values(), "conv_id")
    )
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count("*").alias("n_children")
    )
    facts = [
        nodes.select(*NAME, "conv_id", "n_convs", "p1", "p2"),
        everyone.select(*root_of.values(), "conv_id", "n_convs"),
        children,
        totals,
        whole,
        id_hashes(ends),
    ]
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)
    joined = joined.groupBy(*NAME).agg(
        *(F.max(c).alias(c) for c in ("conv_id", "n_convs", "p1", "p2", "n_children", "leaves", "saved", "ends_sha256"))
    )
    joined = joined.where("conv_id IS NOT NULL")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("above_id")
    )
    first = convs.agg(F.min("conv_id")).first()[0]
    parent = F.when(F.col("depth") == 1, F.lit(first)).when(F.col("depth") > 1, F.col("above_id")).cast("long")
    # The children of the root, of which there may be very many, need no join.
    whose = joined.withColumn("depth_p", F.when(F.col("depth") > 1, F.col("depth")))
    out = whose.join(above.withColumnRenamed("depth", "depth_p"), ["depth_p", "p1", "p2"], "left")
    return out.select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """The trie of rebuilt conversations (``rebuilt``, ``prefix_trie``).

    Rows without a conv_id belong to no conversation and are left out. A missing turn comes first, a missing
    role or text is empty; turns with equal numbers are ordered by role and text, and repeated rows are turns
    of their own. Texts of any length count as a hash and a number of characters from the first job on. An
    empty table gives no rows; a table of turnless conversations the root alone. Further columns are ignored.
    """
    return prefix_trie(*rebuilt(conversations), leaf_bits)
