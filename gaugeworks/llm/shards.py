"""Best-fit-decreasing bin packing of indivisible groups into shards.

Groups of equal texts are sized where they are (pre-aggregated, so a group with a third of all rows is one
row), and counted per size class. The classes, largest first, enter the shard with the tightest remaining
capacity, found in a balanced tree; groups of one class fill a shard until it is full before the next one is
looked up, which is what placing them one by one would do. The driver holds one row per size class (at most
2^CLASS_BITS per power of two), never groups. Ranks of groups in a class and of documents in a shard are
made of counts per salt, so no window holds more than one salt of a class or shard.
"""

from __future__ import annotations

import random
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeworks.llm.common import slim, stored

CLASS_BITS = 10  # size classes per power of two: 2^10, so a class is exact to 0.1 %
ROWS_PER_SALT = 20_000
ROW_BYTES = 8  # counted for a document besides its text


class _Node:
    __slots__ = ("key", "left", "level", "right")

    def __init__(self, key):
        self.key, self.left, self.right, self.level = key, None, None, 1


class CapacityTree:
    """Ordered set of (remaining, shard) as a treap: logarithmic insert, removal and least key at or above."""

    def __init__(self, seed: int = 0):
        self.root = None
        self.random = random.Random(seed)

    def _split(self, node, key):
        """Nodes with keys under ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            low, high = self._split(node.right, key)
            node.right = low
            return node, high
        low, high = self._split(node.left, key)
        node.left = high
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low.level > high.level:
            low.right = self._merge(low.right, high)
            return low
        high.left = self._merge(low, high.left)
        return high

    def add(self, key) -> None:
        node = _Node(key)
        node.level = self.random.random()
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, node), high)

    def remove(self, key) -> None:
        low, rest = self._split(self.root, key)
        _, high = self._split(rest, (key[0], key[1] + 1))
        self.root = self._merge(low, high)

    def at_least(self, key):
        """The smallest key that is not under ``key``, or None."""
        node, found = self.root, None
        while node is not None:
            if node.key < key:
                node = node.right
            else:
                found, node = node.key, node.left
        return found

    def largest(self):
        node = self.root
        while node is not None and node.right is not None:
            node = node.right
        return node and node.key


class Run(NamedTuple):
    """Groups of a class with ranks in [first, last) go to a shard."""

    size: int
    first: int
    last: int
    shard: int


def place(classes: list[tuple[int, int]], capacity: int, shards: int | None = None) -> list[Run]:
    """Best fit decreasing of (size, count) classes.

    Without ``shards``, a new shard is opened when nothing fits; a group over the capacity gets one for
    itself. With a number of shards, what fits nowhere goes to the emptiest shard.
    """
    tree, runs, opened = CapacityTree(), [], shards or 0
    for shard in range(opened):
        tree.add((capacity, shard))
    for size, count in sorted(classes, reverse=True):
        done = 0
        while done < count:
            key = tree.at_least((size, -1))
            if key is None:
                if shards is None:
                    key = (max(capacity, size), opened)
                    opened += 1
                else:
                    key = tree.largest()
                    tree.remove(key)
            else:
                tree.remove(key)
            fit = max(1, key[0] // size) if size else count
            n = min(fit, count - done)
            runs.append(Run(size, done, done + n, key[1]))
            done += n
            tree.add((key[0] - n * size, key[1]))
    return runs


def even_capacity(classes: list[tuple[int, int]], shards: int) -> int:
    """Capacity with which the shards come out equal: groups over an even share each fill a shard of their
    own, the other shards share the rest."""
    total = sum(s * n for s, n in classes)
    left = shards
    for size, count in sorted(classes, reverse=True):
        for _ in range(count):
            if left <= 1 or size * left <= total:
                return -(-total // max(left, 1))
            total -= size
            left -= 1
    return -(-total // max(left, 1))


def size_class(size: Column, bits: int = CLASS_BITS) -> Column:
    """The size rounded up to ``bits`` significant binary digits."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1)))) - bits, F.lit(0))).cast("long")
    return (F.floor((size + step - 1) / step) * step).cast("long")


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str, salts: int) -> DataFrame:
    """Rank from 0, without gaps, of each row in its group, by salt and then ``order``.

    A group is cut into salts; a window numbers one salt of one group, and counts per salt shift it.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    within = Window.partitionBy(*group, "_salt")
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        salted.groupBy(*group, "_salt")
        .agg(F.count("*").alias("_n"))
        .select(*group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        salted.withColumn("_at", F.row_number().over(within.orderBy(*order)) - 1)
        .join(shift, [*group, "_salt"])
        .withColumn(rank, (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_salt", "_at", "_before")
    )


def shard_documents(docs: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    Either a number of shards that come out as equal in bytes as the groups allow, or a capacity in bytes
    for as few shards as best fit decreasing needs. Documents with equal texts stay together. A missing text
    is an empty one; repeated rows are documents of their own; a missing doc_id is kept and comes first in
    its salt. An empty table gives no rows.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    sized = stored(
        slim(docs).select(
            "doc_id",
            F.unhex(F.sha2("text", 256)).alias("text_key"),
            (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
        ),
        "sharding-sizes",
    )
    groups = stored(
        sized.groupBy("text_key")
        .agg(F.sum("size").alias("group_size"))
        .select("text_key", size_class(F.col("group_size")).alias("size_class")),
        "sharding-groups",
    )
    counts = [(r[0], r[1]) for r in groups.groupBy("size_class").count().collect()]
    n_groups = sum(n for _, n in counts)
    if capacity is None:
        runs = place(counts, even_capacity(counts, shards), shards)
    else:
        runs = place(counts, capacity)
    plan = spark.createDataFrame(
        [tuple(r) for r in runs] or [(0, 0, 0, 0)], "size_class long, first long, last long, shard int"
    )
    salts = max(1, n_groups // ROWS_PER_SALT)
    placed = (
        ranked(groups, ["size_class"], ["text_key"], "rank", salts)
        .join(plan, "size_class")
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
        .select("text_key", "shard")
    )
    located = sized.join(placed, "text_key").select("doc_id", "size", "text_crc32", "shard")
    salts = max(1, sized.count() // ROWS_PER_SALT)
    return ranked(located, ["shard"], ["doc_id", "text_crc32", "size"], "slot", salts).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
