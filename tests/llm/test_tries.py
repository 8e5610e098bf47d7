"""The trie of rebuilt conversations against plain dictionaries, for parts of every size, and odd rows."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import tries


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    sequences = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        sequences[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(int)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, m in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(m) - 1) * (len(key[-1][1]) if key else 0)
    out = []
    for key, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(key), parent, len(m), children[key], leaves[key], saved[key], sha))
    return sorted(out, key=repr)


def found(df, leaf_bits=tries.LEAF_BITS):
    return sorted((tuple(r) for r in tries.conversation_trie(df, leaf_bits).collect()), key=repr)


def odd_rows():
    rng = random.Random(1)
    rows = []
    for c in [*range(30), 100, 101, 102, -5, -100, 205, *range(300, 320), 2**62]:
        for i in range(rng.choice((1, 3, 8, 9, 17, 70))):
            rows.append((c, rng.choice((None, i, i, i)), rng.choice(("a", "b", None)), rng.choice(("x", "yé", None, ""))))
    for c in range(400, 420):
        shared = rng.choice((5, 30, 60, 64))
        rows += [(c, i, "u", "same" if i < shared else str(rng.random())) for i in range(rng.choice((20, 33, 64)))]
    return rows + [(None, 1, "a", "b"), (7, 3, "a", "x"), (7, 3, "a", "x"), (8, 0, "a", "long " * 100_000)]


@pytest.mark.parametrize("leaf_bits", [0, 2, 3])
def test_odd_conversations(spark, leaf_bits):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("depth", "n", "n1", "place", "part", "row", "base", "copy", "cuts"):
        df = df.withColumn(name, F.lit(name))
    assert found(df, leaf_bits) == brute(rows)


def test_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])
    assert found(df) == want and len(want) > 200


def test_none_and_turnless(spark):
    df = spark.createDataFrame([(501, 0, "a", "b")], "conv_id long, turn long, role string, text string")
    assert found(df.where("false")) == []
    rows = [(c, 0, "a", "b") for c in range(501, 520)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(df) == brute(rows)


def test_ids_of_one_node_in_many_texts(spark, monkeypatch):
    df = spark.range(3_000).selectExpr("1L AS depth", "id % 2 AS n1", "5L AS n2", "id AS conv_id")
    monkeypatch.setattr(tries, "CHUNK_CHARS", 100)
    got = {r["n1"]: r["ends_sha256"] for r in tries.id_hashes(df).collect()}
    want = {k: hashlib.sha256(",".join(map(str, range(k, 3_000, 2))).encode()).hexdigest() for k in (0, 1)}
    assert got == want
