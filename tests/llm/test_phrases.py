"""Collocations against plain counting, streams cut into ranges, and odd rows."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gaugeworks.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=phrases.LEAST, top=phrases.TOP):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = set()
        for q, b in candidates.items():
            for m in range(2, len(q)):
                covered |= {q[i : i + m] for i in range(len(q) - m + 1) if 100 * b >= 80 * count[q[i : i + m]]}
        ranked = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(df, **parameters):
    return sorted(tuple(r) for r in phrases.collocations(df, **parameters).collect())


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r["lang"], r["text"]) for r in df.select("lang", "text").collect()])
    assert found(df) == want and len(want) > 100


def texts(seed, n):
    rng = random.Random(seed)
    ends = ("", "", "", "", ",", "\t", "\n", "É", "A", ". ", "\x1c", " ")
    word = lambda: rng.choice("abcdefgh") + rng.choice(ends)
    size = lambda: rng.choice((0, 1, 5, 200, 2_000))
    return [(rng.choice(("a", "b", None, "und")), " ".join(word() for _ in range(size()))) for _ in range(n)]


def test_odd_texts_and_few_words(spark):
    rows = [*texts(3, 80), ("z", None), (None, ""), ("long", "same words here " * 40_000)]
    rows += rows[:10]
    df = spark.createDataFrame(rows, "lang string, text string")
    for name in ("doc_id", "phrase", "words", "f", "n", "lang_id", "part", "own", "rank", "score"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    assert found(df, top=40) == brute(rows, top=40)
    assert found(df.where("false")) == []


def test_streams_cut_into_many_ranges(spark):
    """Every range has few phrases, so beginnings and extensions lie in other ranges."""
    rows = texts(4, 40)
    df = spark.createDataFrame(rows, "lang string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(df, least=3) == brute(rows, least=3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_counts_beyond_64_bits(spark):
    big = 2**62
    rows = [("x", ["a"], big), ("x", ["b"], big), ("x", ["a", "b"], big - 5), ("x", ["a", "b", "c"], 40), ("x", ["c"], 90),
            ("x", ["b", "c"], 41)]
    df = spark.createDataFrame(rows, "lang string, words array<string>, f long")
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in phrases.scored(df).collect()}
    score = lambda a, left, right: 2_000_000 * a // (left + right)
    # 'b c' lies in 'a b c' almost always.
    assert got == {"a b": (big, big, score(big - 5, big, big)), "a b c": (big, 41, score(40, big, 41))}


def test_read_off():
    rows = [("x", ["a"], 9, 0), ("x", ["a", "b"], 7, 1), ("x", ["a", "b", "c"], 3, 1), ("x", ["a", "d"], 8, 1), ("y", ["a"], 2, 1)]
    assert sorted(phrases.read_off(iter(rows)), key=repr) == sorted(
        [
            ("x", ["a", "b", "c"], 3, [9, 7], None),
            ("x", ["a", "b"], 7, [9], 3),
            ("x", ["a", "d"], 8, [9], None),
            ("x", ["a"], None, None, 8),
            ("y", ["a"], 2, [], None),
        ],
        key=repr,
    )
