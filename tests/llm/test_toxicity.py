"""Votes over all documents, samples by hash, and scores row by row."""

import bisect
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import quality, toxicity
from gaugeworks.llm.common import first_by_hash

DOCS = "doc_id long, text string"
WORDS = "alba bruno carta delta edile fiume gatto hotel isola lento mondo nuvola".split()


def _docs(n, seed=1):
    """Texts with copies (a third of all rows one text), empty and missing ones; toxic ones have words of their own."""
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 7 == 3
        words = [pick.choice(WORDS) for _ in range(pick.randrange(3, 30))]
        if toxic:
            words += pick.sample(["skorza", "vrump", "zlurk"], 2)
        text = {0: "alba carta", 1: None if i % 2 else ""}.get(i % 3 if i % 3 == 0 else i % 11, " ".join(words))
        rows.append((i, text))
        if i % 2 and text:
            labels.append((i, int("skorza" in text or "vrump" in text or "zlurk" in text)))
    return rows, labels


@pytest.mark.parametrize("n", [0, 1, 400])
def test_votes_equal_one_pass(spark, n):
    rows, _ = _docs(n)
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    found = [toxicity.buckets_of(t or "") for _, t in rows]
    asked = np.unique(np.concatenate([*found[:50], toxicity._SIZES]))
    votes, everyone = toxicity.corpus_votes(docs, asked)
    want, n_want = toxicity._shares(found)
    assert np.allclose(votes, want[asked]) and np.isclose(everyone, n_want)


@pytest.mark.parametrize("n", [0, 1, 30, 900, 1000, 5000])
def test_first_by_hash(spark, n):
    ids = spark.range(1000).select((F.col("id") % 950).alias("doc_id")).repartition(16)
    want = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    assert sorted(first_by_hash(ids, n).collect()) == sorted(want.collect())
    assert first_by_hash(ids.limit(0), n).count() == 0


def test_the_ordering_task_gets_little_more_than_the_sample(spark):
    ids = spark.range(0, 200_000, 1, 64).withColumnRenamed("id", "doc_id")
    plan = first_by_hash(ids, 10_000)._jdf.queryExecution().optimizedPlan().toString()
    bound = int(re.search(r"Filter .*xxhash64\(\w+#\d+L, 42\) < (-?\d+)", plan).group(1))
    assert 10_000 <= ids.where(F.xxhash64("doc_id") < bound).count() <= 11_000


def test_scores_row_by_row(spark):
    rows, labels = _docs(600)
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, marks).collect()}
    weights = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    assert len(got) == len(rows)
    for doc_id, text in rows:
        margin = model.bias + sum(weights.get(b, 0.0) for b in toxicity.buckets_of(text or "").tolist())
        score = 1 / (1 + np.exp(-(model.slope * margin + model.shift)))
        assert abs(got[doc_id]["score"] - score) < 1e-9
        assert got[doc_id]["predicted"] == int(got[doc_id]["score"] >= 0.3)
    said = dict(labels)
    right = [got[i]["predicted"] == int(any(w in (t or "") for w in ("skorza", "vrump", "zlurk"))) for i, t in rows if i not in said]
    assert sum(right) / len(right) > 0.95


def test_quality_scores_row_by_row(spark):
    rows, _ = _docs(500)
    labels = [(i, int(len(t or "") > 60)) for i, t in rows if i % 3]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit_quality(docs, marks)
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, marks).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        x = [float(v) for v in quality.features_of(text or "")]
        z = model.intercept + sum(t[bisect.bisect_right(e.tolist(), v)] for e, t, v in zip(model.edges, model.tables, x, strict=True))
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            at = [bisect.bisect_right(model.pair_edges[j].tolist(), x[j]) for j in (a, b)]
            z += table[at[0], at[1]]
        assert abs(got[doc_id]["score"] - 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))) < 1e-9
        assert got[doc_id]["predicted"] == int(got[doc_id]["score"] >= 0.7)
