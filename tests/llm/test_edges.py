"""Missing values, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm import (
    anchors,
    decontaminate,
    licenses,
    packing,
    quality,
    rules,
    shards,
    simhash,
    suffixes,
    toxicity,
)
from gaugeworks.llm.queries import tokenizer_path

LONG = " ".join(f"word{i % 5000} and" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(30))
ROWS = [
    (1, ""),
    (2, None),
    (None, f"no id here {PASSAGE}"),
    (3, LONG),
    (4, f"first {PASSAGE} end"),
    (5, f"second {PASSAGE} other"),
    (6, "same row"),
    (6, "same row"),
    (7, "under the MIT License"),
    (8, " \n\t "),
]
CLASHES = (
    "score fp bucket chunk_id n_words shard text_key _row _key _doc size law slot label words key data rest "
    "payload answer row root node u v doc held_out predicted kept item_id"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(ROWS, "doc_id long, text string")
    for k, name in enumerate(CLASHES):
        made = made.withColumn(name, F.lit(k) if k % 2 else F.lit(None).cast("string"))
    return made.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 0, 0), (2, None, None), (None, 1, 1), (3, 1, 0), (4, 1, 1), (4, 1, 1), (5, 0, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PASSAGE), (2, None), (None, ""), (3, "passage1 passage2"), (1, PASSAGE)]
    return spark.createDataFrame(rows, "item_id long, text string")


def one_row_each(spark, labels):
    return {
        "quality": lambda d: quality.quality_scores(d, labels),
        "shards": lambda d: shards.shard_documents(d, 3),
        "licenses": licenses.scan_licenses,
        "anchors": anchors.repeated_words,
        "suffixes": suffixes.repeated_bytes,
        "rules": rules.quality_rules,
        "simhash": simhash.near_components,
        "toxicity": lambda d: toxicity.toxicity_scores(d, labels),
    }


@pytest.mark.parametrize(
    "name", ["quality", "shards", "licenses", "anchors", "suffixes", "rules", "simhash", "toxicity"]
)
def test_one_row_per_document(spark, docs, none, labels, name):
    run = one_row_each(spark, labels)[name]
    got = run(docs).collect()
    order = lambda ids: sorted(ids, key=lambda i: (i is None, i or 0))
    assert order(r["doc_id"] for r in got) == order(i for i, _ in ROWS)
    assert run(none).count() == 0


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_values_of_odd_texts(docs, labels):
    r = by_id(quality.quality_scores(docs, labels))
    assert r[1]["score"] == r[2]["score"] == r[8]["score"] and not r[None]["held_out"]
    assert all(0 <= x["score"] <= 1 for x in r.values())
    r = by_id(toxicity.toxicity_scores(docs, labels))
    assert r[1]["score"] == r[2]["score"] and all(0 <= x["score"] <= 1 for x in r.values())
    r = by_id(shards.shard_documents(docs, 3))
    assert (r[1]["size"], r[2]["size"], r[2]["text_crc32"]) == (8, 8, 0) and r[1]["shard"] == r[2]["shard"]
    r = by_id(licenses.scan_licenses(docs))
    assert (r[2]["n_words"], r[2]["labels"], r[2]["score"], r[2]["first_word"]) == (0, "", 0.0, None)
    assert (r[7]["base_labels"], r[7]["n_base"], r[7]["first_word"], r[7]["score"]) == ("mit", 1, 0, 1.0)
    assert r[3]["n_words"] == 120_000
    r = by_id(rules.quality_rules(docs))
    assert (r[2]["n_words"], r[2]["base_failed"], r[2]["kept"]) == (0, True, False)
    assert r[3]["n_repeat_words"] == 120_000 and r[3]["base_failed"]
    r = by_id(simhash.near_components(docs))
    assert r[1]["fingerprint"] == r[2]["fingerprint"] == r[8]["fingerprint"] == "0" * 16
    assert r[1]["component_id"] == r[8]["component_id"] == 1 and r[6]["component_id"] == 6


def test_repeats_follow_the_smaller_id(docs):
    r = by_id(anchors.repeated_words(docs))
    assert [r[i]["n_removed"] for i in (4, 5, None, 6, 3)] == [0, 30, 30, 0, 0]
    r = by_id(suffixes.repeated_bytes(docs))
    shared = len(f" {PASSAGE} ")
    assert [r[i]["n_removed"] for i in (4, 5, 6)] == [0, shared, 0] and r[5]["n_spans"] == 1
    assert r[None]["n_removed"] == len(f" {PASSAGE}") and r[2]["n_bytes"] == 0


def test_packing_places_every_token_once(docs, none):
    got = packing.pack_documents(docs, tokenizer_path()).collect()
    total = {}
    for r in got:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total[1] == total[2] == total[8] == 1 and total[None] > 1
    sizes = {}
    for r in got:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 4096 or n & (n - 1) == 0 for n in sizes.values())
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_contaminated_pairs(docs, none, items):
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert {(4, 1), (5, 1), (None, 1)} <= got and not {1, 2, 3, 6, 7, 8} & {d for d, _ in got}
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == 7


def test_filters_keep_columns(docs, none, labels):
    kept = simhash.drop_near_copies(docs)
    assert kept.dtypes == docs.dtypes
    # 1, 2 and 8 have no words; the three texts with the passage share 0.84 and more of their shingles, so the
    # smallest id stays; of the two equal rows one stays.
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [1, 3, 4, 6, 7]
    # 26 of 33 shingles are shared, just under 0.8: both stay.
    less = PASSAGE.rsplit(" ", 3)[0] + " a b c d"
    pair = docs.where("doc_id = 5").withColumn("text", F.lit(f"second {PASSAGE}"))
    pair = pair.unionByName(pair.withColumns({"doc_id": F.lit(11).cast("long"), "text": F.lit(f"second {less}")}))
    x, y = (simhash.shingle_set(r["text"], 5) for r in pair.collect())
    assert 0.7 < len(set(x) & set(y)) / len(set(x) | set(y)) < 0.8
    assert sorted(r["doc_id"] for r in simhash.drop_near_copies(pair).collect()) == [5, 11]
    cut = anchors.drop_repeated_words(docs)
    assert cut.schema.names == docs.schema.names
    r = by_id(cut)
    assert r[5]["text"] == "second other" and r[5]["n_chars"] == 12 and r[2]["text"] is None and r[3]["text"] == LONG
    assert r[4]["slot"] == by_id(docs)[4]["slot"]
    for f in (simhash.drop_near_copies, anchors.drop_repeated_words, lambda d: quality.keep_good(d, labels)):
        assert f(none).count() == 0


def test_pipeline_on_empty_table(spark, tmp_path, none, labels, items):
    for name, df in (("documents", none), ("labels", labels), ("benchmark", items)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
