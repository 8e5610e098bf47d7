"""Operators against plain Python on the smallest documents, and properties of their parts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm import (
    anchors,
    decontaminate,
    licenses,
    packing,
    quality,
    queries,
    rules,
    shards,
    simhash,
    suffixes,
    toxicity,
)
from gaugeworks.llm import chunks as C
from gaugeworks.llm.common import stored

DIRECTORY = "/root/testdata/sf0.001"
QUALITY_DIRECTORY = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{DIRECTORY}/documents.parquet").select("doc_id", "text").collect()
    return dict(sorted((r[0], r[1] or "") for r in rows))


def result(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, DIRECTORY).collect()}


def test_contamination(spark, texts):
    items = spark.read.parquet(f"{DIRECTORY}/benchmark.parquet").collect()
    words = decontaminate.words_of
    line = {i: b" " + b" ".join(words(t)) + b" " for i, t in texts.items()}
    want = {(d, r["item_id"]) for d, x in line.items() for r in items if b" " + b" ".join(words(r["text"])) + b" " in x}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op1_bm25_decontamination"](spark, DIRECTORY).collect()}
    assert got == want and want


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(1)
    vocabulary = [b"w%d" % i for i in range(200)]
    pick = lambda n: [rng.choice(vocabulary[: rng.choice((20, 200))]) for _ in range(n)]
    items = [(i, b" ".join(pick(rng.randint(1, 30))).decode(), "") for i in range(150)]
    frequency = Counter(w for _, q, _ in items for w in set(decontaminate.words_of(q)))
    index = decontaminate.Index(items, frequency, len(items), 15.0, 0.5)
    for _ in range(200):
        words = set(pick(60)) | set(index.items[rng.randrange(len(index.items))][1][:20])
        score = Counter()
        for w in words & index.lists.keys():
            for item, impact in zip(*index.lists[w][:2], strict=True):
                score[item] += impact
        assert {i for i, s in score.items() if s >= index.threshold} == {i for i, _ in index.search(words)}


@pytest.mark.parametrize(("name", "label"), [("op2_additive_quality", "quality"), ("op10_pu_toxicity", "toxic")])
def test_classifier_on_held_out_labels(spark, name, label):
    marked = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{QUALITY_DIRECTORY}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, QUALITY_DIRECTORY).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marked]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = sum(r["predicted"] == marked[r["doc_id"]] for r in held)
    assert right >= 0.9 * len(held) and len(held) > 20
    positive = [r["score"] for r in held if marked[r["doc_id"]]]
    negative = [r["score"] for r in held if not marked[r["doc_id"]]]
    assert np.mean([p > n for p in positive for n in negative]) > 0.9


def test_shape_functions_and_pairs_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit_gam(x, y, rounds=60)
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x) > 0.5) == (y > 0)) > 0.9


def test_toxic_scorer_equals_feature_lookup(texts):
    some = list(texts.values())[:60]
    found = [toxicity.buckets_of(t) for t in some]
    chosen = np.unique(np.concatenate(found))[::40]
    model = toxicity.Linear(chosen, np.random.default_rng(0).normal(size=len(chosen)), 0.3)
    scorer, table = toxicity.Scorer(model, memo_words=50), model.lookup()
    assert np.allclose([scorer.margin(t) for t in some], [model.margin(f, table) for f in found])


def test_shards(spark, texts):
    got = result(spark, "op3_best_fit_shards")
    assert got.keys() == texts.keys()
    load, slots, place = Counter(), {}, {}
    for i, t in texts.items():
        r = got[i]
        assert (r["size"], r["text_crc32"]) == (len(t.encode()) + 8, zlib.crc32(t.encode()))
        assert place.setdefault(t, r["shard"]) == r["shard"]
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(load) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_best_fit_equals_one_by_one():
    rng = random.Random(5)
    for _ in range(30):
        classes = list(Counter(rng.choice((7, 9, 20, 33, 60)) for _ in range(rng.randint(1, 60))).items())
        capacity, bins = 100, []
        for size in sorted((s for s, n in classes for _ in range(n)), reverse=True):
            fits = [(left, k) for k, left in enumerate(bins) if left >= size]
            if fits:
                bins[min(fits)[1]] -= size
            else:
                bins.append(capacity - size)
        runs = shards.place(classes, capacity)
        load = Counter()
        for r in runs:
            load[r.shard] += r.size * (r.last - r.first)
        assert len(load) == len(bins) and sorted(load.values()) == sorted(capacity - left for left in bins)


def test_licenses(spark, texts):
    word = re.compile(licenses.WORD)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    templates = [(x.label, set(x.text.split())) for x in licenses.TEMPLATES]
    got = result(spark, "op4_license_join")
    for i, t in texts.items():
        w = word.findall(t.translate(lower))
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            hits = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            starts += hits
            labels |= {label} if hits else set()
        more = set(labels)
        for b in range(0, max(1, len(w)), 32):
            block = set(w[b : b + 64])
            more |= {label for label, ts in templates if len(block & ts) >= licenses.needed(len(ts), 0.8)}
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(starts))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(labels)), ",".join(sorted(more)))


def test_letters_beyond_a_to_z_are_not_lowered(spark):
    text = "under the mit l\u0130cense UNDER THE MIT LICENSE \u212alicense"
    r = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["base_labels"]) == (9, 1, 4, "mit")
    lone = [(1, "under the mit l\u0130cense"), (2, "cc by n\u212a"), (3, "Apache License Version 2")]
    got = licenses.scan_licenses(spark.createDataFrame(lone, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_base"] for r in got} == {1: 0, 2: 0, 3: 1}


def test_native_queries_have_no_python(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    for df in (licenses.scan_licenses(docs), rules.quality_rules(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_repeated_words(spark, texts):
    first, split = {}, {i: t.encode().split() for i, t in texts.items()}
    for i, w in split.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    got = result(spark, "op5_block_anchors")
    for i, w in split.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        r = got[i]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path())
    pieces, sequences = {}, {}
    for r in queries.QUERIES["op6_vector_packing"](spark, DIRECTORY).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == texts.keys()
    for i, t in texts.items():
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_packing_keeps_all_limits():
    rng = np.random.default_rng(2)
    for _ in range(20):
        n = rng.integers(0, 300, 80)
        loss = np.minimum(rng.integers(0, 200, 80), n)
        seen = Counter()
        for sequence in packing.pack_block(n, loss, 256, 5, 100):
            total = sum(p[2] for p in sequence)
            lossy = sum(max(0, s + k - max(s, int(n[i] - loss[i]))) for i, s, k in sequence)
            assert total & (total - 1) == 0 and total <= 256 and len(sequence) <= 5 and lossy <= 100
            for i, s, k in sequence:
                seen.update((i, t) for t in range(s, s + k))
        assert seen == Counter({(i, t): 1 for i in range(80) for t in range(int(n[i]))})


def test_packing_examples(spark):
    rows = [(1, 100, 40), (2, 50, None), (3, None, 5), (4, 9000, 100), (4, 9000, 100)]
    got = packing.pack_examples(spark.createDataFrame(rows, "doc_id long, n_tokens long, n_loss long")).collect()
    total = Counter()
    for r in got:
        total[r["doc_id"]] += r["length"]
    assert total == {1: 100, 2: 50, 4: 18000} and sum(r["loss_tokens"] for r in got) == 240


def test_odd_words_are_encoded_as_in_the_whole_text():
    encode = packing.Encoder(queries.tokenizer_path(), memo_words=5)
    for t in ("Don't STOP<|endoftext|> now", "Ünïcode Straße İstanbul ΣΑΣ", "a b\tc\r\nd  e", "x" * 300, "12,5% 漢字!?", "é́ é"):
        want = np.array(encode.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode(t) == want and encode(t) == want


def test_repeated_bytes(spark, texts):
    first, raw = {}, {i: t.encode() for i, t in texts.items()}
    for i, b in raw.items():
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    got = result(spark, "op7_suffix_array")
    for i, b in raw.items():
        edge = np.zeros(len(b) + 51, int)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                edge[k] += 1
                edge[k + 50] -= 1
        gone = np.cumsum(edge)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), int(gone.sum()), len(suffixes.spans_of(gone)))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_pieces_of_a_hot_anchor_spread_over_buckets(spark, monkeypatch):
    """A short phrase in differing surroundings stands in all texts; longer ones repeat around it in some."""
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(n))
    phrase, rows = letters(20), []
    around = [(letters(40), letters(40)) for _ in range(3)]
    for i in range(1_500):
        before, after = rng.choice(around) if i % 10 == 0 else (letters(40), letters(40))
        rows.append((i, before + phrase + after))
    monkeypatch.setattr(suffixes, "HOT_PIECES", 60)
    monkeypatch.setattr(suffixes, "PIECES_PER_BUCKET", 100)
    sent = Counter()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = C.chunked(docs)
    dedup = suffixes.Dedup(50, chunks.agg({"n_bytes": "sum"}).first()[0])
    first = {}
    packets = [(c, b, p) for c in map(lambda r: C.Chunk(r["chunk_id"], r["data"]), chunks.collect()) for b, p in dedup.anchors(c, {})]
    for bucket in {b for _, b, _ in packets}:
        mine = [(c, p) for c, b, p in packets if b == bucket]
        for (c, _), (answer, n) in zip(mine, dedup.shared([p for _, p in mine]), strict=True):
            first.setdefault(c, {})[(1, bucket)] = answer
            sent["hits"] += n
    dedup.text_buckets = max(1, sent["hits"] // suffixes.PIECES_PER_BUCKET)
    pieces = Counter()
    for c, answers in first.items():
        for bucket, payload in dedup.send_texts(c, answers):
            pieces[bucket] += len(C.thaw(payload)[0]) / 35  # windows of a piece
    assert dedup.text_buckets > 2 and max(pieces.values()) < 2 * suffixes.PIECES_PER_BUCKET
    seen, want = {}, {}
    for i, t in rows:
        gone = set()
        for k in range(len(t) - 49):
            if seen.setdefault(t[k : k + 50], i) < i:
                gone |= set(range(k, k + 50))
        want[i] = len(gone)
    got = {r["doc_id"]: r["n_removed"] for r in suffixes.repeated_bytes(docs).collect()}
    assert got == want and sum(n > 0 for n in want.values()) > 100


def test_changed_and_partial_items_are_found():
    rng = random.Random(8)
    vocabulary = grown(rng, 3_000)
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(10, 40))) + ". " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(100)]
    frequency = Counter(w for _, t in items for w in set(decontaminate.words_of(t)))
    parts = [(i, *decontaminate.question_and_answer(t)) for i, t in items]
    index = decontaminate.Index(parts, frequency, 100, 30.0, decontaminate.THRESHOLD)
    found = Counter()
    for i, q, a in parts:
        changed, answer = (q + " " + a).split(), a.split()
        changed[rng.randrange(len(changed))] = "other"
        answer[len(answer) // 2] = "other"
        for kind, text in (("changed", " ".join(changed)), ("answer", q + " " + " ".join(answer)), ("question", q)):
            around = [" ".join(rng.choices(vocabulary, k=50)) for _ in range(2)]
            found[kind] += i in {index.items[k][0] for k in index.matches(text.join((around[0] + " ", " " + around[1])))}
        assert not index.matches(" ".join(rng.choices(vocabulary, k=400)))
    assert min(found[k] for k in ("changed", "answer", "question")) >= 90


def test_deep_shallow_sort():
    rng = random.Random(0)
    for k in range(60):
        unit = bytes(rng.choice(b"ab" if k % 2 else b"abcdefgh") for _ in range(rng.randint(1, 300)))
        text = unit * rng.randint(1, 3) + bytes(60)
        starts = np.array(rng.sample(range(len(text) - 55), min(len(text) - 55, rng.randint(1, 200))))
        length = rng.choice((9, 20, 50))
        order, rank = suffixes.deep_shallow(np.frombuffer(text, np.uint8), starts, length, rng.choice((8, 16, 32)))
        strings = [text[s : s + length] for s in starts[order]]
        assert sorted(order.tolist()) == list(range(len(starts))) and strings == sorted(strings)
        assert all((rank[i] == rank[i - 1]) == (strings[i] == strings[i - 1]) for i in range(1, len(strings)))


def test_repeated_bytes_of_periodic_text(spark):
    rng = random.Random(4)
    parts = ["aaaa", "ab", "xyzzy ", "the quick brown fox jumps over the lazy dog and runs away ", "é"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    docs = spark.createDataFrame([*rows, (100, "a" * 500), (101, "a" * 49)], "doc_id long, text string")
    first = {}
    for r in docs.collect():
        b = r["text"].encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], r["doc_id"])
    got = {r["doc_id"]: r["n_removed"] for r in suffixes.repeated_bytes(docs).collect()}
    for r in docs.collect():
        b, gone = r["text"].encode(), set()
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < r["doc_id"]:
                gone.update(range(k, k + 50))
        assert got[r["doc_id"]] == len(gone)


def test_rules(spark, texts):
    word, got = re.compile(rules.WORD), result(spark, "op8_rule_cascade")
    for i, t in texts.items():
        w = word.findall(t)
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        count, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if count[x] > 1:
                covered.update(range(k, k + 8))
        lines = [x for x in t.split("\n") if word.search(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"]) == (len(w), sum(map(len, w)))
        assert r["n_symbols"] == sum(c in rules.SYMBOLS for c in t)
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_cascade_order_is_counted(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    sample = stored(rules.measured(docs), "rules-test")
    given = rules.default_rules()
    orders = {tuple(r.name for r in rules.cascade_order(sample, given)) for _ in range(5)}
    assert len(orders) == 1
    # Twins of a rule that touch more come after it; a rule whose failures another one has already is last.
    short, n = F.col("n_words") < 60, F.col("n_words")
    cheap, dear = rules.Rule("cheap", short, F.lit(1)), rules.Rule("dear", short, n)
    inside, other = rules.Rule("inside", F.col("n_words") < 50, F.lit(2)), rules.Rule("other", n > 400, 3 * n)
    names = [r.name for r in rules.cascade_order(sample, [dear, inside, other, cheap])]
    assert names == ["cheap", "other", "inside", "dear"]
    assert [r.name for r in rules.cascade_order(sample.where("false"), given[:2])] == ["symbols", "word_length"]


def test_cascade_order_does_not_change_the_verdict(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    given = rules.default_rules()
    verdicts = [
        {r[0]: r[1] for r in rules.measured(docs).select("doc_id", rules.cascade(order)).collect()}
        for order in (given, given[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    marked = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIRECTORY}/labels.parquet").collect()}
    got = result(spark, "op8_rule_cascade")
    assert all(got[i]["kept"] or got[i]["base_failed"] for i, q in marked.items() if q == 1)
    assert not any(got[i]["kept"] for i, q in marked.items() if q == 0)


def test_simhash(spark, texts):
    got = result(spark, "op9_simhash_covering")
    prints = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i]["fingerprint"] == f"{prints[i]:016x}"
    near = {i: {i} for i in prints}
    for i, x in prints.items():
        for j, y in prints.items():
            if (x ^ y).bit_count() <= 4 and near[i] is not near[j]:
                both = near[i] | near[j]
                for k in both:
                    near[k] = both
    assert all(got[i]["component_id"] == min(near[i]) for i in prints)


@pytest.mark.parametrize(("bits", "refine"), [(4, 5), (4, 6), (4, 8), (6, 0), (6, 7)])
def test_close_fingerprints_share_an_anchor(bits, refine):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, bits + 1), replace=False):
            y[i] ^= np.uint64(1 << int(b))
    keys = []
    for fp in (x, y):
        row, key = simhash.anchor_keys(fp, bits, refine)
        keys.append({(int(r), int(k)) for r, k in zip(row, key, strict=True)})
    assert {r for r, _ in keys[0] & keys[1]} == set(range(1500))


def test_keys_grow_with_the_fingerprints():
    groups = [simhash.groups_for(n, 4) for n in (0, 10**6, 10**9, 10**10, 10**12)]
    assert groups == sorted(groups) and groups[:2] == [5, 5] and 5 < groups[2] < groups[-1] <= 8
    fp = np.random.default_rng(2).integers(0, 2**64, 20_000, dtype=np.uint64)
    largest = []
    for n in (5, 6, 7):
        keys = np.sort(simhash.anchor_keys(fp, 4, n)[1])
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        largest.append(np.diff(starts).max())
    assert largest[0] > largest[-1]


@pytest.mark.parametrize("refine", [5, 6, 7])
def test_more_groups_link_the_same(spark, refine):
    rng = random.Random(4)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    fps = sorted(fps)
    root = {x: x for x in fps}
    for x in fps:
        for y in fps:
            if (x ^ y).bit_count() <= 4 and root[x] != root[y]:
                old, new = max(root[x], root[y]), min(root[x], root[y])
                root = {k: new if r == old else r for k, r in root.items()}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = {x: x for x in fps}
    for a, b in simhash.fingerprint_links(nodes, 4, refine).collect():
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= 4
        old, new = max(got[a], got[b]), min(got[a], got[b])
        got = {k: new if r == old else r for k, r in got.items()}
    assert got == root


def test_large_anchor_gives_a_tree_of_links():
    rng = np.random.default_rng(0)
    centre = np.uint64(rng.integers(0, 2**63))
    fp = np.unique(np.array([centre ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 64, (400, 2))]))
    a, b = simhash.linked(np.zeros(len(fp), np.int64), fp, 4)
    assert len(a) == len(fp) - 1 and set(a) | set(b) == set(fp) and (np.bitwise_count(a ^ b) <= 4).all()


def test_near_copies(spark):
    rng = random.Random(7)
    base = [[f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(300)] for _ in range(12)]
    rows, number = [], 0
    for b in base:
        for _ in range(4):
            w = list(b)
            for k in rng.sample(range(300), rng.randint(0, 2)):
                w[k] = f"new{rng.randrange(10**6)}"
            rows.append((number, " ".join(w)))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.drop_near_copies(docs).collect()) == list(range(0, 48, 4))


def grown(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(n)]


def kept_by_brute_force(rows, similarity=0.8):
    """Ids that stay: the smallest of each group that pairs of at least this Jaccard similarity connect."""
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in rows}
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sets:
            x, y = sets[i], sets[j]
            if i < j and group[i] != group[j] and len(x & y) >= similarity * len(x | y):
                old, new = sorted((group[i], group[j]), reverse=True)
                group = {k: new if g == old else g for k, g in group.items()}
    return sorted(set(group.values()))


def kept_near_copies(spark, rows):
    return sorted(r["doc_id"] for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect())


@pytest.mark.parametrize("block_bytes", [simhash.BLOCK_BYTES, 3_000])
def test_near_copies_in_blocks(spark, monkeypatch, block_bytes):
    """One cluster whose texts mostly are not similar to each other, with links of every kind inside."""
    monkeypatch.setattr(simhash, "BLOCK_BYTES", block_bytes)
    rng = random.Random(9)
    words, rows = grown(rng, 60), []
    for k in range(90):
        w = list(words)
        for i in rng.sample(range(60), rng.choice((0, 1, 1, 2, 3))):
            w[i] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(w + grown(rng, rng.choice((0, 0, 1, 8))))))
    want = kept_by_brute_force(rows)
    assert 5 < len(want) < 80 and kept_near_copies(spark, rows) == want


def test_joined_groups():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 100, np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(70, 101)], rng.integers(0, 2**63, 5, np.uint64)])) for _ in range(60)]
    group = simhash.joined_groups(sets, np.arange(60), None, 0.8)
    want = np.arange(60)
    for i in range(60):
        for j in range(i):
            if simhash.similar(sets[i], sets[j], 0.8):
                want[want == want[i]] = want[j]
    assert len({*zip(group.tolist(), want.tolist(), strict=True)}) == len(set(group.tolist())) == len(set(want.tolist())) < 60


def test_near_copies_below_a_common_centre(spark):
    """Many texts within reach of one fingerprint that are not similar to it hold near copies of each other."""
    rng = random.Random(3)
    words = grown(rng, 400)
    texts = []
    for _ in range(60):  # the same words in blocks of another order: one bag of words, few common shingles
        blocks = [words[k : k + 8] for k in range(0, 400, 8)]
        rng.shuffle(blocks)
        b = [w for block in blocks for w in block]
        texts += [b, b[:-3] + grown(rng, 3)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = kept_by_brute_force(rows)
    assert kept_near_copies(spark, rows) == want and want == list(range(0, 120, 2))


@pytest.mark.parametrize("kind", ["appended", "cut", "edited"])
def test_near_copies_of_every_kind_are_candidates(kind):
    """Pairs from similarity 0.8 on share a key; word fingerprints within 6 bits missed most appended ones."""
    rng = random.Random(kind)
    found = of = 0
    for _ in range(300):
        n = rng.choice((30, 100, 300, 1000))
        a = grown(rng, n)
        b = list(a)
        if kind == "appended":
            b += grown(rng, rng.randint(1, n // 4))
        elif kind == "cut":
            b = b[: n - rng.randint(1, n // 5)]
        else:
            for k in rng.sample(range(n), max(1, n // rng.randint(45, 100))):
                b[k] = f"new{rng.randrange(10**6)}"
        x, y = (np.unique(simhash.shingle_hashes(" ".join(t), 5)) for t in (a, b))
        if len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)):
            of += 1
            found += bool(set(simhash.band_keys(x).tolist()) & set(simhash.band_keys(y).tolist()))
    assert of > 100 and found == of


def test_near_copies_among_equal_bags_of_words(spark):
    """Texts of the same words in other orders are not alike, yet near copies among them are found."""
    rng = random.Random(5)
    words, rows = grown(rng, 200), []
    for k in range(12):
        rng.shuffle(words)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:-2], words[-1], words[-2]]))]
    assert kept_near_copies(spark, rows) == kept_by_brute_force(rows) == list(range(0, 24, 2))


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    marked = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIRECTORY}/labels.parquet").collect()}
    items = [b" ".join(decontaminate.words_of(r["text"])) for r in spark.read.parquet(f"{DIRECTORY}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, DIRECTORY), f"test-{name}")
        if name != "packing":
            assert docs.columns == before.columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any(marked.get(i) == 0 for i in kept["quality"]) and all(
        i in kept["quality"] for i, q in marked.items() if q == 1
    )
    assert len(set(kept["near_copies"].values())) == len(kept["near_copies"])
    seen = {}
    for i, t in sorted(kept["near_copies"].items()):
        w = t.split()
        for k in range(len(w) - 12):
            seen.setdefault(tuple(w[k : k + 13]), i)
    for i, t in kept["near_copies"].items():
        w = t.split()
        again = any(seen[tuple(w[k : k + 13])] < i for k in range(len(w) - 12))
        assert again == (kept["repeated_passages"][i] != t)
    held = lambda t: any(x in b" ".join(decontaminate.words_of(t)) for x in items)
    assert {i for i, t in kept["repeated_passages"].items() if not held(t)} == kept["decontamination"].keys()
    assert {r["doc_id"] for r in docs.collect()} == kept["decontamination"].keys()


def test_close_fingerprints_propose_near_copies(spark):
    far = 0x0F0F_0F0F_0F0F_0F0F
    sketches = [(1, 9, 0, [1, 2]), (2, 9, 0b1011, [3, 4]), (3, 9, -1, [4, 5]), (4, 9, far, [6, 7]), (5, 9, far, [8, 9])]
    sketches = stored(spark.createDataFrame(sketches, "node long, size long, fp long, bands array<long>"), "sketches")
    # 1 and 2 by close fingerprints alone, 2 and 3 by a key alone, 4 and 5 by equal fingerprints.
    got = {r["node"]: r["cluster"] for r in simhash._clusters(sketches).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
