"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is read as three blocks of at most 23 bits. The anchors of a block are the code words of
the binary Golay code: every 23-bit word lies within distance 3 of exactly one of them. Two fingerprints that
differ in at most k bits differ in at most k // 3 bits of some block, so one of them has its nearest anchor
within 3 + k // 3 of the other. Each distinct fingerprint is replicated to all anchors within that radius, and
fingerprints are compared per anchor. With ``refine`` groups an anchor is cut further by the other bits: of
``refine`` groups of them at least ``refine - k`` are equal, so a fingerprint goes to the value of every such choice.
More groups mean more copies of a row but longer, hence many more, keys: their number follows the number of
fingerprints (``groups_for``).

Distinct fingerprints, not documents, are replicated: copies are one row before any comparison. What one
anchor holds is bounded by the ball around it. Within an anchor up to PAIRWISE fingerprints are compared
pair by pair; larger ones are searched from their centre, which gives a tree of links instead of all pairs.

Near copies that are verified (``drop_near_copies``) are proposed by the same anchors from fingerprints of the shingle
set. Texts with one side grown or cut are far apart in them, so min-hashes of the set, whose chance to agree is the
Jaccard similarity itself, whatever was edited, add what fingerprints miss: BANDS keys of BAND_ROWS min-hashes each.
What either connects is a cluster; its texts meet once and are compared exactly, those that links connect already not
again. Clusters with very much text are first thinned by links between close fingerprints, then cut into blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.chunks import mixed
from gaugeworks.llm.common import arrow_rows, body, slim, stored
from gaugeworks.llm.graph import components

BITS = 4  # differing bits of linked fingerprints
SHINGLE = 4
SEED = 42
PAIRWISE = 64
ROWS_PER_BUCKET = 250_000
ROWS_PER_KEY = 512  # fingerprints that an anchor, cut by groups, holds where they are spread evenly
PAIR_ROWS = 500
BLOCK_BYTES = 8 << 20  # text of a cluster that one task compares with itself
BANDS, BAND_ROWS = 32, 4  # a pair at similarity 0.8 shares no key with probability (1 - 0.8**4)**32 = 5e-8

GOLAY = 0xC75  # generator polynomial of the code, fixed value
BLOCKS = ((0, 21), (21, 21), (42, 22))  # first bit and width


def _remainder(x: int) -> int:
    for bit in range(22, 10, -1):
        if x >> bit & 1:
            x ^= GOLAY << (bit - 11)
    return x


_HIGH = np.array([_remainder(m << 11) for m in range(4096)], np.uint64)


def _patterns(weight: int) -> np.ndarray:
    """Per syndrome the error patterns of at most ``weight`` bits, lightest first, padded with all ones."""
    found: list[list[int]] = [[] for _ in range(2048)]
    unit = [_remainder(1 << b) for b in range(23)]
    for w in range(weight + 1):
        for bits in combinations(range(23), w):
            syndrome = 0
            for b in bits:
                syndrome ^= unit[b]
            found[syndrome].append(sum(1 << b for b in bits))
    width = max(map(len, found))
    return np.array([f + [2**32 - 1] * (width - len(f)) for f in found], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; zero for none. Hashes are unpacked in parts, for long texts."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        part = hashes[lo : lo + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``size`` words (A-Z lowered), repeats included; of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - size + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.fromiter((digest(join(words[i : i + size]), seed) for i in range(n)), np.uint64, n)


def text_fingerprint(text: str) -> int:
    return fingerprint(shingle_hashes(text))


def fingerprints(docs: DataFrame, of=text_fingerprint, key: str = "doc_id") -> DataFrame:
    """(key, fp) of columns (key, text); fp is the 64-bit fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fp = np.fromiter((of(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=[key, "fp"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, fp long")


def anchor_keys(fp: np.ndarray, bits: int, refine: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of fingerprints as (row, key), cut by each choice of ``refine - bits`` of ``refine`` groups of the other
    bits, or not at all with 0."""
    patterns = _PATTERNS.setdefault(3 + bits // 3, None)
    if patterns is None:
        patterns = _PATTERNS[3 + bits // 3] = _patterns(3 + bits // 3)
    rows, keys = [], []
    for i, (first, width) in enumerate(BLOCKS):
        x = fp >> np.uint64(first) & np.uint64((1 << width) - 1)
        error = patterns[(_HIGH[x >> np.uint64(11)] ^ (x & np.uint64(2047))).astype(np.int64)]
        row, column = np.nonzero(error != np.uint64(2**32 - 1))
        anchor = (x[row] ^ error[row, column]) >> np.uint64(11) | np.uint64(i << 12)
        if not refine:
            rows.append(row)
            keys.append(anchor)
            continue
        low = fp & np.uint64((1 << first) - 1)
        high = fp >> np.uint64(first + width) if first + width < 64 else np.zeros_like(fp)
        rest, n = low | high << np.uint64(first), 64 - width
        cuts = [n * g // refine for g in range(refine + 1)]
        choices = list(combinations(range(refine), refine - bits))
        for c, chosen in enumerate(choices):
            value = np.zeros(len(row), np.uint64)
            for g in chosen:
                wide = np.uint64(cuts[g + 1] - cuts[g])
                value = value << wide | rest[row] >> np.uint64(cuts[g]) & np.uint64((1 << int(wide)) - 1)
            rows.append(row)
            keys.append((anchor * np.uint64(len(choices)) + np.uint64(c)) << np.uint64(32) | value)
    return np.concatenate(rows), np.concatenate(keys)


_PATTERNS: dict[int, np.ndarray | None] = {}


def groups_for(n: int, bits: int) -> int:
    """Groups of the other bits so that ``n`` fingerprints, evenly spread, put ROWS_PER_KEY rows or fewer on a key."""
    each = len(anchor_keys(np.ones(1, np.uint64), bits, 0)[0])
    anchors = len(BLOCKS) * len(_HIGH)
    groups = bits + 1
    while groups < 2 * bits and n * each / anchors > ROWS_PER_KEY * 2 ** (42 * (groups - bits) / groups):
        groups += 1
    return groups


def _centre_out(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected in one anchor: a search from the member nearest to the majority."""
    middle = np.uint64(fingerprint(fp))
    left = np.argsort(np.bitwise_count(fp ^ middle), kind="stable")
    a, b, queue = [], [], []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        at = queue.pop(0)
        near = np.bitwise_count(fp[left] ^ fp[at]) <= bits
        reached, left = left[near], left[~near]
        a.append(np.full(len(reached), fp[at]))
        b.append(fp[reached])
        queue.extend(reached)
    return np.concatenate([*a, fp[:0]]), np.concatenate([*b, fp[:0]])


def linked(key: np.ndarray, fp: np.ndarray, bits: int, pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """Links found among the rows of some anchors."""
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([start, [len(key)]]))
    a, b = [fp[:0]], [fp[:0]]
    for s, n in zip(start[size > pairwise], size[size > pairwise], strict=True):
        x, y = _centre_out(fp[s : s + n], bits)
        a.append(x)
        b.append(y)
    small = np.repeat(size <= pairwise, size)
    key, fp = key[small], fp[small]
    for d in range(1, pairwise):
        same = np.flatnonzero(key[d:] == key[:-d]) if d < len(key) else np.zeros(0, np.int64)
        if not len(same):
            break
        near = same[np.bitwise_count(fp[same] ^ fp[same + d]) <= bits]
        a.append(fp[near])
        b.append(fp[near + d])
    return np.concatenate(a), np.concatenate(b)


def fingerprint_links(nodes: DataFrame, bits: int = BITS, refine: int | None = None) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp) at most ``bits`` apart; all that connect them."""
    nodes = nodes.select("fp")
    n = nodes.count()
    groups = groups_for(n, bits) if refine is None else refine
    per_row = sum(1 for _ in anchor_keys(np.arange(1, 2, dtype=np.uint64), bits, groups)[0])
    buckets = max(1, n * per_row // ROWS_PER_BUCKET)

    def spread(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(fp), 2_000):
                part = fp[lo : lo + 2_000]
                row, key = anchor_keys(part, bits, groups)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(part[row].view(np.int64))], names=["key", "fp"]
                )

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = linked(pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    return (
        nodes.mapInArrow(spread, "key long, fp long")
        .groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
        .applyInPandas(link, "a long, b long")
    )


def near_components(docs: DataFrame, bits: int = BITS, refine: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Documents are linked when their fingerprints differ in at most ``bits`` bits; component_id is the smallest
    doc_id reachable. Missing and empty texts have the fingerprint zero and are linked like any other. A
    missing doc_id stays missing and names a component only if no other does: then component_id is null. Repeated
    rows get one row each; shingles of very long texts are counted in parts. An empty table gives no rows; further
    columns, whatever their names, are left out.
    """
    prints = stored(fingerprints(slim(docs)), "simhash-fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-nodes")
    roots = components(fingerprint_links(nodes, bits, refine))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


_MINHASH = np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * BAND_ROWS), np.uint64) | np.uint64(1)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """BANDS keys of a set of shingle hashes; each mixes BAND_ROWS min-hashes. Empty sets have keys of their own."""
    if not len(shingles):
        return np.arange(BANDS, dtype=np.uint64)
    flip, factor = _MINHASH
    parts = (shingles[lo : lo + 1_000, None] for lo in range(0, len(shingles), 1_000))
    least = np.minimum.reduce([((part ^ flip) * factor).min(0) for part in parts])
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        keys = mixed(keys ^ column)
    return keys


def shingle_set(text: str, size: int) -> np.ndarray:
    """Distinct shingle hashes of a text, in order; one that stands for nothing if it has no words."""
    found = np.unique(shingle_hashes(text, size))
    return found if len(found) else np.zeros(1, np.uint64)


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) >= similarity


def joined_groups(sets: list[np.ndarray], group: np.ndarray, side: np.ndarray | None, similarity: float) -> np.ndarray:
    """Groups of sets, the given ones joined wherever two sets are similar; with sides only pairs across them.

    Sets go by size, each compared with the larger ones in reach that its group does not hold yet: its members are
    marked and counted in all those at once.
    """
    if len(sets) == 2:
        near = group[0] != group[1] and similar(sets[0], sets[1], similarity)
        return np.full(2, group.min()) if near else group
    size = np.array([len(x) for x in sets])
    order = np.argsort(size, kind="stable")
    group, size = group[order], size[order]
    side = None if side is None else side[order]
    values, ids = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(values), bool)
    last = np.searchsorted(size, np.floor(size / similarity).astype(np.int64) + 1, side="right")
    for i in range(len(size)):
        open_ = group[i + 1 : last[i]] != group[i]
        if side is not None:
            open_ &= side[i + 1 : last[i]] != side[i]
        other = i + 1 + np.flatnonzero(open_)
        if not len(other):
            continue
        mark[ids[start[i] : start[i + 1]]] = True
        n = size[other]
        first = np.cumsum(n) - n
        common = np.add.reduceat(mark[ids[np.repeat(start[other] - first, n) + np.arange(int(n.sum()))]], first, dtype=np.int64)
        mark[ids[start[i] : start[i + 1]]] = False
        near = other[common / (size[i] + n - common) >= similarity]
        if len(near):
            these = np.unique(np.append(group[near], group[i]))
            group[np.isin(group, these)] = these[0]
    out = np.empty_like(group)
    out[order] = group
    return out


def _sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, size, fp, bands) of texts: bytes, fingerprint and band keys of their shingles."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
            fp = np.fromiter((fingerprint(x) for x in sets), np.uint64, len(sets)).view(np.int64)
            bands = pa.array([band_keys(x).view(np.int64) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(fp), bands], names=["node", "size", "fp", "bands"]
            )

    sized = texts.select("node", "text", F.octet_length("text").cast("long").alias("size"))
    return sized.mapInArrow(run, "node long, size long, fp long, bands array<long>")


def _clusters(sketches: DataFrame) -> DataFrame:
    """Stored (node, cluster) of the texts that a chain of close fingerprints or shared band keys connects with another
    one."""
    keys = sketches.select(F.explode("bands").alias("key"), "node")
    heads = keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("end")).where("head < end")
    stars = keys.join(heads, "key").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    roots = components(_fingerprint_pairs(sketches.select("node", "fp")).unionByName(stars))
    return stored(roots.select("node", F.col("root").alias("cluster")), "near-clusters")


def _fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes (node, fp): with the first of an equal fingerprint, and between close fingerprints."""
    first = stored(nodes.groupBy("fp").agg(F.min("node").alias("head")), "near-prints")
    same = nodes.join(first, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    end = lambda c: first.select(F.col("fp").alias(c), F.col("head").alias(f"node_{c}"))
    close = fingerprint_links(first).where("a <> b").distinct().join(end("a"), "a").join(end("b"), "b")
    return same.unionByName(close.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))


def _held(pairs: DataFrame, texts: DataFrame, similarity: float, shingle: int, name: str) -> DataFrame:
    """The stored pairs (a, b) of nodes whose shingle sets are similar enough."""
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))

    def hold(batches):
        for batch in batches:
            both = ((shingle_set(x.as_py(), shingle), shingle_set(y.as_py(), shingle)) for x, y in zip(*batch.columns[2:], strict=True))
            ok = pa.array([similar(x, y, similarity) for x, y in both], pa.bool_())
            yield batch.select([0, 1]).filter(ok)

    paired = stored(pairs, f"{name}-pairs").join(side("a"), "a").join(side("b"), "b")
    with arrow_rows(pairs.sparkSession, PAIR_ROWS):  # a row has two whole texts
        return stored(paired.select("a", "b", "text_a", "text_b").mapInArrow(hold, "a long, b long"), f"{name}-links")


def _cut(placed: DataFrame, texts: DataFrame, similarity: float, shingle: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows (cluster, node, unit, bx, by, side) of the comparisons to make, and links found on the way.

    A cluster of up to BLOCK_BYTES is one comparison. Of a larger one the texts that links between close
    fingerprints connect are a unit; it is cut into blocks, those of its largest unit and those of the rest, and
    all pairs of blocks are compared but those within the largest unit.
    """
    whole = {"unit": F.col("node"), "bx": F.lit(0), "by": F.lit(0), "side": F.lit(0)}
    columns = ["cluster", "node", *whole]
    large = placed.groupBy("cluster").agg(F.sum("size").alias("total")).where(F.col("total") > BLOCK_BYTES)
    large = stored(large, "near-large")
    if large.isEmpty():
        return placed.withColumns(whole).select(columns), None
    small = placed.join(large, "cluster", "left_anti").withColumns(whole).select(columns)
    big = stored(placed.join(large, "cluster"), "near-big")
    links = _held(_fingerprint_pairs(big), texts, similarity, shingle, "near-close")
    big = big.join(components(links), "node", "left").withColumn("unit", F.coalesce("root", "node"))
    big = stored(big.select("cluster", "node", "size", "total", "unit"), "near-units")
    units = big.groupBy("cluster", "unit").agg(F.sum("size").alias("n"))
    top = units.groupBy("cluster").agg(F.max(F.struct("n", "unit")).alias("top"))
    blocks = lambda n: F.ceil(n / BLOCK_BYTES).cast("int")
    big = big.join(top, "cluster").withColumns(
        {"others": blocks(F.col("total") - F.col("top.n")), "tops": blocks(F.col("top.n"))}
    )
    h = F.xxhash64("node")
    in_top = F.col("unit") == F.col("top.unit")
    mine = F.when(in_top, F.col("others") + F.pmod(h, F.col("tops"))).otherwise(F.pmod(h, F.col("others"))).cast("int")
    last = F.when(in_top, F.col("others") - 1).otherwise(F.col("others") + F.col("tops") - 1).cast("int")
    big = big.where("others > 0").withColumn("mine", mine)
    big = big.withColumn("partner", F.explode(F.sequence(F.lit(0), last)))
    big = big.select(
        "cluster", "node", "unit",
        F.least("mine", "partner").alias("bx"),
        F.greatest("mine", "partner").alias("by"),
        (F.col("mine") > F.col("partner")).cast("int").alias("side"),
    )
    return small.unionByName(big), links


def _linked_texts(rows: DataFrame, n_bytes: int, similarity: float, shingle: int) -> DataFrame:
    """(a, b) that connect the similar texts of each comparison: rows of ``_cut`` with text."""
    buckets = max(1, n_bytes // (2 * BLOCK_BYTES))
    task = ["cluster", "bx", "by"]

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for (_, bx, by), part in pdf.groupby(task, sort=False):
            if len(part) < 2:
                continue
            sets = [shingle_set(t, shingle) for t in part["text"]]
            node, side = part["node"].to_numpy(), part["side"].to_numpy()
            group = joined_groups(sets, part["unit"].to_numpy().copy(), None if bx == by else side, similarity)
            names, index = np.unique(group, return_inverse=True)
            least = np.full(len(names), np.iinfo(np.int64).max)
            np.minimum.at(least, index, node)
            far = least[index] != node
            a.append(node[far])
            b.append(least[index][far])
        none = np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    bucket = F.pmod(F.xxhash64(*task), F.lit(buckets)).alias("bucket")
    return rows.groupBy(bucket).applyInPandas(meet, "a long, b long")


def drop_near_copies(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """The documents, all columns, without near copies: of each group the smallest doc_id stays.

    A link holds when the word-shingle sets have at least the given Jaccard similarity, and a group is what
    held links connect. Texts with close fingerprints or a shared band key are candidates; what these connect is compared
    exactly, a pair only if links that hold do not connect the two already. Equal texts are one text from the start. Missing and
    empty texts are copies of each other; a text of any length is compared whole; of rows with equal text and
    doc_id one stays, whichever; a missing doc_id comes last. An empty table stays empty, and columns of any name
    stay as they are.
    """
    columns = [f"`{c}`" for c in docs.columns]
    key = F.sha2(body(docs), 256)
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    texts = stored(
        docs.select(key.alias("text_key"), order.alias("doc"), body(docs).alias("text"))
        .groupBy("text_key")
        .agg(F.min("doc").alias("doc"), F.any_value("text").alias("text"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-texts",
    )
    sketches = stored(_sketches(texts, shingle), "near-sketches")
    placed = stored(sketches.select("node", "size", "fp").join(_clusters(sketches), "node"), "near-placed")
    n_bytes = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rows, links = _cut(placed, texts, similarity, shingle)
    found = _linked_texts(rows.join(texts.select("node", "text"), "node"), n_bytes, similarity, shingle)
    roots = components(found if links is None else found.unionByName(links))
    rooted = texts.select("node", "text_key", "doc").join(roots, "node", "left")
    stay = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct("doc", "text_key")).alias("s"))
    stay = stay.select(F.col("s.text_key").alias("_key"), F.col("s.doc").alias("_doc"))
    marked = docs.select(F.struct(*columns).alias("_row"), key.alias("_key"), order.alias("_doc"))
    kept = marked.join(stay, ["_key", "_doc"])
    single = kept.groupBy("_key", "_doc").agg(F.any_value("_row").alias("_row"))
    return single.select("_row.*")
