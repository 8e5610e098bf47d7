"""Collocations from sorted count streams.

Which phrases occur often enough is found length by length: a phrase of m words can only be frequent if both of
its parts of m - 1 words are, so chunks of text ask (``chunks``) for the counts of those alone. Counts by hash
are never too small; the phrases that pass are counted once more by their words, which is exact.

The counts are then laid out twice, as streams in prefix order (by words) and in suffix order (by words from the
last). In such a stream every beginning of a phrase comes before it, so one pass with a stack of at most four
entries reads off the counts of all left parts and the largest extension to the right, or those of the right
parts and the largest extension to the left. Streams are cut by ranges; the few beginnings that a range needs
from earlier ones are put in front of it. The two streams meet in a merge join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm import chunks as C
from gaugeworks.llm.common import body, stored

LONGEST = 4
LEAST = 30
TOP = 2_000
COVERED_PERCENT = 80
SCALE = 2_000_000
SALTS = 64
BUCKET_BYTES = 8 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)

_BREAK = b"\xff"  # in no UTF-8 text
_LETTERS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")
COUNTED = "lang_id long, phrase string, f long"
STREAM = "lang string, words array<string>, f long, parts array<long>, extension long"


class _Words:
    """Words of a chunk as numbers, -1 between pieces; per number its word, language and hash."""

    def __init__(self, chunk: C.Chunk):
        texts: dict[int, list[bytes]] = {}
        for i, text in zip(chunk.ids.tolist(), chunk.documents(), strict=True):
            texts.setdefault(i, []).append(text)
        self.words, self.lang, ids, hashes = [], [], [], []
        self.passed: dict[int, np.ndarray] = {}  # by size, once known
        for lang, parts in texts.items():
            tokens = _BREAK.join(parts).lower().translate(_LETTERS).replace(_BREAK, b" \xff ").split()
            number = {w: k for k, w in enumerate(dict.fromkeys(tokens), len(self.words))}
            here = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
            if _BREAK in number:
                here[here == number[_BREAK]] = -1
            ids += [here, np.array([-1])]
            self.words += number
            self.lang += [lang] * len(number)
            seed = lang & 0xFFFFFFFFFFFFFFFF
            hashes.append(np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in number), np.uint64, len(number)))
        self.ids = np.concatenate([*ids, np.zeros(0, np.int64)])
        self.hashes = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        breaks = np.flatnonzero(self.ids < 0)
        ends = np.append(breaks, len(self.ids))
        self.room = ends[np.searchsorted(breaks, np.arange(len(self.ids)))] - np.arange(len(self.ids))

    def totals(self) -> dict[int, int]:
        langs = np.array(self.lang, np.int64)[self.ids[self.ids >= 0]]
        return dict(zip(*(x.tolist() for x in np.unique(langs, return_counts=True)), strict=True))


class Counting:
    """Passes over a chunk that leave the frequent phrases of 1, 2, ... words."""

    def __init__(self, n_bytes: int, least: int, longest: int):
        self.least, self.longest = least, longest
        self.buckets = max(1, n_bytes // BUCKET_BYTES)
        self.bits = min(64, math.ceil(math.log2(max(2, n_bytes / 4))) + 8)

    def _open(self, words: _Words, answers: dict, size: int) -> np.ndarray:
        """Places where a phrase of that size stands in a piece and both its parts may be frequent."""
        reach = max(len(words.ids) - size + 1, 0)
        good = words.room[:reach] >= size
        if size > 1:
            below = np.append(self._passed(words, answers, size - 1), False)
            good = good & below[:reach] & below[1 : reach + 1]
        return good

    def _asked(self, words: _Words, start: np.ndarray, size: int):
        """Distinct hashes of the phrases that start there, in order, with each start's index and the counts."""
        value = np.zeros(len(start), np.uint64)
        for k in range(size):
            value = value * _STEP + words.hashes[words.ids[start + k]]
        value = C.mixed(value) >> np.uint64(64 - self.bits)
        return np.unique(value, return_inverse=True, return_counts=True)

    def _passed(self, words: _Words, answers: dict, size: int) -> np.ndarray:
        """Places where a phrase of that size starts that may be frequent, by the answers to its round."""
        if size in words.passed:
            return words.passed[size]
        good = self._open(words, answers, size)
        start = np.flatnonzero(good)
        distinct, index, _ = self._asked(words, start, size)
        hit = np.zeros(len(distinct), bool)
        for bucket, part in C.bucket_slices(distinct, self.bits, self.buckets):
            told = C.thaw(answers[(size, bucket)])[0]
            hit[part] = np.unpackbits(told, count=part.stop - part.start).astype(bool)
        good[start] = hit[index]
        words.passed[size] = good
        return good

    def questions(self, size: int):
        def ask(chunk: C.Chunk, answers: dict) -> Iterator[tuple[int, bytes]]:
            words = _Words(chunk)
            distinct, _, count = self._asked(words, np.flatnonzero(self._open(words, answers, size)), size)
            for bucket, part in C.bucket_slices(distinct, self.bits, self.buckets):
                yield bucket, C.freeze(np.diff(distinct[part], prepend=np.uint64(0)), count[part].astype(np.uint32))

        return ask

    def often(self, payloads: list[bytes]) -> list[tuple[bytes, int]]:
        """A bit per entry: the counts of its hash in all chunks reach the least."""
        parts = [C.thaw(p) for p in payloads]
        values = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in parts])
        _, index = np.unique(values, return_inverse=True)
        total = np.bincount(index, np.concatenate([c for _, c in parts]))  # doubles, exact below 2**53
        good = total[index] >= self.least
        cut = np.split(good, np.cumsum([len(c) for _, c in parts])[:-1])
        return [(C.freeze(np.packbits(g)), int(g.sum())) for g in cut]

    def counts(self, chunk: C.Chunk, answers: dict) -> pa.RecordBatch:
        """Counts in the chunk of the phrases that may be frequent, by words; of all words as phrase ''."""
        words = _Words(chunk)
        totals = words.totals()
        lang, phrase, f = list(totals), [b""] * len(totals), list(totals.values())
        for size in range(1, self.longest + 1):
            passed = self._passed if size < self.longest else self._open
            start = np.flatnonzero(passed(words, answers, size))
            code = words.ids[start]
            for k in range(1, size):
                _, code = np.unique(code, return_inverse=True)
                code = code * (len(words.words) + 1) + words.ids[start + k]
            _, first, count = np.unique(code, return_index=True, return_counts=True)
            for s, c in zip(start[first].tolist(), count.tolist(), strict=True):
                ids = words.ids[s : s + size].tolist()
                lang.append(words.lang[ids[0]])
                phrase.append(b" ".join([words.words[i] for i in ids]))
                f.append(c)
        columns = [pa.array(lang, pa.int64()), pa.array(phrase, pa.string()), pa.array(f, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang_id", "phrase", "f"])


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, words, f) of the phrases of up to ``longest`` words with f >= least, and (lang, n) of all words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    langs = stored(docs.select(lang.alias("lang")).distinct().withColumn("lang_id", F.xxhash64("lang")), "phrase-langs")
    chunks = C.chunked(docs.select(F.xxhash64(lang).alias("doc_id"), body(docs).alias("text")))
    n_bytes = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    counting = Counting(n_bytes, least, longest)
    answers: list[DataFrame] = []
    for size in range(1, longest):
        asked = C.answered(chunks, *answers) if answers else chunks
        answers.append(C.ask(asked, size, counting.questions(size), counting.often, f"phrase-round{size}"))
    found = C.finish(C.answered(chunks, *answers) if answers else chunks, COUNTED, counting.counts)
    total = found.groupBy("lang_id", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))
    total = stored(total.join(langs, "lang_id").select("lang", "phrase", "f"), "phrase-counts")
    phrases = total.where("phrase <> ''").select("lang", F.split("phrase", " ").alias("words"), "f")
    return phrases, total.where("phrase = ''").select("lang", F.col("f").alias("n"))


def read_off(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One pass over an ordered stream of (lang, words, f, own): of every own phrase its count, the counts of its
    proper beginnings and the largest count of a phrase with one more word at its end; of every other phrase
    that it stood in front and that largest count alone."""
    stack: list[list] = []  # lang, words, f, own, largest
    for lang, words, f, own in rows:
        while stack and (stack[-1][0] != lang or words[: len(stack[-1][1])] != stack[-1][1]):
            yield _told(stack)
        if stack and len(stack[-1][1]) + 1 == len(words) and own:
            stack[-1][4] = max(stack[-1][4] or 0, f)
        stack.append([lang, words, f, own, None])
    while stack:
        yield _told(stack)


def _told(stack: list[list]) -> tuple:
    lang, words, f, own, largest = stack.pop()
    return (lang, words, f, [s[2] for s in stack], largest) if own else (lang, words, None, None, largest)


def _stream(counts: DataFrame, name: str) -> DataFrame:
    """(lang, words, f, parts, extension) of counts (lang, words, f): parts are the counts of the beginnings of
    1, 2, ... words, extension is the largest count of the phrase with one more word."""
    order = ["lang", "words"]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), name)
    # The beginnings that the first phrase of a range needs from earlier ranges: fewer than a phrase has words.
    heads = ranged.groupBy("part").agg(F.min(F.struct(*order)).alias("head"))
    place = F.explode(F.sequence(F.lit(1), F.size("head.words")))
    heads = heads.select("part", "head.lang", "head.words", place.alias("size")).where("size < size(words)")
    heads = heads.select("part", "lang", F.slice("words", 1, F.col("size")).alias("words"))
    front = heads.join(counts.hint("merge"), order).select("lang", "words", "f", "part", F.lit(0).alias("own"))
    # Where a range begins with the beginning itself, it is not missing.
    front = front.join(ranged.select(*order, "part"), [*order, "part"], "left_anti").select(front.columns)
    rows = ranged.withColumn("own", F.lit(1)).unionByName(front)
    rows = rows.repartition("part").sortWithinPartitions("part", "own", *order)

    def run(batches):
        def listed():
            part = None
            for batch in batches:
                for p, lang, words, f, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if p != part:
                        part = p
                        yield None, [], 0, 0
                    yield lang, words, f, own

        out: list[tuple] = []
        for row in read_off(listed()):
            if row[0] is not None:
                out.append(row)
            if len(out) >= 10_000:
                yield _told_batch(out)
                out = []
        yield _told_batch(out)

    told = rows.select("part", "lang", "words", "f", "own").mapInArrow(run, STREAM)
    # A phrase whose extensions lie in several ranges has a row of each.
    return told.groupBy(*order).agg(F.max("f").alias("f"), F.max("parts").alias("parts"), F.max("extension").alias("extension"))


def _told_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "words", "f", "parts", "extension"])


def scored(counts: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two and more words that no longer one covers.

    A phrase is covered by a longer one with covered_percent of its count or more. The largest of all that
    contain it has one word more, so one extension on either side decides.
    """
    forward = _stream(counts, "phrase-prefixes").where("size(words) > 1")
    back = counts.withColumn("words", F.reverse("words"))
    backward = _stream(back, "phrase-suffixes").where("size(words) > 1").select(
        "lang", F.reverse("words").alias("words"), F.col("parts").alias("ends"), F.col("extension").alias("before")
    )
    both = forward.join(backward.hint("merge"), ["lang", "words"])
    cut = F.expr(
        f"""transform(sequence(1, size(words) - 1), k -> struct(
            (cast(f AS decimal(20, 0)) * {SCALE})
                div (cast(parts[k - 1] AS decimal(20, 0)) + ends[size(words) - k - 1]) AS score,
            k AS k, parts[k - 1] AS l, ends[size(words) - k - 1] AS r))"""
    )
    covered = F.expr(
        f"coalesce(cast(greatest(extension, before) AS decimal(20, 0)) * 100 >= cast(f AS decimal(20, 0)) * {covered_percent}, false)"
    )
    both = both.where(~covered).withColumn("cut", F.array_min(cut))
    return both.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    A missing language is 'und', a missing text is empty. Words of any script stand as they are but for A-Z,
    which are lowered; pieces end at the signs ``.,;:!?`` and line ends, so no phrase goes over them. Repeated
    rows count as often as they stand. Ties are ordered by count and phrase, tied cuts by the shorter first
    part. A text of any length is one document of one chunk. An empty table gives no rows; doc_id and further
    columns are not read.
    """
    counts, words = phrase_counts(docs, least, longest)
    found = stored(scored(counts), "phrase-scores")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    near = near.where(F.col("rank") <= top)  # at most SALTS times as many rows of a language go on
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
