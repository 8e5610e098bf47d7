"""Benchmark decontamination: training passages query a BM25 index of test items by block-max WAND.

Test items are the indexed documents. Impacts are BM25 weights divided by the score of an item against
itself, so one threshold between 0 and 1 holds for all items and a passage that contains a whole item scores
1. Every passage (half-overlapping windows of words) is a query; all items at or above the threshold are
retrieved, none is cut off by a k. A retrieved pair is verified by the runs of words that the item's question
and its answer share with the passage; a question, or an answer, of WHOLE words or more that is there alone is enough.

The index is built on the driver from at most SHARD_ITEMS items and travels with the tasks; more items make
more indexes, each applied to all documents. Documents are read where they are: nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import body, slim

TELLING = 0.75  # share of an item's own score that its telling (long) words make
THRESHOLD = 0.45  # share of an item's own score a passage must reach; a question without its answer does
OVERLAP = 0.6  # share of the question's and of the answer's word runs that must be in the passage
RUN = 5  # words of a run
WHOLE = 8  # words of a question or answer that tells its item alone
K1, B = 1.2, 0.75
BLOCK = 16  # postings of a block
SHARD_ITEMS = 20_000
LEAST_STEP = 64  # words from one passage to the next, unless items are longer

_LETTERS = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of letters and digits, A-Z lowered; bytes over 127 count as letters."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer, what comes before it the question; a single sentence is cut
    in the middle."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if words_of(p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    return " ".join(words[: (len(words) + 1) // 2]), " ".join(words[(len(words) + 1) // 2 :])


def runs(words: list[bytes], size: int = RUN) -> set[tuple]:
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def shared_runs(part: list[bytes], passage: list[bytes], size: int = RUN) -> float:
    """Share of the part's word runs that the passage has; 1 for a part without words.

    Runs of a part of fewer than 4 * ``size`` words are shorter, down to two words, so that one changed word leaves
    more than half of them.
    """
    size = min(size, max(2, len(part) // 4))
    wanted = runs(part, size)
    return len(wanted & runs(passage, min(size, len(part)))) / len(wanted) if wanted else 1.0


def holds(passage: list[bytes], question: list[bytes], answer: list[bytes], overlap: float) -> tuple[float, float] | None:
    """Overlaps of question and answer if the passage holds the item: enough of both, or one of them, of WHOLE words
    or more, all but for a changed word."""
    q, a = shared_runs(question, passage), shared_runs(answer, passage)
    if min(q, a) >= overlap:
        return q, a
    for part, share in ((question, q), (answer, a)):
        if len(part) >= WHOLE and share >= 1 - RUN / max(1, len(part) - RUN + 1) - 1e-9 and share >= overlap:
            return q, a
    return None


class Index:
    """Inverted index of items with block maxima, for one fixed threshold."""

    def __init__(self, items, frequency: dict[bytes, int], n_items: int, mean_words: float, threshold: float):
        """items: (item_id, question, answer) rows; frequency: items of the whole table that hold a word."""
        self.threshold = threshold - 1e-9
        self.items, postings = [], {}
        self.telling: dict[bytes, list[tuple[int, float]]] = {}
        self.least: list[float] = []
        for item_id, question, answer in items:
            q, a = words_of(question), words_of(answer)
            counts: dict[bytes, int] = {}
            for w in q + a:
                counts[w] = counts.get(w, 0) + 1
            if not counts:
                continue
            number = len(self.items)
            self.items.append((item_id, q, a))
            length = K1 * (1 - B + B * len(q + a) / mean_words)
            weight = {
                w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + length)
                for w, n in counts.items()
            }
            own, rest = sum(weight.values()), 1.0
            # Long words are rare in any text. A passage at the threshold has at least so much of the score in
            # the item's telling words, as the others cannot make up for more.
            for w, x in sorted(weight.items(), key=lambda v: (-len(v[0]), -v[1], v[0])):
                postings.setdefault(w, []).append((number, x / own))
                if rest > 1.0 - TELLING:
                    self.telling.setdefault(w, []).append((number, x / own))
                    rest -= x / own
            self.least.append(self.threshold - rest)
        self.lists = {}
        for w, found in postings.items():
            at, impact = [f[0] for f in found], [f[1] for f in found]
            ends = [min(i + BLOCK, len(at)) - 1 for i in range(0, len(at), BLOCK)]
            most = [max(impact[i : i + BLOCK]) for i in range(0, len(at), BLOCK)]
            self.lists[w] = (at, impact, [at[e] for e in ends], most, max(impact))
        self.step = max([LEAST_STEP, *(len(q) + len(a) for _, q, a in self.items)])

    def search(self, words: set[bytes]) -> list[tuple[int, float]]:
        """All (item number, score) at or above the threshold, by block-max WAND."""
        found, enough = [], self.threshold
        cursors = [[self.lists[w][0][0], 0, self.lists[w]] for w in words if w in self.lists]
        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2][4]
                if bound >= enough:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, leave = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.items)
            for c in cursors[: pivot + 1]:
                block = bisect_left(c[2][2], item)
                if block < len(c[2][2]):
                    bound += c[2][3][block]
                    leave = min(leave, c[2][2][block] + 1)
            if bound < enough:  # no item before ``leave`` can reach the threshold
                self._advance(cursors, pivot, max(leave, item + 1))
            elif cursors[0][0] == item:
                score = sum(c[2][1][c[1]] for c in cursors[: pivot + 1])
                if score >= enough:
                    found.append((item, score))
                self._advance(cursors, pivot, item + 1)
            else:
                self._advance(cursors, pivot, item)

    def _admits(self, telling: set[bytes]) -> bool:
        """Whether telling words are enough of some item for the search to be worth while."""
        part: dict[int, float] = {}
        for w in telling:
            for item, impact in self.telling[w]:
                part[item] = part.get(item, 0.0) + impact
        return any(x >= self.least[item] for item, x in part.items())

    @staticmethod
    def _advance(cursors: list, pivot: int, item: int) -> None:
        """Move the cursors up to the pivot to the first posting at or after ``item``; drop ended ones."""
        for c in cursors[: pivot + 1]:
            if c[0] < item:
                c[1] = bisect_left(c[2][0], item, c[1])
                c[0] = c[2][0][c[1]] if c[1] < len(c[2][0]) else -1
        cursors[:] = [c for c in cursors if c[0] >= 0]

    def matches(self, text: str, overlap: float = OVERLAP) -> dict[int, tuple[float, float, float]]:
        """Per item of which a passage of the text holds enough: (score, question overlap, answer overlap)."""
        words = words_of(text)
        telling = self.telling.keys() & set(words)
        if not self._admits(telling):
            return {}
        step, best = self.step, {}
        last = max(0, (len(words) - step - 1) // step)
        near: dict[int, set[bytes]] = {}
        for i, w in enumerate(words):
            if w in telling:
                at = min(i // step, last)
                near.setdefault(at, set()).add(w)
                near.setdefault(max(0, min(i // step - 1, last)), set()).add(w)
        starts = [s for s, held in near.items() if self._admits(held)]
        for start in sorted(starts):
            passage = words[start * step : (start + 2) * step]
            for item, score in self.search(set(passage)):
                _, q, a = self.items[item]
                shared = holds(passage, q, a, overlap)
                if shared and (score, *shared) > best.get(item, ()):
                    best[item] = (score, *shared)
        return best


def build_indexes(items: DataFrame, threshold: float = THRESHOLD, shard_items: int = SHARD_ITEMS) -> list[Index]:
    """Indexes over all items (item_id, and text or question and answer), each of about ``shard_items``.

    Items without words are left out; repeated items are items of their own.
    """
    if "question" in items.columns and "answer" in items.columns:
        text = F.concat_ws(" ", "question", "answer")
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("question", "answer")]
    else:
        text, parts = body(items), [body(items).alias("question"), F.lit(None).cast("string").alias("answer")]
    picked = items.select(F.col("item_id").cast("long").alias("item_id"), *parts, text.alias("text"))

    @F.pandas_udf("array<binary>")
    def distinct_words(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(words_of(t))) for t in texts])

    @F.pandas_udf("long")
    def count_words(texts: pd.Series) -> pd.Series:
        return pd.Series([len(words_of(t)) for t in texts], dtype="int64")

    n, total = picked.agg(F.count("*"), F.coalesce(F.sum(count_words("text")), F.lit(0))).first()
    shards = max(1, -(-n // shard_items))
    picked = picked.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    spread = picked.select("shard", F.explode(distinct_words("text")).alias("word"))
    often = spread.groupBy("word").count()
    out = []
    for k in range(shards):
        own = spread.where(F.col("shard") == k).select("word").distinct()
        frequency = {bytes(r[0]): r[1] for r in often.join(own, "word").collect()}
        rows = picked.where(F.col("shard") == k).orderBy("item_id", "text").select("item_id", "question", "answer").collect()
        cut = [(i, *(question_and_answer(q) if a is None else (q, a))) for i, q, a in rows]
        out.append(Index(cut, frequency, n, max(1.0, total / max(1, n)), threshold))
    return out


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per document and test item it contains: doc_id, item_id, score, question_overlap, answer_overlap.

    Score and overlaps are those of the document's best passage for the item. Clean documents have no row.
    Missing and empty texts match nothing; repeated documents repeat their rows; a missing doc_id stays
    missing. Without items there are no rows.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

    def scan(index: Index) -> DataFrame:
        def run(batches):
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                for i, text in zip(ids, batch.column(1), strict=True):
                    for item, values in sorted(index.matches(text.as_py(), overlap).items()):
                        rows.append((i, index.items[item][0], *values))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[c.split()[0] for c in schema.split(", ")],
                )

        return slim(docs).mapInArrow(run, schema)

    scans = [scan(index) for index in build_indexes(items, threshold)]
    out = scans[0]
    for more in scans[1:]:
        out = out.unionByName(more)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The documents, all columns, that contain no test item."""

    def clean(index: Index):
        @F.pandas_udf("boolean")
        def holds_none(texts: pd.Series) -> pd.Series:
            return pd.Series([not index.matches(t, overlap) for t in texts], dtype="bool")

        return holds_none(body(docs))

    for index in build_indexes(items, threshold):
        docs = docs.where(clean(index))
    return docs
