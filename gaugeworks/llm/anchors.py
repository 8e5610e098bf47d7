"""Substring deduplication by fixed-block anchors.

Of every document the non-overlapping blocks of ANCHOR words are indexed; every rolling window of as many
words, at any place, probes the index. A repeated run of WINDOW = 2 * ANCHOR - 1 words or more covers a whole
block in one of its places, so it is hit. Hits are then extended: the WINDOW-word windows around them are
compared exactly (80-bit hashes), which joins into the maximal repeats, and words of a window that also starts
in a document with a smaller doc_id go.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import chunks as C
from gaugeworks.llm.common import LAST_ID

WINDOW = 13
BUCKET_BYTES = 6 << 20  # text whose windows one bucket of a round takes
_STEP = np.uint64(0x9E3779B97F4A7C15)

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_FLAGS_BLOCK, _FLAGS_TWICE = np.uint8(1), np.uint8(2)


class _Words:
    """Words of a chunk as one array of hashes, with the document and place of each."""

    def __init__(self, chunk: C.Chunk):
        self.lists = [d.split() for d in chunk.documents()]
        self.counts = np.array([len(w) for w in self.lists], np.int64)
        n = int(self.counts.sum())
        digest = xxhash.xxh64_intdigest
        self.hashes = np.fromiter((digest(w) for ws in self.lists for w in ws), np.uint64, n)
        self.first = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(n) - self.first[self.doc] if n else np.zeros(0, np.int64)

    def starts(self, size: int) -> np.ndarray:
        """Starts of windows of so many words that stay in their document."""
        return np.flatnonzero(self.place + size <= self.counts[self.doc]) if len(self.doc) else self.place

    def grams(self, starts: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for k in range(size):
            out = out * _STEP + self.hashes[starts + k]
        return C.mixed(out)


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the values, and the first index of each group of equal ones in that order."""
    order = np.argsort(values, kind="stable")
    v = values[order]
    return order, np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)


class Dedup:
    """The three passes over a chunk, for one window size and corpus size."""

    def __init__(self, window: int, n_bytes: int):
        self.window, self.anchor = window, (window + 1) // 2
        self.buckets = max(1, n_bytes // BUCKET_BYTES)
        self.bits = min(64, math.ceil(math.log2(max(2, n_bytes / 4))) + 7)

    def _probes(self, words: _Words):
        """Rolling windows of anchor size: starts, and their distinct hashes in order with each start's index."""
        starts = words.starts(self.anchor)
        grams = words.grams(starts, self.anchor) >> np.uint64(64 - self.bits)
        order, first = _grouped(grams)
        index = np.empty(len(order), np.int64)
        index[order] = np.repeat(np.arange(len(first)), np.diff([*first, len(order)]))
        return starts, grams[order[first]], index

    def probe(self, chunk: C.Chunk, _):
        words = _Words(chunk)
        starts, distinct, index = self._probes(words)
        flags = np.zeros(len(distinct), np.uint8)
        flags[index[words.place[starts] % self.anchor == 0]] |= _FLAGS_BLOCK
        low = np.full(len(distinct), len(words.counts), np.int64)
        high = np.full(len(distinct), -1, np.int64)
        np.minimum.at(low, index, words.doc[starts])
        np.maximum.at(high, index, words.doc[starts])
        flags[low < high] |= _FLAGS_TWICE
        for bucket, part in C.bucket_slices(distinct, self.bits, self.buckets):
            yield bucket, C.freeze(np.diff(distinct[part], prepend=np.uint64(0)), flags[part])

    @staticmethod
    def hit(payloads: list[bytes]) -> list[tuple[bytes, int]]:
        """An entry is hit when the string is a block somewhere and stands in at least two documents."""
        parts = [C.thaw(p) for p in payloads]
        values = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in parts])
        flags = np.concatenate([f for _, f in parts])
        order, first = _grouped(values)
        size = np.diff([*first, len(order)])
        seen = np.bitwise_or.reduceat(flags[order], first) if len(first) else flags
        good = (seen & _FLAGS_BLOCK > 0) & ((size > 1) | (seen & _FLAGS_TWICE > 0))
        out = np.empty(len(order), bool)
        out[order] = np.repeat(good, size)
        cut = np.split(out, np.cumsum([len(f) for _, f in parts])[:-1])
        return [(C.freeze(np.packbits(c)), int(c.sum())) for c in cut]

    def _windows(self, words: _Words, answers: dict):
        """Windows with a hit inside: starts, distinct 80-bit hashes in order, each start's index."""
        starts, distinct, index = self._probes(words)
        hit = np.zeros(len(distinct), bool)
        for bucket, part in C.bucket_slices(distinct, self.bits, self.buckets):
            bits = C.thaw(answers[(1, bucket)])[0]
            hit[part] = np.unpackbits(bits, count=part.stop - part.start).astype(bool)
        near = np.zeros(len(words.doc) + 1, np.int64)
        near[starts[hit[index]] + 1] = 1
        near = np.cumsum(near)
        candidates = words.starts(self.window)
        candidates = candidates[near[candidates + self.window - self.anchor + 1] > near[candidates]]
        high = words.grams(candidates, self.window)
        low = (words.grams(candidates + self.window // 2, self.window - self.window // 2) >> np.uint64(48)).astype(np.uint16)
        order = np.lexsort((low, high))
        h, lo = high[order], low[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])]) if len(h) else np.zeros(0, bool)
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(new) - 1
        return candidates, h[new], lo[new], index

    def _least(self, chunk: C.Chunk, words: _Words, starts, index, n: int) -> np.ndarray:
        least = np.full(n, LAST_ID, np.int64)
        np.minimum.at(least, index, chunk.ids[words.doc[starts]])
        return least

    def extend(self, chunk: C.Chunk, answers: dict):
        words = _Words(chunk)
        starts, high, low, index = self._windows(words, answers)
        least = self._least(chunk, words, starts, index, len(high))
        for bucket, part in C.bucket_slices(high, 64, self.buckets):
            yield bucket, C.freeze(np.diff(high[part], prepend=np.uint64(0)), low[part], least[part])

    @staticmethod
    def earlier(payloads: list[bytes]) -> list[tuple[bytes, int]]:
        """One bit per entry: the window starts in a document before the packet's first one that has it."""
        parts = [C.thaw(p) for p in payloads]
        high = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _, _ in parts])
        low = np.concatenate([x for _, x, _ in parts])
        least = np.concatenate([x for _, _, x in parts])
        order = np.lexsort((low, high))
        h, lo = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])]))
        smallest = np.minimum.reduceat(least[order], first)
        out = np.empty(len(order), bool)
        out[order] = np.repeat(smallest, np.diff([*first, len(order)])) < least[order]
        cut = np.split(out, np.cumsum([len(x) for _, x, _ in parts])[:-1])
        return [(C.freeze(np.packbits(c)), int(c.sum())) for c in cut]

    def covered(self, chunk: C.Chunk, answers: dict) -> tuple[_Words, np.ndarray]:
        """Words of the chunk, and which of them go."""
        words = _Words(chunk)
        starts, high, _, index = self._windows(words, answers)
        least = self._least(chunk, words, starts, index, len(high))
        before = np.zeros(len(high), bool)
        for bucket, part in C.bucket_slices(high, 64, self.buckets):
            bits = C.thaw(answers[(2, bucket)])[0]
            before[part] = np.unpackbits(bits, count=part.stop - part.start).astype(bool)
        gone = starts[before[index] | (least[index] < chunk.ids[words.doc[starts]])]
        edge = np.zeros(len(words.doc) + 1, np.int64)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + self.window, -1)
        return words, np.cumsum(edge[:-1]) > 0

    def digest(self, chunk: C.Chunk, answers: dict) -> list[tuple]:
        words, gone = self.covered(chunk, answers)
        rows = []
        for k, (i, listed) in enumerate(zip(chunk.ids.tolist(), words.lists, strict=True)):
            out = gone[words.first[k] : words.first[k] + len(listed)]
            kept = listed if not out.any() else [w for w, g in zip(listed, out.tolist(), strict=True) if not g]
            sha = hashlib.sha256(b" ".join(kept)).hexdigest()
            rows.append((None if i == LAST_ID else i, len(listed), len(listed) - len(kept), sha))
        return rows

    def rewrite(self, chunk: C.Chunk, answers: dict) -> pa.RecordBatch:
        """The chunk's whole rows with repeated words cut out. Kept words of a changed text are joined by one
        blank, or by a line end where the text had one between them."""
        words, gone = self.covered(chunk, answers)
        rest = C.unpacked_rows(chunk.rest)
        missing = rest.column(rest.schema.names.index("text")).to_pylist()
        texts, changed = [], []
        for k, text in enumerate(chunk.documents()):
            out = gone[words.first[k] : words.first[k] + words.counts[k]]
            changed.append(bool(out.any()))
            if changed[-1]:
                lines, at = [], 0
                for line in text.split(b"\n"):
                    n = len(line.split())
                    kept = [w for w, g in zip(line.split(), out[at : at + n].tolist(), strict=True) if not g]
                    at += n
                    if kept:
                        lines.append(b" ".join(kept))
                text = b"\n".join(lines)
            texts.append(None if missing[k] else text.decode("utf-8", "surrogatepass"))
        columns = dict(zip(rest.schema.names, rest.columns, strict=True)) | {"text": pa.array(texts, pa.string())}
        if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
            old = columns["n_chars"].to_pylist()
            n = [len(t) if c and t is not None else o for t, c, o in zip(texts, changed, old, strict=True)]
            columns["n_chars"] = pa.array(n, columns["n_chars"].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _solved(docs: DataFrame, window: int, whole_rows: bool = False) -> tuple[Dedup, DataFrame]:
    chunks = C.chunked(docs, whole_rows=whole_rows)
    n_bytes = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    dedup = Dedup(window, n_bytes)
    hits = C.ask(chunks, 1, dedup.probe, Dedup.hit, "anchor-hits")
    earlier = C.ask(C.answered(chunks, hits), 2, dedup.extend, Dedup.earlier, "anchor-repeats")
    return dedup, C.answered(chunks, hits, earlier)


def repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    A word goes when a window that covers it also starts in a document with a smaller doc_id, judged on the
    input. A missing text has no words; a missing doc_id comes after all others; rows with one doc_id never
    remove each other's words. Texts shorter than a window lose nothing.
    """
    dedup, chunks = _solved(docs, window)
    return C.finish(chunks, RESULT, dedup.digest)


def drop_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, with repeated words cut out of ``text``; an n_chars column follows.

    Documents that lose nothing keep their text as it is; one that loses every word stays with an empty text.
    """
    dedup, chunks = _solved(docs, window, whole_rows=True)
    return C.finish(chunks, docs.schema, dedup.rewrite)
