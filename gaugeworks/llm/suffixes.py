"""Suffix-array deduplication of bytes with deep-shallow sorting.

Only suffixes that can share LENGTH bytes with another document are sorted, and those that share them meet in
one task. In every window of LENGTH bytes the GRAM-byte strings with the least hash are its anchors; equal
windows have equal anchors at equal places. A first round finds the anchors that stand in several documents;
a second one sends, for each of those, the text around it (all windows it anchors) to the bucket of its hash.

A bucket sorts the suffixes that start in its windows, deep-shallow: multikey quicksort on eight-byte
characters down to SHALLOW bytes, then blind tries for the groups that are still equal. Suffixes equal over
LENGTH bytes come out side by side, and the smallest doc_id of each such run decides. Pieces of an anchor that
are equal as a whole are one piece from the start, so copies cost no sorting.
"""

from __future__ import annotations

import hashlib
import math
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import chunks as C
from gaugeworks.llm.common import LAST_ID

LENGTH = 50
GRAM = 16
SHALLOW = 32
ANCHOR_BUCKET_BYTES = 24 << 20  # text whose anchors one bucket of the first round takes
PIECES_PER_BUCKET = 40_000
HOT_PIECES = 10_000  # pieces of one anchor beyond which its windows travel one by one
CHUNK_BYTES = 4 << 20

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = C.mixed(np.arange(1, 257, dtype=np.uint64))
_WEIGHT = {1 << k: C.mixed(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(8)}


# Sorting ---------------------------------------------------------------------------------------------


class _Fork:
    """Inner node of a blind trie: the byte place that tells its branches apart, and the branches."""

    __slots__ = ("branches", "place")

    def __init__(self, place: int, branches: dict):
        self.place, self.branches = place, branches


def _differ(a: bytes, b: bytes) -> int:
    """First place where two strings of equal length differ, or their length."""
    if a == b:
        return len(a)
    low, high = 0, len(a)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def blind_trie_order(strings: list[bytes]) -> list[list[int]]:
    """Indices of strings of equal length in ascending order, equal ones together.

    A string goes down by the bytes at the branching places alone, is compared once with the leaf it ends
    at, and hangs in where the two differ.
    """
    root: object = [0]
    for i in range(1, len(strings)):
        new, node = strings[i], root
        while isinstance(node, _Fork):
            node = node.branches.get(new[node.place]) or next(iter(node.branches.values()))
        place = _differ(new, strings[node[0]])
        if place == len(new):
            node.append(i)
            continue
        old = strings[node[0]][place]
        above, node = None, root
        while isinstance(node, _Fork) and node.place < place:
            above, node = node, node.branches[new[node.place]]
        if isinstance(node, _Fork) and node.place == place:
            node.branches[new[place]] = [i]
        else:
            fork = _Fork(place, {old: node, new[place]: [i]})
            if above is None:
                root = fork
            else:
                above.branches[new[above.place]] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Fork):
            stack.extend(node.branches[k] for k in sorted(node.branches, reverse=True))
        else:
            out.append(node)
    return out


def _character(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number that sorts as they do."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | text[at + k].astype(np.uint64)
    return out


def deep_shallow(text: np.ndarray, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW):
    """Order of the suffixes by their first ``length`` bytes, and the rank of each place in that order, where
    equal strings have one rank. ``text`` must reach ``length`` bytes beyond every start."""
    n = len(starts)
    order, group = np.arange(n), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)  # places whose group has more than one member
    for depth in range(0, min(shallow, length) // 8 * 8, 8):
        places = np.flatnonzero(open_)
        if not len(places):
            break
        key = _character(text, starts[order[places]] + depth)
        inner = np.lexsort((key, group[places]))
        order[places] = order[places][inner]
        key, held = key[inner], group[places]
        new = np.zeros(n + 1, bool)
        new[places[1:]] = (key[1:] != key[:-1]) & (held[1:] == held[:-1])
        first = np.concatenate([[True], group[1:] != group[:-1]]) | new[:n]
        group = np.cumsum(first) - 1
        size = np.bincount(group)
        open_ = size[group] > 1
    # Groups that are equal so far: pairs are tries of two leaves, done all at once; larger ones one by one.
    done = min(shallow, length) // 8 * 8
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff([*first, n])
    split = np.zeros(n, bool)
    split[first] = True
    if done < length:
        pairs = first[size == 2]
        for lo in range(0, len(pairs), 100_000):
            p = pairs[lo : lo + 100_000]
            span = np.arange(done, length)
            a, b = (text[starts[order[q]][:, None] + span] for q in (p, p + 1))
            differs = a != b
            unequal = differs.any(1)
            split[p[unequal] + 1] = True
            row = np.flatnonzero(unequal)
            at = differs[row].argmax(1)
            swap = p[row[a[row, at] > b[row, at]]]
            order[swap], order[swap + 1] = order[swap + 1].copy(), order[swap].copy()
        raw = text.tobytes()
        for f, m in zip(first[size > 2], size[size > 2], strict=True):
            members = order[f : f + m].copy()
            leaves = blind_trie_order([raw[s + done : s + length] for s in starts[members].tolist()])
            at = f
            for leaf in leaves:
                split[at] = True
                order[at : at + len(leaf)] = members[leaf]
                at += len(leaf)
    return order, np.cumsum(split) - 1


# Anchors ---------------------------------------------------------------------------------------------


def _sliding(x: np.ndarray, size: int, of) -> np.ndarray:
    """of(x[i:i+size]) for every i at which the window is whole."""
    span, have = x, 1
    while 2 * have <= size:
        span, have = of(span[:-have], span[have:]), 2 * have
    rest = size - have
    return of(span[: len(span) - rest], span[rest:]) if rest else span


class _Pieces:
    """Runs of windows with one anchor: start, number of windows, anchor, document; and the GRAM-byte hashes."""

    def __init__(self, chunk: C.Chunk, length: int, gram: int):
        text, whole = np.frombuffer(chunk.text, np.uint8), length - gram + 1
        self.start, self.windows, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.anchor = self.grams = np.zeros(0, np.uint64)
        if len(text) < length:
            return
        h, have = _BYTE[text], 1
        while have < gram:  # gram is a power of two
            h = h[:-have] * _WEIGHT[have] + h[have:]
            have *= 2
        self.grams = h = C.mixed(h) | np.uint64(1)
        least = _sliding(h, whole, np.minimum)
        for end in chunk.ends[:-1].tolist():  # windows that leave their document
            least[max(0, end - length + 1) : end] = 0
        start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        size = np.diff([*start, len(least)])
        good = least[start] > 0
        # Least values crowd at the low end; mixed again, they spread evenly over the buckets.
        self.start, self.windows, self.anchor = start[good], size[good], C.mixed(least[start[good]])
        self.doc = np.searchsorted(chunk.ends, self.start, side="right")

    def cut(self, rows: np.ndarray, hot: np.ndarray, length: int, gram: int) -> np.ndarray:
        """Make pieces of one window of the hot ones among the rows; their anchor is a hash of the window, which
        spreads them over the buckets and which equal windows share. Returns the rows in their new places."""
        wide = rows[hot]
        n = self.windows[wide]
        at = len(self.start)
        self.start = np.concatenate([self.start, np.repeat(self.start[wide], n) + _ramp(n)])
        self.windows = np.concatenate([self.windows, np.ones(int(n.sum()), self.windows.dtype)])
        self.doc = np.concatenate([self.doc, np.repeat(self.doc[wide], n)])
        self.anchor = np.concatenate([self.anchor, np.zeros(int(n.sum()), np.uint64)])
        single = np.arange(at, len(self.start))
        self.anchor[single] = C.mixed(self.prints(single, length, gram) ^ _STEP)
        return np.concatenate([rows[~hot], single])

    def prints(self, rows: np.ndarray, length: int, gram: int) -> np.ndarray:
        """A hash of the whole text of pieces, from the hashes of the strings that tile it."""
        start, last = self.start[rows], self.start[rows] + self.windows[rows] - 1 + length - gram
        out = C.mixed(self.windows[rows].astype(np.uint64))
        at, k = np.arange(len(rows)), 0
        while len(at):
            out[at] = C.mixed(out[at] * _STEP + self.grams[np.minimum(start[at] + k, last[at])])
            at = at[start[at] + k < last[at]]
            k += gram
        return out


class Dedup:
    """The passes over a chunk, for one length and corpus size."""

    def __init__(self, length: int, n_bytes: int, gram: int = GRAM, shallow: int = SHALLOW):
        self.length, self.gram, self.shallow = length, gram, shallow
        self.buckets = max(1, n_bytes // ANCHOR_BUCKET_BYTES)
        self.bits = min(64, math.ceil(math.log2(max(2, n_bytes / 8))) + 8)
        self.text_buckets = 1

    def _distinct(self, pieces: _Pieces):
        return np.unique(pieces.anchor >> np.uint64(64 - self.bits), return_inverse=True)

    def anchors(self, chunk: C.Chunk, _):
        pieces = _Pieces(chunk, self.length, self.gram)
        distinct, index = self._distinct(pieces)
        low = np.full(len(distinct), len(chunk.ids), np.int64)
        high = np.full(len(distinct), -1, np.int64)
        np.minimum.at(low, index, pieces.doc)
        np.maximum.at(high, index, pieces.doc)
        several = (low < high).astype(np.uint8)
        count = np.bincount(index, minlength=len(distinct)).astype(np.uint32)
        for bucket, part in C.bucket_slices(distinct, self.bits, self.buckets):
            yield bucket, C.freeze(np.diff(distinct[part], prepend=np.uint64(0)), several[part], count[part])

    @staticmethod
    def shared(payloads: list[bytes]) -> list[tuple[bytes, int]]:
        """Two bits per anchor: it stands in several documents, and it has more than HOT_PIECES pieces. The hits are
        the pieces of shared anchors."""
        parts = [C.thaw(p) for p in payloads]
        values = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _, _ in parts])
        several, pieces = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        distinct, index, count = np.unique(values, return_inverse=True, return_counts=True)
        good = count > 1
        good[index[several > 0]] = True
        hot = good & (np.bincount(index, pieces, len(distinct)) > HOT_PIECES)
        cut = np.cumsum([len(s) for _, s, _ in parts])[:-1]
        told = zip(*(np.split(x, cut) for x in (good[index], hot[index], pieces)), strict=True)
        return [(C.freeze(np.packbits(g), np.packbits(h)), int(n[g].sum(dtype=np.int64))) for g, h, n in told]

    def _shared_pieces(self, chunk: C.Chunk, answers: dict):
        """Pieces whose anchor stands in several documents, in order of the anchor; the group of equal pieces
        each belongs to, the first one of each group, and the smallest doc_id of each group."""
        pieces = _Pieces(chunk, self.length, self.gram)
        distinct, index = self._distinct(pieces)
        hit, hot = np.zeros(len(distinct), bool), np.zeros(len(distinct), bool)
        for bucket, part in C.bucket_slices(distinct, self.bits, self.buckets):
            for flags, bits in zip((hit, hot), C.thaw(answers[(1, bucket)]), strict=True):
                flags[part] = np.unpackbits(bits, count=part.stop - part.start).astype(bool)
        chosen = np.flatnonzero(hit[index])
        if hot.any():
            chosen = pieces.cut(chosen, hot[index[chosen]], self.length, self.gram)
        prints = pieces.prints(chosen, self.length, self.gram)
        order = np.lexsort((prints, pieces.anchor[chosen]))
        chosen, prints = chosen[order], prints[order]
        if not len(chosen):
            return pieces, chosen, chosen, chosen, chosen
        anchor = pieces.anchor[chosen]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (prints[1:] != prints[:-1])])
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(chunk.ids[pieces.doc[chosen]], first)
        return pieces, chosen, np.cumsum(new) - 1, chosen[first], least

    def send_texts(self, chunk: C.Chunk, answers: dict):
        pieces, _, _, rows, least = self._shared_pieces(chunk, answers)
        if not len(rows):
            return
        anchor, windows = pieces.anchor[rows], pieces.windows[rows]
        start, end = pieces.start[rows].tolist(), (pieces.start[rows] + windows + self.length - 1).tolist()
        for bucket, part in C.bucket_slices(anchor, 64, self.text_buckets):
            texts = [chunk.text[a:b] for a, b in zip(start[part], end[part], strict=True)]
            blob = np.frombuffer(b"".join(texts), np.uint8)
            yield bucket, C.freeze(anchor[part], windows[part].astype(np.uint32), least[part], blob)

    def sort_texts(self, payloads: list[bytes]) -> list[tuple[bytes, int]]:
        """Per text a bit set: which of its windows start in a document before the text's smallest one."""
        parts = [C.thaw(p) for p in payloads]
        hashes, windows, least = (np.concatenate([p[k] for p in parts]) for k in range(3))
        blob = np.concatenate([p[3] for p in parts]).tobytes()
        windows = windows.astype(np.int64)
        size = windows + self.length - 1
        begin = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        ids: dict[tuple, int] = {}
        rows = zip(hashes.tolist(), begin.tolist(), (begin + size).tolist(), strict=True)
        index = np.array([ids.setdefault((h, blob[s:e]), len(ids)) for h, s, e in rows], np.int64)
        n = len(ids)
        smallest = np.full(n, LAST_ID, np.int64)
        np.minimum.at(smallest, index, least)
        row_of = np.empty(n, np.int64)
        row_of[index] = np.arange(len(index))
        # Only texts whose anchor has another text too have windows to sort; the others are equal everywhere.
        _, anchor, count = np.unique(hashes[row_of], return_inverse=True, return_counts=True)
        several = np.flatnonzero(count[anchor] > 1)
        width = windows[row_of]
        best = np.repeat(smallest, width)
        base = np.concatenate([[0], np.cumsum(width)[:-1]]).astype(np.int64)
        if len(several):
            reps = width[several]
            inner = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
            starts = np.repeat(begin[row_of[several]], reps) + inner
            order, rank = deep_shallow(np.frombuffer(blob, np.uint8), starts, self.length, self.shallow)
            owner = np.repeat(smallest[several], reps)[order]
            first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
            low = np.minimum.reduceat(owner, first)
            best[(np.repeat(base[several], reps) + inner)[order]] = low[rank]
        # A piece of periodic text may have any number of windows, so bits are written one after the other.
        where = np.repeat(base[index], windows) + _ramp(windows)
        bits = best[where] < np.repeat(least, windows)
        cut, out, at = np.cumsum([int(p[1].astype(np.int64).sum()) for p in parts]), [], 0
        for end in cut.tolist():
            out.append((C.freeze(np.packbits(bits[at:end])), int(bits[at:end].sum())))
            at = end
        return out

    def removed(self, chunk: C.Chunk, answers: dict) -> np.ndarray:
        """Which bytes of the chunk go."""
        pieces, chosen, group, rows, least = self._shared_pieces(chunk, answers)
        edge = np.zeros(len(chunk.text) + 1, np.int32)
        if len(rows):
            windows = pieces.windows[rows]
            base = np.cumsum(windows) - windows
            bits = np.zeros(int(windows.sum()), bool)
            for bucket, part in C.bucket_slices(pieces.anchor[rows], 64, self.text_buckets):
                lo, hi = int(base[part.start]), int(base[part.stop - 1] + windows[part.stop - 1])
                bits[lo:hi] = np.unpackbits(C.thaw(answers[(2, bucket)])[0], count=hi - lo).astype(bool)
            n = pieces.windows[chosen]
            gone = bits[np.repeat(base[group], n) + _ramp(n)]
            gone |= np.repeat(least[group] < chunk.ids[pieces.doc[chosen]], n)
            starts = (np.repeat(pieces.start[chosen], n) + _ramp(n))[gone]
            edge += np.bincount(starts, minlength=len(edge)).astype(np.int32)
            edge -= np.bincount(starts + self.length, minlength=len(edge)).astype(np.int32)
        return np.cumsum(edge[:-1]) > 0

    def digest(self, chunk: C.Chunk, answers: dict) -> list[tuple]:
        gone, text, rows = self.removed(chunk, answers), np.frombuffer(chunk.text, np.uint8), []
        for i, s, e in zip(chunk.ids.tolist(), chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            out = gone[s:e]
            n = int(out.sum())
            spans = int((out[1:] & ~out[:-1]).sum()) + int(out[0]) if n else 0
            kept = text[s:e][~out].tobytes() if n else chunk.text[s:e]
            rows.append((None if i == LAST_ID else i, e - s, n, spans, hashlib.sha256(kept).hexdigest()))
        return rows


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive groups of the given sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def spans_of(gone: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes as (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in list(pairwise(edges))[::2]]


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    A byte goes when a string of ``length`` bytes that covers it also starts in a document with a smaller
    doc_id, judged on the input. Missing texts count as empty ones; a missing doc_id comes after all others;
    rows with one doc_id never remove each other's bytes. Texts shorter than ``length`` lose nothing.
    """
    chunks = C.chunked(docs, CHUNK_BYTES)
    n_bytes = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    dedup = Dedup(length, n_bytes)
    shared = C.ask(chunks, 1, dedup.anchors, Dedup.shared, "suffix-anchors")
    hits = shared.agg(F.coalesce(F.sum("hits"), F.lit(0))).first()[0]
    dedup.text_buckets = max(1, hits // PIECES_PER_BUCKET)
    earlier = C.ask(C.answered(chunks, shared), 2, dedup.send_texts, dedup.sort_texts, "suffix-order")
    return C.finish(C.answered(chunks, shared, earlier), RESULT, dedup.digest)
