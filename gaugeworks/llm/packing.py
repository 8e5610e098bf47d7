"""Vector bin packing of token sequences.

Examples are placed into sequences under three limits at once: tokens, segments (pieces) and loss-bearing
tokens. The example whose demand vector has the largest dot product with what is left in the open sequence
goes in next; where none fits whole, the best one is cut and its rest stays in the pool. A sequence that
cannot be filled gives back what exceeds a power of two, so no sequence is padded.

Spark cuts the work: every task packs the examples of its partition in blocks of a fixed number of rows, so
nothing is shuffled and memory does not grow with the input.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import slim

SEQUENCE_TOKENS = 4096
MAX_SEGMENTS = 512
BLOCK_ROWS = 2048
END_ID = 2
MEMO_WORDS = 300_000  # words one generation of a worker's memory of encodings holds

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack_block(tokens, loss, max_tokens=SEQUENCE_TOKENS, max_segments=MAX_SEGMENTS, max_loss=SEQUENCE_TOKENS):
    """Pack examples of given token and loss-bearing token counts; the loss-bearing ones come last.

    Returns a list of sequences, each a list of (example, start, length). Every token of every example lies
    in exactly one piece. Examples without tokens get no piece.
    """
    tokens = np.asarray(tokens, np.int64)
    quiet = tokens - np.minimum(np.asarray(loss, np.int64), tokens)  # leading tokens without loss
    at = np.zeros(len(tokens), np.int64)  # next token of each example that is not placed
    live = tokens > 0
    sequences = []

    def loss_of(i, start, length):
        return max(0, start + length - max(start, int(quiet[i])))

    def close(pieces):
        """Keep the largest power of two of a part-filled sequence, give back the rest."""
        total = sum(p[2] for p in pieces)
        keep = total if total == max_tokens else 1 << (total.bit_length() - 1)
        excess = total - keep
        while excess:
            i, start, length = pieces.pop()
            back = min(excess, length)
            at[i] -= back
            live[i] = True
            excess -= back
            if length > back:
                pieces.append((i, start, length - back))
        sequences.append(pieces)

    while live.any():
        room = np.array([max_tokens, max_segments, max_loss], np.int64)
        pieces = []
        while room.all():
            pool = np.flatnonzero(live)
            if not len(pool):
                break
            need = tokens[pool] - at[pool]
            need_loss = tokens[pool] - np.maximum(at[pool], quiet[pool])
            # Dot product of the demand with what is left, each in shares of its limit.
            score = need * (room[0] / max_tokens**2) + room[1] / max_segments**2 + need_loss * (room[2] / max_loss**2)
            fits = (need <= room[0]) & (need_loss <= room[2])
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1.0)))
                length = int(need[k])
            else:
                k = int(np.argmax(score))
                length = int(min(need[k], room[0], room[2] + max(0, quiet[pool[k]] - at[pool[k]])))
            i, start = int(pool[k]), int(at[pool[k]])
            pieces.append((i, start, length))
            at[i] += length
            live[i] = at[i] < tokens[i]
            room -= (length, 1, loss_of(i, start, length))
        if len(pieces) > 1 and any(a[0] == b[0] and a[1] + a[2] == b[1] for a, b in itertools.pairwise(pieces)):
            pieces = _joined(pieces)
        close(pieces)
    return sequences


def _joined(pieces):
    out = [pieces[0]]
    for i, start, length in pieces[1:]:
        j, s, n = out[-1]
        if i == j and s + n == start:
            out[-1] = (j, s, n + length)
        else:
            out.append((i, start, length))
    return out


PUNCTUATION = tuple(".,;:!?")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a visible character: itself, or else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = itertools.count(256)
    return {b: chr(b if b in visible else next(free)) for b in range(256)}


BYTE_LETTERS = _byte_letters()


def _latin(word: str) -> bool:
    """Letters below U+0250 that stay single letters in lower case (such letters are composed already)."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and len(low := word.lower()) == len(word) and low.isalpha()))


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    No token of such a vocabulary spans white space, so words between blanks and line ends are encoded one
    by one and remembered: in two generations, of which the older is dropped when the newer one is full.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.memo_words = memo_words
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _letters(self, word: str) -> bytes:
        """A composed run of Latin letters, which the vocabulary's own splitting leaves whole."""
        piece = word.lower()
        if not piece.isascii():
            piece = "".join([BYTE_LETTERS[b] for b in piece.encode()])
        return np.array([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            if _latin(word):
                found = self._letters(word)
            elif word[-1:] in PUNCTUATION and _latin(word[:-1]):
                found = self._ids(word[:-1]) + self._ids(word[-1])
            else:
                found = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= 64:
            if len(self.new) >= self.memo_words:
                self.old, self.new = self.new, {}
            self.new[word] = found
        return found

    def _ids(self, word: str) -> bytes:
        found = self.new.get(word)
        return self._word(word) if found is None else found

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        get = self.new.get
        found = [get(w) for w in words]
        if None in found:
            found = [self._ids(w) if x is None else x for w, x in zip(words, found, strict=True)]
        return b"".join(found)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _number(counter: Iterator[int]) -> int:
    """A sequence number no other task gives."""
    context = TaskContext.get()
    return ((context.partitionId() if context else 0) << 32) | next(counter)


def _rows(sequences, ids, n_tokens, n_loss, counter, encoded=None):
    out = []
    for pieces in sequences:
        number, offset = _number(counter), 0
        for i, start, length in pieces:
            crc = None if encoded is None else zlib.crc32(memoryview(encoded[i])[4 * start : 4 * (start + length)])
            lossy = max(0, start + length - max(start, int(n_tokens[i] - n_loss[i])))
            out.append((ids[i], start, length, crc, int(n_tokens[i]), number, offset, lossy))
            offset += length
    return out


_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int = SEQUENCE_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Tokenize whole texts and pack them; one row per piece, all tokens bear loss.

    A missing or empty text is its end id alone. A missing doc_id stays missing. Repeated rows are packed
    each for itself. Further columns are ignored. No rows give no pieces.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, counter = encoder(tokenizer), itertools.count()
        for batch in batches:
            for lo in range(0, batch.num_rows, block_rows):
                part = batch.slice(lo, block_rows)
                ids = part.column(0).to_pylist()
                encoded = [encode(t.as_py()) + end for t in part.column(1)]
                n = np.array([len(e) // 4 for e in encoded], np.int64)
                yield _batch(_rows(pack_block(n, n, max_tokens, max_segments, max_loss), ids, n, n, counter, encoded))

    return slim(docs).mapInArrow(run, PIECES)


def pack_examples(
    examples: DataFrame,
    max_tokens: int = SEQUENCE_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = SEQUENCE_TOKENS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pack instruction examples given as (doc_id, n_tokens, n_loss); prompt tokens come before loss-bearing ones.

    Missing or negative counts are zero; an example without tokens gets no piece. ids_crc32 is null.
    """
    count = lambda c: F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0)).alias(c)

    def run(batches):
        counter = itertools.count()
        for batch in batches:
            for lo in range(0, batch.num_rows, block_rows):
                part = batch.slice(lo, block_rows)
                n = part.column(1).to_numpy()
                loss = np.minimum(part.column(2).to_numpy(), n)
                ids = part.column(0).to_pylist()
                yield _batch(_rows(pack_block(n, loss, max_tokens, max_segments, max_loss), ids, n, loss, counter))

    return examples.select(F.col("doc_id").cast("long"), count("n_tokens"), count("n_loss")).mapInArrow(run, PIECES)
