"""Toxicity: non-negative positive-unlabelled learning of a linear classifier in numpy.

Confirmed toxic documents are the positives; the rest of the text is unlabelled, a mixture with a known class
prior. The risk of a classifier on negatives is the risk of "negative" on unlabelled text less prior times its
risk on positives; where a batch drives that difference below zero the step goes the other way, so the
model cannot profit from memorising (non-negative correction).

Features are the distinct words and word beginnings of a document, hashed; only those markedly more frequent
in positives than in all text get a weight, so long texts gather no noise.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import first_by_hash, held_out, slim

POSITIVE_ROWS = 6_000  # most confirmed toxic rows the model is fitted on
UNLABELLED_ROWS = 12_000  # most unlabelled rows of the gradient steps
THRESHOLD = 0.3
BUCKETS = 1 << 22
PREFIXES = (4, 5, 7)
SIZE_MARK = b"size:%d"
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def tokens_of(text: str) -> set[bytes]:
    """Distinct words of letters in lower case (A-Z alone are lowered), their beginnings, marked by length and
    by whether one, two or more different words share them, and the size of the text in powers of two."""
    words = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    different = set(words)
    out = set(different)
    for k in PREFIXES:
        starts = [w[:k] for w in different if len(w) >= k]
        count = Counter(starts)
        mark = b"%d:" % k
        out.update([mark + w for w in count])
        out.update([b"2" + mark + w for w, n in count.items() if n > 1])
        out.update([b"3" + mark + w for w, n in count.items() if n > 2])
    out.add(SIZE_MARK % len(words).bit_length())
    return out


def bucket(token: bytes) -> int:
    return zlib.crc32(token) & (BUCKETS - 1)


def buckets_of(text: str) -> np.ndarray:
    """Sorted distinct hashed features of one whole text."""
    found = tokens_of(text)
    return np.unique(np.fromiter(map(bucket, found), np.int64, len(found)))


@dataclass
class Linear:
    """Selected buckets (sorted), their weights, bias, and the calibration of the margin."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def lookup(self) -> np.ndarray:
        table = np.full(BUCKETS, -1, np.int32)
        table[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        return table

    def margin(self, found: np.ndarray, table: np.ndarray) -> float:
        at = table[found]
        return self.bias + float(self.weights[at[at >= 0]].sum())

    def score(self, margins: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margins + self.shift)


class Scorer:
    """Margins of texts, remembering for each word which weighted features it can bring (for most: none)."""

    def __init__(self, model: Linear, memo_words: int = 400_000):
        self.model, self.table, self.memo_words = model, model.lookup(), memo_words
        self.memo: dict[bytes, tuple] = {}

    def _index(self, token: bytes) -> int:
        return int(self.table[bucket(token)])

    def _look(self, word: bytes) -> tuple:
        """(index or -1 of the word, (start, indices for one, two, three words) of each weighted start)."""
        starts = []
        for k in PREFIXES:
            if len(word) >= k:
                token = b"%d:" % k + word[:k]
                at = (self._index(token), self._index(b"2" + token), self._index(b"3" + token))
                if max(at) >= 0:
                    starts.append((token, at))
        own = self._index(word)
        found = (own, tuple(starts)) if starts or own >= 0 else ()
        if len(self.memo) >= self.memo_words:
            self.memo.clear()
        self.memo[word] = found
        return found

    def margin(self, text: str) -> float:
        words = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()
        different, get = set(words), self.memo.get
        hits = [f for w in different if (f := self._look(w) if (g := get(w)) is None else g)]
        chosen = {self._index(SIZE_MARK % len(words).bit_length())}
        chosen.update([own for own, _ in hits])
        counts = Counter([start for _, starts in hits for start in starts])
        for (_, at), n in counts.items():
            chosen.update(at[: min(n, 3)])
        chosen.discard(-1)
        return self.model.bias + float(sum(self.model.weights[i] for i in sorted(chosen)))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _group(found: np.ndarray) -> int:
    """Least mixed feature of a document, -1 without any: (near) copies mostly share it."""
    return int(((found.astype(np.int64) * 0x9E3779B1) % (1 << 32)).min()) if len(found) else -1


def _shares(rows: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Votes per bucket, and all votes. All documents of a group together have one vote."""
    if not rows:
        return np.zeros(BUCKETS), 0.0
    _, group, size = np.unique([_group(r) for r in rows], return_inverse=True, return_counts=True)
    voice = 1.0 / size[group]
    votes = np.bincount(np.concatenate(rows).astype(np.int64), np.repeat(voice, [len(r) for r in rows]), BUCKETS)
    return votes, float(voice.sum())


_SIZES = np.unique([bucket(SIZE_MARK % k) for k in range(32)])


def candidates(positive: list[np.ndarray], least: float = 1.5, share: float = 0.015) -> np.ndarray:
    """Buckets in a fair share of the positives, and those of the sizes."""
    p, n_p = _shares(positive)
    return np.union1d(np.flatnonzero(p >= max(least, share * n_p)), _SIZES)


def select(asked: np.ndarray, positive: list[np.ndarray], u: np.ndarray, n_u: float, prior: float) -> np.ndarray:
    """Those candidates that are far rarer in the rest of the text. ``u`` are the candidates' votes in all text, ``n_u``
    all votes there."""
    p, n_p = _shares(positive)
    p = p[asked]
    clean = np.maximum(u / max(1.0, n_u) - prior * p / max(1.0, n_p), 0.0) / max(1e-9, 1.0 - prior)
    expected = (clean + 0.5 / max(1.0, n_u)) * n_p
    z = (p - expected) / np.sqrt(expected + 1.0)
    return np.union1d(asked[(p > 4 * expected) & (z > 1.0)], _SIZES)


def corpus_votes(docs: DataFrame, asked: np.ndarray) -> tuple[np.ndarray, float]:
    """Votes of some buckets over all documents, and all votes, as ``_shares`` counts them.

    Each task adds up its documents by group before the shuffle, so a group with a third of all documents is a row per
    batch. What is shuffled is a number of at most four bytes for each candidate of a document; a task reads its groups
    in order and holds one of them. A row per candidate comes back.
    """
    asked_bytes = asked.astype("<i4").tobytes()
    kind = "<u2" if len(asked) < 1 << 16 else "<u4"

    def by_group(batches):
        place = np.full(BUCKETS, -1, np.int32)
        wanted = np.frombuffer(asked_bytes, "<i4")
        place[wanted] = np.arange(len(wanted), dtype=np.int32)
        for pdf in batches:
            size, hits = Counter(), {}
            for text in pdf["text"]:
                found = buckets_of(text)
                group, at = _group(found), place[found]
                size[group] += 1
                hits.setdefault(group, []).append(at[at >= 0])
            rows = []
            for group, parts in hits.items():
                which, times = np.unique(np.concatenate(parts), return_counts=True)
                counts = times.astype("<u4").tobytes() if size[group] > 1 else None  # alone: one each
                rows.append((group, size[group], which.astype(kind).tobytes(), counts))
            yield pd.DataFrame(rows, columns=["grp", "n", "which", "times"])

    def vote(batches):
        votes, everyone = np.zeros(len(asked_bytes) // 4), 0
        now, n, sums = None, 0, None

        def close():
            if now is not None:
                np.add(votes, sums / n, out=votes)

        for pdf in batches:
            for group, size, which, times in pdf.itertuples(index=False):
                if group != now:
                    close()
                    now, n, sums, everyone = group, 0, np.zeros(len(votes)), everyone + 1
                at = np.frombuffer(which, kind)
                sums[at] += np.frombuffer(times, "<u4") if times is not None else 1
                n += size
        close()
        some = np.flatnonzero(votes)
        yield pd.DataFrame({"at": np.append(some, -1), "votes": np.append(votes[some], float(everyone))})

    parts = slim(docs).select("text").mapInPandas(by_group, "grp long, n long, which binary, times binary")
    summed = (
        parts.repartition("grp").sortWithinPartitions("grp").mapInPandas(vote, "at long, votes double")
        .groupBy("at").agg(F.sum("votes").alias("votes")).toPandas()
    )
    u = np.zeros(len(asked))
    inside = summed[summed["at"] >= 0]
    u[inside["at"].to_numpy()] = inside["votes"].to_numpy()
    return u, float(summed.loc[summed["at"] < 0, "votes"].sum())


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    chosen: np.ndarray,
    epochs: int = 60,
    rate: float = 0.05,
    decay: float = 1e-3,
    batch: int = 2_000,
    seed: int = 0,
) -> Linear:
    """Linear model over the chosen buckets by the non-negative PU risk, logistic loss and Adam steps."""
    table = np.full(BUCKETS, -1, np.int64)
    table[chosen] = np.arange(len(chosen))

    def compact(rows):
        cols = [table[r] for r in rows]
        cols = [c[c >= 0] for c in cols]
        return cols

    pos, unl = compact(positive), compact(unlabelled)
    w, b = np.zeros(len(chosen)), -2.0
    m, v, t = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1), 0
    rng = np.random.default_rng(seed)

    def forward(rows):
        n = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        owner = np.repeat(np.arange(len(rows)), n)
        return flat, owner, np.bincount(owner, w[flat], len(rows)) + b

    def pull(flat, owner, per_row):
        g = np.empty(len(w) + 1)
        g[:-1] = np.bincount(flat, per_row[owner], len(w))
        g[-1] = per_row.sum()
        return g

    if pos and unl:
        share = max(1, len(unl) // batch)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(unl)), share):
                some = rng.choice(len(pos), min(len(pos), batch), replace=False)
                fp, op, zp = forward([pos[i] for i in some])
                fu, ou, zu = forward([unl[i] for i in part])
                sp, su = _sigmoid(zp), _sigmoid(zu)
                soft = lambda z: np.logaddexp(0.0, z)
                # Risks: positives as positive, and negatives seen through unlabelled less positives.
                negative = soft(zu).mean() - prior * soft(zp).mean()
                g_neg = pull(fu, ou, su / len(su)) - prior * pull(fp, op, sp / len(sp))
                g_pos = prior * pull(fp, op, (sp - 1) / len(sp))
                g = g_pos + g_neg if negative >= 0 else -g_neg
                g[:-1] += decay * w
                t += 1
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                w -= step[:-1]
                b -= step[-1]
    return Linear(chosen, w, float(b))


def calibrate(model: Linear, margins: np.ndarray, toxic: np.ndarray, steps: int = 200) -> Linear:
    """Slope and shift that turn margins into probabilities, from labelled rows (smoothed targets, Newton steps)."""
    n1, n0 = float(toxic.sum()), float((1 - toxic).sum())
    if not n1 or not n0:
        return model
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.std(margins)), 1e-6)
    z = margins / scale
    a, c = 1.0, 0.0
    for _ in range(steps):
        p = _sigmoid(a * z + c)
        d, h = p - target, np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([(d * z).sum() + 1e-2 * a, d.sum()])
        hessian = np.array([[(h * z * z).sum() + 1e-2, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hessian, gradient)
        a, c = a - float(np.clip(move[0], -1, 1)), c - float(np.clip(move[1], -1, 1))
    if a <= 0:
        return model
    return Linear(model.buckets, model.weights, model.bias, a / scale, c)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> Linear:
    """Fit from at most so many confirmed toxic and unlabelled rows, the first of each by a hash.

    Which features count is judged from all documents; the bounded rows serve the gradient steps alone. The prior is
    the share of toxic rows among labelled ones outside the held-out fold; those rows, negatives as well (which PU
    learning itself does not need), calibrate the scores.
    """
    doc = F.col("doc_id")
    marked = labels.select(doc.cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        doc.isNotNull() & F.col("toxic").isNotNull() & ~held_out(doc.cast("long"))
    )
    tally = marked.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(max((tally[1] + 0.5) / (tally[0] + 1.0), 1e-3), 0.9)

    def measured(picked: DataFrame, only: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
        kept = None if only is None else only.astype("<i4").tobytes()

        def measure(batches):
            wanted = None if kept is None else np.frombuffer(kept, "<i4")
            for pdf in batches:
                x = [buckets_of(t) for t in pdf["text"]]
                x = x if wanted is None else [np.intersect1d(v, wanted, assume_unique=True) for v in x]
                x = [v.astype("<i4").tobytes() for v in x]
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "x": x})

        rows = (
            slim(docs)
            .join(F.broadcast(picked), "doc_id")  # bounded by the row limits above
            .mapInPandas(measure, "doc_id long, toxic int, x binary")
            .toPandas()
            .sort_values(["doc_id", "toxic"], kind="stable")
        )
        return [np.frombuffer(v, "<i4") for v in rows["x"]], rows["toxic"].to_numpy()

    positive, _ = measured(first_by_hash(marked.where("toxic = 1"), positive_rows), None)
    asked = candidates(positive)
    u, n_u = corpus_votes(docs, asked)
    chosen = select(asked, positive, u, n_u, prior)
    negative = first_by_hash(marked.where("toxic = 0"), unlabelled_rows // 2)
    others = first_by_hash(slim(docs).select("doc_id").where(doc.isNotNull()), unlabelled_rows)
    x, toxic = measured(negative.unionByName(others.withColumn("toxic", F.lit(-1))), chosen)
    of = lambda kind: [x[i] for i in np.flatnonzero(toxic == kind)]
    negative = of(0)
    model = fit_nnpu(positive, of(-1), prior, chosen)
    table = model.lookup()
    margins = np.array([model.margin(v, table) for v in positive + negative])
    return calibrate(model, margins, np.array([1.0] * len(positive) + [0.0] * len(negative)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Missing texts count as empty ones, which all get the same score. A missing doc_id is not held out.
    Repeated rows get one row each. Without positives every text gets the same low score.
    """
    model = fit_toxicity(docs, labels)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series(model.score(np.array([scorer.margin(t) for t in texts])), dtype="float64")

    return (
        slim(docs)
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
