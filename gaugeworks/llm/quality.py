"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins; cyclic boosting fits, feature after feature and round after round, a shallow
tree to the gradient of the logistic loss and adds its leaves to that feature's table. Then the pairs whose
tables would lower the loss most get two-dimensional tables the same way. A score is the sum of the table
entries of a document's bins. The model is fitted on the driver from a bounded number of labelled rows and
travels as a few small tables; features and scores are computed where the documents are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import body, first_by_hash, held_out, slim

FIT_ROWS = 60_000  # most labelled rows the model is fitted on
THRESHOLD = 0.7

FEATURES = (
    "log_words",
    "mean_word",
    "symbol_share",
    "capital_share",
    "digit_share",
    "punctuation_share",
    "exclamation_share",
    "different_words",
    "twin_words",
    "different_lines",
    "words_per_line",
    "longest_word",
    "top_word_share",
    "short_word_share",
)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_UPPER, _DIGIT, _SYMBOL, _PUNCT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"#*$%&|<>@^~=_{}[]\\")] = True
_PUNCT[list(b".,;:!?'\"()-")] = True
_CLASS_OF = np.select([_UPPER, _DIGIT, _SYMBOL, _PUNCT, _SPACE], [1, 2, 3, 4, 5], 0).astype(np.uint8)


def features_of(text: str) -> list[float]:
    """Feature values of one whole text, in the order of FEATURES; zeros for a text without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=6)
    chars = max(1, len(raw) - int(kinds[5]))
    lengths = np.fromiter(map(len, words), np.int64, n)
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        kinds[3] / chars,
        kinds[1] / chars,
        kinds[2] / chars,
        kinds[4] / chars,
        raw.count(b"!") / n,
        len(ids) / n**0.9,
        float((codes[1:] == codes[:-1]).sum()) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        float(np.log1p(lengths.max())),
        float(np.bincount(codes).max()) / n,
        float((lengths <= 2).sum()) / n,
    ]


def feature_matrix(texts: Iterator[str]) -> np.ndarray:
    return np.array([features_of(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class Gam:
    """Bin edges per feature, a table per feature, tables of pairs, and the intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]
    intercept: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            ia, ib = (np.searchsorted(self.pair_edges[j], x[:, j], side="right") for j in (a, b))
            out += table[ia, ib]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges between quantiles of the values."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Leaf values per bin of a tree over the ordered bins: split where the gain is largest, up to ``leaves``."""
    parts, out = [(0, len(gradient))], np.zeros(len(gradient))
    g, h = (np.concatenate([[0.0], np.cumsum(v)]) for v in (gradient, hessian))

    def best(lo, hi):
        if hi - lo < 2:
            return 0.0, lo
        at = np.arange(lo + 1, hi)
        left = (g[at] - g[lo]) ** 2 / (h[at] - h[lo] + smooth)
        right = (g[hi] - g[at]) ** 2 / (h[hi] - h[at] + smooth)
        gain = left + right - (g[hi] - g[lo]) ** 2 / (h[hi] - h[lo] + smooth)
        k = int(np.argmax(gain))
        return float(gain[k]), int(at[k])

    while len(parts) < leaves:
        gain, at, part = max(((*best(*p), p) for p in parts), key=lambda v: v[0])
        if gain <= 1e-12:
            break
        parts.remove(part)
        parts += [(part[0], at), (at, part[1])]
    for lo, hi in parts:
        out[lo:hi] = (g[hi] - g[lo]) / (h[hi] - h[lo] + smooth)
    return out


def fit_gam(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 150,
    rate: float = 0.15,
    bins: int = 48,
    leaves: int = 3,
    pairs: int = 6,
    pair_bins: int = 6,
    smooth: float = 1.0,
) -> Gam:
    """Cyclic boosting of per-feature tables, then of the tables of the strongest pairs."""
    n, width = x.shape
    if n == 0:
        x, y, n = np.zeros((1, width)), np.array([0.5]), 1
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    edges = [_cuts(x[:, j], bins) for j in range(width)]
    codes = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    f = np.full(n, base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-f))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            size = len(tables[j])
            step = rate * _tree(np.bincount(codes[j], g, size), np.bincount(codes[j], h, size), leaves, smooth)
            tables[j] += step
            f += step[codes[j]]
    rough = [_cuts(x[:, j], pair_bins) for j in range(width)]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(rough)]
    shape = lambda a, b: (len(rough[a]) + 1, len(rough[b]) + 1)

    def grid(a, b, values):
        return np.bincount(cells[a] * shape(a, b)[1] + cells[b], values, int(np.prod(shape(a, b)))).reshape(shape(a, b))

    g, h = slopes()
    gain = {(a, b): float((grid(a, b, g) ** 2 / (grid(a, b, h) + smooth)).sum()) for a, b in itertools.combinations(range(width), 2)}
    chosen = sorted(gain, key=lambda k: -gain[k])[:pairs]
    pair_tables = [np.zeros(shape(a, b)) for a, b in chosen]
    for _ in range(rounds // 3):
        for k, (a, b) in enumerate(chosen):
            g, h = slopes()
            gg, hh = grid(a, b, g), grid(a, b, h)
            # A tree of depth two: the best cut of one axis, then a tree over the other axis on each side.
            rows = _tree(gg.sum(1), hh.sum(1), 2, smooth)
            step = np.zeros_like(gg)
            for value in np.unique(rows):
                side = rows == value
                step[side] = _tree(gg[side].sum(0), hh[side].sum(0), 2, smooth)
            pair_tables[k] += rate * step
            f += rate * step[cells[a], cells[b]]
    for j in range(width):  # tables sum to zero over the rows; the intercept carries the rest
        mean = float(tables[j][codes[j]].mean())
        tables[j] -= mean
        base += mean
    return Gam(edges, tables, chosen, rough, pair_tables, base)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Gam:
    """The model from labelled rows outside the held-out fold, at most ``fit_rows`` of them (the first by a hash)."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    )
    marked = first_by_hash(marked, fit_rows)

    def measure(batches):
        for pdf in batches:
            x = feature_matrix(pdf["text"])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "x": list(x)})

    rows = (
        slim(docs)
        .join(F.broadcast(marked), "doc_id")  # at most fit_rows short rows
        .mapInPandas(measure, "doc_id long, quality double, x array<double>")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    x = np.array(rows["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit_gam(x, rows["quality"].to_numpy())


def scorer(model: Gam):
    """Column function: the score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_matrix(texts)), dtype="float64")

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Missing texts count as empty ones, which all get the same score. A missing doc_id is not held out. With
    no labels at all every score is 0.5. Repeated rows get one row each.
    """
    score = scorer(fit_quality(docs, labels))
    return (
        slim(docs)
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold."""
    good: Column = scorer(fit_quality(docs, labels))(body(docs)) >= threshold
    return docs.where(good)
