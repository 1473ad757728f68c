"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into quantile bins.  Cyclic boosting visits one
feature after another, fits a tree of at most three leaves to the gradients
summed by bin, and adds a fraction of it to the feature's lookup table.  Then
the pairs of features whose four-leaf tree explains most of what is left get
a two-dimensional table each, boosted in the same way.  Scoring is a sum of
looked-up numbers for a whole batch at once.

The model is fitted on the driver from at most ``MAX_TRAIN_ROWS`` labelled
rows (their feature vectors only, never texts); scoring covers every row.

Defined results: a null text counts as empty; an empty text has the features 0
and is scored like any other; a text of any length is read whole.  With no
training rows, or only one class, all texts get the same score; an empty table
gives an empty table.  Repeated rows are scored alike, repeated labels of an id
count once; equal gains are cut at the first bin.  Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import labelled_ids, quoted

MAX_TRAIN_ROWS = 20_000
PART = 256           # texts copied out of an Arrow batch at a time
FEATURES = ("log_words", "word_len", "symbols", "exclaims", "upper", "digits", "punctuation",
            "distinct", "adjacent_same", "dup_lines", "log_line_words")

# classes of code points; those from 0x250 on count as letters
_LETTER, _UPPER, _DIGIT, _SPACE, _SYMBOL, _EXCLAIM, _PUNCT = range(7)


def _classes() -> np.ndarray:
    table = np.zeros(0x250, dtype=np.int64)
    for c in map(chr, range(0x250)):
        table[ord(c)] = (_SYMBOL if c in "#*$%&|<>" else _EXCLAIM if c == "!" else _SPACE if c.isspace()
                         else _DIGIT if c.isdigit() else _UPPER if c.isupper()
                         else _LETTER if c.isalpha() else _PUNCT)
    return table


_TABLE = _classes()


def features(text: str | None) -> list[float]:
    """The feature vector of one whole text, in the order of ``FEATURES``."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    count = np.bincount(_TABLE[np.minimum(codes, 0x24F)], minlength=7)
    chars = max(1, len(codes) - int(count[_SPACE]))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    return [np.log1p(n), chars / n, count[_SYMBOL] / n, count[_EXCLAIM] / n, count[_UPPER] / chars,
            count[_DIGIT] / chars, count[_PUNCT] / chars, len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)),
            np.log1p(n / max(1, len(lines)))]


@dataclass
class Gam:
    edges: list[np.ndarray] = field(default_factory=list)       # bin borders by feature
    tables: list[np.ndarray] = field(default_factory=list)      # log odds by bin
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        out = np.full(len(x), self.base)
        for b, table in zip(at, self.tables, strict=True):
            out += table[b]
        for i, j, table in self.pairs:
            out += table[at[i], at[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, int]:
    """(gain, bin) of the best split of a run of bins into [:bin] and [bin:]."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl ** 2 / (hl + penalty) + (g.sum() - gl) ** 2 / (h.sum() - hl + penalty) \
        - g.sum() ** 2 / (h.sum() + penalty)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    """Leaf value by bin of a tree with at most three leaves."""
    _, cut = _best_cut(g, h, penalty)
    spans = [(0, cut), (cut, len(g))] if cut else [(0, len(g))]
    gains = [_best_cut(g[a:b], h[a:b], penalty) for a, b in spans]
    k = int(np.argmax([x for x, _ in gains]))
    if gains[k][1]:
        a, b = spans.pop(k)
        spans += [(a, a + gains[k][1]), (a + gains[k][1], b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """(gain, value by cell) of the best tree that cuts both features once."""
    sums = []
    for m in (g, h):
        c = np.zeros((m.shape[0] + 1, m.shape[1] + 1))
        c[1:, 1:] = m.cumsum(0).cumsum(1)
        a = c[1:-1, 1:-1]
        sums.append((a, c[1:-1, -1:] - a, c[-1:, 1:-1] - a, c[-1, -1] - c[1:-1, -1:] - c[-1:, 1:-1] + a))
    if not sums[0][0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(gs ** 2 / (hs + penalty) for gs, hs in zip(*sums, strict=True))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [float(gs[i, j] / (hs[i, j] + penalty)) for gs, hs in zip(*sums, strict=True)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:] = value[0], value[1]
    out[i + 1:, :j + 1], out[i + 1:, j + 1:] = value[2], value[3]
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + penalty)), out


def fit(x: np.ndarray, y: np.ndarray, max_bins: int = 32, rounds: int = 150, rate: float = 0.15,
        n_pairs: int = 6, pair_rounds: int = 40, penalty: float = 1.0) -> Gam:
    """Fit the model to feature rows ``x`` and labels ``y`` (0 or 1)."""
    model = Gam()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        model.edges = [np.zeros(0)] * len(FEATURES)
        model.tables = [np.zeros(1)] * len(FEATURES)
        return model
    quantiles = np.linspace(0, 1, max_bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = model.bins(x)
    logit = np.full(len(y), model.base)

    def slopes(cell: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            step = rate * _shallow_tree(*slopes(at[j], len(table)), penalty)
            table += step
            logit += step[at[j]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[i]), len(model.tables[j])
        g, h = slopes(at[i] * shape[1] + at[j], shape[0] * shape[1])
        return g.reshape(shape), h.reshape(shape)

    ranked = sorted(((_quadrants(*grid(i, j), penalty)[0], i, j)
                     for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for _, i, j in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _quadrants(*grid(i, j), penalty)[1]
            table += step
            logit += step[at[i], at[j]]
    return model


def _rows(texts: Iterable[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


def _parts(texts: pa.Array) -> Iterator[np.ndarray]:
    """Feature rows of ``PART`` texts at a time: of an Arrow batch, whose bytes Spark bounds, only a part is copied."""
    for k in range(0, len(texts), PART):
        yield _rows(texts.slice(k, PART).to_pylist())


def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([r for x in _parts(texts) for r in x.tolist()], type=pa.list_(pa.float64()))
    return of(text)


def train(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column,
          max_rows: int = MAX_TRAIN_ROWS, text_col: str = "text") -> Gam:
    """Fit on the labelled rows whose id ``keep`` admits (a condition on doc_id of ``labels``)."""
    ids = labelled_ids(labels, label_col, keep, max_rows)
    # the ids are at most max_rows, so the join can be a broadcast
    sample = (docs.select(quoted("doc_id").alias("doc_id"), quoted(text_col).alias("text"))
              .join(F.broadcast(ids), "doc_id")
              .select("doc_id", "label", feature_column(F.col("text")).alias("x"))
              .groupBy("doc_id").agg(F.max("label").alias("label"), F.min("x").alias("x"))
              .select("label", "x").toPandas())
    x = np.array(sample["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, sample["label"].to_numpy(dtype=np.float64))


def score_column(model: Gam, text: Column) -> Column:
    """Probability of label 1 of each text."""
    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *[model.score(x) for x in _parts(texts)]]))
    return of(text)
