"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text is a row of tokens: runs of letters and digits of any script, in lower
case, cut after ``LONGEST`` characters so that scripts without spaces give many
tokens, too.  A token enters as a word vector (a row of a hashed table) beside a
character vector (the mean of the rows of its four-character pieces in another,
so that word forms never seen before count by their parts).  All windows of
``WINDOW`` tokens, ``STRIDE`` apart, are read by gated recurrent units from both
ends; attention weighs their states, and a logistic unit scores the window.  A
text scores as its highest window.

All weights are trained together by gradients, both tables included: a step
moves the rows that its windows hold.  Table rows begin at zero, and those that
fewer than ``SEEN`` training texts hold stay there.  Every step also shortens
each row by a little, by less the more texts there are, so rows whose gradients
do not agree from step to step stay at zero or return there: with few texts the
network would else learn their rare words by heart.  Training takes the windows of a labelled text as a
bag whose score is the soft maximum of its windows, since a label does not say
where a text is toxic.  It uses at most ``MAX_TRAIN_ROWS`` labelled texts of at
most ``MAX_TRAIN_CHARS`` code points each (whole texts, of which a step draws
``TRAIN_WINDOWS`` windows) and a fixed number of steps, on the driver.

Scoring reads every window of every whole text.  Texts are worked on in batches
of about ``CHARS`` code points; a longer one is read piece by piece, each from
the first token of the next window on, so a text of any length takes bounded
memory and gets the windows of the whole.

Defined results: a null text counts as empty; a text without tokens is one
empty window and scores as such; with no training rows, or only one class, all
texts score the prior (0.5 without any label).  Of a text that is labelled more
than once the larger label counts, of an id with several texts the least text.
An empty table gives an empty table; repeated rows score alike; equal scores
are left as they are.  Extra columns stay, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import labelled_ids, quoted

MAX_TRAIN_ROWS = 4_000
MAX_TRAIN_CHARS = 20_000
TRAIN_WINDOWS = 20
WINDOW, STRIDE = 32, 16
LONGEST = 24             # characters of a token
SHRINK = 7.0             # how fast table rows shorten; by less the more training texts there are
SCALE_ROWS = 30          # table rows that a step's gradients are taken to lie on, for the tables' step sizes
SEEN = 3                 # training texts that must hold a table row for it to be trained
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 16
WORD_DIM, CHAR_DIM, STATE, ATTEND = 4, 6, 8, 8
CHARS = 1 << 18          # code points worked on at once
WINDOWS_AT_ONCE = 4_096
PART = 256               # texts copied out of an Arrow batch at a time

# By code point, whether it is part of a token; those beyond the table are.
_TOKEN = np.array([chr(c).isalnum() for c in range(1 << 16)] + [True])
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0x100000001B3, i, 1 << 64) for i in range(LONGEST)], dtype=np.uint64)
_PLACES = _POWERS[:4] * _MIX | np.uint64(1)


@dataclass
class Tokens:
    """The tokens of a batch of texts, one after another."""
    word: np.ndarray         # row in the word table, by token
    chars: np.ndarray        # rows in the character table
    char_ends: np.ndarray    # where each token's character rows end
    counts: np.ndarray       # tokens by text
    starts: np.ndarray       # where each token starts, in code points of the batch


def tokenize(lowered: list[str]) -> Tokens:
    """Tokens of texts in lower case."""
    raw = [np.frombuffer(t.encode("utf-32-le", "replace"), dtype=np.uint32) for t in lowered]
    gap = np.full(1, 32, dtype=np.uint32)
    data = np.concatenate([x for r in raw for x in (r, gap)] + [gap])
    inside = _TOKEN[np.minimum(data, 1 << 16)]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    held = np.flatnonzero(inside)
    place = (held - np.repeat(starts, ends - starts)) % LONGEST       # long runs are cut
    first = np.flatnonzero(place == 0)
    starts = held[first]
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))))
    if not len(starts):
        empty = np.zeros(0, dtype=np.int32)
        return Tokens(empty, empty, empty, counts, empty)
    lens = np.diff(np.concatenate((first, [len(held)])))
    code = data[held].astype(np.uint64) + np.uint64(1)
    word = np.add.reduceat(code * code * _POWERS[place], first)
    word = ((word * _MIX) >> np.uint64(64 - 15)).astype(np.int32)
    # four characters from the one before each place on; beyond the token's ends all count as blank
    left = np.repeat(lens, lens) - place
    blank = np.uint64(0)
    before = np.where(place > 0, np.concatenate((code[:1], code[:-1])), blank)
    after = np.where(left > 1, np.concatenate((code[1:], code[-1:])), blank)
    third = np.where(left > 2, np.concatenate((code[2:], code[-2:]))[:len(code)], blank)
    piece = before * _PLACES[0] + code * _PLACES[1] + after * _PLACES[2] + third * _PLACES[3]
    chars = ((piece ^ (piece >> np.uint64(29))) * _MIX >> np.uint64(64 - 16)).astype(np.int32)
    return Tokens(word, chars, np.cumsum(lens), counts, starts)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token, tokens) of every window; a text without tokens has one empty window."""
    n = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(counts)), n)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    base = np.cumsum(counts) - counts
    return text, base[text] + turn * STRIDE, np.minimum(WINDOW, counts[text] - turn * STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


# What a step's gradients hold, but for the tables, whose rows follow from those of the token vectors.
PARTS = ("wx_f", "wh_f", "b_f", "wx_b", "wh_b", "b_b", "att", "att_b", "att_v", "out", "out_b")


class Network:
    """Weights by name: word, char (tables), two recurrent directions, attention, output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d = WORD_DIM + CHAR_DIM
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {"word": np.zeros((WORD_ROWS, WORD_DIM), np.float32), "char": np.zeros((CHAR_ROWS, CHAR_DIM), np.float32),
                  "att": draw(2 * STATE, ATTEND), "att_b": np.zeros(ATTEND, np.float32), "att_v": draw(ATTEND),
                  "out": draw(2 * STATE), "out_b": np.zeros(1, np.float32)}
        for side in "fb":
            self.w[f"wx_{side}"] = draw(d, 3 * STATE)
            self.w[f"wh_{side}"] = draw(STATE, 3 * STATE)
            self.w[f"b_{side}"] = np.zeros(3 * STATE, np.float32)
        self.prior: float | None = None

    def inputs(self, t: Tokens) -> np.ndarray:
        """Token vectors, and a row of zeros at the end for places without a token."""
        out = np.zeros((len(t.word) + 1, WORD_DIM + CHAR_DIM), dtype=np.float32)
        if len(t.word):
            out[:-1, :WORD_DIM] = self.w["word"][t.word]
            first = np.concatenate(([0], t.char_ends[:-1]))
            total = np.add.reduceat(self.w["char"][t.chars], first, axis=0)
            out[:-1, WORD_DIM:] = total / np.maximum(1, t.char_ends - first)[:, None].astype(np.float32)
        return out

    def read(self, x: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States (step, window, STATE) over projected inputs (step, window, 3 STATE), from one end."""
        steps, n, _ = x.shape
        wh, h = self.w[f"wh_{side}"], np.zeros((n, STATE), np.float32)
        out = np.empty((steps, n, STATE), np.float32)
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            g = h @ wh
            zr = _sigmoid(x[t, :, :2 * STATE] + g[:, :2 * STATE])
            z, r = zr[:, :STATE], zr[:, STATE:]
            c = np.tanh(x[t, :, 2 * STATE:] + r * g[:, 2 * STATE:])
            if keep is not None:
                keep.append((t, h, z, r, c, g[:, 2 * STATE:]))
            h = z * h + (1 - z) * c
            out[t] = h
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple:
        a = np.tanh(states @ self.w["att"] + self.w["att_b"])
        e = np.where(mask, a @ self.w["att_v"], np.float32(-1e4))
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        return a, alpha, pooled, pooled @ self.w["out"] + self.w["out_b"][0]

    @staticmethod
    def places(first: np.ndarray, size: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(step, window): the token at each place, or ``last`` where there is none, and whether there is one."""
        step = np.arange(WINDOW)[:, None]
        mask = step < size[None, :]
        return np.where(mask, first[None, :] + step, last), mask

    def window_logits(self, t: Tokens, only: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(text, logit) of every window of a batch, or of the first ``only``."""
        text, first, size = (v[:only] for v in windows(t.counts))
        x = self.inputs(t)
        projected = {s: x @ self.w[f"wx_{s}"] + self.w[f"b_{s}"] for s in "fb"}
        out = np.empty(len(text), np.float32)
        for k in range(0, len(text), WINDOWS_AT_ONCE):
            span = slice(k, k + WINDOWS_AT_ONCE)
            at, mask = self.places(first[span], size[span], len(x) - 1)
            states = np.concatenate([self.read(projected[s][at], s) for s in "fb"], axis=2)
            out[span] = self.pool(states, mask)[3]
        return text, out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        lowered = [(t or "").lower() for t in texts]
        best, k = np.full(len(texts), -np.inf), 0
        while k < len(texts):
            if len(lowered[k]) > CHARS:
                best[k] = self._best_of_long(lowered[k])
                k += 1
                continue
            end, chars = k, 0
            while end < len(texts) and chars + len(lowered[end]) <= CHARS:
                chars += len(lowered[end]) + 1
                end += 1
            end = max(end, k + 1)
            text, logit = self.window_logits(tokenize(lowered[k:end]))
            np.maximum.at(best[k:end], text, logit)
            k = end
        return 1 / (1 + np.exp(-np.clip(best, -30, 30)))

    def _best_of_long(self, lowered: str) -> float:
        """The highest window of a long text, read in pieces that begin where a window does."""
        best, at, size = -np.inf, 0, CHARS
        while True:
            piece = lowered[at:at + size]
            t = tokenize([piece])
            if at + size >= len(lowered):
                return max(best, float(self.window_logits(t)[1].max()))
            # whole windows without the last token, which may go on
            n = (int(t.counts[0]) - 1 - WINDOW) // STRIDE + 1
            if n < 1:
                size *= 2
                continue
            best = max(best, float(self.window_logits(t, n)[1].max()))
            at, size = at + int(t.starts[n * STRIDE]), CHARS

    def gradients(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, bag: np.ndarray,
                  y: np.ndarray) -> dict:
        """Gradients of the bags' log loss by weight."""
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.read(x[at] @ self.w[f"wx_{s}"] + self.w[f"b_{s}"], s, kept[s])
                                 for s in "fb"], axis=2)
        a, alpha, pooled, logit = self.pool(states, mask)
        top = np.full(len(y), -np.inf, np.float32)
        np.maximum.at(top, bag, logit)
        share = np.exp(logit - top[bag])
        total = np.bincount(bag, share, len(y))
        weight = (share / total[bag]).astype(np.float32)       # a window's part in its bag's soft maximum
        soft = np.bincount(bag, weight * logit, len(y))
        d_logit = weight * (1 / (1 + np.exp(-soft)) - y)[bag].astype(np.float32) / len(y)
        grad = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.w["out"]
        d_alpha = (states * d_pooled).sum(axis=2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        grad["att_v"] = np.einsum("tn,tna->a", d_e, a)
        d_a = d_e[:, :, None] * self.w["att_v"] * (1 - a * a)
        grad["att"] = np.einsum("tns,tna->sa", states, d_a)
        grad["att_b"] = d_a.sum(axis=(0, 1))
        d_states = alpha[:, :, None] * d_pooled + d_a @ self.w["att"].T
        for k, s in enumerate("fb"):
            d_in = np.empty((*at.shape, 3 * STATE), np.float32)
            d_h = np.zeros((at.shape[1], STATE), np.float32)
            grad[f"wh_{s}"] = np.zeros_like(self.w[f"wh_{s}"])
            for t, h, z, r, c, gc in reversed(kept[s]):
                d = d_h + d_states[t, :, k * STATE:(k + 1) * STATE]
                d_c = d * (1 - z) * (1 - c * c)
                d_z = d * (h - c) * z * (1 - z)
                d_r = d_c * gc * r * (1 - r)
                d_in[t] = np.concatenate((d_z, d_r, d_c), axis=1)
                d_g = np.concatenate((d_z, d_r, d_c * r), axis=1)
                grad[f"wh_{s}"] += h.T @ d_g
                d_h = d * z + d_g @ self.w[f"wh_{s}"].T
            flat = d_in.reshape(-1, 3 * STATE)
            grad[f"wx_{s}"] = x[at].reshape(-1, x.shape[1]).T @ flat
            grad[f"b_{s}"] = flat.sum(axis=0)
            d_x = flat @ self.w[f"wx_{s}"].T
            grad["x"] = grad["x"] + d_x if "x" in grad else d_x      # by place, in the order of ``at``
        return grad


def _taken(t: Tokens, which: np.ndarray) -> Tokens:
    """The chosen tokens as one text."""
    starts = np.concatenate(([0], t.char_ends[:-1]))[which]
    lens = t.char_ends[which] - starts
    ends = np.cumsum(lens)
    rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)
    return Tokens(t.word[which], t.chars[rows], ends, np.array([len(which)]), t.starts[which])


def _table_gradients(t: Tokens, d_x: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of both tables from those of the token vectors."""
    lens = np.diff(np.concatenate(([0], t.char_ends)))
    per_char = np.repeat(d_x[:, WORD_DIM:] / lens[:, None], lens, axis=0)
    add = lambda rows, d, n: np.stack([np.bincount(rows, d[:, j], n) for j in range(d.shape[1])], axis=1)
    return {"word": add(t.word, d_x[:, :WORD_DIM], WORD_ROWS), "char": add(t.chars, per_char, CHAR_ROWS)}


def _shown(rows: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Which rows of a table at least ``SEEN`` texts hold."""
    found = np.unique(text.astype(np.int64) * size + rows) % size
    return np.bincount(found, minlength=size) >= SEEN


def fit(texts: list[str], labels: np.ndarray, steps: int = 300, batch: int = 40, rate: float = 0.05,
        seed: int = 7) -> Network:
    """Train on texts and their labels (0 or 1) with Adam, as many positive as negative texts a step."""
    net, y = Network(seed), np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        net.prior = float((y.sum() + 0.5) / (len(y) + 1))
        return net
    rng = np.random.default_rng(seed)
    parts = [tokenize([(t or "").lower() for t in texts[k:k + 64]]) for k in range(0, len(texts), 64)]
    held = np.cumsum([0] + [len(t.chars) for t in parts])
    t = Tokens(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("word", "chars")],
               np.concatenate([p.char_ends + held[i] for i, p in enumerate(parts)]),
               np.concatenate([p.counts for p in parts]), np.concatenate([p.starts for p in parts]))
    del parts
    owner = np.repeat(np.arange(len(y), dtype=np.int32), t.counts)
    trained = {"word": _shown(t.word, owner, WORD_ROWS),
               "char": _shown(t.chars, np.repeat(owner, np.diff(np.concatenate(([0], t.char_ends)))), CHAR_ROWS)}
    del owner
    text, first, size = windows(t.counts)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    classes = [np.flatnonzero(y == 0), np.flatnonzero(y == 1)]
    moments = {k: (np.zeros_like(w), np.zeros_like(w) if k not in trained else np.zeros(1)) for k, w in net.w.items()}
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(c, batch // 2) for c in classes])
        own = [rng.permutation(np.arange(bounds[i], bounds[i + 1]))[:TRAIN_WINDOWS] for i in chosen]
        bag = np.repeat(np.arange(len(chosen)), [len(o) for o in own])
        use = np.concatenate(own)
        at, mask = net.places(first[use], size[use], len(t.word))
        which, back = np.unique(at, return_inverse=True)
        some = _taken(t, which[which < len(t.word)])
        at = back.reshape(at.shape)
        grad = net.gradients(net.inputs(some), np.where(mask, at, len(some.word)), mask, bag, y[chosen])
        d_x = grad.pop("x")
        places = np.where(mask, at, len(some.word)).reshape(-1)
        d_token = np.stack([np.bincount(places, d_x[:, j], len(some.word) + 1) for j in range(d_x.shape[1])], axis=1)
        if len(some.word):
            grad |= {k: g * trained[k][:, None] for k, g in _table_gradients(some, d_token[:-1]).items()}
        speed = rate * (1 - step / (steps + 1))
        for k, g in grad.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            if k in trained:
                # one scale for a whole table: a row moves as its gradients are large and agree, rare rows hardly
                v += 0.01 * ((g ** 2).sum() / SCALE_ROWS - v)
            else:
                v += 0.01 * (g ** 2 - v)
            net.w[k] -= (speed * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
            if k in trained:
                norm = np.sqrt((net.w[k] ** 2).sum(axis=1, keepdims=True))
                net.w[k] *= np.maximum(0, 1 - speed * SHRINK * len(y) ** -0.75 / np.maximum(norm, 1e-12))
    # steps saw both classes alike: half way back to their shares in the sample, as a miss weighs more than an alarm
    net.w["out_b"] += np.float32(0.5 * np.log(y.sum() / (1 - y).sum()))
    return net


def train(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column,
          max_rows: int = MAX_TRAIN_ROWS, text_col: str = "text") -> Network:
    """Fit on the labelled rows whose id ``keep`` admits (a condition on doc_id of ``labels``)."""
    short = (docs.select(quoted("doc_id").alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
             .where(F.length("text") <= MAX_TRAIN_CHARS))
    # ids are chosen before texts are looked at: at most max_rows, so the join can be a broadcast
    ids = labelled_ids(labels, label_col, keep, max_rows)
    sample = (short.join(F.broadcast(ids), "doc_id")
              .groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
              .orderBy("doc_id").toPandas())
    return fit(sample["text"].tolist(), sample["label"].to_numpy(dtype=np.float64))


def score_column(net: Broadcast, text: Column) -> Column:
    """Probability of label 1 of each text; ``net`` is a broadcast network (its size is fixed)."""
    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        parts = [net.value.score(texts.slice(k, PART).to_pylist()) for k in range(0, len(texts), PART)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))
    return of(text)
