import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import queries, toxicity
from tests.conftest import SF_SMALL

SF_LARGE = "/root/testdata/sf0.1"


def texts_of(n, seed, bad=("vile", "grubby")):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(("ka", "lo", "mi", "ter", "en"), k=rng.randint(1, 4)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(1, 150))]
        if i % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(("", "ko", "ta"))
        out.append((" ".join(w), int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def net():
    sample = texts_of(500, 1)
    return toxicity.fit([t for t, _ in sample], np.array([y for _, y in sample]), steps=80)


def test_held_out_accuracy_and_unseen_word_forms(net):
    held = texts_of(300, 2)
    score = net.score([t for t, _ in held])
    y = np.array([y for _, y in held])
    assert ((score >= 0.5) == y).mean() > 0.95
    clean = "kalo miter en " * 30
    assert net.score([clean + "vilelomi " + clean])[0] > net.score([clean * 2])[0]


def test_every_window_counts(net):
    clean = "kalo miter en loka " * 3000
    for where in (0, 17, 6001, 11_990):
        words = clean.split()
        words[where] = "vile"
        assert net.score([" ".join(words)])[0] > net.score([clean])[0]


def test_windows_cover_all_tokens():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 500):
        text, first, size = toxicity.windows(np.array([n, 5]))
        seen = {j for t, f, s in zip(text, first, size, strict=True) if t == 0 for j in range(f, f + s)}
        assert seen == set(range(n)) and (size <= toxicity.WINDOW).all()


def test_batches_do_not_change_scores(net):
    sample = [t for t, _ in texts_of(40, 3)] + [None, "", "...", "é" * 10]
    one = np.concatenate([net.score([t]) for t in sample])
    assert np.allclose(one, net.score(sample), atol=1e-5)
    assert one[40] == one[41] == one[42] and ((one >= 0) & (one <= 1)).all()


def bag_loss(net, t, y):
    """Log loss of bags of windows, each scored by the soft maximum of its windows, by plain means."""
    text, first, size = toxicity.windows(t.counts)
    x = net.inputs(t)
    at, mask = net.places(first, size, len(x) - 1)
    states = np.concatenate([net.read(x[at] @ net.w[f"wx_{s}"] + net.w[f"b_{s}"], s) for s in "fb"], axis=2)
    logit = net.pool(states, mask)[3].astype(np.float64)
    total = 0.0
    for i, label in enumerate(y):
        own = logit[text == i]
        share = np.exp(own - own.max())
        soft = float((share * own).sum() / share.sum())
        total += np.log1p(np.exp(-(2 * label - 1) * soft))
    return total / len(y)


def test_gradients_equal_differences():
    """Of one-window bags, whose soft maximum is their only window, for every weight and both tables."""
    rng = np.random.default_rng(0)
    net = toxicity.Network(3)
    net.w = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in net.w.items()}
    t = toxicity.tokenize(["a bc def gh " * 8, "xy z " * 11])
    y = np.array([1.0, 0.0])
    text, first, size = toxicity.windows(t.counts)
    assert text.tolist() == [0, 1]
    at, mask = net.places(first, size, len(t.word))
    grad = net.gradients(net.inputs(t).astype(np.float64), at, mask, text, y)
    d_x = grad.pop("x")
    assert set(grad) == set(toxicity.PARTS)
    d_token = np.zeros((len(t.word) + 1, d_x.shape[1]))
    np.add.at(d_token, at.reshape(-1), d_x)
    grad |= toxicity._table_gradients(t, d_token[:-1])
    for name, g in grad.items():
        place = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, eps = net.w[name][place], 1e-3
        net.w[name][place] = kept + eps
        up = bag_loss(net, t, y)
        net.w[name][place] = kept - eps
        down = bag_loss(net, t, y)
        net.w[name][place] = kept
        assert (up - down) / (2 * eps) == pytest.approx(g[place], rel=0.05, abs=1e-4), name


def plain_tokens(text):
    out, run = [], ""
    for c in (text or "").lower() + " ":
        if (c.isalnum() or ord(c) > 0xFFFF) and len(run) < toxicity.LONGEST:
            run += c
        else:
            if run:
                out.append(run)
            run = c if c.isalnum() or ord(c) > 0xFFFF else ""
    return out


def test_scores_equal_a_plain_walk_over_windows(net):
    """Window by window, token by token, with vectors made of one token at a time."""
    def vector(token):
        t = toxicity.tokenize([token])
        assert t.counts.tolist() == [1]
        return np.concatenate((net.w["word"][t.word[0]], net.w["char"][t.chars].mean(axis=0)))

    def unit(v, side):
        h = np.zeros(toxicity.STATE)
        out = []
        n = toxicity.STATE
        for x in v:
            a, g = x @ net.w[f"wx_{side}"] + net.w[f"b_{side}"], h @ net.w[f"wh_{side}"]
            z, r = (1 / (1 + np.exp(-(a[i * n:(i + 1) * n] + g[i * n:(i + 1) * n]))) for i in (0, 1))
            h = z * h + (1 - z) * np.tanh(a[2 * n:] + r * g[2 * n:])
            out.append(h)
        return out

    for text in ["vile kalo", "miter en loka " * 20 + "grubbyko", "x" * 100, "Kalo, MITER. en\u00a0vile", ""]:
        tokens, best = plain_tokens(text), -np.inf
        for s in range(0, max(1, len(tokens) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
            v = [vector(w) for w in tokens[s:s + toxicity.WINDOW]]
            # places without a token are blank: the backward unit reads them before the window's last token
            pad = [np.zeros(toxicity.WORD_DIM + toxicity.CHAR_DIM)] * (toxicity.WINDOW - len(v))
            fore, back = unit(v + pad, "f"), unit((v + pad)[::-1], "b")[::-1]
            states = [np.concatenate(p) for p in zip(fore, back)][:max(1, len(v))]
            if not v:
                states = [np.concatenate(p) for p in zip(fore, back)]
            e = np.array([np.tanh(h @ net.w["att"] + net.w["att_b"]) @ net.w["att_v"] for h in states])
            alpha = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
            best = max(best, float(sum(a * h for a, h in zip(alpha, states)) @ net.w["out"] + net.w["out_b"][0]))
        assert net.score([text])[0] == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-4), text[:20]


def test_long_texts_get_the_windows_of_the_whole(net, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(t for t, _ in texts_of(40, seed)) for seed in (5, 6)] + ["ab" * 3000, "漢字" * 2000 + " vile " + "漢" * 999]
    texts.append(" ".join("q" * rng.randint(1, 90) for _ in range(400)))
    whole = net.score(texts)
    logits = [np.sort(net.window_logits(toxicity.tokenize([t.lower()]))[1]) for t in texts]
    for chars in (500, 1999, 5000):
        monkeypatch.setattr(toxicity, "CHARS", chars)
        assert np.allclose(net.score(texts), whole, atol=1e-5)
    assert [float(1 / (1 + np.exp(-x[-1]))) for x in logits] == pytest.approx(whole.tolist(), abs=1e-5)


def test_tokens_end_at_any_space_or_mark(net):
    for gap in ("\u00a0", "\u3000", "\u2003", "\uff0c", "\u2019 \u201c", "\u2014", "\u3002"):
        clean, bad = gap.join(["kalo", "miter", "en"] * 40), gap.join(["kalo", "vile", "en"])
        assert toxicity.tokenize([clean]).counts.tolist() == [120]
        assert net.score([clean + gap + bad])[0] == pytest.approx(net.score([(clean + gap + bad).replace(gap, " ")])[0], abs=1e-5)
    assert toxicity.tokenize(["é" * 50, "漢" * 24, "", "a1_b"]).counts.tolist() == [3, 1, 0, 2]


def held_out(spark):
    """(training texts and labels, held-out texts and labels) of sf0.1."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_LARGE}/documents.parquet").select("doc_id", "text").collect()}
    rows = sorted((r.doc_id, r.toxic) for r in spark.read.parquet(f"{SF_LARGE}/labels.parquet").collect())
    own = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    return [([docs[i] or "" for i, _ in rows if own(i) == side], np.array([y for i, y in rows if own(i) == side]))
            for side in (False, True)]


def auc(score, y):
    return float(np.mean((score[y == 1][:, None] > score[y == 0]) + 0.5 * (score[y == 1][:, None] == score[y == 0])))


def test_the_trained_tables_and_units_carry_the_score(spark):
    (texts, labels), (held, y) = held_out(spark)
    net = toxicity.fit(texts, labels)
    whole = net.score(held)
    # a network over fixed tables with a column of log odds by label came to 0.959 and 0.965 here
    assert auc(whole, y) > 0.959 and ((whole >= 0.7) == y).mean() > 0.965
    for parts in (("word", "char"), ("wx_f", "wx_b"), ("out",)):
        kept = {k: net.w[k] for k in parts}
        net.w |= {k: np.zeros_like(v) for k, v in kept.items()}
        assert auc(net.score(held), y) < 0.6, parts
        net.w |= kept


def test_no_labels_give_the_prior(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, "toxic", F.lit(True))
    shared = spark.sparkContext.broadcast(net)
    assert [r[0] for r in docs.select(toxicity.score_column(shared, F.col("text"))).collect()] == [0.5] * 3
    assert docs.limit(0).select(toxicity.score_column(shared, F.col("text"))).count() == 0


def test_query(spark):
    rows = queries.QUERIES["op1_toxicity"](spark, SF_SMALL).collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_extra_columns_of_any_name_and_nulls(spark):
    names = ["label", "score", "held_out", "a.b", "Text_", "x"]
    docs = spark.createDataFrame([(1, "vile words"), (1, "vile words"), (2, "good words"), (None, None)],
                                 "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in names])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    net = spark.sparkContext.broadcast(toxicity.train(docs, labels, "toxic", F.lit(True)))
    out = docs.withColumn("s", toxicity.score_column(net, F.col("text")))
    assert out.columns == [*docs.columns, "s"] and len({r.s for r in out.where("doc_id = 1").collect()}) == 1
