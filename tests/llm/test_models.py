"""The numpy models against plain step by step formulas."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pitfeat.llm import byteconv, gru, lm_score
from pitfeat.llm.common import id_bucket


def plain_log_softmax(x):
    return x - x.max() - math.log(np.exp(x - x.max()).sum())


def plain_score(net, symbols):
    """Natural log-probability of a text, one step after the other in doubles."""
    s, h, total = gru.STATE, np.zeros(gru.STATE), 0.0
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for x, y in zip([gru.END, *symbols], [*symbols, gru.END]):
        gx, gh = net.inputs[x].astype(float), h @ net.inner.astype(float)
        z, r = sigmoid(gx[:s] + gh[:s]), sigmoid(gx[s:2 * s] + gh[s:2 * s])
        n = np.tanh(gx[2 * s:] + r * gh[2 * s:])
        h = (1 - z) * n + z * h
        own = y // gru.WIDTH if y < net.known else y - net.known + len(net.to_word)
        total += plain_log_softmax(h @ net.to_class + net.class_bias)[own]
        if y < net.known:
            total += plain_log_softmax(h @ net.to_word[own] + net.word_bias[own])[y - own * gru.WIDTH]
    return total


@pytest.mark.parametrize("trained", [False, True])
def test_gru_score_step_by_step(trained):
    r = np.random.default_rng(5)
    net = gru.Gru.start(np.arange(1, 100)[::-1].astype(float), np.array([50.0, 3.0, 0.0]))
    texts = [r.integers(1, 102, n).astype(np.int32) for n in (0, 1, 23, 24, 25, 200, 1500)]
    if trained:
        net.train(texts)
    assert net.score(texts) == pytest.approx([plain_score(net, t.tolist()) for t in texts], rel=2e-4)


def plain_adam(net, grads, moments, rate, step):
    for p, g, (m, v) in zip(net.parameters(), grads, moments):
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


def test_gru_training_repeats_plain_adam():
    """A pass equals fresh gradients with Adam as written in its paper, number by number."""
    r = np.random.default_rng(9)
    start = np.arange(1, 2100)[::-1].astype(float), np.array([50.0, 3.0, 0.0])
    fast, plain = gru.Gru.start(*start), gru.Gru.start(*start)
    texts = [r.integers(1, 2102, n).astype(np.int32) for n in (0, 1, 23, 24, 25, 200, 700)]
    assert fast.train(texts) == sum(len(t) + 1 for t in texts)
    moments = [(np.zeros(p.shape), np.zeros(p.shape)) for p in plain.parameters()]
    ((x, y, inside),) = gru.piece_groups(texts)
    steps = -(-len(x) // gru.STEPS)
    h = np.zeros((x.shape[1], gru.STATE), np.float32)
    for step in range(1, steps + 1):
        part = slice((step - 1) * gru.STEPS, step * gru.STEPS)
        live = inside[part].any(0)
        grads, h[live], _ = plain._gradients(x[part, live], y[part, live], inside[part, live], h[live])
        plain_adam(plain, grads, moments, 6e-3 * (1 - 0.9 * step / steps), step)
    for a, b in zip(fast.parameters(), plain.parameters()):
        assert np.allclose(a, b, atol=2e-4)


def test_gru_sums_of_rows_by_symbol():
    r = np.random.default_rng(4)
    keys = np.concatenate([np.zeros(300, int), np.full(16, 3), np.full(17, 5), np.full(15, 8), r.integers(10, 400, 500)])
    keys = r.permutation(keys).astype(np.int16)
    place = r.permutation(2 * len(keys))[:len(keys)]
    parts = [r.normal(size=(2 * len(keys), 4)).astype(np.float32) for _ in range(3)]
    for n in (len(keys), 1):
        symbols, sums = gru._sums(keys[:n], parts, place[:n])
        assert sorted(symbols) == sorted(set(keys[:n].tolist()))
        for k, row in zip(symbols, sums):
            assert np.allclose(row, np.concatenate([p[place[:n][keys[:n] == k]].sum(0) for p in parts]), atol=1e-4)


def test_gru_training_writes_into_kept_gradients():
    """Every step of a pass gets the same arrays for its gradients; before, each had new ones to fill."""
    net, seen = gru.Gru.start(np.arange(1, 100)[::-1].astype(float), np.array([50.0])), []
    whole, held = net._gradients, []

    def kept(*args):
        found = whole(*args)
        seen.append([id(g) for g in found[0]])
        held.append(found)  # so that no id is given twice
        return found

    net._gradients = kept
    net.train([np.arange(1, 100, dtype=np.int32)] * 3)
    assert len(seen) == 5 and all(s == seen[0] for s in seen)


def test_lm_score_from_the_weights(spark, monkeypatch):
    r = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(r.choices(words, weights=range(60, 0, -1), k=r.randrange(30)))) for i in range(40)]
    texts += [(100, None), (101, "never seen words"), (102, "W1 w1\nW2")]
    monkeypatch.setattr(lm_score, "KNOWN", 7)
    monkeypatch.setattr(
        lm_score, "train", lambda _, lex: gru.Gru.start(lex.value.known_counts, lex.value.rare[:, 0]).unpack(weights(lex)))

    def weights(lex):
        start = gru.Gru.start(lex.value.known_counts, lex.value.rare[:, 0])
        return start.packed() + np.random.default_rng(1).normal(0, 0.1, start.packed().size).astype(np.float32)

    df = spark.createDataFrame([(i, t, 5) for i, t in texts], "doc_id long, text string, row int")
    training = id_bucket("doc_id", 10) != 0
    got = {x.doc_id: x.score for x in lm_score.score(df, training, head=20).collect()}
    learn = [t or "" for i, t in texts if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for t in learn for w in t.encode().lower().split())
    known = sorted(counts, key=lambda w: (-counts[w], w))[:7]
    rare = {b: [0, 0] for b in range(lm_score.BUCKETS)}
    for w, c in counts.items():
        if w not in known:
            rare[lm_score.bucket(w)][0] += c
            rare[lm_score.bucket(w)][1] += 1
    known_counts = np.array([len(learn), *[counts[w] for w in known]], float)
    mass = np.array([rare[b][0] for b in range(lm_score.BUCKETS)], float)
    net = gru.Gru.start(known_counts, mass)
    net.unpack(net.packed() + np.random.default_rng(1).normal(0, 0.1, net.packed().size).astype(np.float32))
    for i, t in texts:
        own = (t or "").encode().lower().split()
        symbols = [1 + known.index(w) if w in known else 8 + lm_score.bucket(w) for w in own]
        want = plain_score(net, symbols) / math.log(10)
        for w in own:
            if w not in known:
                n, v = rare[lm_score.bucket(w)]
                want += math.log10(counts[w] + 0.1) - math.log10(n + 0.1 * (v + 1))
        assert got[i] == pytest.approx(want, rel=2e-4), (i, t)


def test_folded_table_equals_plain_convolution():
    r = np.random.default_rng(2)
    net = byteconv.ByteConv.start(3)
    net.output, net.offset = (r.normal(size=p.shape).astype(np.float32) for p in (net.output, net.offset))
    for w in byteconv.WIDTHS:
        net.biases[w] = r.normal(size=byteconv.FILTERS).astype(np.float32)
    x = r.integers(0, 256, (37, byteconv.LENGTH)).astype(np.uint8)
    plain = np.empty((len(x), 3))
    for i, row in enumerate(x):
        e, pooled = net.embedding[row].astype(float), []
        for w in byteconv.WIDTHS:
            out = np.array([e[at:at + w].ravel() @ net.filters[w] for at in range(len(row) - w + 1)])
            pooled.append(out.max(0) + net.biases[w])
        plain[i] = np.maximum(np.concatenate(pooled), 0) @ net.output
    assert np.allclose(net.window_scores(x), plain, atol=1e-3)
    assert np.allclose(np.maximum(net._pool(x)[0], 0) @ net.output, plain, atol=1e-3)
    # a text's score is the mean of its windows, by the bytes in each
    text = r.integers(0, 256, 3 * byteconv.LENGTH + 17).astype(np.uint8).tobytes()
    v, sizes = byteconv.windows(text)
    want = (net.window_scores(v) * sizes[:, None]).sum(0) / sizes.sum() + net.offset
    assert np.allclose(net.text_scores([b"", text, text])[1:], want, atol=1e-4)
