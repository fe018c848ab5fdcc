"""The network against a plain version, its gradients, pieces of long texts, odd rows, and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries, toxicity

SCHEMA = "doc_id long, text string, score string, label int, held_out int"


def network(seed=4, words=0):
    rng = np.random.default_rng(seed)
    weights = {k: (w + rng.standard_normal(w.shape) * 0.3).astype(np.float32) for k, w in toxicity.fresh(words).items()}
    return toxicity.Network(weights, np.sort(rng.integers(0, 1 << 62, words).astype(np.uint64)))


def plain_score(text, net):
    """Word by word and window by window, in Python numbers."""
    w = {k: v.astype(float) for k, v in net.weights.items()}
    words = [m[at : at + toxicity.LONGEST] for m in re.findall(rb"[a-zA-Z\x80-\xff]+", text) for at in range(0, len(m), toxicity.LONGEST)]
    vectors = []
    for word in words:
        hashes, kinds, _, _ = toxicity.tokens([word])
        chars = sum(w["char"][k] for k in kinds) / math.sqrt(len(kinds))
        vectors.append(np.concatenate([w["word"][net.numbers(hashes)[0]], chars]))

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def layer(way, xs):
        h, out, n = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for x in xs:
            given, by = x @ w[f"{way}_in"] + w[f"{way}_bias"], h @ w[f"{way}_state"]
            z, r = sigmoid(given[:n] + by[:n]), sigmoid(given[n : 2 * n] + by[n : 2 * n])
            h = (1 - z) * np.tanh(given[2 * n :] + r * by[2 * n :]) + z * h
            out.append(h)
        return out

    best = 0.0
    starts = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE) if words else []
    for s in starts:
        s = min(s, max(0, len(words) - toxicity.WINDOW))
        xs = vectors[s : s + toxicity.WINDOW]
        own = len(xs)
        xs = xs + [np.zeros(2 * toxicity.WIDTH)] * (toxicity.WINDOW - own)
        states = [np.concatenate(p) for p in zip(layer("ahead", xs), reversed(layer("back", xs[::-1])))][:own]
        focus = np.array([np.tanh(h @ w["attend"] + w["attend_bias"]) @ w["focus"] for h in states])
        share = np.exp(focus - focus.max())
        pooled = sum(a * h for a, h in zip(share / share.sum(), states))
        best = max(best, float(sigmoid(pooled @ w["out"] + w["out_bias"][0])))
    return best


def some_texts():
    rng = random.Random(3)
    made = ["the", "Über", "x", "y" * 70, "z" * 200, "né", "12", "ab-cd"]
    return [" ".join(rng.choice(made) for _ in range(n)).encode() for n in (1, 3, 31, 32, 33, 47, 48, 49, 64, 200)]


def test_scores_equal_those_of_a_plain_version():
    net = network()
    texts = [b"", b"12 34", *some_texts()]
    assert toxicity.score(texts, net) == pytest.approx([plain_score(t, net) for t in texts], abs=3e-5)
    assert toxicity.score([None, b"", b"1 2"], net).tolist() == [0, 0, 0]
    assert toxicity.score([], net).tolist() == []


@pytest.mark.parametrize("block", [300, 1000])
def test_scores_do_not_depend_on_pieces(monkeypatch, block):
    net = network(9)
    texts = [b"", *some_texts(), b"7 " * 2000 + b"end", b"q" * 5000, (b"1 " * 300 + b"word ") * 20]
    whole = toxicity.score(texts, net)
    monkeypatch.setattr(toxicity, "BLOCK", block)
    assert len(toxicity._pieces(texts[-4])) > 1
    assert toxicity.score(texts, net) == pytest.approx(whole, abs=2e-5)


def test_gradients(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOW", 5)
    monkeypatch.setattr(toxicity, "STRIDE", 2)
    rng = np.random.default_rng(0)
    weights = {k: w.astype(float) for k, w in toxicity.fresh(3).items()}
    hashes, chars, begins, owner = toxicity.tokens([b"aa bb cc dd ee ff gg", b"xx yy"])
    words = toxicity.Words(rng.integers(0, 4, len(hashes)), chars, begins, owner)
    places, _ = toxicity.windows(owner, 2)
    error = rng.standard_normal(len(places))

    def loss():
        return float((toxicity.forward(places, toxicity.inputs(words, weights).astype(float), weights) * error).sum())

    trace, vectors = [], toxicity.inputs(words, weights).astype(float)
    toxicity.forward(places, vectors, weights, trace)
    grads = toxicity.backward(error, places, vectors, words, weights, trace)
    for name, w in weights.items():
        for i in np.flatnonzero(np.abs(grads[name].ravel()) > 1e-6)[:4]:
            old = w.flat[i]
            w.flat[i] = old + 1e-3
            above = loss()
            w.flat[i] = old - 1e-3
            slope = (above - loss()) / 2e-3
            w.flat[i] = old
            assert slope == pytest.approx(grads[name].flat[i], rel=0.03, abs=2e-3), (name, i)


def test_tables(spark):
    rng = random.Random(1)
    clean = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = []
    for i in range(120):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 90))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "nasty"
        rows.append((i, " ".join(words), "x", int(i % 3 == 0), 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    net = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    long = " ".join(rng.choice(clean) for _ in range(20_000))
    odd = [(None, None), (1, ""), (2, "12 34"), (3, "alpha nasty beta"), (3, "alpha nasty beta"), (4, "alpha beta"), (5, long), (6, long + " nasty " + long)]
    got = toxicity.with_toxicity(spark.createDataFrame([(i, t, "x", 1, 1) for i, t in odd], SCHEMA), net)
    assert got.columns == ["doc_id", "text", "label", "held_out", "score"]
    score = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert score[None, None] == score[1, ""] == score[2, "12 34"] == 0
    assert score[3, "alpha nasty beta"] > 0.5 and score[6, odd[7][1]] > 0.5
    assert score[4, "alpha beta"] < 0.5 and score[5, long] < 0.5
    assert toxicity.with_toxicity(docs.limit(0), net).collect() == []
    alone = toxicity.fit(docs.where("label = 0").select("doc_id", "text"), docs.select("doc_id", "label"))
    assert {r.score for r in toxicity.with_toxicity(docs.limit(3), alone).collect()} == {0.5}
    empty = toxicity.fit(docs.limit(0).select("doc_id", "text"), docs.select("doc_id", "label").limit(0))
    assert toxicity.with_toxicity(docs, empty).count() == 120


def test_held_out_accuracy(spark):
    """Documents that the fit has not seen; a tenth of the toxic ones carry no toxic word."""
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op11_recurrent_toxicity"](spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    caught = np.mean([r.predicted for r in rows if r.toxic])
    alone = np.mean([1 - r.predicted for r in rows if not r.toxic])
    assert caught > 0.88 and alone > 0.97
    assert found.where((F.col("predicted") == 1) != (F.col("score") >= 0.5)).count() == 0
