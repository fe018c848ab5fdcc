"""Quality against a plain forward-backward, texts of very many lines, and held-out accuracy."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from strata.llm import quality, queries


def field(seed=1):
    rng = np.random.default_rng(seed)
    weights = (rng.standard_normal(quality.FEATURES) * 0.4).astype(np.float32)
    return quality.Field(weights, np.array([[0.6, -0.3], [-0.2, 0.7]]), 0.6)


def some_texts():
    rng = random.Random(2)
    lines = ["", "The cat sat.", "LOUD!!", "1 2 3", "a a a", "é è", "...", "x" * 900]
    sizes = (1, 2, 3, 4, 5, 7, 10, 17, 50, 333)
    made = ["\n".join(rng.choice(lines) for _ in range(n)).encode() for n in sizes]
    return [b"a", b"\n", b"\n\n\n", b"x\n", b"\ny", *[t for t in made if t]]


def plain_score(text, f):
    """Sums over the labels of two lines at a time, in Python numbers."""
    lines = quality.lines_of([text])
    emit = [(-float(x) / 2, float(x) / 2) for x in lines.features.astype(float) @ f.weights.astype(float)]
    pairs = f.pairs.tolist()
    log_sum = lambda xs: max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs))
    ahead = [list(emit[0])]
    for e in emit[1:]:
        ahead.append([log_sum([ahead[-1][a] + pairs[a][b] for a in (0, 1)]) + e[b] for b in (0, 1)])
    back = [[0.0, 0.0]]
    for e in reversed(emit[1:]):
        back.insert(0, [log_sum([pairs[a][b] + e[b] + back[0][b] for b in (0, 1)]) for a in (0, 1)])
    good = [1 / (1 + math.exp((x[0] + y[0]) - (x[1] + y[1]))) for x, y in zip(ahead, back)]
    return sum(g * n for g, n in zip(good, lines.lengths)) / sum(lines.lengths)


def test_scores_equal_those_of_a_plain_version():
    f, texts = field(), some_texts()
    want = [plain_score(t, f) for t in texts]
    assert quality.score([*texts, b"", None], f) == pytest.approx([*want, 0.6, 0.6], abs=1e-5)


@pytest.mark.parametrize("segment", [4, 60, 1 << 15])
def test_cut_texts_score_as_whole_ones(monkeypatch, segment):
    f, texts = field(3), some_texts()
    whole = quality.score(texts, f)
    monkeypatch.setattr(quality, "MANY", -1)
    monkeypatch.setattr(quality, "SEGMENT", segment)
    assert quality.score(texts, f) == pytest.approx(whole, abs=1e-6)


def test_memory_of_a_text_of_line_breaks():
    tracemalloc.start()
    quality.score([b"\n" * (3 << 20), b"ab\n" * (1 << 20)], field())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op7_line_field_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op1_bayes_language"](spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(known, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.99
