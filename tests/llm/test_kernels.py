"""The parts of the operators that work on plain values, against brute force."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pytest

from strata.llm import decontam, jaccard, langid, pii, quality, suffix_dedup


def test_language_scores_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    weights = rng.integers(-900_000, -100_000, (langid.BUCKETS + 1, 3)).astype(np.int32)
    weights[-1] = 0
    model = langid.Model(["a", "b", "c"], weights, np.zeros(3, np.int64))
    texts = [None, "", "12 34", "Ünder the tree", "x", "ab " * 4000, "é" * 777, "The THE the"]
    whole = langid.score(texts, model)
    monkeypatch.setattr(langid, "BLOCK", 64)
    cut = langid.score(texts, model)
    assert whole[0] == cut[0] and np.array_equal(whole[1], cut[1])
    assert whole[0][:3] == ["und"] * 3 and whole[1][:3].tolist() == [0, 0, 0]
    assert langid.score(texts, langid.Model([], np.zeros((1, 0), np.int32), np.zeros(0)))[0] == ["und"] * len(texts)


STRICT = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    for kind, pattern in enumerate(STRICT):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                or (kind == 2 and 16 <= len(digits) <= 19 and pii.luhn(digits))
                or (kind == 3 and 8 <= len(digits) <= 15)
            ):
                yield kind, m.start(), m.end()


@pytest.mark.parametrize(
    "text",
    [
        "",
        "a@b.c@d.e, x@@y.z .@a-.b. é@q.w ü.x@y.de1",
        "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1..2.3.4.5 9.9.9",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 1 2 3",
        "+1 (389) 555-5010 +49 30 1234567890123456 ++33.1.2 +44 20 7946 0958.",
        "call 4111 1111 1111 1111+1 23 45 67 89 mail a.b@c.d +12345678",
        "7" * 3000 + "@" + "8." * 500 + "9",
    ],
)
def test_strict_spans(text):
    got = sorted((k, a, b) for k, a, b, strict in pii.matches(text) if strict)
    assert got == sorted(plain_spans(text))


def test_looser_spans_keep_off_strict_ones():
    found = pii.candidates("write to jo at example dot com or (389) 555-5010, not +1 (389) 555-5011")
    assert sorted((x["kind"], x["base"]) for x in found) == [(0, False), (3, False), (3, True)]


def test_unreliable_labelers_lose_weight():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.55])
    votes = np.where(rng.random((4000, 3)) < right, truth[:, None], ~truth[:, None]) * 2
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior = pii.estimate(patterns, np.zeros(len(patterns), bool), counts.astype(float))
    by_pattern = {tuple(p): q for p, q in zip(patterns, posterior)}
    assert by_pattern[2, 2, 0] > 0.9 > 0.1 > by_pattern[0, 0, 2]


def test_redaction():
    assert pii.redact("to a@b.c now", [(0, 3, 8)]) == "to [email] now"


def test_line_marginals_against_enumeration():
    rng = np.random.default_rng(5)
    scores, pairs, starts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5])
    good, joint = quality._marginals(scores, starts, pairs, True)
    counts = np.zeros((2, 2))
    for start, stop in zip(starts, [4, 5, 9]):
        weights = {}
        for path in itertools.product((0, 1), repeat=stop - start):
            total = sum((y - 0.5) * s for y, s in zip(path, scores[start:stop]))
            weights[path] = np.exp(total + sum(pairs[a, b] for a, b in zip(path, path[1:])))
        whole = sum(weights.values())
        for t in range(stop - start):
            assert good[start + t] == pytest.approx(sum(w for p, w in weights.items() if p[t]) / whole)
        for path, w in weights.items():
            for a, b in zip(path, path[1:]):
                counts[a, b] += w / whole
    assert joint == pytest.approx(counts)


def test_quality_is_learnt_and_defined_for_empty_texts():
    good = [f"The {i} trees stand by a river. They are old.\nBirds sing there.".encode() for i in range(40)]
    bad = [f"BUY!! NOW!! {i}\nwin | win | win\n$$$ *** $$$".encode() for i in range(40)]
    field = quality.train(quality.lines_of(good + bad), np.array([1.0] * 40 + [0.0] * 40))
    got = quality.score([good[0], bad[0], None, b"", b"\n\n", good[1] * 3000], field)
    assert got[0] > 0.9 and got[1] < 0.1 and got[2] == got[3] == field.prior and got[5] > 0.9
    assert ((got >= 0) & (got <= 1)).all()


def test_wand_finds_all_above_the_threshold():
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 30) % 60) for _ in range(50)]
    frequency: dict = {}
    for t in texts:
        for w in set(decontam.words(t)):
            frequency[w] = frequency.get(w, 0) + 1
    index = decontam.Index(list(enumerate(texts)), 50, 30.0, frequency)
    for t in texts[:10]:
        terms = np.array(sorted({index.terms[w] for w in decontam.words(t)}))
        scores = np.zeros(50)
        for term in terms:
            scores[index.ids[term]] += index.impacts[term]
        for threshold in (0.2, 0.5, 0.9):
            assert index.search(terms, threshold, 0, 50) == np.flatnonzero(scores > threshold).tolist()


def shingle_words(text, n):
    w = (text or b"").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_shingle_sets(monkeypatch):
    texts = [None, b"", b" \n", b"One", b"one TWO", b"a b c a b c a", "é É ß".encode(), b"x y z " * 2000]
    for piece in (jaccard.PIECE, 16):
        monkeypatch.setattr(jaccard, "PIECE", piece)
        sets = jaccard.shingle_sets(texts, 3)
        assert [len(s) for s in sets] == [len(shingle_words(t, 3)) for t in texts]
    assert jaccard.set_ids(sets)[1] == jaccard.set_ids(sets)[2]


def test_links_among_sets():
    sets = [np.arange(0, 100), np.arange(2, 102), np.arange(50, 150), np.arange(4, 104)]
    whole = jaccard.links_among([s.astype(np.int64) for s in sets], np.full(4, 2), np.arange(4), 90)
    assert sorted(whole) == [(0, 1), (0, 3)]


def test_repeats_against_brute_force():
    rng = np.random.default_rng(11)
    base = bytes(rng.integers(97, 101, 700).astype(np.uint8))
    contexts, left = [], []
    for i in range(12):
        text = bytearray(base)
        text[int(rng.integers(0, 700))] = 122
        if i % 3 == 0:
            text[int(rng.integers(0, 250))] = 121
        cut = int(rng.integers(0, 60))
        contexts.append(bytes(text[cut:]))
        left.append(300 - cut)
    left = np.array(left)
    low, high = np.zeros(12, np.int64), np.full(12, 300)
    got = suffix_dedup.repeats(contexts, left, low, high, np.array([0, 7]))
    for group in (range(7), range(7, 12)):
        for i in group:
            hits = [
                d
                for d in range(left[i] + 1)
                for j in group
                if j != i and d <= left[j]
                and len(a := contexts[i][left[i] - d :][:400]) == 400
                and a == contexts[j][left[j] - d :][:400]
            ]
            assert got[i].tolist() == ([min(hits), max(hits)] if hits else [1, 0])
