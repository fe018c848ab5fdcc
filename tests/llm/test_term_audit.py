"""Term counts and divergences against plain Python: odd texts, null and empty names, ties, cut texts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import term_audit

SCHEMA = "doc_id long, text string, lang string, source string, value long, term string, part int, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = ["a", "the", "The", "abcdefgh", "abcdefghi", "ABCDEFGHIJKLMNOP", "É", "é", "日本語", "x" * 63, "x" * 64, "x" * 65, "x" * 200, "x" * 199 + "y"]


def terms(text):
    return [m.group().translate(LOWER) for m in re.finditer("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def some_docs(n, seed, langs=("en", "de", None, ""), sources=("s1", "s2", "é", "z", None, "")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "".join(rng.choice(WORDS) + rng.choice([" ", "1", "--", "\n", "\x7f", "[", "@"]) for _ in range(rng.choice([0, 1, 5, 40])))
        rows.append((i, rng.choice([None, "", "12 3", text, text, text]), rng.choice(langs), rng.choice(sources)))
    return rows


def plain(rows, least):
    docs = [(lang or "", source or "", Counter(terms(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, c in own for t in c)
        kept = {t for t, n in df.items() if n >= least}
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            counts[s].update({t: n for t, n in c.items() if t in kept})
        everything = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b, t):
            return (p(a, t) - p(b, t)) ** 2 // (p(a, t) + p(b, t))

        for s, c in counts.items():
            pairs = [(o, sum(f(c, d, t) for t in kept)) for o, d in counts.items() if o != s]
            marks = [(t, f(c, everything, t)) for t in kept if c[t] and p(c, t) > p(everything, t)]
            for part, found in (("pair", pairs), ("term", marks)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(found, 1) if part == "pair" or r <= 10]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 4, 1000])
def test_audit(spark, monkeypatch, least):
    monkeypatch.setattr(term_audit, "LEAST_DOCS", least)
    rows = some_docs(60, least)
    rows += rows[:9]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(3)
    got = term_audit.audit(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least)


def test_empty_tables(spark):
    assert term_audit.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = [(1, None, None, None, 1, "x", 2, 3), (2, "", "", "", 1, "x", 2, 3)]
    assert term_audit.audit(spark.createDataFrame(alone, SCHEMA)).collect() == []


@pytest.mark.parametrize("size", [1 << 20, 300, 40])
def test_counts_do_not_depend_on_slices(monkeypatch, size):
    monkeypatch.setattr(term_audit, "SLICE", size)
    rows = [(t or "", lang or "", s or "") for _, t, lang, s in some_docs(50, 5)]
    rows.append((("ab cd-" * 50 + "y" * 500 + " ab"), "en", "s1"))
    batch = pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in (1, 2, 0)], ["lang", "source", "text"])
    got = Counter(), Counter()
    groups = set()
    for out in term_audit._count(iter([batch.slice(0, 20), batch.slice(20, 0), batch.slice(20)])):
        for lang, source, term, n, docs in zip(*(c.to_pylist() for c in out.columns)):
            groups.add((lang, source))
            if term is not None:
                got[0][lang, source, term] += n
                got[1][lang, source, term] += docs
    want = Counter(), Counter()
    for text, lang, source in rows:
        for t, n in Counter(terms(text)).items():
            want[0][lang, source, t] += n
            want[1][lang, source, t] += 1
    assert got == want and groups == {(lang, s) for _, lang, s in rows}


def test_pointers_come_in_the_order_of_their_terms():
    text = " ".join(w for _, t, _, _ in some_docs(80, 11) for w in [t or ""])
    raw = np.frombuffer(text.encode(), np.uint8)
    found = term_audit.runs_of(raw, np.array([len(raw)]), np.zeros(1, np.int64))
    assert found.terms().to_pylist() == sorted(set(terms(text)), key=str.encode)


@pytest.mark.parametrize("cells,sources", [(1 << 20, 256), (8, 2), (1, 1)])
def test_pair_sums_do_not_depend_on_blocks(monkeypatch, cells, sources):
    monkeypatch.setattr(term_audit, "CELLS", cells)
    monkeypatch.setattr(term_audit, "SOURCES", sources)
    rng = random.Random(2)
    names = ["a", "b", "c", "d", "e"]
    counts = {t: {s: rng.choice([1, 7, 10**12]) for s in rng.sample(names, rng.randint(1, 5))} for t in (f"t{i}" for i in range(11))}
    mass = [sum(c.get(s, 0) for c in counts.values()) + 22 for s in names]
    rows = [("en", part, t, s, n) for part in range(-(-5 // sources)) for t, by in sorted(counts.items()) for s, n in by.items()]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], ["lang", "piece", "term", "source", "n"])
    got = Counter()
    for out in term_audit._pair_sums(iter([batch.slice(0, 7), batch.slice(7)]), term_audit.Masses({"en": names}, {"en": mass})):
        for _, a, b, v in zip(*(c.to_pylist() for c in out.columns)):
            got[a, b] += v
    p = {s: [1 + 10**9 * (c.get(s, 0) + 2) // m for c in counts.values()] for s, m in zip(names, mass)}
    want = {(a, b): sum((x - y) ** 2 // (x + y) for x, y in zip(p[a], p[b])) for i, a in enumerate(names) for b in names[i + 1 :]}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
