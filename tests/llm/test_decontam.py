"""Decontamination against brute force: items of all lengths, several parts of the index, odd rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.llm import decontam

DOCS = "doc_id long, text string, leaks int, items string, lang string"


def leaked(text, items):
    """Items of which a share of 0.8 of the runs lies within some passage as the operator cuts them."""
    tokens, found = decontam.words(text or ""), set()
    longest = max((len(decontam.words(t)) for _, t in items), default=1)
    half = max(decontam.PASSAGE, 2 * longest) // 2
    starts = range(0, max(1, len(tokens) - half), half)
    for item_id, item in items:
        own = decontam.words(item)
        size = min(decontam.SHINGLE, len(own))
        runs = decontam.shingles(own, size)
        for start in starts:
            if own and len(runs & decontam.shingles(tokens[start : start + 2 * half], size)) >= decontam.OVERLAP * len(runs):
                found.add(item_id)
    return sorted(found)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))
    common = [word() for _ in range(40)]
    some = lambda n: [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n)]
    items = [(i, " ".join(some(n)) + rng.choice(["", ".", "? " + " ".join(some(3))])) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 10, 30, 60] * 3)]
    items += [(5, items[5][1]), (90, items[5][1])]
    texts = [None, "", " "]
    for k in range(120):
        tokens = some(rng.choice([3, 40, 200, 700]))
        if k % 2:
            own = decontam.words(items[k % len(items)][1])
            if k % 3 == 0 and len(own) > 20:  # a copy with a word changed
                own[len(own) // 2] = "changed"
            at = rng.randint(0, len(tokens))
            tokens[at:at] = own
        texts.append(" ".join(tokens))
    texts.append(texts[4])
    return items, texts


@pytest.mark.parametrize("part_bytes", [16 << 20, 400])
def test_leaks_equal_those_of_all_pairs(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(decontam, "PART_BYTES", part_bytes)
    items, texts = corpus(4)
    benchmark = spark.createDataFrame([*items, (None, "a b c d e f"), (77, None), (78, ""), (79, " ")], "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 1, "x", "en") for i, t in enumerate(texts)], DOCS)
    found = decontam.with_leaks(docs, benchmark)
    assert found.columns == ["doc_id", "text", "items", "lang", "leaks"]
    got = {r.doc_id: [x["items"] for x in r.leaks] for r in found.collect()}
    # Part by part passages are as long as that part's items ask for: what one passage of all holds, all hold.
    want = {i: leaked(t, items) for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 60
    if part_bytes > 400:
        assert got == want
    else:
        missed = sum(len(set(want[i]) - set(got[i])) for i in want)
        assert missed <= 0.02 * sum(map(len, want.values()))
    kept = decontam.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in got if not got[i])


def test_short_items_are_found_inside_longer_texts(spark):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma"), (2, "omega")], "item_id long, text string")
    texts = ["it says alpha beta gamma here and goes on for a while", "alpha gamma beta", "Alpha Beta Gamma", "the omega", "omegas"]
    docs = spark.createDataFrame([(i, t, 1, "x", "en") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: [x["items"] for x in r.leaks] for r in decontam.with_leaks(docs, benchmark).collect()}
    assert got == {0: [1], 1: [], 2: [1], 3: [2], 4: []}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, "x", "en")], DOCS)
    benchmark = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.with_leaks(docs, benchmark.limit(0)).select(F.size("leaks")).head()[0] == 0
    assert decontam.with_leaks(docs.limit(0), benchmark).collect() == []
    assert [x["items"] for x in decontam.with_leaks(docs, benchmark).head().leaks] == [1]
