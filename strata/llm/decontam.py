"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND.

The items are indexed: for each term the items that hold it, in blocks, with the largest impact of each
block. An impact is the term's BM25 weight in the item over the item's own full score, so that one
threshold serves short and long items. Every document is read in overlapping passages, at least twice as
long as the longest item, and each passage is a query: all items that score above the threshold are
found. The blocks' bounds are added up for all passages of a text at once and rule out nearly all blocks;
within the others WAND moves from pivot to pivot, the first item at which the terms' bounds pass the
threshold. Hits are verified: the five-word shingles of the item's question and answer must be found in
the passage; an item of fewer words is found as one run of its own length.

Words are counted in Spark. The items are dealt to parts by hash, as many as their bytes ask for; the index of one
part at a time is built and broadcast, with one pass over the documents for each part.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import attach
from strata.session import stage, unstage

K1, B = 1.2, 0.75

#: Share of an item's own score that a passage must reach to be verified.
THRESHOLD = 0.5

#: Words of a shingle and the share of the item's shingles that a passage must hold.
SHINGLE, OVERLAP = 5, 0.8

#: Items of a block, and half passages whose bounds are held at once.
BLOCK, STRETCH = 2, 256

#: Least words of a passage.
PASSAGE = 64

#: Bytes of items in one part of the index.
PART_BYTES = 16 << 20


def words(text: str) -> list[str]:
    """Words between spacing, in lower case."""
    return text.lower().split()


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer of an item: its last sentence answers, if there is more than one."""
    ends = [m.end() for m in re.finditer(r"[.!?](?=\s)|\n", text.rstrip())]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def shingles(tokens: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Distinct runs of words; a shorter text is one run, an empty one has none."""
    return {tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))} if tokens else set()


@dataclass
class Item:
    """Runs of ``size`` words of the question, and the others."""

    item_id: int
    size: int
    question: set
    answer: set


class Index:
    """Postings of a part of the items. Statistics are those of all items."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, mean_words: float, frequency: dict[str, int]):
        self.items: list[Item] = []
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        longest = 1
        for item_id, text in items:
            tokens = words(text)
            counts = Counter(tokens)
            impact = {}
            for term, tf in counts.items():
                df = frequency[term]
                idf = math.log(1 + (n_items - df + 0.5) / (df + 0.5))
                impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(tokens) / mean_words))
            full = sum(impact.values())
            for term, weight in impact.items():
                postings[term].append((len(self.items), weight / full))
            question, answer = (words(x) for x in parts_of(text))
            # The runs across the border belong to the answer.
            size = min(SHINGLE, len(tokens))
            runs = shingles(tokens, size)
            asked = shingles(question, size) & runs
            self.items.append(Item(item_id, size, asked, runs - asked))
            longest = max(longest, len(tokens))
        self.passage = max(PASSAGE, 2 * longest)
        self.ids = [np.array([p for p, _ in v]) for v in postings.values()]
        self.impacts = [np.array([w for _, w in v]) for v in postings.values()]
        self.bound = np.array([w.max() for w in self.impacts])
        self.terms = {t: i for i, t in enumerate(postings)}
        # The blocks of each term and its largest impact in them, one term after the other.
        blocks, tops = [], []
        for ids, impacts in zip(self.ids, self.impacts):
            block, first = np.unique(ids // BLOCK, return_index=True)
            blocks.append(block)
            tops.append(np.maximum.reduceat(impacts, first))
        self.upto = np.cumsum([0, *[len(b) for b in blocks]])
        self.block, self.top = np.concatenate(blocks), np.concatenate(tops)
        self.n_blocks = -(-len(self.items) // BLOCK)

    def search(self, terms: np.ndarray, threshold: float, begin: int, end: int) -> list[int]:
        """Numbers from ``begin`` to ``end`` of all items that score above ``threshold`` for distinct terms."""
        lists = []
        for t in terms:
            lo, hi = np.searchsorted(self.ids[t], (begin, end))
            if lo < hi:
                lists.append([self.ids[t][lo:hi].tolist(), self.impacts[t][lo:hi].tolist(), 0, float(self.impacts[t][lo:hi].max())])
        found = []
        while True:
            live = sorted((x for x in lists if x[2] < len(x[0])), key=lambda x: x[0][x[2]])
            total, pivot = 0.0, None
            for ids, _, at, top in live:
                total += top
                if total > threshold:
                    pivot = ids[at]
                    break
            if pivot is None:
                return found
            score = 0.0
            for x in live:
                ids, impacts, at, _ = x
                if ids[at] > pivot:
                    break
                while at < len(ids) and ids[at] < pivot:
                    at += 1
                if at < len(ids) and ids[at] == pivot:
                    score += impacts[at]
                    at += 1
                x[2] = at
            if score > threshold:
                found.append(pivot)

    def _bounds(self, codes: np.ndarray, half: np.ndarray, halves: int) -> np.ndarray:
        """Upper bounds of the scores of each block's items for each half passage."""
        pairs = np.unique(half * len(self.terms) + codes)
        half, codes = np.divmod(pairs, len(self.terms))
        count = self.upto[codes + 1] - self.upto[codes]
        at = np.arange(count.sum()) + np.repeat(self.upto[codes] - np.cumsum(count) + count, count)
        keys = np.repeat(half, count) * self.n_blocks + self.block[at]
        return np.bincount(keys, self.top[at], halves * self.n_blocks).reshape(halves, self.n_blocks)

    def leaks(self, text: str) -> dict[int, tuple[float, float]]:
        """Share of question and of answer found, for each item that the text leaks."""
        tokens = words(text)
        codes = np.array(list(map(self.terms.get, tokens, repeat(-1))), np.int64)
        places = np.flatnonzero(codes >= 0)
        codes = codes[places]
        size = self.passage // 2
        halves = max(1, -(-len(tokens) // size))
        leaked: dict[int, tuple[float, float]] = {}
        # A passage is two halves; a long text is read in stretches that share a half.
        for first in range(0, max(1, halves - 1), STRETCH - 1):
            last = min(first + STRETCH, halves)
            lo, hi = np.searchsorted(places, (first * size, last * size))
            bounds = self._bounds(codes[lo:hi], places[lo:hi] // size - first, last - first)
            sums = bounds[:-1] + bounds[1:] if last - first > 1 else bounds
            for passage, block in np.argwhere(sums > THRESHOLD):
                start = (first + int(passage)) * size
                stop = start + 2 * size
                lo, hi = np.searchsorted(places, (start, stop))
                hits = self.search(np.unique(codes[lo:hi]), THRESHOLD, int(block) * BLOCK, int(block + 1) * BLOCK)
                runs: dict[int, set] = {}
                for number in hits:
                    item = self.items[number]
                    if item.size not in runs:
                        runs[item.size] = shingles(tokens[start:stop], item.size)
                    asked, answered = len(item.question & runs[item.size]), len(item.answer & runs[item.size])
                    if asked + answered >= OVERLAP * (len(item.question) + len(item.answer)):
                        shares = (asked / max(1, len(item.question)), answered / len(item.answer) if item.answer else 1.0)
                        leaked[item.item_id] = max(leaked.get(item.item_id, shares), shares)
        return leaked


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text, words, terms) of items: the number of words and the distinct ones."""
    for batch in batches:
        tokens = [words(t) for t in batch.column(1).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array([len(t) for t in tokens], pa.int64())]
        terms = pa.array([sorted(set(t)) for t in tokens], pa.list_(pa.string()))
        yield pa.record_batch([*columns, terms], names=["item_id", "text", "words", "terms"])


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The index, in parts of about ``PART_BYTES`` bytes of items, built one by one.

    Only a part's items and the frequencies of its words come to the driver.
    """
    clean = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    told = clean.mapInArrow(_told, "item_id long, text string, words long, terms array<string>").where("words > 0")
    items = stage(told, "benchmark-items")
    sums = items.agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not sums.n:
        return
    frequency = items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    parts = -(-sums.bytes // PART_BYTES)
    frequency = stage(frequency, "benchmark-terms") if parts > 1 else frequency
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for part in range(parts):
        own = dealt.where(F.col("part") == part)
        rows = own.orderBy("item_id", "text").select("item_id", "text").toArrow()
        known = frequency if parts == 1 else frequency.join(own.select(F.explode("terms").alias("term")).distinct(), "term")
        table = known.toArrow()
        counts = dict(zip(table["term"].to_pylist(), table["df"].to_pylist()))
        if rows.num_rows:
            yield Index(list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist())), sums.n, sums.words / sums.n, counts)
    unstage(items, *([frequency] if parts > 1 else []))


def _finder(shared):
    @F.pandas_udf("items array<bigint>, question array<double>, answer array<double>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [sorted(shared.value.leaks(t).items()) if t else [] for t in texts]
            yield pd.DataFrame(
                {
                    "items": pd.Series([[i for i, _ in x] for x in found], dtype=object),
                    "question": pd.Series([[q for _, (q, _) in x] for x in found], dtype=object),
                    "answer": pd.Series([[a for _, (_, a) in x] for x in found], dtype=object),
                }
            )

    return find


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``leaks``: an array of (item_id, question, answer), one entry for each item found in a passage
    of the text, with the shares of the item's question and answer that the passage holds.

    A null or empty text leaks nothing. Items without id or words are not searched for, and an item
    that repeats is one. Rows that repeat are told alike; an empty table of either kind gives no leak.
    All columns of ``docs`` but an earlier ``leaks`` are kept.
    """
    spark, rows = docs.sparkSession, docs.drop("leaks")
    indexes = _indexes(benchmark)
    first, second = next(indexes, None), next(indexes, None)
    if first is None:
        return rows.withColumn("leaks", F.expr(f"cast(array() as {LEAKS})"))
    if second is None:
        return rows.withColumn("leaks", _leaks(_finder(spark.sparkContext.broadcast(first))(F.col(text))))
    # Several parts: the leaks of each are written before the next part is sent out.
    rows = stage(rows.withColumn("__row", F.monotonically_increasing_id()), "decontam-rows")
    found = []
    for index in chain((first, second), indexes):
        shared = spark.sparkContext.broadcast(index)
        leaks = rows.select("__row", _leaks(_finder(shared)(F.col(text))).alias("leaks")).where(F.size("leaks") > 0)
        found.append(stage(leaks, "decontam-leaks"))
        shared.unpersist()
    together = reduce(DataFrame.unionByName, found).groupBy("__row").agg(F.sort_array(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    whole = attach(rows, together, ["__row"]).withColumn("leaks", F.coalesce("leaks", F.expr(f"cast(array() as {LEAKS})")))
    return whole.drop("__row")


LEAKS = "array<struct<items: bigint, question: double, answer: double>>"


def _leaks(found: Column) -> Column:
    return F.arrays_zip(*[found.getField(c).alias(c) for c in ("items", "question", "answer")])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    return with_leaks(docs, benchmark).where(F.size("leaks") == 0).select(*docs.columns)
