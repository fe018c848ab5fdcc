"""Which terms tell the sources of a language apart, from counts by a sort of pointers to word starts.

A term is a run of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased. A task reads
the texts of a batch as one buffer of Arrow, marks the places where terms start, and sorts these pointers by a
multikey quicksort: many pivots part them first; then all groups of pointers that agree so far are split at
once into those whose next eight bytes are below, at or above those of a member of the group. Pointers at
a pivot go on with the next eight bytes, and are done where the term has ended. Runs of equal pointers are the terms. Ordered by group of documents
and place within a run, they give the occurrences and the documents of each term in each (lang, source).

These counts are summed over tasks before and after the shuffle. Divergences of pairs of sources are summed
per slice of terms, so no task holds all terms of a language; all numbers are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stage, unstage

#: Fewest documents of a language that a kept term is in, and terms reported of each group.
LEAST_DOCS, TOP = 10, 10

UNIT = 1_000_000_000

#: Bytes of text whose pointers are sorted together; a longer text is cut up and its counts are added.
SLICE = 8 << 20

#: Most pivots that all pointers of a slice are first parted by.
PIVOTS = 1 << 16

#: Depth in bytes from which the few pointers left are compared as whole words.
DEEP = 64

#: Most groups (lang, source): their totals go to all tasks, and their pairs are the result.
LARGEST_GROUPS = 1 << 20

#: Cells of the table of one slice of terms, and sources of a language compared with all others at once.
CELLS, SOURCES = 1 << 20, 256


def _letters() -> np.ndarray:
    """Each byte of a term lower-cased, 0 for all others."""
    table = np.zeros(256, np.uint8)
    upper, lower = np.arange(65, 91), np.arange(97, 123)
    table[upper] = lower
    table[lower] = lower
    table[0x80:] = np.arange(0x80, 256)
    return table


LETTERS = _letters()


@dataclass
class Runs:
    """Equal runs of one slice: a pointer of each, and its lengths, group, occurrences and documents."""

    text: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    groups: np.ndarray
    counts: np.ndarray
    docs: np.ndarray

    def terms(self) -> pa.Array:
        offsets = np.zeros(len(self.starts) + 1, np.int32)
        np.cumsum(self.sizes, out=offsets[1:])
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - self.starts, self.sizes)
        return pa.StringArray.from_buffers(len(self.starts), pa.py_buffer(offsets), pa.py_buffer(self.text[at]))


def pointers(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased buffer, and start, size and text of each term; texts end at ``ends``."""
    text = LETTERS[raw]
    inside = text != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = ends[ends < len(raw)]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    return text, starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(ends, starts, side="right")


def sort_pointers(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each pointer the rank of the first of its run of equal terms in the sorted order."""
    n = len(starts)
    rank = np.zeros(n, np.int64)
    if not n:
        return rank
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray(len(text) + 1, ">u8", padded, strides=(1,))

    def block(which: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The next eight bytes of terms, zeros past their ends; no term holds a zero."""
        left = sizes[which] - depth
        spare = (8 * (8 - np.clip(left, 0, 8))).astype(np.uint64)
        value = words[starts[which] + np.minimum(depth, sizes[which])].astype(np.uint64)
        return np.where(left > 0, (value >> np.minimum(spare, np.uint64(63))) << np.minimum(spare, np.uint64(63)), np.uint64(0))

    active = np.arange(n)
    depth = np.zeros(n, np.int64)
    keys = block(active, depth)
    group = low = None
    while len(active):
        if group is None:  # all pointers are parted at once, by many pivots
            pivots = np.unique(keys[:: 1 + n // PIVOTS])
            at = np.minimum(np.searchsorted(pivots, keys), len(pivots) - 1)
            level = pivots[at] == keys
            side = 2 * at + np.where(level, 1, 2 * (keys > pivots[at]))
            held = np.bincount(side, minlength=2 * len(pivots) + 1)
            begins = np.cumsum(held) - held
        else:
            pivots = np.zeros(len(low), np.uint64)
            pivots[group] = keys
            at = pivots[group]
            side = 3 * group + 1 + (keys > at) - (keys < at)
            held = np.bincount(side, minlength=3 * len(low))
            begins = np.repeat(low, 3) + (np.cumsum(held.reshape(-1, 3), axis=1) - held.reshape(-1, 3)).ravel()
            level = keys == at
        depth = depth + 8 * level
        # A lone pointer is in place, and so are those whose terms have ended within the pivot.
        settled = (held[side] == 1) | (level & (sizes[active] < depth))
        rank[active[settled]] = begins[side[settled]]
        go = ~settled
        active, depth, side, level, keys = active[go], depth[go], side[go], level[go], keys[go]
        deep = depth >= DEEP
        if deep.any():
            _finish(text, starts, sizes, rank, active[deep], side[deep], begins)
            active, depth, side, level, keys = active[~deep], depth[~deep], side[~deep], level[~deep], keys[~deep]
        keys[level] = block(active[level], depth[level])
        left = np.bincount(side, minlength=len(begins)) > 0
        group = (np.cumsum(left) - 1)[side]
        low = begins[left]
    return rank


def _finish(text, starts, sizes, rank, which, side, begins) -> None:
    """Ranks pointers that agree over many bytes, by their whole terms."""
    buffer = text.tobytes()
    words = [buffer[s : s + z] for s, z in zip(starts[which].tolist(), sizes[which].tolist())]
    order = sorted(range(len(words)), key=lambda i: (side[i], words[i]))
    before, at, run = None, 0, 0
    for i in order:
        if before is None or side[i] != side[before]:
            at = run = 0
        elif words[i] != words[before]:
            run = at
        rank[which[i]] = begins[side[i]] + run
        before, at = i, at + 1


def runs_of(raw: np.ndarray, ends: np.ndarray, groups: np.ndarray) -> Runs:
    """The terms of each group in the texts of one buffer; ``groups`` numbers that of each text."""
    text, starts, sizes, owner = pointers(raw, ends)
    rank = sort_pointers(text, starts, sizes)
    of = groups[owner] if len(owner) else np.zeros(0, np.int64)
    many = int(groups.max(initial=0)) + 1
    order = np.argsort(rank * many + of, kind="stable")
    rank, of, owner = rank[order], of[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(rank) != 0) | (np.diff(of) != 0)
    fresh = new.copy()  # the first pointer of a text in its run
    fresh[1:] |= np.diff(owner) != 0
    heads = np.flatnonzero(new)
    picked = order[heads]
    counts = np.diff(np.append(heads, len(order)))
    docs = np.add.reduceat(fresh.astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
    return Runs(text, starts[picked], sizes[picked], of[heads], counts, docs)


def _cut(raw: np.ndarray) -> list[np.ndarray]:
    """Pieces of a long text that begin where no term goes on; a term is never cut."""
    parts, at = [], 0
    while len(raw) - at > SLICE:
        end = at + SLICE
        while end < len(raw):
            outside = np.flatnonzero(LETTERS[raw[end : end + SLICE]] == 0)
            if len(outside):
                end += int(outside[0])
                break
            end += SLICE
        end = min(end, len(raw))
        parts.append(raw[at:end])
        at = end
    return [*parts, raw[at:]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs) of texts; a row without a term for each group that occurs."""
    seen: set[tuple[str, str]] = set()
    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        names = sorted(set(zip(langs, sources)))
        number = {name: i for i, name in enumerate(names)}
        groups = np.array([number[name] for name in zip(langs, sources)], np.int64)
        if new := [name for name in names if name not in seen]:
            seen.update(new)
            yield _rows(names, np.array([number[x] for x in new]), pa.nulls(len(new), pa.string()), [0] * len(new), [0] * len(new))
        texts = batch.column(2)
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1)
            own, ends = raw[offsets[first] : offsets[last]], offsets[first + 1 : last + 1] - offsets[first]
            if len(own) > SLICE:  # one long text
                yield from _long(own, names, groups[first])
            else:
                found = runs_of(own, ends, groups[first:last])
                yield _rows(names, found.groups, found.terms(), found.counts, found.docs)
            first = last


def _long(raw: np.ndarray, names: list[tuple[str, str]], group: int) -> Iterator[pa.RecordBatch]:
    """The terms of one text, whose pieces are sorted one by one."""
    total: dict[str, int] = {}
    for piece in _cut(raw):
        found = runs_of(piece, np.array([len(piece)]), np.zeros(1, np.int64))
        for term, n in zip(found.terms().to_pylist(), found.counts.tolist()):
            total[term] = total.get(term, 0) + n
    where = np.full(len(total), group)
    yield _rows(names, where, pa.array(list(total), pa.string()), list(total.values()), np.ones(len(total), np.int64))


def _rows(names, groups, terms, counts, docs) -> pa.RecordBatch:
    langs, sources = (pa.array([name[i] for name in names], pa.string()) for i in (0, 1))
    columns = [langs.take(pa.array(groups)), sources.take(pa.array(groups)), terms, pa.array(counts, pa.int64()), pa.array(docs, pa.int64())]
    return pa.record_batch(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group.

    Nulls count as ''. Each group that occurs also has one row with a null term and zeros.
    """
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source, text)]
    rows = docs.select(*[c.alias(n) for c, n in zip(columns, ("lang", "source", "text"))])
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, mass: Column) -> Column:
    """1 + floor(10^9 (n + 2) / mass), in whole numbers."""
    return F.lit(1) + F.call_function("div", (n + 2).cast("decimal(28,0)") * F.lit(UNIT).cast("decimal(10,0)"), mass.cast("decimal(28,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


@dataclass(frozen=True)
class Masses:
    """The sources of each language in order, with n + 2 v of each."""

    sources: dict[str, list[str]]
    mass: dict[str, list[int]]

    def zeros(self, lang: str) -> np.ndarray:
        """The probability that each source gives to a term it lacks."""
        return np.array([1 + 2 * UNIT // m for m in self.mass[lang]], np.int64)


def _pair_sums(batches: Iterator[pa.RecordBatch], masses: Masses) -> Iterator[pa.RecordBatch]:
    """Sums of divergences over this task's terms, from rows in order of (lang, part, term).

    A part is a range of a language's sources, which is compared with all those behind their own.
    """
    held: tuple[str, int] | None = None
    total = np.zeros((0, 0), np.int64)
    zeros = np.zeros(0, np.int64)
    index: dict[str, int] = {}
    table = np.zeros((0, 0), np.int64)
    filled, before = -1, None

    def add() -> None:
        if filled < 0:
            return
        p = table[: filled + 1]
        begin = held[1] * SOURCES
        for i in range(total.shape[0]):
            own, others = p[:, begin + i : begin + i + 1], p[:, begin + i + 1 :]
            gap = own - others
            total[i, begin + i + 1 :] += (gap * gap // (own + others)).sum(0)

    def flush() -> Iterator[pa.RecordBatch]:
        if held is None:
            return
        add()
        i, j = np.nonzero(total)
        names = pa.array(masses.sources[held[0]], pa.string())
        yield pa.record_batch(
            [pa.array([held[0]] * len(i), pa.string()), names.take(pa.array(i + held[1] * SOURCES)), names.take(pa.array(j)), pa.array(total[i, j])],
            ["lang", "source", "item", "value"],
        )

    for batch in batches:
        langs, parts, terms, sources, counts = (batch.column(i).to_pylist() for i in range(5))
        for lang, part, term, source, n in zip(langs, parts, terms, sources, counts):
            if held != (lang, part):
                yield from flush()
                held, before, filled = (lang, part), None, -1
                zeros = masses.zeros(lang)
                index = {s: i for i, s in enumerate(masses.sources[lang])}
                total = np.zeros((min(SOURCES, len(zeros) - part * SOURCES), len(zeros)), np.int64)
                table = np.empty((max(1, CELLS // len(zeros)), len(zeros)), np.int64)
            if term != before:
                before, filled = term, filled + 1
                if filled == len(table):
                    filled -= 1
                    add()
                    filled = 0
                table[filled] = zeros
            at = index[source]
            table[filled, at] = 1 + (n + 2) * UNIT // masses.mass[lang][at]
    yield from flush()


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Divergence of each source of a language from its others, and the terms that mark it.

    Returns ``lang, source, part, item, value, rank``. Rows of part ``pair`` compare a source with each other
    source (item) of its language by the sum of f over all kept terms; those of part ``term`` are the ten
    terms (item) of largest f among those that the source has and uses more than its language does. A
    term is kept in a language where at least ten of its documents hold it. f = floor((p - q)^2 / (p + q)), of
    p = 1 + floor(10^9 (n + 2) / (N + 2 V)) with n of N occurrences and V kept terms. Ranks start from 1, by
    value descending and item ascending in UTF-8.

    Nulls in the three columns count as ''; null and '' are one source. A group without terms takes part
    in pairs; a language without kept terms has pairs of value 0. Repeated rows count each. A language of
    one source has no pairs, and an empty table gives no rows. Other columns take no part. A term may be
    as long as its text, and a text as long as a task can hold. More than 2^20 groups raise an error.
    """
    spark = docs.sparkSession
    in_lang = Window.partitionBy("lang", "term")
    counts = stage(term_counts(docs, text, lang, source), "terms")
    groups = counts.where("term IS NULL").select("lang", "source")
    spread = counts.where("term IS NOT NULL").withColumns({"_docs": F.sum("docs").over(in_lang), "in_lang": F.sum("n").over(in_lang)})
    kept = stage(spread.where(F.col("_docs") >= LEAST_DOCS).select("lang", "source", "term", "n", "in_lang"), "kept-terms")

    if groups.count() > LARGEST_GROUPS:
        raise ValueError(f"more than {LARGEST_GROUPS} groups of language and source")
    n_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    v_lang = kept.groupBy("lang", "term").agg(F.lit(1)).groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    known = groups.join(n_group, ["lang", "source"], "left").join(v_lang, "lang", "left").na.fill(0).collect()
    unstage(counts)
    totals: dict[str, dict[str, tuple[int, int]]] = {}
    for r in known:
        totals.setdefault(r.lang, {})[r.source] = (r.words, r.v)
    masses = Masses(
        {x: sorted(by, key=str.encode) for x, by in totals.items()},
        {x: [by[s][0] + 2 * by[s][1] for s in sorted(by, key=str.encode)] for x, by in totals.items()},
    )
    facts = [
        (x, s, Decimal(n + 2 * v), Decimal(sum(m for m, _ in by.values()) + 2 * v), -(-len(by) // SOURCES))
        for x, by in totals.items()
        for s, (n, v) in by.items()
    ]
    told = spark.createDataFrame(facts, "lang string, source string, mass decimal(28,0), lang_mass decimal(28,0), parts int")
    rows = kept.join(told, ["lang", "source"])

    p, q = probability(F.col("n"), F.col("mass")), probability(F.col("in_lang"), F.col("lang_mass"))
    marks = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    marks = marks.where(F.col("p") > F.col("q")).select("lang", "source", "part", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    top = marks.withColumn("rank", ranked).where(F.col("rank") <= TOP)

    shared = spark.sparkContext.broadcast(masses)
    cells = rows.select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("piece"), "term", "source", "n")
    cells = cells.repartition("lang", "piece", "term").sortWithinPartitions("lang", "piece", "term")
    sums = cells.mapInArrow(lambda b: _pair_sums(b, shared.value), "lang string, source string, item string, value long")
    half = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = told.select("lang", "source").join(told.select("lang", F.col("source").alias("item")), "lang").where(F.col("source") != F.col("item"))
    valued = pairs.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value")
    )
    return valued.withColumn("rank", ranked).unionByName(top)
