"""Removal of repeated byte strings by a suffix sort that compares hashes.

A string of ``LENGTH`` bytes is repeated when it also starts anywhere else. Among the short grams inside
each such string the one with the smallest hash is its anchor, so equal strings have equal anchors at
equal places. Texts are cut into contexts, the bytes of all strings around one anchor, about one for every
150 bytes of text; only contexts whose anchor occurs elsewhere can hold a repeat and are compared.

Contexts meet by anchor. Those of one anchor are put in order by the bytes that follow it and by the
bytes that precede it: a mergesort whose comparisons find the common extension of two suffixes by binary
search over polynomial hashes of prefixes, in a number of steps logarithmic in its length. The common
extensions of neighbours in both orders give those of all pairs; two contexts share repeated strings
where both extensions together reach ``LENGTH`` bytes. Bytes are compared to verify each string found.

An anchor may be very common. Its contexts are then split by offset: strings that begin in one half of the
offsets share more bytes around the anchor than the gram, and contexts meet by these, again and
again until groups are small or the strings themselves are the key. Equal contexts count as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import PrefixHash, attach, batches_of, mixed, whole_groups
from strata.session import release, stage, unstage

LENGTH = 400
GRAM = 100

#: Contexts that are sorted together, more are split by offset; and rows of their table of pairs held at once.
LARGEST_GROUP, ROWS = 8192, 64

#: Contexts of small groups that are sorted side by side.
STRETCH = 2000

#: Bytes that are searched for anchors at once.
BLOCK = 1 << 19
PLACE = np.uint64(BLOCK * 2 - 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, np.ndarray]]:
    """Pieces of texts in blocks: owner and offset of each piece, the bytes, and where pieces end.

    A long text is cut to pieces that overlap by one byte less than the length of a string.
    """
    owner, offset, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, BLOCK - LENGTH + 1):
            piece = text[at : at + BLOCK]
            if size and size + len(piece) > BLOCK:
                yield np.array(owner), b"".join(parts), np.array(offset), np.cumsum([len(p) for p in parts])
                owner, offset, parts, size = [], [], [], 0
            owner.append(i)
            offset.append(at)
            parts.append(piece)
            size += len(piece)
    if parts:
        yield np.array(owner), b"".join(parts), np.array(offset), np.cumsum([len(p) for p in parts])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For each context: the text, the anchor's hash and place, and the first and last start of its strings."""
    out = [[np.zeros(0, np.int64)] * 5]
    for owner, data, offset, ends in _blocks(texts):
        grams = mixed(PrefixHash(np.frombuffer(data, np.uint8)).all_of(GRAM))
        ranks = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        lowest = (_sliding_min(ranks, LENGTH - GRAM + 1) & PLACE).astype(np.int64)
        starts = np.arange(len(lowest))
        piece = np.searchsorted(ends, starts, side="right")
        valid = starts + LENGTH <= ends[piece]
        lowest, starts, piece = lowest[valid], starts[valid], piece[valid]
        new = np.ones(len(starts), bool)
        new[1:] = (lowest[1:] != lowest[:-1]) | (piece[1:] != piece[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(starts)) - 1
        shift = offset[piece[at]] - np.append(0, ends)[piece[at]]
        place = lowest[at]
        out.append([owner[piece[at]], grams[place].view(np.int64), place + shift, starts[at] + shift, starts[last] + shift])
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out))


CONTEXT = "array<struct<h: bigint, place: bigint, first: bigint, last: bigint>>"
CONTEXT_TYPE = pa.struct([(n, pa.int64()) for n in ("h", "place", "first", "last")])


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        texts = batch.column("text").to_pylist()
        owner, *columns = anchors(texts)
        counts = np.bincount(owner, minlength=len(texts))
        flat = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(CONTEXT_TYPE))
        found = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), flat)
        yield pa.record_batch([batch.column("tk"), found], names=["tk", "found"])


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tk, place, first, last, h, context) of the anchors given for each text."""
    names = ["tk", "place", "first", "last", "h", "context"]
    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        rows: list[list] = [[] for _ in names]
        for tk, text, found in zip(*(batch.column(n).to_pylist() for n in ("tk", "text", "found"))):
            for x in sorted(found, key=lambda x: (x["place"], x["first"])):
                values = (tk, x["place"], x["first"], x["last"], x["h"], text[x["first"] : x["last"] + LENGTH])
                for column, value in zip(rows, values):
                    column.append(value)
        kinds = [pa.binary(), *[pa.int64()] * 4, pa.binary()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)


class Suffixes:
    """Contexts side by side, with the place of each anchor, to be put in order by what follows or precedes it."""

    def __init__(self, contexts: list[bytes], left: np.ndarray):
        self.bytes = b"".join(contexts)
        self.data = np.frombuffer(self.bytes, np.uint8)
        size = np.array([len(c) for c in contexts], np.int64)
        self.at = np.cumsum(size) - size + left
        self.left, self.right = left, size - left
        self.hash = PrefixHash(self.data)

    def extension(self, i: np.ndarray, j: np.ndarray, ahead: bool) -> np.ndarray:
        """Length of the common extension of anchors i and j, by binary search over hashes."""
        room = np.minimum(self.right[i], self.right[j]) if ahead else np.minimum(self.left[i], self.left[j])
        low, high = np.zeros_like(room), room
        while len(low) and (low < high).any():
            middle = (low + high + 1) // 2
            a, b = (self.at[i], self.at[j]) if ahead else (self.at[i] - middle, self.at[j] - middle)
            same = self.hash.of(a, middle) == self.hash.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, ahead: bool) -> np.ndarray:
        """Whether suffix i sorts before suffix j."""
        n = self.extension(i, j, ahead)
        room = self.right if ahead else self.left
        ends_i, ends_j = n == room[i], n == room[j]
        a, b = (self.at[i] + n, self.at[j] + n) if ahead else (self.at[i] - n - 1, self.at[j] - n - 1)
        top = len(self.data) - 1
        smaller = self.data[np.clip(a, 0, top)] < self.data[np.clip(b, 0, top)]
        return np.where(ends_i, ~ends_j, ~ends_j & smaller)

    def sort(self, starts: np.ndarray, counts: np.ndarray, ahead: bool) -> np.ndarray:
        """The suffixes of each group in order, by mergesort of all groups at once."""
        order = np.arange(len(self.at))
        base, size = np.repeat(starts, counts), np.repeat(counts, counts)
        width = 1
        while width < counts.max(initial=0):
            live = np.flatnonzero(size > width)
            rank = live - base[live]
            pair = base[live] + rank // (2 * width) * (2 * width)
            in_left = rank % (2 * width) < width
            end = base[live] + size[live]
            middle = np.minimum(pair + width, end)
            low = np.where(in_left, middle, pair)
            high = np.where(in_left, np.minimum(pair + 2 * width, end), middle)
            first = low.copy()
            own = order[live]
            while (open_ := low < high).any():
                at = np.flatnonzero(open_)
                probe = (low[at] + high[at]) // 2
                other = order[probe]
                # Equal suffixes keep their order: those of the left half come first.
                left = in_left[at]
                passed = self.before(np.where(left, other, own[at]), np.where(left, own[at], other), ahead)
                passed = np.where(left, passed, ~passed)
                low[at] = np.where(passed, probe + 1, low[at])
                high[at] = np.where(passed, high[at], probe)
            target = np.where(in_left, live, pair + live - middle) + low - first
            merged = order.copy()
            merged[target] = own
            order = merged
            width *= 2
        return order


def _with_all(near: np.ndarray, rank: np.ndarray, i: int) -> np.ndarray:
    """Common extensions of suffix i with all of its group, from those of neighbours in order."""
    at = rank[i]
    out = np.zeros(len(near), np.int64)
    out[at + 1 :] = np.minimum.accumulate(near[at + 1 :])
    out[:at] = np.minimum.accumulate(near[at:0:-1])[::-1]
    return out[rank]


def _by_bytes(contexts: list[bytes], left: np.ndarray, i: int, ahead: bool) -> np.ndarray:
    """The same by comparing bytes, where hashes have misled."""
    side = (lambda j: contexts[j][left[j] :]) if ahead else (lambda j: contexts[j][: left[j]][::-1])
    out = np.zeros(len(contexts), np.int64)
    for j in range(len(contexts)):
        pairs = zip(side(i), side(j))
        out[j] = next((n for n, (a, b) in enumerate(pairs) if a != b), min(len(side(i)), len(side(j))))
    return out


def repeats(contexts: list[bytes], left: np.ndarray, low: np.ndarray, high: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(smallest, largest) offset of a repeated string for each context, (1, 0) if it has none.

    An offset is the anchor's place less the string's; ``low`` and ``high`` bound those looked at.
    ``starts``: first context of each group.
    """
    counts = np.diff(np.append(starts, len(contexts)))
    suffixes = Suffixes(contexts, left)
    orders = []
    for ahead in (True, False):
        order = suffixes.sort(starts, counts, ahead)
        near = np.zeros(len(order), np.int64)
        near[1:] = suffixes.extension(order[1:], order[:-1], ahead)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        orders.append((near, rank))
    out = np.tile(np.array([1, 0], np.int64), (len(contexts), 1))
    for start, count in zip(starts, counts):
        own = slice(start, start + count)
        near = [(near[own], rank[own] - start) for near, rank in orders]
        for at in range(0, count if count > 1 else 0, ROWS):
            rows = np.arange(at, min(at + ROWS, count))
            ahead, back = (np.stack([_with_all(*x, i) for i in rows]) for x in near)
            for attempt in range(2):
                reach_back = np.minimum(back, np.minimum.outer(high[own][rows], high[own]))
                reach_ahead = np.minimum(ahead, LENGTH - np.maximum.outer(low[own][rows], low[own]))
                found = reach_back + reach_ahead >= LENGTH
                found[np.arange(len(rows)), rows] = False
                most, least = np.where(found, reach_back, -1), LENGTH - np.where(found, reach_ahead, -1)
                partners = most.argmax(1), least.argmin(1)
                hit = np.flatnonzero(found.any(1))
                offsets = most.max(1), least.min(1)
                if all(
                    _string(suffixes, start + at + i, d[i]) == _string(suffixes, start + p[i], d[i])
                    for i in hit
                    for p, d in zip(partners, offsets)
                ):
                    break
                ahead, back = (np.stack([_by_bytes(contexts[own], left[own], i, x) for i in rows]) for x in (True, False))
            out[start + at + hit, 0], out[start + at + hit, 1] = offsets[1][hit], offsets[0][hit]
    return out


def _string(suffixes: Suffixes, i: int, offset: int) -> bytes:
    at = int(suffixes.at[i] - offset)
    return suffixes.bytes[at : at + LENGTH]


def _stretches(table: pa.Table) -> Iterator[pa.Table]:
    """A table of groups in pieces of about ``STRETCH`` rows that keep groups whole."""
    key = table.column("key").to_numpy()
    ends = np.append(np.flatnonzero(np.diff(key)) + 1, len(key))
    at = 0
    while at < len(key):
        end = int(ends[min(np.searchsorted(ends, at + STRETCH), len(ends) - 1)])
        yield table.slice(at, end - at)
        at = end


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in (t for groups in whole_groups(batches, "key") for t in _stretches(groups)):
        key = table.column("key").to_numpy()
        contexts = table.column("context").to_pylist()
        left, low, high = (table.column(n).to_numpy().astype(np.int64) for n in ("left", "low", "high"))
        starts = np.append(0, np.flatnonzero(np.diff(key)) + 1)
        found = repeats(contexts, left, low, high, starts)
        hit = np.flatnonzero(found[:, 1] >= found[:, 0])
        ids = table.column("ck").to_pylist()
        yield pa.record_batch([pa.array([ids[i] for i in hit], pa.binary()), pa.array(found[hit, 0]), pa.array(found[hit, 1])], names=["ck", "least", "most"])


RANGES = "ck binary, least long, most long"


def _ranges(contexts: DataFrame) -> DataFrame:
    """(ck, least, most): offsets of repeated strings of each different context (ck, h, context, left)."""
    spark = contexts.sparkSession
    own_low = F.lit(LENGTH) - (F.octet_length("context") - F.col("left"))
    cells = contexts.withColumns(
        {"key": F.col("h"), "low": F.lit(0).cast("long"), "high": F.lit(LENGTH - GRAM).cast("long"), "own": own_low.cast("long")}
    )
    found = spark.createDataFrame([], RANGES)
    while True:
        sizes = cells.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        sized = stage(attach(cells, sizes, ["key"], "inner"), "suffix-cells")
        small = sized.where(F.col("size") <= LARGEST_GROUP).drop("size")
        compared = small.repartition("key").sortWithinPartitions("key").select("key", "ck", "context", "left", "low", "high")
        found = found.unionByName(compared.mapInArrow(_compare, RANGES))
        large = sized.where(F.col("size") > LARGEST_GROUP)
        # Where one offset is left, the key stands for the string itself; equal strings are repeated.
        string = F.substring("context", (F.col("left") - F.col("low") + 1).cast("int"), F.lit(LENGTH))
        alike = large.where("low = high").select("ck", "key", F.col("low").alias("least"), string.alias("string"))
        often = alike.groupBy("key", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        alike = attach(alike, often, ["key", "string"], "semi")
        found = found.unionByName(alike.select("ck", "least", F.col("least").alias("most")))
        large = large.where("low < high").drop("size", "key")
        if large.isEmpty():
            return found.groupBy("ck").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        halves = F.explode(
            F.array(
                F.struct(F.col("low").alias("low"), middle.alias("high")),
                F.struct((middle + 1).alias("low"), F.col("high").alias("high")),
            )
        )
        cells = large.withColumn("half", halves).withColumns({"low": F.col("half.low"), "high": F.col("half.high")}).drop("half")
        # Only offsets that the context has strings at.
        cells = cells.where((F.col("low") <= F.col("left")) & (F.col("high") >= F.col("own")))
        core = F.substring(
            "context",
            (F.col("left") - F.least(F.col("low"), F.col("left")) + 1).cast("int"),
            (F.lit(LENGTH) - F.col("high") + F.col("low")).cast("int"),
        )
        cells = cells.withColumn("key", F.xxhash64("low", "high", core))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(tk, spans): the byte spans (start, stop) of each different text that repeated strings cover.

    ``texts`` has the rows (tk, key, text): tk names a text, equal texts have equal names, and key
    tells apart rows of equal texts. Spans may overlap and are in no order; texts without any have no row.
    """
    sized = texts.withColumn("bytes", F.octet_length("text"))
    named = sized.groupBy("tk").agg(F.count("*").alias("copies"), F.max("bytes").alias("bytes"), F.min("key").alias("key"))
    names = stage(named, "suffix-texts")
    one = names.select("tk", "key")
    long = sized.where(F.col("bytes") >= LENGTH).select("tk", "text")
    found = stage(long.mapInArrow(_find_anchors, f"tk binary, found {CONTEXT}"), "suffix-anchors")
    # An anchor is of use if its gram occurs at two places; copies of a text have the same places.
    rows = found.select("tk", F.explode("found").alias("x")).select("tk", "x.*")
    places = rows.select("h", F.xxhash64("tk", "place").alias("at"))
    twice = places.groupBy("h").agg(F.min("at").alias("a"), F.max("at").alias("b")).where("a <> b").select("h")
    useful = attach(rows, twice, ["h"], "inner").groupBy("tk").agg(F.collect_set(F.struct("h", "place", "first", "last")).alias("found"))
    wanted = attach(useful, one, ["tk"], "inner")
    cut = attach(texts, wanted, ["tk", "key"], "inner").select("tk", "text", "found")
    kinds = "tk binary, place long, first long, last long, h long, context binary"
    contexts = cut.mapInArrow(_cut_contexts, kinds).withColumn("left", F.col("place") - F.col("first"))
    # A context is named by its bytes and the place of its anchor.
    named = F.concat("context", F.col("left").cast("string").cast("binary"))
    contexts = stage(contexts.withColumn("ck", F.unhex(F.substring(F.sha2(named, 256), 1, 32))), "suffix-contexts")
    different = contexts.groupBy("ck", "h", "left", "context").agg(F.count("*").alias("n"))
    different = stage(different, "suffix-different")
    unstage(found)
    release(texts.sparkSession)
    ranges = _ranges(different.drop("n"))
    own = F.lit(LENGTH) - (F.octet_length("context") - F.col("left"))
    several = different.where("n > 1").select("ck", own.cast("long").alias("least"), F.col("left").alias("most"))
    ranges = ranges.unionByName(several).groupBy("ck").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    placed = attach(contexts.select("tk", "place", "ck").distinct(), ranges, ["ck"], "inner")
    spans = placed.select("tk", (F.col("place") - F.col("most")).alias("start"), (F.col("place") - F.col("least") + LENGTH).alias("stop"))
    copied = names.where((F.col("copies") > 1) & (F.col("bytes") >= LENGTH))
    spans = spans.unionByName(copied.select("tk", F.lit(0).cast("long").alias("start"), F.col("bytes").cast("long").alias("stop")))
    return spans.groupBy("tk").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def _remove(with_text: bool):
    names = ["__key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_text else 5]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            rows: list[list] = [[] for _ in range(5)]
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                runs = merged([(s["start"], s["stop"]) for s in spans or ()])
                edges = [0, *[x for run in runs for x in run], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                values = (len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept)
                for column, value in zip(rows, values):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(rows, kinds)]
            yield pa.record_batch([batch.column("__key"), *columns[: len(names) - 1]], names=names)

    return remove


def remove_repeats(docs: DataFrame, key: str = "doc_id", with_text: bool = True) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256, and ``kept``, the bytes left.

    A byte goes when a string of ``LENGTH`` bytes covers it that also starts elsewhere, in the same text
    or another; strings never cross texts and are judged on the input. What is left need not be
    valid UTF-8. A null text counts as empty. Rows that repeat are documents of their own, each a
    repeat of the other. An empty table gives no rows. Columns other than key and text are not looked at.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("key"), text.alias("text"))
    texts = texts.withColumn("tk", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    with batches_of(docs.sparkSession, 1000):
        spans = stage(repeated_spans(texts), "suffix-spans")
    release(docs.sparkSession)
    joined = attach(texts, spans, ["tk"]).select(F.col("key").alias("__key"), "text", "spans")
    columns = f"__key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_remove(with_text), columns + ", kept binary" * with_text).withColumnRenamed("__key", key)
