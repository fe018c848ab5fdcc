"""N-gram Jaccard join by prefix filters under several global token orders.

A document is the set of hashes of its word n-grams. Two sets of similarity t can only be linked if they
share a token among the first n - ceil(t n) + 1 of each, whatever order all tokens are put in. Three
orders are used. The first puts rare tokens in front and is joined on: documents that share a token of
their prefixes meet in a group. The other two are orders by hash; of the pairs that meet, only those
that also share prefix tokens under both are verified, by counting the tokens they share: as many as it
takes to reach t with all that lies behind the prefixes.

Only the tokens in the lowest part of the hash range are counted, one and a half prefixes per document;
they stand first, by their counts, and the others follow by hash. Tokens without a second document
come before all others, so a document with enough of them is done.

Equal sets are one. A group is named by its smallest member, its center, and holds all sets that share a
token with it. Every set is first compared in one of its groups; what is compared together gives a tree
of links rather than all of them. Then the tokens whose sets are still in several components are looked
at again, and their sets compared in full, so no link is lost: those of large groups in pairs of blocks,
left out where sizes or a common component rule links out. There the prefixes are compared first, and
only sets with a candidate are fetched whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import attach, mixed, sifted, whole_groups
from strata.llm.components import components, joined
from strata.session import release, stage, unstage

#: Bytes that are hashed at once.
PIECE = 2 << 20

#: Sets of a block, and tokens that a table of sets by tokens has at once.
BLOCK, SLAB = 256, 4096

#: Prefixes of a document that are counted for the order by rarity.
COUNTED = 1.5

#: Fixed odd multipliers of the orders by hash.
ORDERS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

#: Columns of a set's prefixes under them.
PREFIXES = ("second", "third")

VALUES = np.zeros(256, np.uint64)
VALUES[:] = np.arange(1, 257)
VALUES[[9, 10, 11, 12, 13, 32]] = 0


def prefix_length(n, percent: int):
    """Tokens of a set of n of which a linked set shares at least one."""
    return n - -(-(n * percent) // 100) + 1


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Lower-case bytes of about ``PIECE`` bytes, with the owner of each text in it; words stay whole."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at, text = 0, text or b""
        while at < len(text):
            cut = len(text)
            if cut - at > PIECE:
                ends = [x for x in (text.rfind(c, at, at + PIECE) for c in (b" ", b"\n", b"\t")) if x > at]
                later = [x for x in (text.find(c, at + PIECE) for c in (b" ", b"\n", b"\t")) if x >= 0]
                cut = max(ends) if ends else min(later, default=cut)
            owners.append(i)
            parts.append(text[at:cut].lower())
            size += cut - at + 1
            at = cut
            if size >= PIECE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the text that each belongs to."""
    hashes, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for owners, parts in _pieces(texts):
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        values = VALUES[data]
        inside = values > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        place = np.arange(len(data), dtype=np.int64) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(data)]))))
        longest = int(np.diff(np.append(starts, len(data))).max())
        factors = mixed(np.arange(1, min(max(longest, starts[0]), 1 << 16) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        factor = factors[place & 0xFFFF]
        if longest > 1 << 16:
            factor += (place >> 16).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        hashes.append(mixed(np.add.reduceat(values * (factor | np.uint64(1)), starts)))
        text_ends = np.cumsum([len(p) + 1 for p in parts])
        of.append(np.array(owners)[np.searchsorted(text_ends, starts, side="right")])
    return np.concatenate(hashes), np.concatenate(of)


def shingle_sets(texts: list[bytes | None], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of n words of each text; a shorter text is one run, none is empty."""
    hashes, of = word_hashes(texts)
    counts = np.bincount(of, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    long = max(0, len(hashes) - n + 1)
    runs = np.full(long, n, np.uint64)
    for k in range(n):
        runs = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + long])
    out = []
    for end, count in zip(ends, counts):
        if count >= n:
            out.append(np.unique(runs[end - count : end - n + 1].view(np.int64)))
        elif count:
            short = np.full(1, count, np.uint64)
            for h in hashes[end - count : end]:
                short = mixed(short * np.uint64(0x9E3779B97F4A7C15) + h)
            out.append(short.view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of each set. Two of n different sets share one with a chance of n^2 / 2^65."""
    sums = np.array([int(mixed(s.view(np.uint64)).sum(dtype=np.uint64)) for s in sets], np.uint64)
    return mixed(sums + np.array([len(s) for s in sets], np.uint64)).view(np.int64)


def _lists(values: list[np.ndarray], kind: type = np.int64) -> pa.Array:
    offsets = np.cumsum([0, *[len(v) for v in values]], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, kind)))


def _parts(batch: pa.RecordBatch, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _sketch(n: int, percent: int):
    share = min(1.0, COUNTED * (100 - percent) / 100)
    bound = -(2**63) + int(share * 2**64) - 1

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in _parts(b)):
            sets = shingle_sets(batch.column("__text").to_pylist(), n)
            low = [s[: max(int(np.searchsorted(s, bound, side="right")), prefix_length(len(s), percent))] if len(s) else s for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            columns = [batch.column("__row"), batch.column("__key"), sizes, pa.array(set_ids(sets)), _lists(low)]
            yield pa.record_batch(columns, names=["__row", "__key", "n", "sid", "low"])

    return sketch


def _full(n: int, percent: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets that are asked for, each once, with their prefixes under the orders by hash."""
        for batch in (p for b in batches for p in _parts(b)):
            sets = shingle_sets(batch.column("__text").to_pylist(), n)
            # The upper halves will do to tell which sets have a candidate: equal tokens stay equal.
            prefixes = [_lists([(_prefix_under(s, factor, percent) >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in sets], np.int32) for factor in ORDERS]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            columns = [batch.column("sid"), batch.column("cells"), sizes, *prefixes, _lists(sets)]
            yield pa.record_batch(columns, names=["sid", "cells", "size", *PREFIXES, "tokens"])

    return full


def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, sid): those whose token has several sids, with their number.

    The first and last token of a partition may go on in another one; their rows are all given and marked.
    """
    first, held = None, None
    out = pa.schema([("token", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("edge", pa.bool_())])

    def rows(token: np.ndarray, sid: np.ndarray, last: bool):
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        pair = new.copy()
        pair[1:] |= sid[1:] != sid[:-1]
        run = np.cumsum(new) - 1
        count = np.bincount(run[pair])[run]
        edge = (token == first) | ((token == token[-1]) & last)
        keep = pair & ((count > 1) | edge)
        columns = (token[keep], sid[keep], count[keep].astype(np.int64), edge[keep])
        return pa.record_batch([pa.array(c) for c in columns], schema=out)

    for batch in batches:
        token, sid = batch.column("token").to_numpy(), batch.column("sid").to_numpy()
        if not len(token):
            continue
        first = token[0] if first is None else first
        if held is not None:
            token, sid = np.concatenate((held[0], token)), np.concatenate((held[1], sid))
        cut = int(np.searchsorted(token, token[-1]))
        if cut:
            yield rows(token[:cut], sid[:cut], False)
        held = token[cut:], sid[cut:]
    if held is not None:
        yield rows(*held, True)


def _shared_tokens(sketches: DataFrame) -> DataFrame:
    """(token, sid, n) of the counted tokens that n > 1 different sets hold.

    Rows are ranged by token and set, so that the rows of a common token spread over several tasks.
    """
    rows = sketches.select(F.explode("low").alias("token"), "sid")
    ranged = rows.repartitionByRange("token", "sid").sortWithinPartitions("token", "sid")
    found = stage(ranged.mapInArrow(_shared_runs, "token long, sid long, n long, edge boolean"), "jaccard-shared")
    edges = found.where("edge").select("token", "sid")
    counts = edges.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    return found.where("NOT edge").drop("edge").unionByName(attach(edges, counts, ["token"], "inner"))


def _prefixes(sketches: DataFrame, percent: int) -> DataFrame:
    """(sid, tokens): the tokens of each set's prefix, in order of rarity, that other sets hold."""
    sizes = sketches.groupBy("sid").agg(F.max("n").alias("size"), F.max(F.size("low")).alias("counted"))
    shared = _shared_tokens(sketches).groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("shared"))
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    alone = F.col("counted") - F.size("shared")
    found = attach(shared, sizes, ["sid"], "inner").withColumn("left", (length - alone).cast("int")).where("left > 0")
    return found.select("sid", F.slice("shared.token", F.lit(1), F.col("left")).alias("tokens"))


def _meetings(prefixes: DataFrame) -> DataFrame:
    """(token, sid, center): the sets that share a prefix token, and the smallest of them."""
    rows = prefixes.select("sid", F.explode("tokens").alias("token"))
    centers = rows.groupBy("token").agg(F.min("sid").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    return attach(rows, centers, ["token"], "inner")


def _shared_counts(lists: list[np.ndarray]) -> np.ndarray:
    """Number of tokens that each two of the lists share."""
    m = len(lists)
    owner = np.repeat(np.arange(m), [len(x) for x in lists])
    tokens = np.concatenate(lists)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    out = np.zeros((m, m), np.float32)
    for at in range(0, int(often.sum()), SLAB):
        lo, hi = np.searchsorted(column, (at, at + SLAB))
        table = np.zeros((m, SLAB), np.float32)
        table[owner[lo:hi], column[lo:hi] - at] = 1
        out += table @ table.T
    return out.astype(np.int64)


def _prefix_under(tokens: np.ndarray, factor: int, percent: int) -> np.ndarray:
    """The prefix of a set under an order by hash, as hashes."""
    ranks = mixed(tokens.view(np.uint64) * np.uint64(factor))
    length = prefix_length(len(tokens), percent)
    return np.partition(ranks, length - 1)[:length] if length < len(ranks) else ranks


def candidates(size: np.ndarray, sides: np.ndarray, parts: np.ndarray, prefix: Callable[[int, int], np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a cell may link: those of fitting sizes whose prefixes share enough tokens under every order.

    ``sides``: 0 and 1 for the two blocks that are compared, all 2 if a block is compared with itself.
    ``parts``: the components that the sets are already known to be in; pairs within one are not looked at.
    ``prefix`` gives that of a set under the order of a number.
    """
    wanted = (parts[:, None] != parts[None, :]) & ((sides[:, None] != sides[None, :]) | (sides[:, None] == 2))
    wanted &= 100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size)
    for order in range(len(ORDERS)):
        live = np.flatnonzero(wanted.any(1))
        if not len(live):
            break
        lists = [np.sort(prefix(int(i), order)) for i in live]
        shared, own = _shared_counts(lists), size[live]
        # Below the smaller of two last ranks both prefixes are whole; at most all the rest is shared besides. Ranks
        # may be cut short: a set's tokens of one rank are counted once in ``shared``.
        last = np.array([x[-1] for x in lists])
        rest = own[:, None] - np.stack([np.searchsorted(x, np.minimum(last, x[-1])) for x in lists])
        alike = np.array([len(x) - len(np.unique(x)) for x in lists])
        most = shared + np.minimum(rest, rest.T) + np.minimum.outer(alike, alike)
        wanted[np.ix_(live, live)] &= (100 + percent) * most >= percent * np.add.outer(own, own)
    return wanted


def links_among(sets: list[np.ndarray], sides: np.ndarray, parts: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A tree of links for each component among the sets; see `candidates`."""
    size = np.array([len(s) for s in sets], np.int64)
    wanted = candidates(size, sides, parts, lambda i, order: _prefix_under(sets[i], ORDERS[order], percent), percent)
    live = np.flatnonzero(wanted.any(1))
    if not len(live):
        return []
    shared = _shared_counts([sets[i] for i in live])
    union = size[live][:, None] + size[live][None, :] - shared
    linked = wanted[np.ix_(live, live)] & (100 * shared >= percent * union)
    root = np.arange(len(live))
    found = []
    for i in range(len(live)):
        if root[i] != i:
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]):
                if int(j) not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        for j in seen:
            root[j] = i
            if j != i:
                found.append((int(live[i]), int(live[j])))
    return found


def _linker(percent: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            table = table.combine_chunks()
            cell = table.column("cell").to_numpy()
            part, side = (table.column(c).to_numpy() for c in ("part", "side"))
            tokens = table.column("tokens").chunk(0) if table.num_rows else None
            if tokens is None:
                continue
            values, offsets = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            edges = np.flatnonzero(np.diff(cell)) + 1
            a, b = [], []
            for lo, hi in zip(np.append(0, edges), np.append(edges, len(cell))):
                if hi - lo > 1:
                    sets = [values[offsets[i] : offsets[i + 1]] for i in range(lo, hi)]
                    for i, j in links_among(sets, side[lo:hi], part[lo:hi], percent):
                        a.append(part[lo + i])
                        b.append(part[lo + j])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return link


def _sieve(percent: int):
    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows (cell, part, side, sid, size and prefixes) those that have a candidate in their cell."""
        for table in whole_groups(batches, "cell"):
            if not table.num_rows:
                continue
            table = table.combine_chunks()
            cell, part, side, size = (table.column(c).to_numpy() for c in ("cell", "part", "side", "size"))
            lists = [table.column(c).chunk(0) for c in PREFIXES]
            values, offsets = [x.values.to_numpy() for x in lists], [x.offsets.to_numpy() for x in lists]
            edges = np.flatnonzero(np.diff(cell)) + 1
            kept = []
            for lo, hi in zip(np.append(0, edges), np.append(edges, len(cell))):
                if hi - lo > 1:
                    prefix = lambda i, k, lo=lo: values[k][offsets[k][lo + i] : offsets[k][lo + i + 1]].view(np.uint32)
                    kept.append(lo + np.flatnonzero(candidates(size[lo:hi], side[lo:hi], part[lo:hi], prefix, percent).any(1)))
            kept = pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64))
            yield from table.select(["sid", "cell", "part", "side"]).take(kept).combine_chunks().to_batches()

    return sieve


CELLS = "array<struct<cell: bigint, part: bigint, side: int>>"


def _place(*block: str) -> Column:
    """Where a set is compared: the cell, named by its group and two blocks, the set's part and its side."""
    return F.struct(F.xxhash64("center", *block).alias("cell"), F.col("part").alias("part"), F.col("side").cast("int").alias("side"))


def _cells(members: DataFrame) -> DataFrame:
    """(sid, cells): where each set is first compared, from the members (center, sid, part) of groups.

    A group beyond ``BLOCK`` members is dealt to blocks, and each is compared with itself. Four of its members
    are put in all of its blocks, so that copies in several blocks come to one component. A group of one
    has nothing to compare: its set has no cell there.
    """
    drawn = F.xxhash64("sid")
    common = F.array(F.min("sid"), F.max("sid"), F.min_by("sid", drawn), F.max_by("sid", drawn)).alias("common")
    blocks = F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    sizes = members.groupBy("center").agg(blocks, (F.count("*") > 1).alias("several"), common)
    own = F.array(F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    every = F.when(F.array_contains("common", F.col("sid")), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)
    rows = attach(members, sizes, ["center"], "inner").withColumn("block", F.explode(every))
    place = F.when(F.col("several"), _place("block", "block"))
    return rows.withColumn("side", F.lit(2)).groupBy("sid").agg(F.collect_list(place).alias("cells"))


def _cells_across(members: DataFrame, percent: int) -> DataFrame:
    """(sid, cells): as `_cells`, but all blocks of a group that may hold links are compared, for members with
    their ``size``.

    Sets of a block have sizes of one step, each step so wide that linked sets are at most one apart. A part
    that fills half a block has blocks of its own; two blocks of one part have nothing to find.
    """
    step = F.floor(F.log("size") / (math.log(100 / percent) * (1 + 1e-9))) if percent < 100 else F.col("size")
    rows = members.withColumn("step", step.cast("long"))
    parts = rows.groupBy("center", "step", "part").agg(F.when(F.count("*") >= BLOCK // 2, F.first("part")).alias("own"))
    rows = attach(rows, parts, ["center", "step", "part"], "inner")
    totals = rows.groupBy("center", "step", "own").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = attach(rows, totals, ["center", "step", "own"], "inner")
    block = F.struct("step", "own", F.pmod(F.xxhash64("sid"), F.col("blocks")).alias("nth"))
    rows = rows.select("center", "sid", "part", block.alias("block"))
    blocks = stage(rows.select("center", "block").distinct(), "jaccard-blocks")
    pairs = blocks.join(blocks.select("center", F.col("block").alias("other")), "center").where(
        (F.abs(F.col("block.step") - F.col("other.step")) <= 1) & ~F.coalesce(F.col("block.own") == F.col("other.own"), F.lit(False))
    )
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    placed = attach(rows, pairs.groupBy("center", "block").agg(F.collect_list("other").alias("others")), ["center", "block"], "inner")
    placed = placed.withColumn("other", F.explode("others")).withColumn("side", side)
    placed = placed.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return placed.groupBy("sid").agg(F.collect_list(_place("low", "high")).alias("cells"))


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): trees of links between the parts of the sets (cells, tokens) that are in one cell."""
    rows = sets.select("tokens", F.explode("cells").alias("at")).select("at.*", "tokens")
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_linker(percent), "a long, b long")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written once with ``__row``, a number that no other row has."""
    return stage(docs.withColumn("__row", F.monotonically_increasing_id()), "jaccard-rows")


def _components(rows: DataFrame, key: str, n: int, percent: int, unique: bool) -> DataFrame:
    """(__row, __key, n, component) of rows: ``component`` is the smallest set that a row's set reaches.

    ``__row`` names a row, or, if not ``unique``, its text, of which one row is then read again.
    """
    spark, kind, name = rows.sparkSession, rows.schema[key].dataType.simpleString(), rows.schema["__row"].dataType.simpleString()
    texts = rows.select("__row", F.col(key).alias("__key"), F.col("text").cast("binary").alias("__text"))
    full = stage(texts.mapInArrow(_sketch(n, percent), f"__row {name}, __key {kind}, n long, sid long, low array<long>"), "jaccard-sketches")
    prefixes = stage(_prefixes(full.where("n > 0"), percent), "jaccard-prefixes")
    sketches = stage(full.drop("low"), "jaccard-sizes")
    unstage(full)
    some = sketches.where("n > 0")
    meetings = stage(_meetings(prefixes), "jaccard-meetings")
    release(spark)

    # First every set in the group of its smallest center.
    home = meetings.groupBy("sid").agg(F.min("center").alias("center"))
    once = home.unionByName(home.select(F.col("center").alias("sid"), "center")).distinct()
    cells = _cells(once.withColumn("part", F.col("sid")))
    # One row stands for all that have the same set.
    named = some.groupBy("sid").agg(F.min("__row").alias("__row"))
    wanted = stage(attach(cells, named, ["sid"], "inner"), "jaccard-cells")
    texts = sifted(texts.drop("__key"), wanted, "__row")
    if not unique:  # each task passes on one copy of a text
        copy = F.row_number().over(Window.partitionBy("__row").orderBy("__row"))
        texts = texts.withColumn("__copy", copy).where("__copy = 1").drop("__copy")
    wanted = texts.join(wanted.hint("merge"), "__row").select("sid", "cells", "__text")
    layout = f"sid long, cells {CELLS}, size long, second array<int>, third array<int>, tokens array<long>"
    sets = stage(wanted.mapInArrow(_full(n, percent), layout), "jaccard-sets")
    found = stage(_links(sets, percent), "jaccard-links")
    release(spark)

    # Then the sets of tokens that are still in several components, unless one group has had them all.
    parts = stage(components(found), "jaccard-components")
    sized = attach(home, home.groupBy("center").agg(F.count("*").alias("members")), ["center"], "inner")
    homes = sized.select("sid", F.col("center").alias("home"), (F.col("members") < BLOCK).alias("whole"))
    placed = attach(attach(meetings, homes, ["sid"], "inner"), parts.select(F.col("node").alias("sid"), "component"), ["sid"])
    placed = placed.withColumn("part", F.coalesce("component", "sid")).drop("component")
    # A center was compared in its own group besides its home.
    guest = F.when(F.col("sid") == F.col("center"), F.col("center")).otherwise(F.col("home"))
    split = placed.groupBy("token").agg(
        F.min("part").alias("least"),
        F.max("part").alias("most"),
        ((F.min("home") == F.max("home")) | (F.min(guest) == F.max(guest))).alias("together"),
        F.min("whole").alias("whole"),
    )
    split = split.where("least < most AND NOT (together AND whole)")
    left = attach(placed, split.select("token"), ["token"], "semi").select("center", "sid", "part").distinct()
    left = attach(stage(left, "jaccard-left"), sets.select("sid", "size"), ["sid"], "inner")
    # Their prefixes tell which of them have a candidate at all; only those are fetched whole.
    across = stage(_cells_across(left, percent), "jaccard-across")
    light = attach(sifted(sets.select("sid", "size", *PREFIXES), across, "sid"), across, ["sid"], "inner", alike=True)
    light = light.select("sid", "size", *PREFIXES, F.explode("cells").alias("at")).select("at.*", "sid", "size", *PREFIXES)
    light = light.repartition("cell").sortWithinPartitions("cell")
    chosen = stage(light.mapInArrow(_sieve(percent), "sid long, cell long, part long, side int"), "jaccard-candidates")
    chosen = stage(chosen.groupBy("sid").agg(F.collect_list(F.struct("cell", "part", "side")).alias("cells")), "jaccard-chosen")
    again = attach(sifted(sets.select("sid", "tokens"), chosen, "sid"), chosen, ["sid"], "inner", alike=True)
    more = stage(_links(again, percent), "jaccard-links")
    parts = stage(joined(parts, more), "jaccard-components")
    unstage(sets)
    release(spark)

    named = attach(sketches.select("__row", "__key", "n", "sid"), parts.select(F.col("node").alias("sid"), "component"), ["sid"])
    return named.select("__row", "__key", "n", F.coalesce("component", "sid").alias("component"))


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_shingles, and component_id, the smallest key that it reaches by links.

    Documents link when their sets of distinct runs of ``n`` words (A to Z lowered) share ``percent`` or
    more of their union. A shorter text is one run; a null or empty one has none and is linked with
    nothing, and its component_id is its own key. A null key is never the smallest; documents that only
    reach null keys have a null component_id. Rows that repeat are documents of their own, with equal
    results. An empty table gives no rows. Columns other than key and text are not looked at.
    """
    name = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    named = _components(docs.select(key, "text", name.alias("__row")), key, n, percent, unique=False)
    lowest = named.where("n > 0").groupBy("component").agg(F.min("__key").alias("lowest"))
    result = attach(named, lowest, ["component"])
    component = F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("__key"))
    return result.select(F.col("__key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def first_of_groups(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """One document of each group, with all columns: that of the smallest key, null last, and of equal keys
    the first row. Rows whose text is null or empty are in no group and all stay.
    """
    rows = _numbered(docs)
    placed = _components(rows, key, n, percent, unique=True).where("n > 0")
    order = F.struct(F.col("__key").isNull().alias("none"), "__key", "__row")
    firsts = placed.groupBy("component").agg(F.min(order)["__row"].alias("__first"))
    dropped = attach(placed, firsts, ["component"], "inner").where("__row <> __first").select("__row")
    return attach(rows, dropped, ["__row"], "anti", alike=True).select(*docs.columns)
