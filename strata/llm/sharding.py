"""Sharding by a hierarchical tree of weighted hash draws.

A document descends the tree of regions, racks and shards. At each node every child draws an
exponential variate from a hash of the document's key and the child's name, divided by the child's
weight; the smallest draw wins. A child is thus chosen in proportion to its weight, and when a weight
changes only documents that the changed child wins or loses move: all movement stays within the
subtrees whose weights changed. A new shard opens a region of its own (`grow`), so it competes at the
top of the tree and takes documents only into itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import attach
from strata.session import stage

#: Rows that are put in order together when slots are numbered.
SLOT_ROWS = 1000


@dataclass(frozen=True)
class Node:
    """A shard (``shard`` given) or a group of nodes, which weighs the sum of its children."""

    name: str
    weight: float = 0.0
    shard: int | None = None
    children: tuple[Node, ...] = field(default=())

    @property
    def mass(self) -> float:
        return self.weight if self.shard is not None else sum(c.mass for c in self.children)


def tree(shards: int, racks: int = 3, per_rack: int = 4) -> Node:
    """Shards 0 to ``shards`` - 1 of weight 1, filling racks and regions in order."""
    leaves = [Node(f"s{i}", 1.0, i) for i in range(shards)]
    rows = [Node(f"k{i // per_rack}", children=tuple(leaves[i : i + per_rack])) for i in range(0, shards, per_rack)]
    return Node("", children=tuple(Node(f"r{i // racks}", children=tuple(rows[i : i + racks])) for i in range(0, len(rows), racks)))


def grow(root: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, alone in a new region and rack."""
    new = sum(1 for _ in _leaves(root))
    rack = Node(f"k+{new}", children=(Node(f"s{new}", weight, new),))
    return Node(root.name, children=(*root.children, Node(f"r+{new}", children=(rack,))))


def _leaves(node: Node):
    if node.shard is not None:
        yield node
    for child in node.children:
        yield from _leaves(child)


def _draw(key: Column, path: str, weight: float) -> Column:
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11) + 1) / F.lit(float(2**53))
    return -F.log(uniform) / F.lit(weight)


def descend(rows: DataFrame, root: Node, key: Column, out: str) -> DataFrame:
    """Adds ``out``, the number of the shard that the key falls into: one column of draws per level."""
    level, at = [("", root)], None
    steps = []
    while any(node.shard is None for _, node in level):
        below, step = [], None
        for i, (path, node) in enumerate(level):
            first = len(below)
            children = [(f"{path}/{c.name}", c) for c in node.children if c.mass > 0] or [(path, node)]
            below += children
            if len(children) == 1:
                pick = F.lit(first)
            else:
                draws = [F.struct(_draw(key, p, c.mass).alias("draw"), F.lit(first + j).alias("child")) for j, (p, c) in enumerate(children)]
                pick = F.array_min(F.array(*draws))["child"]
            if at is None:
                step = pick
            else:
                step = F.when(F.col(at) == i, pick) if step is None else step.when(F.col(at) == i, pick)
        at = f"__{out}{len(steps)}"
        steps.append(at)
        rows = rows.withColumn(at, step)
        level = below
    numbers = F.array(*[F.lit(node.shard) for _, node in level])
    return rows.withColumn(out, numbers[F.col(at)] if at else F.lit(level[0][1].shard)).drop(*steps)


def with_shard(docs: DataFrame, root: Node, out: str = "shard", key: str = "doc_id") -> DataFrame:
    """Adds ``out``, the shard of each row, which its key and the tree alone decide.

    A null key counts as an empty one; rows of equal keys go together, whatever their texts. All columns
    are kept, an earlier ``out`` is replaced, and an empty table gives no rows.
    """
    return descend(docs, root, F.coalesce(F.col(key).cast("string"), F.lit("")), out)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``slot``, which counts the rows of each ``shard`` from 0 without gaps.

    No shard is put in order as a whole: its rows are dealt by hash to slices of about ``SLOT_ROWS``
    rows, counted per slice, and numbered within it from the count of the slices before.
    """
    total = rows.count()
    slices = max(1, math.ceil(total / (SLOT_ROWS * max(1, rows.select("shard").distinct().count()))))
    sliced = rows.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    before = Window.partitionBy("shard").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("shard", "__slice").agg(F.count("*").alias("__n"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    within = Window.partitionBy("shard", "__slice").orderBy(*order)
    placed = sliced.withColumn("__place", F.row_number().over(within) - 1)
    return attach(placed, starts, ["shard", "__slice"]).withColumn("slot", (F.col("__start") + F.col("__place")).cast("long")).drop(
        "__slice", "__place", "__start"
    )


def assign(docs: DataFrame, root: Node | None = None) -> DataFrame:
    """Where each document goes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: doc_id and the tree alone decide, so equal texts with different ids may part.
    A null doc_id counts as an empty key; a null text has no bytes and checksum 0. Rows that repeat a
    doc_id share a shard and get a slot each. An empty table gives no rows. Other columns are not
    looked at.
    """
    root = root or tree(24)
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = stage(with_shard(with_shard(slim, root), grow(root), "grown_shard"), "sharded")
    return numbered(placed, ["doc_id", "size", "text_crc32"])


def write_shards(docs: DataFrame, path: str, root: Node | None = None) -> None:
    """Writes the documents to one folder per shard; a large shard gets several files."""
    root = root or tree(24)
    with_shard(docs, root).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
