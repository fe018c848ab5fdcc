"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import attach
from strata.session import stage


def _lowest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with ``low``, the smallest of a and its neighbours b."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    return attach(edges, low, ["a"], "inner").withColumn("low", F.least("low", "a"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (a, b) is either a root b, or an a with one root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return nodes.agg(F.count(F.when((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0)), 1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); a component is named by its smallest node.

    Alternates two steps: every node hands its larger neighbours to its smallest one, then its smaller
    ones, until only stars are left. Neither gathers a node's neighbours, so hubs do no harm; the number
    of rounds grows with the logarithm of the longest path. Null ends and loops are left out.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "components")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _lowest(both).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = _lowest(stage(large.distinct(), "components"))
        small = small.select("a", F.explode(F.array("a", "b")).alias("c"), "low").where("c <> low")
        edges = stage(small.select(F.col("c").alias("a"), F.col("low").alias("b")).distinct(), "components")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of ``parts`` after ``links`` (a, b) between components; these may be new ones."""
    merged = stage(components(links), "components").select(F.col("node").alias("component"), F.col("component").alias("named"))
    renamed = attach(parts, merged, ["component"]).select("node", F.coalesce("named", "component").alias("component"))
    known = parts.select(F.col("component")).distinct()
    new = attach(merged, known, ["component"], "anti").select(F.col("component").alias("node"), F.col("named").alias("component"))
    return renamed.unionByName(new)
