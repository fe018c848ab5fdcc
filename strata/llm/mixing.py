"""Mixing of sources to target weights by capped water-filling.

Every source has a weight and a cap, its size times the most epochs it may be repeated. The words to
take are shared out by weight; a source whose share exceeds its cap is clamped to it, and the excess is
shared by weight among the others until none is above. The clamped sources are those with the smallest
cap per weight, so one ordered pass over the sources (a running sum) finds the level at which the rest
stand, without repeated rounds.

A source's target becomes whole repetitions of all its documents and a fractional one: documents in
the order of a seeded hash, each whole, up to the target; the document at the end is taken in part, so
that the words taken meet the target to within half a word. The order needs no sort of a source: sums
per slice of the hash range tell in which slice the target falls, and only that slice is put in order.

Built of DataFrame functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACE, attach
from strata.session import stage

#: Sources up to this number are sent to all executors; beyond it they are joined by shuffle.
BROADCAST_SOURCES = 10_000

#: Slices of the hash range; only one slice of a source is ever put in order.
SLICES = 4096


def word_count(text: str = "text") -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1 to ``cycle``, repeating, for sources by code point, null last. One row per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))


def water_fill(sources: DataFrame, epochs: int = 3, share: float = 1.0) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size, weight).

    ``share`` of all sizes is handed out. A source of size 0 gets 0.
    """
    cap = F.col("source_size") * F.lit(float(epochs))
    everything = Window.partitionBy()
    rising = Window.orderBy("__fill", F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        sources.withColumn("__cap", cap)
        .withColumn("__fill", F.col("__cap") / F.col("weight"))
        .withColumn("__all", F.sum(F.col("source_size").cast("double")).over(everything) * F.lit(float(share)))
        .withColumn("__weights", F.sum("weight").over(everything))
        .withColumn("__left", F.col("__all") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
        .withColumn("__open", F.col("__weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("__level", F.col("__left") / F.col("__open"))
        .withColumn("__full", F.col("__fill") <= F.col("__level"))
        .withColumn("__final", F.max(F.when(~F.col("__full"), F.col("__level"))).over(everything))
    )
    target = F.when(F.col("__full"), F.col("__cap")).otherwise(F.col("weight") * F.col("__final"))
    return filled.withColumn("target", target).drop(*[c for c in filled.columns if c.startswith("__")])


def _plans(sized: DataFrame, targets: DataFrame, epochs: int) -> DataFrame:
    """Per source: whole repetitions, and the slice and words at which the fractional one ends."""
    whole = F.when(F.col("source_size") == 0, 0).otherwise(
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs))
    )
    wanted = targets.withColumn("whole", whole.cast("long")).withColumn(
        "part", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    )
    sums = sized.groupBy("source", "slice").agg(F.sum("size").alias("__sum"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = attach(sums.withColumn("__upto", F.sum("__sum").over(running)), wanted.select("source", "part"), ["source"], "inner")
    last = (
        ends.where((F.col("part") > F.col("__upto") - F.col("__sum")) & (F.col("part") <= F.col("__upto")))
        .groupBy("source")
        .agg(F.min("slice").alias("end_slice"), F.min(F.col("part") - F.col("__upto") + F.col("__sum")).alias("end_part"))
    )
    return attach(wanted, last, ["source"])


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """Adds size, draw, slice, and a tie that tells texts of one doc_id and size apart."""
    seeded = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    slice_of = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") / F.lit(2**32 // SLICES)).cast("int")
    sized = docs.withColumn("size", word_count()).withColumn("tie", F.xxhash64("text"))
    return sized.withColumn("draw", seeded).withColumn("slice", slice_of)


def _plan(sized: DataFrame, weights: DataFrame | None, epochs: int, share: float) -> DataFrame:
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = cyclic_weights(sources) if weights is None else attach(sources, weights.select("source", "weight"), ["source"], "inner")
    return stage(_plans(sized, water_fill(sources, epochs, share), epochs), "mix-plans")


def _extra(sized: DataFrame, plans: DataFrame) -> DataFrame:
    """Adds the plan of each row's source, and ``extra``, the words it gives to the fractional repetition."""
    small = plans.count() <= BROADCAST_SOURCES
    rows = attach(sized, F.broadcast(plans) if small else plans, ["source"], "inner")
    at_end = F.coalesce(F.col("slice") == F.col("end_slice"), F.lit(False))
    none = F.lit(0).cast("long")
    whole = F.when(F.coalesce(F.col("slice") < F.col("end_slice"), F.lit(False)), F.col("size")).otherwise(none)
    order = Window.partitionBy("source").orderBy("draw", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("size").over(order) - F.col("size")
    ending = rows.where(at_end).withColumn("extra", F.greatest(none, F.least(F.col("size"), F.col("end_part") - before)))
    return rows.where(~at_end).withColumn("extra", whole).unionByName(ending)


def mix(docs: DataFrame, weights: DataFrame | None = None, epochs: int = 3, share: float = 1.0, seed: int = 17) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, source, size, source_size, target (its source's), taken. ``weights`` has one row
    (source, weight) for each source; without it they weigh 1, 2, 3, repeating. A null text has size 0;
    null sources form one source. Rows that share a doc_id share a place in the seeded order. An empty
    table gives no rows. Other columns of ``docs`` are not looked at.
    """
    sized = stage(_sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sized")
    rows = _extra(sized, _plan(sized, weights, epochs, share))
    taken = (F.col("whole") * F.col("size") + F.col("extra")).alias("taken")
    return rows.select("doc_id", "source", "size", "source_size", "target", taken)


def mixed_documents(
    docs: DataFrame, weights: DataFrame | None = None, epochs: int = 3, share: float = 1.0, seed: int = 17
) -> DataFrame:
    """The mix itself: every document as often as `mix` takes it, with all its columns and its whole text.

    The document at the end of a source's fractional repetition stays if at least half of it is taken. Null
    and empty texts are taken as often as their source is repeated in whole. Rows that repeat are documents
    of their own, in a fixed order among rows of one doc_id; null sources form one source, and rows without
    doc_id share a place in the order. An empty table gives no rows.
    """
    held = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "source", "text")
    sized = stage(_sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sized")
    rows = _extra(_sized(held, seed).drop("text"), _plan(sized, weights, epochs, share))
    once_more = (F.col("slice") < F.col("end_slice")) | ((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")))
    copies = F.col("whole") + F.coalesce(once_more, F.lit(False)).cast("int")
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select("__row.*")
