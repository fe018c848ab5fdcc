"""Exact deduplication by distributed most-significant-digit radix partitioning.

All texts start in one group. Each round splits every group by the next digits of its texts: first by
their length and first bytes, then by following blocks of bytes. A text that is alone in its group is
done; a group whose texts have ended holds equal texts. Blocks grow from round to round, so that long
texts need few rounds, while few texts are left to be read. Texts are told apart by their bytes alone;
no digest decides.

A group may hold a third of all rows: rows are counted per group and block with partial sums, and the
group's number is joined back, never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, attach
from strata.session import stage

#: Bytes of the first block, its growth per round, and the most bytes of a block.
FIRST_BLOCK, GROWTH, LARGEST_BLOCK = 64, 8, 8 << 20


def without_space(text: str = "text") -> Column:
    """The text without blanks and control characters of spacing; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"[{SPACE}]+", "")


def equal_groups(rows: DataFrame) -> DataFrame:
    """(rid, gid) of all rows that are not alone; ``rows`` holds rid, bytes (long) and norm (binary).

    gid is the smallest rid of the group.
    """
    spark = rows.sparkSession
    live = rows.select("rid", F.lit(0).cast("long").alias("gid"), "bytes", "norm")
    ended, at, block = [], 0, FIRST_BLOCK
    while True:
        digits = F.substring("norm", at + 1, block)
        cut = live.withColumn("block", digits)
        shared = cut.groupBy("gid", "bytes", "block").agg(F.min("rid").alias("new_gid"), F.count("*").alias("n"))
        shared = shared.where("n > 1").drop("n")
        live = stage(
            attach(cut, shared, ["gid", "bytes", "block"], "inner").select("rid", F.col("new_gid").alias("gid"), "bytes", "norm"),
            "radix-live",
        )
        at += block
        block = min(block * GROWTH, LARGEST_BLOCK)
        ended.append(live.where(F.col("bytes") <= at).select("rid", "gid"))
        live = live.where(F.col("bytes") > at)
        if live.isEmpty():
            break
    found = spark.createDataFrame([], "rid long, gid long")
    for part in ended:
        found = found.unionByName(part)
    return found


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without spacing; a null text counts as empty. Of equal
    texts the row with the most code points stays, then the smallest doc_id (null last), then, among
    rows that repeat it, the one read first. An empty table gives no rows. Other columns are not
    looked at. ``text_sha256`` is the digest of the text without spacing and decides nothing.
    """
    norm = without_space()
    rows = stage(
        docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("points"), norm.alias("norm")).select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            "points",
            F.octet_length("norm").cast("long").alias("bytes"),
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.col("norm").cast("binary").alias("norm"),
        ),
        "radix-rows",
    )
    groups = stage(equal_groups(rows), "radix-groups")
    slim = rows.drop("norm", "bytes")
    members = attach(slim, groups, ["rid"]).withColumn("grouped", F.col("gid").isNotNull())
    members = stage(members.withColumn("gid", F.coalesce("gid", "rid")), "radix-members")
    first = F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))).alias("stays")
    winners = members.where("grouped").groupBy("gid").agg(first, F.count("*").alias("size"))
    winners = winners.select("gid", F.col("stays.doc_id").alias("keep_id"), F.col("stays.rid").alias("keep_rid"), "size")
    return attach(members, winners, ["gid"]).select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_rid", "rid") == F.col("rid")).alias("kept"),
        "text_sha256",
    )
