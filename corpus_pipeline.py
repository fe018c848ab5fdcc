"""A corpus from documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, jaccard, langid, mixing, sharding
from strata.llm.common import read, ship
from strata.session import stage

#: Least posterior probability of a document's language.
CERTAIN = 0.5

SHARDS = 24


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known: neither without letters nor uncertain.

    The model is fitted on the documents that name their language. Null and empty texts and those without a
    letter go; rows that repeat are judged alike; without any named language nothing is known and all go.
    """
    ship(spark)
    found = langid.with_language(docs, langid.fit(docs), lang="__lang", score="__score")
    return found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= CERTAIN)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest doc_id, of each group with similar word 5-grams.

    A null doc_id comes last, and of rows that repeat a doc_id the first stays. Null and empty texts are in
    no group and all stay; a text of fewer than five words is one run.
    """
    ship(spark)
    return jaccard.first_of_groups(docs, n=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no item of the benchmark, each row judged by itself.

    Null and empty texts hold none; without a benchmark all stay.
    """
    ship(spark)
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples the documents so that sources meet their weights, by a seeded order of doc_ids.

    Null sources form one source; null and empty texts have no words and come along with whole repetitions.
    """
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each document, by its doc_id; null ones and rows that repeat one go together."""
    return sharding.with_shard(docs, sharding.tree(SHARDS))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Language, similarity search and index are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
