"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lowered, every run of other characters than letters becomes one blank, and the n-grams of one
to three characters are hashed to buckets. Training counts buckets per language, summed within each task
before the shuffle, over all rows given. The log-probabilities form one matrix of buckets by languages,
whose size is bounded and checked; it is broadcast, and a batch of texts is scored as a sparse
matrix product: rows of the matrix are gathered by bucket and added up per text.

Log-probabilities are kept as integers, so that a sum does not depend on how texts are cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 15
ORDERS = 3
SMOOTHING = 0.5
UNKNOWN = "und"

#: Most cells of the matrix that is broadcast.
LARGEST_MODEL = 1 << 26

#: Units of a log-probability.
SCALE = 1 << 16

#: Characters that are scored at once.
BLOCK = 1 << 19

#: Fixed odd multipliers of the hash.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cleaned characters and the number of the text that each belongs to, in blocks of bounded size.

    Every piece ends with blanks as long as the longest n-gram. A long text is cut to pieces that
    overlap by the characters an n-gram at the end of a piece reaches into the next.
    """
    letters = _letters()
    chars: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters[points]
        if not is_letter.any():
            continue
        points = np.where(is_letter, points, np.uint32(32))
        inside = is_letter.copy()
        inside[1:] |= is_letter[:-1]
        points = np.concatenate((np.array([32], np.uint32), points[inside]))
        for start in range(0, len(points), BLOCK):
            piece = points[start : start + BLOCK + ORDERS - 1]
            chars.append(np.concatenate((piece, np.full(ORDERS, 32, np.uint32))))
            # The overlap and the blanks begin no n-gram of this piece.
            own = np.full(len(chars[-1]), -1, np.int64)
            own[: min(BLOCK, len(points) - start)] = i
            owners.append(own)
            size += len(own)
            if size >= BLOCK:
                yield np.concatenate(chars), np.concatenate(owners)
                chars, owners, size = [], [], 0
    if chars:
        yield np.concatenate(chars), np.concatenate(owners)


def _buckets(chars: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram of ``order`` characters that begins at each place but the last ones."""
    n = len(chars) - ORDERS
    value = np.full(n, order, np.uint32) * np.uint32(MULTIPLIERS[-1])
    for k in range(order):
        value = (value ^ chars[k : k + n]) * np.uint32(MULTIPLIERS[k])
        value ^= value >> np.uint32(15)
    return (value & np.uint32(BUCKETS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, bucket, n) of a task; bucket -1 counts texts."""
    counts: dict[str, np.ndarray] = {}
    texts_of: dict[str, int] = {}
    for batch in batches:
        langs, texts = (batch.column(c).to_pylist() for c in ("lang", "text"))
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs) if x == lang]
            total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            texts_of[lang] = texts_of.get(lang, 0) + len(own)
            for chars, owners in _blocks(own):
                begins = owners[: len(chars) - ORDERS] >= 0
                for order in range(1, ORDERS + 1):
                    total += np.bincount(_buckets(chars, order)[begins], minlength=BUCKETS)
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * (len(at) + 1), pa.string()),
                "bucket": pa.array(np.append(at, -1).astype(np.int32)),
                "n": pa.array(np.append(total[at], texts_of[lang])),
            }
        )


@dataclass
class Model:
    """``weights`` has a row per bucket and one of zeros, a column per language."""

    langs: list[str]
    weights: np.ndarray
    priors: np.ndarray


def fit(rows: DataFrame) -> Model:
    """The model of all rows (text, lang) with a lang; rows of null text count for the priors alone."""
    named = rows.where("lang IS NOT NULL")
    # Told before counting: a task holds the counts of every language it meets.
    known = named.select("lang").distinct().count()
    if known * BUCKETS > LARGEST_MODEL:
        raise ValueError(f"{known} languages make a matrix of more than {LARGEST_MODEL} cells")
    counted = named.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    column = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((BUCKETS + 1, len(langs)))
    where = np.array([column[x] for x in table["lang"].to_pylist()], np.int64)
    counts[table["bucket"].to_numpy(), where] = table["n"].to_numpy()
    texts, grams = counts[BUCKETS].copy(), counts[:BUCKETS]
    logs = np.log(grams + SMOOTHING) - np.log(grams.sum(0) + SMOOTHING * BUCKETS)
    weights = np.zeros((BUCKETS + 1, len(langs)), np.int32)
    weights[:BUCKETS] = np.rint(logs * SCALE)
    return Model(langs, weights, np.rint(np.log(texts / max(1, texts.sum())) * SCALE).astype(np.int64))


def score(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text."""
    totals = np.zeros((len(texts), len(model.langs)), np.int64)
    seen = np.zeros(len(texts), bool)
    for chars, owners in _blocks(texts) if model.langs else ():
        owners = owners[: len(chars) - ORDERS]
        starts = np.flatnonzero(np.diff(owners, prepend=-2))
        of = owners[starts]
        seen[of[of >= 0]] = True
        for order in range(1, ORDERS + 1):
            buckets = np.where(owners >= 0, _buckets(chars, order), BUCKETS)
            sums = np.add.reduceat(model.weights[buckets], starts, axis=0, dtype=np.int64)
            np.add.at(totals, of[of >= 0], sums[of >= 0])
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if seen.any():
        logs = (totals[seen] + model.priors) / SCALE
        best = logs.argmax(1)
        scores[seen] = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
        for i, b in zip(np.flatnonzero(seen), best):
            names[i] = model.langs[b]
    return names, scores


def predictor(spark: SparkSession, model: Model):
    """A function of a text column: struct of lang and score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, certainty = score(texts.where(texts.notna(), None).tolist(), shared.value)
            yield pd.DataFrame({"lang": pd.Series(lang, dtype=object), "score": certainty})

    return predict


def with_language(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the language of each whole text and its posterior probability, from 0 to 1.

    A null text, a text without a letter, and every text under a model that has seen no row get
    ``und`` and 0. Ties go to the language first in order. Rows that repeat get equal results, and an
    empty table gives no rows. All columns of ``docs`` are kept; ``lang`` and ``score`` name the new ones.
    """
    predict = predictor(docs.sparkSession, model)
    found = docs.withColumn("__found", predict(F.col(text)))
    kept = [F.col(c) for c in docs.columns if c not in (lang, score)]
    return found.select(*kept, F.col("__found.lang").alias(lang), F.col("__found.score").alias(score))
