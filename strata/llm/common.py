"""What several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.bits import LARGEST, bit_pages, bit_set, page_of, place_of

PACKAGE = __name__.split(".")[0]
ARCHIVE = f"{PACKAGE}.zip"

#: The characters that separate words, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, also where it is not installed on the executors."""
    context = spark.sparkContext
    if ARCHIVE not in context._python_includes:
        root = Path(__file__).resolve().parents[2]
        path = Path(tempfile.mkdtemp(prefix="strata-package-")) / ARCHIVE
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for module in sorted((root / PACKAGE).rglob("*.py")):
                archive.write(module, module.relative_to(root))
        context.addPyFile(str(path))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Lets steps that run inside hand at most ``rows`` rows to Python at once, as whole texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; 0 for a null key."""
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(parts)).cast("int")


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "left", alike: bool = False) -> DataFrame:
    """``rows`` with the columns of ``facts``, which holds one row for each value of ``keys``.

    A key may hold a third of ``rows``. Both sides are shuffled for this join alone, as no earlier
    partitioning fits null-safe keys; so adaptive execution can split a heavy partition of ``rows``
    and give each piece its copy of the one fact. Null keys match each other. ``alike`` plans the same
    join at every size, where Spark would broadcast facts that happen to be few.
    """
    renamed = facts.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in facts.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    renamed = renamed.hint("merge") if alike else renamed
    return rows.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def sifted(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``, a staged table of distinct keys.

    Done ahead of a join with ``wanted``, so that rows it drops are not shuffled. The keys set bits, eight or
    more for each key up to ``bits.LARGEST`` in all, which go to all tasks; that size is the bound of
    the broadcast. Where so many bits tell too little, ``rows`` come back as they are.
    """
    n = wanted.count()
    bits = min(1 << max(15, (8 * n).bit_length()), LARGEST)
    if 2 * n > bits:
        return rows
    hashed = F.pmod(F.xxhash64(key), F.lit(bits)).cast("long")
    table = F.broadcast(bit_pages(wanted, hashed))
    paged = rows.withColumn("_page", page_of(hashed)).join(table, "_page")
    return paged.where(bit_set(F.col("_bits"), place_of(hashed))).select(*rows.columns)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches in which equal values of ``key``, a long, lie together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        if held and keys[0] == held[-1].column(key)[-1].as_py() and keys[-1] == keys[0]:
            held.append(batch)
            continue
        # The last group may go on in the next batch.
        cut = int(np.argmax(keys == keys[-1]))
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Polynomial hashes, modulo 2^64, of all substrings of some bytes from the hashes of its prefixes."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers, self.inverse = _powers(n + 1)
        self.upto = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.upto[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.upto[start + length] - self.upto[start]) * self.inverse[start]

    def all_of(self, length: int) -> np.ndarray:
        """Hashes of the substrings of one length at every place that has one."""
        n = len(self.upto) - length
        return (self.upto[length:] - self.upto[:n]) * self.inverse[:n] if n > 0 else np.zeros(0, np.uint64)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the life of the worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[:] = [_power_table(b, size) for b in (PrefixHash.BASE, pow(PrefixHash.BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def _power_table(base: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    done, factor = 1, base
    while done < size:
        out[done : 2 * done] = out[:done] * np.uint64(factor)
        factor = factor * factor % (1 << 64)
        done *= 2
    return out
