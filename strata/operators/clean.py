"""Range filters, deduplication, medians, imputation and schema enforcement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 10_000

#: Most groups whose brackets, some hundred bytes each, are sent to all tasks.
MOST_GROUPS = 50_000
Bounds = tuple[float | None, float | None]


def in_range(col: str, lo: float | None, hi: float | None) -> Column:
    """Closed range test; NaN is outside, null stays null."""
    c = F.col(col)
    tests = []
    if lo is not None:
        tests.append(c >= lo)
    if hi is not None:
        tests.append(c <= hi)
    else:
        tests.append(~F.isnan(c.cast("double")) | c.isNull())  # NaN sorts above every number
    return reduce(Column.__and__, tests)


def range_filter(df: DataFrame, bounds: dict[str, Bounds], null_policy: str = "drop") -> DataFrame:
    """Rows inside all bounds. Nulls are dropped, or with ``null_policy="keep"`` left for imputing."""
    if null_policy not in ("drop", "keep"):
        raise ValueError(f"null_policy is 'drop' or 'keep', not {null_policy!r}")
    for col, (lo, hi) in bounds.items():
        test = in_range(col, lo, hi)
        df = df.filter(test | F.col(col).isNull() if null_policy == "keep" else test)
    return df


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter((F.col(col) > 0) & ~F.isnan(F.col(col).cast("double")))


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in ``order``; make the order total to get the same row on each run.

    Spark limits each key to one row per task before the shuffle, so a key with very many copies
    sends few rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group in ``order``, limited per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def approx_quantiles(
    df: DataFrame, cols: list[str], q: float = 0.5, by: list[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """A value of each column whose rank is within ``1/accuracy`` of ``q``; one row per group."""
    return df.groupBy(*by).agg(*[F.percentile_approx(c, q, accuracy).alias(c) for c in cols])


def exact_quantiles(
    df: DataFrame, cols: list[str], q: float = 0.5, by: list[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The smallest value of each column that at least a share ``q`` of the non-null values reach.

    First a sketch brackets the value, leaving a share of about ``8/accuracy`` of a group. Then the
    values in the bracket are counted per cell, of ``CELLS`` equal ones, to find the cell with the
    wanted rank; and only the values of that cell are put in order. A sketch that missed raises an error
    rather than give a wrong value. One row per group with any value; columns as named. The groups are
    counted first: up to ``MOST_GROUPS`` their brackets are broadcast.
    """
    by = list(by)
    margin = 4 / accuracy
    lo_q, hi_q = max(q - margin, 0.0), min(q + margin, 1.0)
    values = df.select(
        *by, F.inline(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in cols]))
    ).filter(F.col("_v").isNotNull())
    group = [*by, "_col"]
    sketch = values.groupBy(*group).agg(
        F.percentile_approx("_v", F.array(F.lit(lo_q), F.lit(hi_q)), accuracy).alias("_b"),
        F.count(F.lit(1)).alias("_n"),
    )
    if by:  # few groups' brackets go to the values, which then need no shuffle to meet them
        few = df.select(*by).distinct().limit(MOST_GROUPS + 1).count() <= MOST_GROUPS
        bracketed = null_safe_join(values, F.broadcast(sketch) if few else sketch, group)
    else:  # one entry per column: read as a scalar, so the values need no shuffle to meet it
        entry = F.struct("_col", F.struct("_b", "_n"))
        lookup = sketch.agg(F.map_from_entries(F.collect_list(entry))).scalar()
        bracketed = values.withColumn("_s", lookup[F.col("_col")]).select("*", "_s._b", "_s._n")
    lo, hi = F.col("_b")[0], F.col("_b")[1]
    inside = F.floor(F.coalesce(F.try_divide(F.col("_v") - lo, hi - lo), F.lit(0.0)) * CELLS)
    below = F.col("_v") < lo
    counted = (
        bracketed.filter(F.col("_v") <= hi)
        .groupBy(
            *group,
            F.greatest(F.ceil(F.col("_n") * F.lit(q)), F.lit(1)).alias("_need"),
            F.when(below, F.lit(-1)).otherwise(inside).alias("_cell"),
            F.when(~below, F.col("_v")).alias("_at"),
        )
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    rising = Window.partitionBy(*group)
    reached = F.col("_upto") >= F.col("_need")
    cells = (
        counted.groupBy(*group, "_need", "_cell")
        .agg(F.sum("_c").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(rising.orderBy("_cell")))
        .groupBy(*group)
        .agg(F.min(F.when(reached, F.struct("_cell", (F.col("_upto") - F.col("_in")).alias("_before")))).alias("_hit"))
    )
    missed = F.raise_error(F.lit("quantile sketch missed its bracket; raise accuracy")).cast("bigint")
    cells = cells.select(
        *group,
        F.when(F.coalesce(F.col("_hit._cell"), F.lit(-1)) < 0, missed).otherwise(F.col("_hit._cell")).alias("_cell"),
        F.col("_hit._before").alias("_before"),
    )
    found = (
        null_safe_join(counted, cells, [*group, "_cell"])
        .withColumn("_upto", F.col("_before") + F.sum("_c").over(rising.orderBy("_at")))
        .filter(reached)
    )
    picked = [F.min(F.when(F.col("_col") == c, F.col("_at"))).alias(c) for c in cols]
    return found.groupBy(*by).agg(*picked)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, nulls being equal; the keys are those of ``left``."""
    same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    extra = [f"r.{c}" for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *extra)


def impute(
    df: DataFrame, defaults: dict[str, float], medians: DataFrame | None = None, by: list[str] = ()
) -> DataFrame:
    """Fill nulls from ``medians``, then from ``defaults``.

    Without ``by`` the medians are one row, read as a scalar subquery; with ``by`` they are joined, a null group to its own.
    """
    by = list(by)
    if medians is None:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()})
    known = [c for c in medians.columns if c not in by]
    fill = F.struct(*[F.col(c) for c in known])
    if by:
        df = null_safe_join(df, medians.select(*by, fill.alias("_fill")), by, "left")
    else:
        df = df.withColumn("_fill", medians.select(fill).scalar())
    filled = {}
    for c in dict.fromkeys([*known, *defaults]):
        parts = [F.col(c)]
        if c in known:
            parts.append(F.col(f"_fill.{c}"))
        if c in defaults:
            parts.append(F.lit(defaults[c]))
        filled[c] = F.coalesce(*parts)
    return df.withColumns(filled).drop("_fill")


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Cast to ``schema`` in its column order; returns the good rows and the rejected ones.

    A value that does not fit its type becomes null. A row lacking a value in a not-null column is
    rejected as it came in, with the names of those columns in ``rejected``.
    """
    fields = [f for f in schema.fields]
    cast = {
        f.name: F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        for f in fields
    }
    required = [f.name for f in fields if not f.nullable]
    lacking = F.filter(
        F.array(*[F.when(cast[c].isNull(), F.lit(c)) for c in required]) if required else F.array().cast("array<string>"),
        lambda name: name.isNotNull(),
    )
    checked = df.withColumn("rejected", lacking)
    good = checked.filter(F.size("rejected") == 0).select(*[c.alias(n) for n, c in cast.items()])
    return good, checked.filter(F.size("rejected") > 0)
