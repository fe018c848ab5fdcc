"""Look-back windows over ordered series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from strata.functions.numeric import rnd
from strata.operators.clean import null_safe_join
from strata.operators.rollup import AGGREGATES, Spec, rounded
from strata.session import stage

OverSeries = Callable[[WindowSpec], Column]


def look_back(
    df: DataFrame,
    by: list[str],
    order: list[str],
    rows: int,
    exprs: dict[str, OverSeries],
    chunk: Column | None = None,
    coarser: Column | None = None,
) -> DataFrame:
    """Add ``exprs`` over the series of each ``by`` group, none of which looks back over ``rows`` rows.

    With ``chunk``, a value that never falls along ``order`` (such as the month), a long series is cut
    up so that no task holds a whole one. Inside a chunk all rows but the first ``rows`` have their
    full frame. Those first ones are worked out again among the first and last ``rows`` rows of the
    series' chunks: every row that such a frame reaches is one of these. Frames stay counted in rows,
    so the result is that of one window over the whole series. Where chunks are many, ``coarser``, a
    value that joins successive chunks, cuts the rows at their edges up in the same way.
    """
    series = Window.partitionBy(*by).orderBy(*order)
    if chunk is None:
        return df.withColumns({alias: fn(series) for alias, fn in exprs.items()})
    cut = df.withColumn("_chunk", chunk)
    whole = Window.partitionBy(*by, "_chunk")
    local = whole.orderBy(*order)
    placed = cut.withColumns({"_at": F.row_number().over(local), "_len": F.count(F.lit(1)).over(whole)})
    inner = placed.withColumns({alias: fn(local) for alias, fn in exprs.items()}).filter(F.col("_at") > rows)
    edges = placed.filter((F.col("_at") <= rows) | (F.col("_len") - F.col("_at") < rows))
    # The mark of a head needs a name of its own where the edges of edges are cut up.
    mark = "_head" + "_" * sum(c.startswith("_head") for c in df.columns)
    edges = edges.withColumn(mark, F.col("_at") <= rows).drop("_chunk", "_at", "_len")
    heads = look_back(edges, by, order, rows, exprs, coarser).filter(mark).drop(mark)
    return inner.drop("_chunk", "_at", "_len").unionByName(heads)


def even_chunks(df: DataFrame, by: list[str], order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` with a column ``_part`` to cut its series at, ``chunks`` in all or as many as the bytes ask for.

    For series of any distribution, also where one moment holds much of the table: Spark samples the
    rows and ranges them by series and order, so only rows equal in both stay together. The ranges are
    fixed by writing them, since a second sample would cut elsewhere. Parts rise along each series.
    """
    ranges = [chunks] if chunks else []
    ranged = df.repartitionByRange(*ranges, *by, *order).withColumn("_part", F.spark_partition_id())
    return stage(ranged, "chunks")


def rolling(
    df: DataFrame,
    by: list[str],
    order: list[str],
    n: int | float,
    specs: Spec,
    chunk: Column | None = None,
    frame: str = "rows",
) -> DataFrame:
    """Aggregates over the last ``n`` rows up to and including each row.

    With ``frame="range"``, over the rows of the last ``n`` units of ``order``, one column of numbers, dates (in
    days) or timestamps (in seconds), as `rolling_range` tells.
    """
    if frame not in ("rows", "range"):
        raise ValueError(f"frame is 'rows' or 'range', not {frame!r}")
    if frame == "range":
        if len(order) != 1 or chunk is not None:
            raise ValueError("a range has one order column and cuts its series itself")
        return rolling_range(df, by, order[0], n, specs)

    def framed(fn: str, col: str, digits: int | None) -> OverSeries:
        return lambda w: rounded(AGGREGATES[fn](col).over(w.rowsBetween(1 - n, 0)), digits)

    return look_back(df, by, order, n - 1, {alias: framed(*spec) for alias, spec in specs.items()}, chunk)


def change_pct(col: str, digits: int) -> OverSeries:
    """Change to the previous row in percent; null on the first row and after a zero."""

    def over(w: WindowSpec) -> Column:
        before = F.lag(col).over(w)
        return rnd(F.try_divide(F.col(col) - before, before) * 100, digits)

    return over


def bands(df: DataFrame, avg: str, sd: str, k: float, digits: int, upper: str, lower: str) -> DataFrame:
    """Bands ``k`` deviations around a mean, both taken as already rounded."""
    return df.withColumns(
        {
            upper: rnd(F.col(avg) + k * F.col(sd), digits),
            lower: rnd(F.col(avg) - k * F.col(sd), digits),
        }
    )


def flags(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Add boolean columns; a null input gives a null flag."""
    return df.withColumns({name: test.cast("boolean") for name, test in tests.items()})


#: Units of order that a chunk of a series spans, in widths of the frame.
CHUNK_WIDTHS = 16


def rolling_range(df: DataFrame, by: list[str], at: str, width: int | float, specs: Spec) -> DataFrame:
    """Aggregates over the rows of a series from ``width`` units before each row's ``at`` up to it.

    Rows of the same moment have the same frame, so they are first put together, which bounds what one
    moment weighs however many rows it has. The moments of a series are cut at multiples of ``CHUNK_WIDTHS``
    widths; those within a width of the end of a chunk are copied into the next one, found by their value,
    so that every frame is whole in its chunk and no task holds a whole series. A gap leaves frames
    with fewer rows. Rows without a moment have each other as their frame, null series are series of their own.
    """
    kind = dict(df.dtypes)[at]
    point = {"date": F.unix_date, "timestamp": F.unix_micros}.get(kind, F.col)(at)
    span = int(width * 1_000_000) if kind == "timestamp" else width
    length = span * CHUNK_WIDTHS or 1
    columns = list(dict.fromkeys(col for _, col, _ in specs.values()))
    parts = {}
    for i, c in enumerate(columns):
        v = F.col(c)
        parts |= {f"_n{i}": F.count(v), f"_sum{i}": F.sum(v), f"_min{i}": F.min(v), f"_max{i}": F.max(v)}
        if any(fn == "stddev" for fn, col, _ in specs.values() if col == c):
            parts |= {f"_mean{i}": F.avg(v), f"_sq{i}": F.var_pop(v) * F.count(v)}
    moments = df.withColumn("_at", point).groupBy(*by, "_at").agg(*[e.alias(k) for k, e in parts.items()])
    own = F.floor(F.col("_at") / F.lit(length))
    near_end = F.col("_at") >= (own + 1) * F.lit(length) - F.lit(span)
    copies = moments.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.when(near_end, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    chunk = Window.partitionBy(*by, "_chunk")
    frame = chunk.orderBy("_at").rangeBetween(-span, 0)
    framed = {}
    for alias, (fn, col, digits) in specs.items():
        i = columns.index(col)
        n, total = F.sum(f"_n{i}").over(frame), F.sum(f"_sum{i}").over(frame)
        if fn == "count":
            value = n
        elif fn == "sum":
            value = total
        elif fn == "avg":
            value = F.try_divide(total, n)
        elif fn in ("min", "max"):
            value = AGGREGATES[fn](f"_{fn}{i}").over(frame)
        else:  # squares are taken around the mean of the chunk, so that little is lost by subtracting
            centre = F.try_divide(F.sum(f"_sum{i}").over(chunk), F.sum(f"_n{i}").over(chunk))
            off = F.col(f"_mean{i}") - centre
            squares = F.sum(F.col(f"_sq{i}") + F.col(f"_n{i}") * off * off).over(frame)
            shift = F.try_divide(total, n) - centre
            value = F.sqrt(F.greatest(F.when(n > 1, (squares - n * shift * shift) / (n - 1)), F.lit(0.0)))
            value = F.when(n > 1, value)
        framed[alias] = rounded(value, digits)
    whole = copies.withColumns(framed).filter(F.col("_chunk").eqNullSafe(F.col("_own"))).select(*by, "_at", *specs)
    return null_safe_join(df.withColumn("_at", point), whole, [*by, "_at"], "left").drop("_at")
