"""Ordered computations over groups too large for one task.

A plain window puts a whole group into one task.  Here the caller also names a
*chunk*: a monotone function of the leading order column (a day of a time, a
slice of a number, the first digits of a hash).  Windows run inside
(group, chunk); one summary row per (group, chunk) is carried along the chunks
and joined back.  Only the summaries of a group meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.expressions import clock_seconds
from millrace.session import scratch_path

OverWindow = Callable[[WindowSpec], Column]

#: Pieces of a column's range that slices follow.
SLICE_POINTS = 64


def chunked(
    df: DataFrame,
    keys: list[str],
    chunk: Column,
    order: list[Column],
    local: dict[str, OverWindow],
    summary: dict[str, Column],
    carry: dict[str, OverWindow],
) -> DataFrame:
    """``df`` plus the ``local`` and ``carry`` columns.

    ``local`` is evaluated in (keys, chunk) by ``order``; ``summary`` are
    aggregates of one (keys, chunk); ``carry`` is evaluated over the summaries
    of a key in chunk order.  Null keys form a group, as in a window.
    """
    # Structs compare null fields as equal, so null keys and chunks join too.
    group, part = F.struct(F.lit(0).alias("g"), *keys), F.struct(chunk.alias("c"))
    named = df.withColumns({"_group": group, "_part": part})
    inside = Window.partitionBy("_group", "_part").orderBy(*order)
    along = Window.partitionBy("_group").orderBy("_part")

    rows = named.select("*", *[f(inside).alias(n) for n, f in local.items()])
    sums = named.groupBy("_group", "_part").agg(*[c.alias(n) for n, c in summary.items()])
    carried = sums.select("_group", "_part", *[f(along).alias(n) for n, f in carry.items()])
    return rows.join(carried, ["_group", "_part"]).drop("_group", "_part")


def before(window: WindowSpec) -> WindowSpec:
    """All earlier rows, without the current one."""
    return window.rowsBetween(Window.unboundedPreceding, -1)


def upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def hash_chunk(digest: Column, digits: int = 4) -> Column:
    """First hex digits: 16 ** digits chunks of about equal size."""
    return F.substring(digest, 1, digits)


def width_chunk(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width))


def slice_chunk(df: DataFrame, column: str, rows_per_slice: int = 1_000_000) -> Column:
    """Slices of a column's range with about equal rows, as many as the row count asks for.

    Small frames get one slice, so the scan is a plain window there; on large
    ones a key that holds most of the rows is spread over many slices.  Borders
    follow SLICE_POINTS approximate quantiles, taken in one pass at once, and are
    even in between: an outlier stretches one of these pieces, not all.
    """
    kind = df.schema[column].dataType.simpleString()
    if kind == "timestamp_ntz":
        place = clock_seconds
    elif kind == "timestamp":
        place = F.unix_micros
    elif kind == "date":
        place = F.unix_date
    else:
        place = lambda c: c
    at = place(F.col(column)).cast("double")
    points = F.percentile_approx(at, [i / SLICE_POINTS for i in range(SLICE_POINTS + 1)])
    # what reaches the driver: a count and SLICE_POINTS + 1 numbers
    n, q = df.agg(F.count(F.lit(1)), points).first()
    slices = -(-n // rows_per_slice)
    known = F.col(column).isNotNull()
    if slices <= 1 or q is None:
        return F.when(known, F.lit(0).cast("long"))

    def spot(low: int, high: int) -> Column:
        """Place of the value among the points low..high, by halving."""
        if high - low > 1:
            middle = (low + high) // 2
            return F.when(at < F.lit(q[middle]), spot(low, middle)).otherwise(spot(middle, high))
        inside = (at - F.lit(q[low])) / F.lit(q[high] - q[low]) if q[high] > q[low] else F.lit(0.0)
        return F.lit(float(low)) + F.greatest(F.lit(0.0), F.least(inside, F.lit(1 - 1e-9)))

    return F.when(known, F.floor(spot(0, SLICE_POINTS) * F.lit(slices / SLICE_POINTS)))


def range_chunks(df: DataFrame, order: list[Column], rows_per_chunk: int = 1_000_000, out: str = "_chunk") -> DataFrame:
    """``df`` with the number of the range of ``order`` that a row falls in, about equal rows each.

    Where slices of one column keep rows of one value together, ranges over all
    order columns, a tie-break among them, part these as well: half of all rows
    may have one time.  The ranges are written to the shared folder, so that
    all passes over them see the same borders.  Small frames are one range and
    not written.
    """
    parts = -(-df.count() // rows_per_chunk)
    if parts <= 1:
        return df.withColumn(out, F.lit(0))
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(parts, *order).withColumn(out, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def running_sum(df, keys, chunk, order, value: Column, out: str) -> DataFrame:
    """Inclusive running sum; ``order`` must be total for equal results on every run."""
    got = chunked(
        df, keys, chunk, order,
        local={"_in": lambda w: F.sum(value).over(upto(w))},
        summary={"_sum": F.sum(value)},
        carry={"_before": lambda w: F.coalesce(F.sum("_sum").over(before(w)), F.lit(0))},
    )
    return got.withColumn(out, F.col("_in") + F.col("_before")).drop("_in", "_before")


def row_numbers(df, keys, chunk, order, out: str = "rn") -> DataFrame:
    return running_sum(df, keys, chunk, order, F.lit(1).cast("long"), out)


def running_max_before(df, keys, chunk, order, value: str, out: str) -> DataFrame:
    """Maximum over all earlier rows, null on the first."""
    got = chunked(
        df, keys, chunk, order,
        local={"_in": lambda w: F.max(value).over(before(w))},
        summary={"_max": F.max(value)},
        carry={"_before": lambda w: F.max("_max").over(before(w))},
    )
    return got.withColumn(out, F.greatest("_in", "_before")).drop("_in", "_before")


def best_so_far(df, keys, chunk, order, value: str, out: str = "is_best") -> DataFrame:
    """True where ``value`` beats every earlier value of its key."""
    got = running_max_before(df, keys, chunk, order, value, "_prev")
    better = F.col(value).isNotNull() & (F.col("_prev").isNull() | (F.col(value) > F.col("_prev")))
    return got.withColumn(out, better).drop("_prev")


def previous_value(df, keys, chunk, order_by: str, default: Column, out: str) -> DataFrame:
    """LAG(order_by, 1, default) in the order of that same column."""
    got = chunked(
        df, keys, chunk, [F.col(order_by)],
        local={"_in": lambda w: F.lag(order_by).over(w), "_first": lambda w: F.row_number().over(w) == 1},
        summary={"_last": F.max(order_by)},
        carry={"_before": lambda w: F.lag("_last", 1).over(w)},
    )
    value = F.when(F.col("_first"), F.coalesce(F.col("_before"), default)).otherwise(F.col("_in"))
    return got.withColumn(out, value).drop("_in", "_first", "_before")


def exact_quantile(df, keys, value: str, chunk: Column, q: float = 0.5, out: str = "median") -> DataFrame:
    """Linear-interpolated quantile of each key, from counted values.

    Equal values are counted before anything is ordered, so neither a hot key
    nor a hot value reaches one task as rows.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    got = running_sum(counts, keys, chunk, [F.col(value)], F.col("_n"), "_upto")
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    # Keys join as structs so that a null key keeps its row.
    key = F.struct(F.lit(0).alias("g"), *keys).alias("_key")
    got = got.select("*", key).join(totals.select(key, "_total"), "_key")
    spot = (F.col("_total") - 1) * F.lit(q)
    low, high = F.floor(spot) + 1, F.ceil(spot) + 1
    holds = lambda pos: (F.col("_upto") >= pos) & (F.col("_upto") - F.col("_n") < pos)
    share = F.max(spot - F.floor(spot))
    v_low, v_high = F.max(F.when(holds(low), F.col(value))), F.max(F.when(holds(high), F.col(value)))
    return (
        got.filter(holds(low) | holds(high))
        .groupBy(*keys)
        .agg((v_low + (v_high - v_low) * share).alias(out))
    )
