"""Column profiles, each in one pass over the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.running import chunked, exact_quantile, upto


def as_rows(one_row: DataFrame, columns: list[str], name: str, measures: dict[str, dict[str, str]]) -> DataFrame:
    """Turn a one-row frame of per-column measures into one row per column.

    ``measures``: output name -> {column: name in the one-row frame}.
    """
    cells = [
        F.struct(F.lit(c).alias(name), *[F.col(at[c]).alias(m) for m, at in measures.items()])
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)])
    return as_rows(row, columns, "column", {"n_null": {c: f"n_{i}" for i, c in enumerate(columns)}})


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values of every column.

    All columns in one pass: the planner groups by (column, value), with the
    values in their own types and reduced before the shuffle, and counts the
    groups, so no task holds all values of one column.
    """
    row = df.agg(*[F.count_distinct(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)])
    return as_rows(row, columns, "column", {"n_distinct": {c: f"n_{i}" for i, c in enumerate(columns)}})


def type_profile(df: DataFrame) -> DataFrame:
    """Per column: kind (text, number, other) and distinct values."""
    def kind(t: T.DataType) -> str:
        if isinstance(t, T.StringType):
            return "text"
        return "number" if isinstance(t, T.NumericType) else "other"

    kinds = {f.name: kind(f.dataType) for f in df.schema.fields}
    out = distinct_counts(df, df.columns)
    label = reduce(
        lambda acc, c: F.when(F.col("column") == c, F.lit(kinds[c])).otherwise(acc),
        df.columns, F.lit(None).cast("string"),
    )
    return out.withColumn("kind", label)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def group_risk(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Per value of every column: mean target, difference and ratio to the mean of all rows."""
    groups = long_form(df, columns, [target]).groupBy("feature", "value").agg(F.avg(target).alias("mean"))
    # every row is in one group of any one column: the mean of all follows from it
    one = df.groupBy(columns[0]).agg(F.sum(F.col(target).cast("double")).alias("_s"), F.count(target).alias("_n"))
    mean = one.agg(F.sum("_s") / F.sum("_n")).scalar()
    return groups.withColumns({"diff": F.col("mean") - mean, "risk": F.try_divide(F.col("mean"), mean)})


def long_form(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """One row per (row, column): feature name and value as text."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def mutual_information(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Mutual information (natural log) of each column with a label.

    From counts alone: n MI = S(xy) - S(x) - S(y) + n ln n with S = sum of
    c ln c over the counts c.  The label takes part as one more feature, whose
    S(x) is the S(y) of all others, so the data is read once.
    """
    own = "\0label"
    named = df.select(*columns, label, F.col(label).cast("string").alias(own))
    cells = long_form(named, [*columns, own], [label]).groupBy("feature", "value", label).agg(
        F.count(F.lit(1)).alias("c")
    )
    s = lambda c: F.sum(F.col(c) * F.ln(c))
    values = cells.groupBy("feature", "value").agg(F.sum("c").alias("x"), s("c").alias("sxy"))
    # One row per feature from here on.
    sums = values.groupBy("feature").agg(F.sum("x").alias("n"), F.sum("sxy").alias("sxy"), s("x").alias("sx"))
    sy = F.max(F.when(F.col("feature") == own, F.col("sx"))).over(Window.partitionBy(F.lit(0)))
    mi = (F.col("sxy") - F.col("sx") - F.col("sy")) / F.col("n") + F.ln("n")
    return sums.withColumn("sy", sy).filter(F.col("feature") != own).select("feature", mi.alias("mi"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    at = lambda a, b: F.col(f"`{a}|{b}`") if (a, b) in pairs else F.col(f"`{b}|{a}`")
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), at(a, b).alias("corr"))
        for a in columns for b in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def equi_width_histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Rows per equal slice of [min, max]; the maximum belongs to the last slice."""
    rows = df.select(F.col(column).cast("double").alias("_v")).filter("_v is not null")
    span = rows.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high")).alias("span")).scalar()
    width = F.nullif(span["high"] - span["low"], F.lit(0.0))
    slot = F.floor((F.col("_v") - span["low"]) * F.lit(bins) / width)
    slot = F.coalesce(F.least(slot + 1, F.lit(bins)), F.lit(1)).cast("int")
    return rows.groupBy(slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
    )


def equi_height_histogram(df: DataFrame, column: str, steps: int, chunk: Column) -> DataFrame:
    """At most ``steps`` steps of about equal row counts.

    Equal values stay in one step: value v belongs to step
    ``ceil(steps * rows up to v / all rows)``.  ``chunk`` is a monotone
    function of ``column`` that bounds what one task orders.
    """
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    )
    # the total is carried along with the running sum, so the data is not read for it again
    whole = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    got = chunked(
        counts, [], chunk, [F.col(column)],
        local={"_in": lambda w: F.sum("_n").over(upto(w))}, summary={"_sum": F.sum("_n")},
        carry={"_before": lambda w: F.sum("_sum").over(upto(w)) - F.col("_sum"), "_total": lambda w: F.sum("_sum").over(whole(w))},
    )
    step = F.ceil((F.col("_in") + F.col("_before")) * F.lit(steps) / F.col("_total")).cast("int")
    out = got.withColumn("step", step).groupBy("step").agg(
        F.max(column).alias("range_hi"),
        F.max_by("_n", column).alias("eq_rows"),
        F.sum("_n").alias("_rows"),
        (F.count(F.lit(1)) - 1).alias("distinct_range"),
    )
    return out.select("step", "range_hi", "eq_rows", (F.col("_rows") - F.col("eq_rows")).alias("range_rows"),
                      "distinct_range")


def range_borders(
    borders: DataFrame, fn: str, value: str, low: Column, high: Column, chunk: Column,
    on_right: Column | None = None,
) -> DataFrame:
    """Left and right border of every range of each function, numbered from 1.

    Each distinct border closes one range; a last range runs from the greatest
    border to ``high``.  ``on_right``: the border value itself belongs to the
    range on its right.
    """
    right = F.lit(False) if on_right is None else on_right
    points = borders.groupBy(fn, value).agg(F.bool_or(right).alias("_right"))
    got = chunked(
        points, [fn], chunk, [F.col(value)],
        local={"_rn": lambda w: F.row_number().over(w), "_lag": lambda w: F.lag(value).over(w)},
        summary={"_n": F.count(F.lit(1)), "_last": F.max(value)},
        carry={
            "_before": lambda w: F.sum("_n").over(upto(w)) - F.col("_n"),
            "_prev": lambda w: F.lag("_last").over(w),
        },
    )
    ranges = got.select(
        fn,
        F.coalesce("_lag", "_prev", low).alias("left_border"),
        F.col(value).alias("right_border"),
        (F.col("_rn") + F.col("_before")).cast("long").alias("number"),
        F.col("_right").alias("include_left"),
        (~F.col("_right")).alias("include_right"),
    )
    closing = points.groupBy(fn).agg(F.max(value).alias("left_border"), F.count(F.lit(1)).alias("_n"))
    return ranges.unionByName(closing.select(
        fn, "left_border", high.alias("right_border"), (F.col("_n") + 1).alias("number"),
        F.lit(False).alias("include_left"), F.lit(True).alias("include_right"),
    ))


def alignment(ranges: DataFrame) -> DataFrame:
    """Per range number: functions that have it and distinct left borders."""
    return ranges.groupBy("number").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("left_border").alias("n_borders")
    )


def last_aligned(ranges: DataFrame, fn: str, name: str) -> DataFrame:
    """Range of one function just before the first number whose borders differ.

    No row if all numbers are aligned, or if none is.
    """
    last = alignment(ranges).filter("n_borders > 1").agg(F.min("number") - 1).scalar()
    return ranges.filter((F.col(fn) == name) & (F.col("number") == last))


def segment_minmax(df: DataFrame, segment: list[Column], columns: list[str]) -> DataFrame:
    """Rows and value range of every column per segment, one pass and one row per (segment, column)."""
    measures = [m for i, c in enumerate(columns) for m in (F.min(c).alias(f"_a{i}"), F.max(c).alias(f"_b{i}"))]
    wide = df.groupBy(*segment).agg(F.count(F.lit(1)).alias("n_rows"), *measures)
    keys = [c for c in wide.columns if not c.startswith(("_a", "_b")) and c != "n_rows"]
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"_a{i}").cast("double").alias("min_value"),
                 F.col(f"_b{i}").cast("double").alias("max_value"))
        for i, c in enumerate(columns)
    ]
    return wide.select(*keys, "n_rows", F.inline(F.array(*cells)))


def history_stats(df: DataFrame, run: str, step: str, value: str, first: int, last: int, chunk: Column) -> DataFrame:
    """Mean, sample deviation and median of a metric history per run, and the mean of a step slice.

    ``chunk`` is a monotone function of ``value`` (for the median).
    """
    inside = F.when(F.col(step).between(first, last), F.col(value))
    stats = df.groupBy(run).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.avg(inside).alias("slice_mean")
    )
    middle = exact_quantile(df, [run], value, chunk).select(F.col(run).alias("_run"), "median")
    return stats.join(middle, F.col(run).eqNullSafe(F.col("_run")), "left").drop("_run")
