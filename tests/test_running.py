"""Chunked scans against plain windows and Python, with hot and null keys."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import profile
from millrace.operators.running import (
    best_so_far, exact_quantile, previous_value, row_numbers, running_max_before, running_sum, slice_chunk, width_chunk,
)


def frame(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(None if rng.random() < 0.1 else ("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 9)}"), i, rng.randint(0, 200),
             None if rng.random() < 0.1 else rng.randint(-50, 50)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, id long, t int, v int")


@pytest.mark.parametrize("per_slice", [7, 100, 10**6])
def test_running_values_equal_windows(spark, per_slice):
    df = frame(spark)
    chunk, order = slice_chunk(df, "t", per_slice), [F.col("t"), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("id", F.row_number().over(w).alias("rn"), F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("s"),
                     F.max("v").over(before).alias("m"))
    got = row_numbers(df, ["k"], chunk, order).select("id", "rn")
    got = got.join(running_sum(df, ["k"], chunk, order, F.coalesce("v", F.lit(0)), "s").select("id", "s"), "id")
    got = got.join(running_max_before(df, ["k"], chunk, order, "v", "m").select("id", "m"), "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_slices_grow_with_rows(spark):
    df = frame(spark)
    n = lambda per: df.select(slice_chunk(df, "t", per).alias("c")).distinct().count()
    assert n(10**6) <= 2 and 5 <= n(100) <= 8


def test_no_keys(spark):
    df = frame(spark).select("id")
    got = row_numbers(df, [], width_chunk(F.col("id"), 50), [F.col("id")]).orderBy("id").collect()
    assert [r.rn for r in got] == list(range(1, 601))


def test_best_so_far(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([3, None, 3, 5, 4, 6])], "run string, epoch int, v int")
    for width in (1, 2, 100):
        got = best_so_far(df, ["run"], width_chunk(F.col("epoch"), width), [F.col("epoch")], "v").orderBy("epoch").collect()
        assert [r.is_best for r in got] == [True, False, False, True, False, True]


def test_previous_value(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 9)] + [("b", 4)], "fn string, v int")
    got = previous_value(df, ["fn"], width_chunk(F.col("v"), 4), "v", F.lit(-2147483648), "left_border")
    assert sorted((r.fn, r.left_border, r.v) for r in got.collect()) == [
        ("a", -2147483648, 1), ("a", 1, 5), ("a", 5, 9), ("b", -2147483648, 4)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-30, 30)), min_size=1, max_size=60), st.sampled_from([0.25, 0.5, 0.9]))
def test_quantile(spark, rows, q):
    import numpy as np

    df = spark.createDataFrame(rows, "k string, v int")
    got = {r.k: r.median for r in exact_quantile(df, ["k"], "v", width_chunk(F.col("v"), 5), q).collect()}
    want = {k: float(np.quantile([v for kk, v in rows if kk == k], q)) for k in {r[0] for r in rows}}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=80), st.integers(1, 12))
def test_equi_height_totals(spark, values, steps):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = profile.equi_height_histogram(df, "v", steps, width_chunk(F.col("v"), 7)).orderBy("step").collect()
    assert len(got) <= steps
    assert sum(r.eq_rows + r.range_rows for r in got) == len(values)
    assert sum(r.distinct_range + 1 for r in got) == len(set(values))
    highs = [r.range_hi for r in got]
    assert highs == sorted(highs) and highs[-1] == max(values)
    assert [r.eq_rows for r in got] == [values.count(h) for h in highs]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=80))
def test_equi_width_totals(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    got = profile.equi_width_histogram(df, "v", 10).collect()
    assert sum(r.n for r in got) == len(values)
    assert all(1 <= r.bin <= 10 for r in got)
    assert max(r.high for r in got) == max(values)


def test_range_borders_cover_the_line(spark):
    df = spark.createDataFrame([("f", v) for v in (10, 20, 20, 35)] + [("g", 7)], "fn string, v int")
    got = profile.range_borders(df, "fn", "v", F.lit(-100), F.lit(100), width_chunk(F.col("v"), 8)).orderBy("fn", "number").collect()
    f = [(r.left_border, r.right_border, r.number) for r in got if r.fn == "f"]
    assert f == [(-100, 10, 1), (10, 20, 2), (20, 35, 3), (35, 100, 4)]
    assert [(r.left_border, r.right_border) for r in got if r.fn == "g"] == [(-100, 7), (7, 100)]
    assert all(not r.include_left and r.include_right for r in got)


def test_alignment(spark):
    rows = [("f", 0, 1), ("f", 5, 2), ("f", 9, 3), ("g", 0, 1), ("g", 5, 2), ("g", 8, 3)]
    ranges = spark.createDataFrame(rows, "fn string, left_border int, number long")
    assert [tuple(r) for r in profile.last_aligned(ranges, "fn", "f").collect()] == [("f", 5, 2)]
    same = ranges.filter("number < 3")
    assert profile.last_aligned(same, "fn", "f").collect() == []


@pytest.mark.parametrize("odd", [10**9, -10**9])
def test_an_outlier_does_not_undo_the_slices(spark, odd):
    rows = [("hot" if i % 3 else f"k{i % 50}", i, i) for i in range(6000)] + [("hot", 6000, odd)]
    df = spark.createDataFrame(rows, "k string, id long, t long")
    chunk = slice_chunk(df, "t", 250)
    sizes = [r.n for r in df.groupBy(chunk.alias("c")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 20 and max(sizes) <= 3 * 6001 / len(sizes)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("id", F.row_number().over(w).alias("rn"))
    got = row_numbers(df, ["k"], chunk, [F.col("t"), F.col("id")]).select("id", "rn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
