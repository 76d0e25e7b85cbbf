"""Hot keys, hot order values and long files: even shares, equal results."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.joins import hot_keys, spread_joins
from millrace.operators.running import best_so_far, previous_value, range_chunks, row_numbers
from millrace.plans import telemetry
from millrace.sources import files


@pytest.fixture()
def fixed_partitions(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_frame(spark, n=9000):
    """A third of the rows have key 7, some none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
    return spark.range(n).select(key.cast("long").alias("k"), "id")


def test_hot_keys(spark):
    assert hot_keys(hot_frame(spark), "k") is None
    found = {r["_hot"]: r["_copies"] for r in hot_keys(hot_frame(spark), "k", 100).collect()}
    assert set(found) == {7} and found[7] >= 2  # shares of 9000 rows over 4 partitions are 2250 rows
    assert hot_keys(hot_frame(spark).limit(0), "k", 1) is None


@pytest.mark.parametrize("least", [10, 10**9])
def test_spread_joins_equal_plain_joins(fixed_partitions, least):
    spark, long = fixed_partitions, hot_frame(fixed_partitions)
    one = spark.range(0, 400, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("a"))
    two = spark.createDataFrame([(7, "x"), (7, "y"), (9, "z"), (None, "none")], "k long, b string")
    three = long.select("k").distinct().withColumn("c", F.lit(1))
    got = spread_joins(long, "k", [(one, "left"), (two, "left"), (three, "inner")], least)
    want = long.join(one, "k", "left").join(two, "k", "left").join(three, "k")
    assert got.columns == want.columns
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert key(got.collect()) == key(want.collect())


def test_spread_joins_share_a_hot_key(fixed_partitions):
    spark = fixed_partitions
    sides = [(spark.range(400).select(F.col("id").alias("k"), F.lit(n).alias(f"s{n}")), "left") for n in range(3)]
    sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    even, plain = sizes(spread_joins(hot_frame(spark, 90_000), "k", sides, 10)), sizes(spread_joins(hot_frame(spark, 90_000), "k", sides))
    assert plain[-1] > 5 * plain[len(plain) // 2]
    assert even[-1] <= 3 * even[len(even) // 2]
    # the chain still runs within one shuffle of the long side
    plan = spread_joins(hot_frame(spark), "k", sides, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4


def test_half_of_the_rows_at_one_time(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, 50 if i % 2 else rng.randrange(100), rng.choice([None, *range(60)])) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, id long, t int, v int")
    order = [F.col("t"), F.col("id")]
    dealt = range_chunks(df, order, 500)
    sizes = [r["count"] for r in dealt.groupBy("_chunk").count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 3 * sum(sizes) / len(sizes)
    w = Window.partitionBy("k").orderBy(*order)
    got = row_numbers(dealt, ["k"], F.col("_chunk"), order).select("id", "rn").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, df.select("id", F.row_number().over(w)).collect()))
    best = best_so_far(dealt, ["k"], F.col("_chunk"), order, "v").select("id", "is_best").collect()
    top = F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))
    assert sorted(map(tuple, best)) == sorted(map(tuple, df.select("id", F.col("v").isNotNull() & (top.isNull() | (F.col("v") > top))).collect()))
    # LAG over values that half of the rows share: the ranges part them by a tie-break
    before = previous_value(range_chunks(df.select("k", "t", "id"), [F.col("t"), F.xxhash64("k", "t", "id")], 500), ["k"], F.col("_chunk"), "t", F.lit(-1), "p")
    lag = df.select("k", "t", F.lag("t", 1, -1).over(Window.partitionBy("k").orderBy("t")).alias("p"))
    assert sorted(map(tuple, before.select("k", "t", "p").collect())) == sorted(map(tuple, lag.collect()))


def test_small_frames_are_one_range(spark):
    assert range_chunks(spark.range(10), [F.col("id")]).select("_chunk").distinct().collect() == [(0,)]


def lock_tables(spark):
    rng = random.Random(1)
    locks = [(1 if rng.random() < 0.9 else 2, rng.choice([11, 12, 7, 8, 0]) if i % 3 else 11, rng.randrange(60), rng.randrange(4, 9), rng.choice(["OBJECT", "PAGE"]),
              "s", f"d{i}", "X", "GRANT") for i in range(600)]
    lock = spark.createDataFrame(locks, "resource_database_id int, resource_associated_entity_id long, lock_owner_address long, request_session_id int, "
                                        "resource_type string, resource_subtype string, resource_description string, request_mode string, request_status string")
    wait = spark.createDataFrame([(a, a + 1, a * 100) for a in range(0, 60, 3)], "resource_address long, blocking_session_id int, wait_duration_ms long")
    part = spark.createDataFrame([(11, 7, 1), (12, 8, 2), (7, 9, 1)], "hobt_id long, object_id long, index_id int")
    obj = spark.createDataFrame([(7, "seven"), (8, "eight"), (9, "nine")], "object_id long, name string")
    index = spark.createDataFrame([(7, 1, "i7"), (8, 2, "i8"), (7, None, "heap")], "object_id long, index_id int, name string")
    return lock, wait, part, obj, index


def test_locks_take_part_in_two_joins(fixed_partitions):
    lock, wait, part, obj, index = lock_tables(fixed_partitions)
    got = telemetry.lock_waits(lock, wait, part, obj, index, 1, "db", own_session=5)
    for n, df in zip(("lock", "wait", "part", "obj", "idx"), (lock, wait, part, obj, index)):
        df.createOrReplaceTempView(n)
    want = fixed_partitions.sql("""
        SELECT 'db' AS database_name, request_session_id, resource_type, CASE resource_type WHEN 'OBJECT' THEN o.name ELSE po.name END AS object_name,
               i.name AS index_name, resource_subtype, resource_description, resource_associated_entity_id, request_mode, request_status,
               blocking_session_id, wait_duration_ms / 1000.0D AS wait_seconds
        FROM lock LEFT JOIN wait ON lock_owner_address = resource_address LEFT JOIN part p ON resource_associated_entity_id = hobt_id
        LEFT JOIN obj o ON resource_associated_entity_id = o.object_id LEFT JOIN obj po ON po.object_id = p.object_id
        LEFT JOIN idx i ON coalesce(o.object_id, p.object_id) = i.object_id AND coalesce(p.index_id, 1) = coalesce(i.index_id, 1)
        WHERE resource_associated_entity_id > 0 AND request_session_id <> 5 AND resource_database_id = 1""")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    # the locks are shuffled for the waits and for what their ids name, and sorted for the report
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("lock_owner_address" in line and "hashpartitioning" in line for line in moved) == 2
    assert sum("hashpartitioning(resource_associated_entity_id" in line for line in moved) <= 4


def test_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        for most in (1000, 0):
            rows = files.read_lines(spark, str(tmp_path), most)
            assert rows.rdd.getNumPartitions() > 8 or not most
            assert sorted((r.line, r.text) for r in rows.collect()) == [(i, f"line {i}") for i in range(5000)]
        rows = files.read_lines(spark, str(tmp_path))
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        # other splits than those counted: an error, not wrong numbers
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
        with pytest.raises(Exception, match="other splits"):
            rows.select("line", "text", F.rand()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("start, end, shift, part", [(0, -1, 1, "a😀b"), (2, -1, 1, "😀b"), (4, -1, 1, "�b"), (0, 2, 1, "a�"), (0, 4, 1, "a😀"), (4, 4, 1, "�"), (6, 6, 1, "b"), (0, 0, 0, "")])
def test_slices_count_two_byte_units(one, start, end, shift, part):
    from millrace.functions import expressions
    assert one(expressions.statement_slice(F.lit("a😀b"), F.lit(start), F.lit(end), shift, shift)) == part
