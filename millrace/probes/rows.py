"""Projections, filters, renames, fills, sorts, limits and unions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import names
from millrace.functions.expressions import between_midnights, days_between, same_day
from millrace.operators import profile, rows
from millrace.probes.registry import Tables, probe
from millrace.sources import files


@probe("same_day_count", """
SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS n_click
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-18'
""")
def same_day_count(t: Tables):
    return t.events.filter(same_day(F.col("ts"), "2024-01-18")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "click").alias("n_click")
    )


@probe("date_range_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
""")
def date_range_filter(t: Tables):
    wanted = days_between(F.col("l_shipdate"), "1997-01-01", "1997-12-31")
    return t.lineitem.filter(wanted).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")


@probe("ts_between_distinct", """
SELECT DISTINCT user_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-06 00:00:00' AND TIMESTAMP '2024-01-07 00:00:00'
""")
def ts_between_distinct(t: Tables):
    return t.events.filter(between_midnights(F.col("ts"), "2024-01-06", "2024-01-07")).select("user_id").distinct()


@probe("zero_measure_count", """
SELECT count(*) FILTER (WHERE l_discount = 0) AS no_discount, count(*) FILTER (WHERE l_tax = 0) AS no_tax FROM lineitem
""")
def zero_measure_count(t: Tables):
    return t.lineitem.agg(
        F.count_if(F.col("l_discount") == 0).alias("no_discount"), F.count_if(F.col("l_tax") == 0).alias("no_tax")
    )


@probe("positive_filter", """
SELECT l_orderkey, l_partkey, l_linenumber, l_discount, l_tax FROM lineitem
WHERE nullif(l_discount, 0.05) > 0 AND l_tax > 0
""")
def positive_filter(t: Tables):
    dirty = t.lineitem.withColumn("_d", F.nullif("l_discount", F.lit(0.05)))
    return rows.keep_positive(dirty, "_d", "l_tax").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_tax"
    )


@probe("in_list_subset", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def in_list_subset(t: Tables):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_totalprice")


@probe("like_or_filter", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE p_name LIKE '%widget%' OR lower(p_name) LIKE 'small%' ORDER BY p_brand, p_name, p_partkey
""")
def like_or_filter(t: Tables):
    wanted = F.col("p_name").contains("widget") | F.lower("p_name").like("small%")
    return t.part.filter(wanted).select("p_partkey", "p_name", "p_brand").orderBy("p_brand", "p_name", "p_partkey")


@probe("drop_columns", "SELECT s_name, s_nationkey FROM supplier")
def drop_columns(t: Tables):
    """First column by position, one by name."""
    left = names.drop_first(t.supplier)
    return left.select(*names.columns_except(left, "s_acctbal"))


@probe("header_promotion", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier
""")
def header_promotion(t: Tables):
    path = files.write_csv(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), t.scratch("headed"))
    return files.promote_header(t.spark, path)


@probe("rename_snake", """
SELECT o_orderkey AS order_id, o_custkey AS pulocation_id, o_totalprice AS total_amount FROM orders
""")
def rename_snake(t: Tables):
    raw = t.orders.select(
        F.col("o_orderkey").alias("orderID"), F.col("o_custkey").alias("PULocationID"),
        F.col("o_totalprice").alias("totalAmount"),
    )
    return names.rename_all(raw, names.to_snake)


@probe("rename_camel", """
SELECT l_orderkey AS "matchId", l_quantity AS "shotsOnTarget", l_tax AS "yellowCards" FROM lineitem
""")
def rename_camel(t: Tables):
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("match.id"), F.col("l_quantity").alias("Shots_On(_target)"),
        F.col("l_tax").alias("YELLOW_cards"),
    )
    return names.rename_all(raw, names.to_camel)


@probe("rename_plain", """
SELECT p_size AS engine_hp, p_brand AS transmission_type, p_retailprice AS price FROM part
""")
def rename_plain(t: Tables):
    raw = t.part.select(
        F.col("p_size").alias("Engine HP"), F.col("p_brand").alias("Transmission Type"),
        F.col("p_retailprice").alias("MSRP"),
    )
    return names.rename_all(raw, names.to_plain).withColumnRenamed("msrp", "price")


@probe("sentinel_to_null", r"""
SELECT p_partkey, nullif(CASE WHEN p_type = 'PROMO' THEN '\N' ELSE p_type END, '\N') AS p_type, p_name FROM part
""")
def sentinel_to_null(t: Tables):
    dirty = t.part.select(
        "p_partkey", F.when(F.col("p_type") == "PROMO", F.lit(r"\N")).otherwise(F.col("p_type")).alias("p_type"), "p_name"
    )
    return rows.sentinel_to_null(dirty)


@probe("fill_constant", """
SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END, 0) AS c_acctbal FROM customer
""")
def fill_constant(t: Tables):
    dirty = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("c_acctbal"))
    return dirty.fillna(0)


@probe("fill_mean", """
WITH dirty AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS bal FROM customer
)
SELECT c_custkey, round(coalesce(bal, (SELECT avg(bal) FROM dirty)), 6) AS bal FROM dirty
""")
def fill_mean(t: Tables):
    dirty = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("bal"))
    return rows.fill_mean(dirty, "bal").select("c_custkey", F.round("bal", 6).alias("bal"))


@probe("binary_flags", """
SELECT o_orderkey, CAST(coalesce(nullif(o_orderstatus, 'P') = 'F', false) AS INTEGER) AS is_final,
       CAST(o_totalprice >= (SELECT avg(o_totalprice) FROM orders) AS INTEGER) AS above_average
FROM orders
""")
def binary_flags(t: Tables):
    out = rows.at_least_mean(t.orders, "o_totalprice", "above_average")
    final = rows.flag(F.nullif("o_orderstatus", F.lit("P")) == "F")
    return out.select("o_orderkey", final.alias("is_final"), "above_average")


@probe("union_tagged", """
SELECT o_orderkey, o_totalprice, 'Green' AS service_type FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice, 'Yellow' FROM orders WHERE o_orderstatus <> 'F'
""")
def union_tagged(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    green, yellow = orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")
    return rows.tag_union({"Green": green, "Yellow": yellow}, "service_type").drop("o_orderstatus")


@probe("multi_key_sort", """
SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier ORDER BY s_nationkey, s_acctbal DESC, s_suppkey
""")
def multi_key_sort(t: Tables):
    return t.supplier.select("s_nationkey", "s_acctbal", "s_suppkey").orderBy("s_nationkey", F.desc("s_acctbal"), "s_suppkey")


@probe("test_run_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def test_run_limit(t: Tables):
    return rows.limited(t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey"), test_run=True, n=10)


@probe("dedup_rn1", """
SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
""")
def dedup_rn1(t: Tables):
    days = t.events.select("user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "ts", "value")
    return rows.first_per_key(days, ["user_id", "event_type", "day"], ["ts", "event_id"])


@probe("hash_shuffle_split", """
WITH h AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn <= n - 2 * floor(n * 0.2) THEN 'train' WHEN rn <= n - floor(n * 0.2) THEN 'val' ELSE 'test' END AS split
FROM h
""")
def hash_shuffle_split(t: Tables):
    return rows.exact_split(t.orders.select("o_orderkey"), "o_orderkey", 42, [("train", 0.6), ("val", 0.2), ("test", 0.2)])


@probe("nested_split", """
WITH h AS (SELECT c_custkey, row_number() OVER (ORDER BY md5('2|' || c_custkey), c_custkey) AS rn, count(*) OVER () AS n FROM customer),
outer_part AS (SELECT c_custkey, rn <= n - floor(n * 0.2) AS full_train FROM h),
i AS (SELECT c_custkey, row_number() OVER (ORDER BY md5('3|' || c_custkey), c_custkey) AS rn, count(*) OVER () AS n
      FROM outer_part WHERE full_train)
SELECT c_custkey, 'test' AS split FROM outer_part WHERE NOT full_train
UNION ALL SELECT c_custkey, CASE WHEN rn <= n - floor(n * 0.25) THEN 'train' ELSE 'val' END FROM i
""")
def nested_split(t: Tables):
    """20 % test, then 25 % of the rest for validation."""
    outer = rows.exact_split(t.customer.select("c_custkey"), "c_custkey", 2, [("full", 0.8), ("test", 0.2)], "outer_part")
    inner = rows.exact_split(
        outer.filter("outer_part = 'full'").select("c_custkey"), "c_custkey", 3, [("train", 0.75), ("val", 0.25)]
    )
    test = outer.filter("outer_part = 'test'").select("c_custkey", F.lit("test").alias("split"))
    return test.unionByName(inner)


@probe("profile_by_type", """
SELECT 'c_custkey' AS "column", 'number' AS kind, count(DISTINCT c_custkey) AS n_distinct FROM customer
UNION ALL SELECT 'c_name', 'text', count(DISTINCT c_name) FROM customer
UNION ALL SELECT 'c_nationkey', 'number', count(DISTINCT c_nationkey) FROM customer
UNION ALL SELECT 'c_acctbal', 'number', count(DISTINCT c_acctbal) FROM customer
UNION ALL SELECT 'c_mktsegment', 'text', count(DISTINCT c_mktsegment) FROM customer
""")
def profile_by_type(t: Tables):
    assert names.columns_of_type(t.customer, T.StringType) == ["c_name", "c_mktsegment"]
    return profile.type_profile(t.customer)
