"""Join shapes and set operations."""

from pyspark.sql import functions as F

from millrace.functions.expressions import days_between
from millrace.operators import graph, joins, rows
from millrace.probes.registry import Tables, probe


@probe("max_by_dropoff_zone", """
SELECT dn.n_name AS dropoff_zone, max(l.l_discount) AS max_tip
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation pn ON c.c_nationkey = pn.n_nationkey AND pn.n_name = 'NATION_0'
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation dn ON s.s_nationkey = dn.n_nationkey
WHERE CAST(o.o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o.o_orderdate AS DATE) <= DATE '1996-12-31'
GROUP BY dn.n_name ORDER BY max_tip DESC, dropoff_zone
""")
def max_by_dropoff_zone(t: Tables):
    """One dimension in two roles: only its name filters the pick-up side."""
    pickup = t.customer.join(t.nation.filter("n_name = 'NATION_0'"), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = (
        t.orders.filter(days_between(F.col("o_orderdate"), "1996-01-01", "1996-12-31"))
        .join(pickup.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .select("o_orderkey")
    )
    # The maximum is taken per supplier first: suppliers and zones join few rows.
    best = (
        t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey").agg(F.max("l_discount").alias("max_tip"))
    )
    return (
        best.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("dropoff_zone")).agg(F.max("max_tip").alias("max_tip"))
        .orderBy(F.desc("max_tip"), "dropoff_zone")
    )


@probe("sum_by_borough", """
SELECT r.r_name AS borough, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey AND r.r_name <> 'AFRICA'
GROUP BY r.r_name
""")
def sum_by_borough(t: Tables):
    # Summed per customer first, so a hot customer is one row in the join.
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_total")
    )
    zones = t.nation.join(t.region.filter("r_name <> 'AFRICA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(zones, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("borough")).agg(F.sum("_total").cast("double").alias("total"))
    )


@probe("left_chain", """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name,
       CAST(coalesce(o.n_orders, 0) AS BIGINT) AS n_orders, o.last_order
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1) o ON o.o_custkey = c.c_custkey
""")
def left_chain(t: Tables):
    counts = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region.filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "last_order")
    )


@probe("coalesced_key_join", """
SELECT o.o_orderkey, n.n_name
FROM (SELECT o.o_orderkey, c.c_nationkey AS k1, CAST(o.o_orderkey % 30 AS INTEGER) AS k2 FROM orders o
      LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c ON o.o_custkey = c.c_custkey) o
LEFT JOIN nation n ON coalesce(o.k1, o.k2) = n.n_nationkey
""")
def coalesced_key_join(t: Tables):
    building = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.col("c_nationkey").alias("k1"))
    left = t.orders.join(building, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn(
        "k2", (F.col("o_orderkey") % 30).cast("int")
    )
    out = joins.coalesced_join(left, t.nation, [F.col("k1"), F.col("k2")], F.col("n_nationkey"))
    return out.select("o_orderkey", "n_name")


@probe("offset_key_join", """
WITH b AS (SELECT o_orderstatus AS fn, year(o_orderdate) - 1994 AS id, max(o_orderdate) AS val FROM orders
           WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00' GROUP BY 1, 2),
p AS (SELECT o_orderstatus AS fn, year(o_orderdate) - 1994 AS part, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT p.fn, CAST(p.part AS INTEGER) AS part, p.n, l.val AS lower_border, u.val AS upper_border
FROM p LEFT JOIN b u ON u.fn = p.fn AND u.id = p.part LEFT JOIN b l ON l.fn = p.fn AND l.id = p.part - 1
""")
def offset_key_join(t: Tables):
    year = (F.year("o_orderdate") - 1994).cast("int")
    borders = (
        t.orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_orderstatus").alias("fn"), year.alias("id")).agg(F.max("o_orderdate").alias("val"))
    )
    parts = t.orders.groupBy(F.col("o_orderstatus").alias("fn"), year.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return joins.borders_by_offset(parts, borders, ["fn"], "part", "id", "val").select(
        "fn", "part", "n", "lower_border", "upper_border"
    )


@probe("cross_join_tally", """
SELECT s_nationkey, count(*) AS n, min(tally) AS low, max(tally) AS high, CAST(sum(tally) AS BIGINT) AS total
FROM supplier CROSS JOIN (SELECT a.d * 10 + b.d + 1 AS tally FROM range(10) a(d), range(10) b(d)) GROUP BY 1
""")
def cross_join_tally(t: Tables):
    """Tally rows 1..100 beside every supplier, generated in place of a cross join."""
    many = rows.repeat_rows(t.supplier.select("s_nationkey"), 100, "tally")
    return many.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("tally").cast("long").alias("low"),
        F.max("tally").cast("long").alias("high"), F.sum("tally").alias("total"),
    )


@probe("lateral_inline", """
SELECT o_orderkey, u.month_no, CAST(o_orderdate + to_months(CAST(u.month_no AS INTEGER)) AS DATE) AS due
FROM orders, LATERAL (SELECT CAST(unnest(range(1, 1 + CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 0 END)) AS INTEGER) AS month_no) u
""")
def lateral_inline(t: Tables):
    """Rows out of a per-row table: orders without any are left out."""
    n = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 3).otherwise(0)
    months = F.when(n > 0, F.sequence(F.lit(1), n))
    rows_ = t.orders.select("o_orderkey", "o_orderdate", F.explode(months).alias("month_no"))
    return rows_.select("o_orderkey", "month_no", F.add_months(F.to_date("o_orderdate"), F.col("month_no")).alias("due"))


@probe("lateral_outer", """
SELECT o.o_orderkey, u.month_no
FROM orders o LEFT JOIN (
  SELECT o_orderkey, CAST(unnest(range(1, 1 + CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 0 END)) AS INTEGER) AS month_no
  FROM orders) u ON o.o_orderkey = u.o_orderkey
""")
def lateral_outer(t: Tables):
    n = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 3).otherwise(0)
    months = F.when(n > 0, F.sequence(F.lit(1), n))
    return t.orders.select("o_orderkey", F.explode_outer(months).alias("month_no"))


def _trade_edges(t: Tables):
    """Distinct (customer nation, supplier nation) pairs that trade.

    Lines are reduced to distinct (order, supplier nation) before they meet the
    orders, so an order with very many lines is at most one row per nation there.
    """
    sold = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", F.col("s_nationkey").alias("j")).distinct()
    )
    bought = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("i")
    )
    return sold.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).select("i", "j").distinct()


_TRADE_SQL = """
trade AS (SELECT DISTINCT c_nationkey AS i, s_nationkey AS j FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
blocked AS (SELECT a.n_nationkey AS i, (a.n_nationkey + 5) % 25 AS j FROM nation a)
"""


def _blockers(t: Tables):
    """Each nation blocks the one five numbers on."""
    return t.nation.select(F.col("n_nationkey").alias("i"), ((F.col("n_nationkey") + 5) % 25).alias("j"))


@probe("candidate_pairs", f"""
WITH {_TRADE_SQL}
SELECT DISTINCT least(i, j) AS v, greatest(i, j) AS w FROM trade t WHERE i <> j
AND NOT EXISTS (SELECT 1 FROM blocked b WHERE (b.i = t.i AND b.j = t.j) OR (b.i = t.j AND b.j = t.i))
""")
def candidate_pairs(t: Tables):
    return graph.allowed_edges(_trade_edges(t), _blockers(t), "i", "j")


@probe("allowed_partner_counts", """
WITH b AS (SELECT n_nationkey AS i, (n_nationkey + 5) % 25 AS j FROM nation),
p AS (SELECT x.n_nationkey AS v, y.n_nationkey AS w FROM nation x JOIN nation y ON x.n_nationkey < y.n_nationkey
      WHERE NOT EXISTS (SELECT 1 FROM b WHERE (b.i = x.n_nationkey AND b.j = y.n_nationkey)
                                           OR (b.i = y.n_nationkey AND b.j = x.n_nationkey)))
SELECT vertex, count(*) AS partners FROM (SELECT v AS vertex FROM p UNION ALL SELECT w FROM p) GROUP BY 1
""")
def allowed_partner_counts(t: Tables):
    return graph.allowed_partner_counts(t.nation, "n_nationkey", _blockers(t), "i", "j")


@probe("degree_check", """
WITH e AS (SELECT DISTINCT least(user_id, (user_id + 1) % 150) AS v, greatest(user_id, (user_id + 1) % 150) AS w FROM events
           UNION SELECT 0, 75),
d AS (SELECT vertex, count(*) AS degree FROM (SELECT v AS vertex FROM e UNION ALL SELECT w FROM e) GROUP BY 1)
SELECT vertex, degree, (SELECT bool_and(degree = 2) FROM d) AS all_two FROM d
""")
def degree_check(t: Tables):
    """Ring over the users plus one chord: two vertices have degree 3."""
    ring = t.events.select(F.col("user_id").alias("a"), ((F.col("user_id") + 1) % 150).alias("b"))
    chord = ring.agg(F.lit(0).cast("long").alias("a"), F.lit(75).cast("long").alias("b"))
    degree = graph.degrees(graph.undirected(ring.unionByName(chord), "a", "b"), "v", "w")
    return degree.withColumn("all_two", graph.all_degrees_two(degree).scalar())
