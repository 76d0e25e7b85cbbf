"""Counts, profiles, correlations, histograms and score quality."""

from pyspark.sql import functions as F

from millrace.operators import metrics, profile
from millrace.operators.running import exact_quantile, row_numbers, slice_chunk, width_chunk
from millrace.probes.registry import Tables, probe


@probe("distinct_counts", """
SELECT 'l_partkey' AS "column", count(DISTINCT l_partkey) AS n_distinct FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem
UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem
UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) FROM lineitem
""")
def distinct_counts(t: Tables):
    return profile.distinct_counts(t.lineitem, ["l_partkey", "l_returnflag", "l_shipdate", "l_discount"])


@probe("max_by_day", """
SELECT CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS max_total FROM orders GROUP BY 1 ORDER BY max_total DESC, day
""")
def max_by_day(t: Tables):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("max_total"))
    return days.orderBy(F.desc("max_total"), "day")


@probe("conditional_means", """
SELECT round(avg(quality) FILTER (WHERE lang = 'en'), 6) AS en_mean, round(avg(quality) FILTER (WHERE lang = 'fr'), 6) AS fr_mean,
       round(avg(quality) FILTER (WHERE source = 'src7'), 6) AS src7_mean, round(avg(quality), 6) AS global_mean
FROM labels JOIN documents USING (doc_id)
""")
def conditional_means(t: Tables):
    df = _labelled(t)
    mean = lambda cond: F.round(F.avg(F.when(cond, F.col("quality"))), 6)
    return df.agg(
        mean(F.col("lang") == "en").alias("en_mean"), mean(F.col("lang") == "fr").alias("fr_mean"),
        mean(F.col("source") == "src7").alias("src7_mean"), F.round(F.avg("quality"), 6).alias("global_mean"),
    )


@probe("null_profile", """
SELECT 'l_discount' AS "column", count(*) FILTER (WHERE nullif(l_discount, 0) IS NULL) AS n_null FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE nullif(l_tax, 0) IS NULL) FROM lineitem
UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE l_quantity IS NULL) FROM lineitem
""")
def null_profile(t: Tables):
    dirty = t.lineitem.select(
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), "l_quantity"
    )
    return profile.null_profile(dirty)


@probe("value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand")
def value_counts(t: Tables):
    return profile.value_counts(t.part, "p_brand")


def _labelled(t: Tables):
    return t.labels.join(t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")


@probe("risk_ratio", """
WITH d AS (SELECT quality, lang, source FROM labels JOIN documents USING (doc_id)),
u AS (SELECT 'lang' AS feature, lang AS value, quality FROM d UNION ALL SELECT 'source', source, quality FROM d),
g AS (SELECT avg(quality) AS m FROM d)
SELECT feature, value, round(avg(quality), 6) AS mean, round(avg(quality) - any_value(m), 6) AS diff,
       round(avg(quality) / any_value(m), 6) AS risk FROM u, g GROUP BY 1, 2
""")
def risk_ratio(t: Tables):
    labelled = _labelled(t).select("lang", "source", "quality")
    out = profile.group_risk(labelled, ["lang", "source"], "quality")
    return out.select("feature", "value", *[F.round(c, 6).alias(c) for c in ("mean", "diff", "risk")])


@probe("group_mean", """
SELECT l_linenumber, round(avg(l_quantity), 6) AS mean_quantity, round(avg(l_discount), 6) AS mean_discount FROM lineitem GROUP BY 1
""")
def group_mean(t: Tables):
    return t.lineitem.groupBy("l_linenumber").agg(
        F.round(F.avg("l_quantity"), 6).alias("mean_quantity"), F.round(F.avg("l_discount"), 6).alias("mean_discount")
    )


@probe("median_by_group", """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS median_price FROM lineitem GROUP BY 1, 2
""")
def median_by_group(t: Tables):
    out = exact_quantile(
        t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", width_chunk(F.col("l_extendedprice"), 500.0)
    )
    return out.select("l_returnflag", "l_linestatus", F.round("median", 6).alias("median_price"))


@probe("quartiles_by_group", """
SELECT user_id, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3 FROM events GROUP BY 1
""")
def quartiles_by_group(t: Tables):
    at = lambda q, out: exact_quantile(t.events, ["user_id"], "value", width_chunk(F.col("value"), 10.0), q, out)
    both = at(0.25, "q1").join(at(0.75, "q3"), "user_id")
    return both.select("user_id", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"))


@probe("std_pop_samp", """
SELECT l_returnflag, round(stddev_pop(l_quantity), 6) AS std_pop, round(stddev_samp(l_quantity), 6) AS std_samp FROM lineitem GROUP BY 1
""")
def std_pop_samp(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev_pop("l_quantity"), 6).alias("std_pop"), F.round(F.stddev_samp("l_quantity"), 6).alias("std_samp")
    )


@probe("group_string_agg", """
SELECT n_regionkey AS node, min(s_suppkey) AS first_id, max(s_suppkey) AS last_id, count(*) AS n,
       (SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM
          (SELECT DISTINCT n2.n_nationkey AS k FROM supplier JOIN nation n2 ON s_nationkey = n2.n_nationkey
           WHERE n2.n_regionkey = n.n_regionkey)) AS id_list
FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey GROUP BY 1
""")
def group_string_agg(t: Tables):
    """The list names distinct nations, so it stays as short as that dimension."""
    per_nation = t.supplier.groupBy("s_nationkey").agg(
        F.min("s_suppkey").alias("a"), F.max("s_suppkey").alias("b"), F.count(F.lit(1)).alias("c")
    )
    nodes = per_nation.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    ids = F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda x: x.cast("string"))
    return nodes.groupBy(F.col("n_regionkey").alias("node")).agg(
        F.min("a").alias("first_id"), F.max("b").alias("last_id"), F.sum("c").alias("n"),
        F.array_join(ids, ",").alias("id_list"),
    )


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@probe("corr_matrix", "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _MEASURES for b in _MEASURES
))
def corr_matrix(t: Tables):
    return profile.correlations(t.lineitem, _MEASURES).select("a", "b", F.round("corr", 6).alias("corr"))


@probe("mutual_information", """
WITH d AS (SELECT quality, lang, source FROM labels JOIN documents USING (doc_id)),
u AS (SELECT 'lang' AS feature, lang AS value, quality FROM d UNION ALL SELECT 'source', source, quality FROM d),
c AS (SELECT feature, value, quality, count(*) AS nxy FROM u GROUP BY ALL),
m AS (SELECT *, sum(nxy) OVER (PARTITION BY feature, value) AS nx, sum(nxy) OVER (PARTITION BY feature, quality) AS ny,
             sum(nxy) OVER (PARTITION BY feature) AS n FROM c)
SELECT feature, round(sum(CAST(nxy AS DOUBLE) / n * ln(CAST(nxy AS DOUBLE) * n / (CAST(nx AS DOUBLE) * ny))), 6) AS mi FROM m GROUP BY 1
""")
def mutual_information(t: Tables):
    out = profile.mutual_information(_labelled(t), ["lang", "source"], "quality")
    return out.select("feature", F.round("mi", 6).alias("mi")).orderBy(F.desc("mi"))


@probe("equi_width_histogram", """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) * 40 / (hi - lo)) + 1, 40) AS INTEGER) AS bin, count(*) AS n,
       min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders, r GROUP BY 1
""")
def equi_width_histogram(t: Tables):
    return profile.equi_width_histogram(t.orders, "o_totalprice", 40)


@probe("equi_height_histogram", """
WITH v AS (SELECT l_quantity AS v, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT v, n, sum(n) OVER (ORDER BY v) AS upto, sum(n) OVER () AS total FROM v),
s AS (SELECT CAST(ceil(upto * 10 / total) AS INTEGER) AS step, v, n FROM c)
SELECT step, max(v) AS range_hi, CAST(arg_max(n, v) AS BIGINT) AS eq_rows, CAST(sum(n) - arg_max(n, v) AS BIGINT) AS range_rows,
       count(*) - 1 AS distinct_range FROM s GROUP BY 1
""")
def equi_height_histogram(t: Tables):
    return profile.equi_height_histogram(t.lineitem, "l_quantity", 10, F.col("l_quantity"))


@probe("price_histogram_200_steps", """
WITH v AS (SELECT l_extendedprice AS v, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT v, n, sum(n) OVER (ORDER BY v) AS upto, sum(n) OVER () AS total FROM v),
s AS (SELECT CAST(ceil(upto * 200 / total) AS INTEGER) AS step, v, n FROM c)
SELECT step, max(v) AS range_hi, CAST(arg_max(n, v) AS BIGINT) AS eq_rows, CAST(sum(n) - arg_max(n, v) AS BIGINT) AS range_rows,
       count(*) - 1 AS distinct_range FROM s GROUP BY 1
""")
def price_histogram_200_steps(t: Tables):
    """Many distinct values: the prefix sums run per slice of 500."""
    return profile.equi_height_histogram(t.lineitem, "l_extendedprice", 200, width_chunk(F.col("l_extendedprice"), 500.0))


_SCORE_SQL = "s AS (SELECT (n_chars * 7919) % 10000 AS k, quality AS y FROM labels JOIN documents USING (doc_id))"


def _scored(t: Tables):
    score = (F.col("n_chars") * 7919) % 10000 / 10000
    return _labelled(t).select(score.alias("score"), F.col("quality").alias("y"))


@probe("threshold_sweep", f"""
WITH {_SCORE_SQL}, th AS (SELECT CAST(range AS INTEGER) AS t FROM range(101)),
c AS (SELECT t, count(*) FILTER (WHERE k >= t * 100 AND y = 1) AS tp, count(*) FILTER (WHERE k >= t * 100 AND y = 0) AS fp,
             count(*) FILTER (WHERE k < t * 100 AND y = 1) AS fn, count(*) FILTER (WHERE k < t * 100 AND y = 0) AS tn
      FROM th, s GROUP BY 1)
SELECT t, tp, fp, fn, tn, tp / (tp + fn) AS tpr, fp / (fp + tn) AS fpr FROM c
""")
def threshold_sweep(t: Tables):
    return metrics.threshold_counts(_scored(t), "score", "y", 100)


@probe("every_tenth_threshold", f"""
WITH {_SCORE_SQL}, th AS (SELECT CAST(range AS INTEGER) AS t FROM range(101) WHERE range % 10 = 0)
SELECT t, count(*) FILTER (WHERE k >= t * 100 AND y = 1) AS tp, count(*) FILTER (WHERE k >= t * 100 AND y = 0) AS fp
FROM th, s GROUP BY 1
""")
def every_tenth_threshold(t: Tables):
    counts = metrics.threshold_counts(_scored(t), "score", "y", 100)
    return counts.filter(F.pmod("t", F.lit(10)) == 0).select("t", "tp", "fp").orderBy("t")


@probe("accuracy_sweep", f"""
WITH {_SCORE_SQL}, th AS (SELECT CAST(range AS INTEGER) AS t FROM range(21))
SELECT t, round(avg(CAST((k >= t * 500) = (y = 1) AS INTEGER)), 6) AS accuracy,
       round(avg(CAST((k > t * 500) = (y = 1) AS INTEGER)), 6) AS strict_accuracy
FROM th, s GROUP BY 1
""")
def accuracy_sweep(t: Tables):
    scored = _scored(t)
    wide = metrics.accuracy_by_threshold(scored, "score", "y", 20)
    strict = metrics.accuracy_by_threshold(scored, "score", "y", 20, strict=True).withColumnRenamed("accuracy", "strict")
    return wide.join(strict, "t").select("t", F.round("accuracy", 6).alias("accuracy"), F.round("strict", 6).alias("strict_accuracy"))


@probe("auc_rank", f"""
WITH {_SCORE_SQL},
r AS (SELECT y, rank() OVER (ORDER BY k) + (count(*) OVER (PARTITION BY k) - 1) / 2.0 AS rk FROM s),
a AS (SELECT sum(rk) FILTER (WHERE y = 1) AS r1, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM r)
SELECT round((r1 - p * (p + 1) / 2.0) / (p * n), 6) AS auc, p AS n_pos, n AS n_neg FROM a
""")
def auc_rank(t: Tables):
    out = metrics.auc(_scored(t), "score", "y", width_chunk(F.col("score"), 0.01))
    return out.select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


@probe("rmse", """
SELECT round(sqrt(avg(power(l_extendedprice - l_quantity * 2000, 2))), 4) AS rmse FROM lineitem
""")
def rmse(t: Tables):
    scored = t.lineitem.select("l_extendedprice", (F.col("l_quantity") * 2000).alias("predicted"))
    return metrics.rmse(scored, "l_extendedprice", "predicted").select(F.round("rmse", 4).alias("rmse"))


@probe("segment_minmax", """
WITH w AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS segment, count(*) AS n, min(l_partkey) a0, max(l_partkey) b0, min(l_quantity) a1,
           max(l_quantity) b1, min(l_extendedprice) a2, max(l_extendedprice) b2 FROM lineitem GROUP BY 1)
SELECT segment, n AS n_rows, 'l_partkey' AS "column", CAST(a0 AS DOUBLE) AS min_value, CAST(b0 AS DOUBLE) AS max_value FROM w
UNION ALL SELECT segment, n, 'l_quantity', a1, b1 FROM w UNION ALL SELECT segment, n, 'l_extendedprice', a2, b2 FROM w
""")
def segment_minmax(t: Tables):
    year = F.year("l_shipdate").alias("segment")
    return profile.segment_minmax(t.lineitem, [year], ["l_partkey", "l_quantity", "l_extendedprice"])


@probe("metric_history_stats", """
WITH h AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch FROM events)
SELECT user_id, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(median(value), 6) AS median,
       round(avg(value) FILTER (WHERE epoch BETWEEN 6 AND 9), 6) AS slice_mean FROM h GROUP BY 1
""")
def metric_history_stats(t: Tables):
    events = t.events.select("user_id", "ts", "event_id", "value")
    history = row_numbers(events, ["user_id"], slice_chunk(events, "ts"), [F.col("ts"), F.col("event_id")], "epoch")
    out = profile.history_stats(history, "user_id", "epoch", "value", 6, 9, slice_chunk(events, "value"))
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("mean", "std", "median", "slice_mean")])
