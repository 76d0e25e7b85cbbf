"""Scans and sinks: every frame is written, read back and compared with its source."""

from pyspark.sql import functions as F

from millrace.functions.expressions import between_midnights
from millrace.operators.rows import repeat_rows
from millrace.plans import football
from millrace.probes.registry import Tables, probe
from millrace.sources import files, tables


@probe("csv_infer_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_infer_roundtrip(t: Tables):
    path = files.write_csv(t.supplier, t.scratch("supplier_csv"))
    df = files.read_csv(t.spark, path)
    return df.select(
        F.col("s_suppkey").cast("long"), "s_name", F.col("s_nationkey").cast("int"), F.col("s_acctbal").cast("double")
    )


@probe("csv_typed_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def csv_typed_scan(t: Tables):
    path = files.write_csv(
        t.orders, t.scratch("orders_csv"), compression="gzip", timestampNTZFormat="yyyy-MM-dd HH:mm:ss"
    )
    return files.read_csv(t.spark, path, schema=t.orders.schema, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")


@probe("csv_encoding_nulls", r"""
SELECT doc_id, text, nullif(lang, 'de') AS lang, source FROM documents
""")
def csv_encoding_nulls(t: Tables):
    docs = t.documents.select("doc_id", "text", F.nullif("lang", F.lit("de")).alias("lang"), "source")
    path = files.write_csv(docs, t.scratch("docs_csv"), encoding="iso-8859-1", null_value=r"\N", lineSep="\n")
    return files.read_csv(
        t.spark, path, schema=docs.schema, encoding="cp1252", null_value=r"\N", multiLine=True, lineSep="\n"
    )


@probe("multi_file_scan", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, max(o_orderkey) AS last_key,
       CAST(sum(CASE WHEN year(o_orderdate) = 1995 THEN NULL ELSE 1 END) AS BIGINT) AS n_priority
FROM orders GROUP BY 1
""")
def multi_file_scan(t: Tables):
    """One file set per year read from a list of paths; one of them lacks a column."""
    root = t.scratch("orders_by_year")
    tables.write_partitioned(t.orders.withColumn("year", F.year("o_orderdate")), root, ["year"])
    years = sorted(r.year for r in t.spark.read.parquet(root).select("year").distinct().collect())
    paths = [f"{root}/year={y}" for y in years]
    first = t.spark.read.parquet(paths[0]).drop("o_orderpriority")
    rest = t.spark.read.parquet(*paths[1:])
    both = files.read_all(t.spark, [first, rest])
    return both.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"),
        F.sum(F.when(F.col("o_orderpriority").isNotNull(), 1)).alias("n_priority"),
    )


@probe("parquet_glob_count", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders")
def parquet_glob_count(t: Tables):
    df = tables.external_table(t.spark, "orders_external", f"{t.folder}/orders*.parquet")
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("n_customers"))


@probe("partitioned_sink_pruned_read", """
SELECT CAST(ts AS DATE) AS pickup_date, count(*) AS n, max(event_id) AS last_event
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY 1
""")
def partitioned_sink_pruned_read(t: Tables):
    days = t.events.withColumn("pickup_date", F.to_date("ts"))
    path = tables.write_partitioned(days, t.scratch("events_by_day"), ["pickup_date"])
    read = t.spark.read.parquet(path)
    wanted = F.col("pickup_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-19").cast("date"))
    return read.filter(wanted).groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")
    )


@probe("ctas_copy", "SELECT * FROM part")
def ctas_copy(t: Tables):
    path = t.scratch("part_copy")
    return tables.publish(t.part, "part_copy_" + path[-12:], path)


@probe("partition_cluster_ctas", """
SELECT DISTINCT user_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00'
""")
def partition_cluster_ctas(t: Tables):
    path = tables.write_partitioned_clustered(
        t.events, t.scratch("events_clustered"), {"event_date": F.to_date("ts")}, ["user_id"]
    )
    table = t.spark.read.parquet(path)
    # The condition on the folder column prunes folders; the one on ts is exact.
    near = F.col("event_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-10").cast("date"))
    exact = between_midnights(F.col("ts"), "2024-01-05", "2024-01-10")
    return table.filter(near & exact).select("user_id").distinct()


@probe("season_partition_model", """
SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS season_start, count(*) AS n,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM orders GROUP BY 1
""")
def season_partition_model(t: Tables):
    path = tables.write_partitioned_clustered(
        t.orders, t.scratch("orders_by_season"),
        {"season_start": F.trunc("o_orderdate", "year")}, ["o_custkey", "o_orderkey"],
    )
    return t.spark.read.parquet(path).groupBy("season_start").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@probe("clustered_model", "SELECT * FROM customer")
def clustered_model(t: Tables):
    return t.spark.read.parquet(tables.write_clustered(t.customer, t.scratch("customer_clustered"), ["c_custkey"]))


@probe("fanout_export", """
SELECT 'DimClub' AS table_name, count(*) AS n FROM supplier
UNION ALL SELECT 'DimPlayer', count(*) FROM customer
UNION ALL SELECT 'FactMatch', count(*) FROM orders
""")
def fanout_export(t: Tables):
    root = t.scratch("fanout")
    tag = root[-12:]
    names = {"club": f"DimClub_{tag}", "player": f"DimPlayer_{tag}", "match": f"FactMatch_{tag}"}
    frames = {"club": t.supplier, "player": t.customer, "match": t.orders}
    done = tables.publish_all(frames, names, root)
    counts = [
        t.spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name.split("_")[0]).alias("table_name"), "n")
        for name in done.values()
    ]
    return files.read_all(t.spark, counts)


# What stands in for each dataset: table, key and text.
_EXPORTED = {
    "club": ("supplier", "s_suppkey", "s_name"), "club_stats": ("region", "r_regionkey", "r_name"), "manager": ("nation", "n_nationkey", "n_name"),
    "manager_club": ("supplier", "s_suppkey", "s_nationkey"), "match": ("orders", "o_orderkey", "o_orderpriority"), "player": ("customer", "c_custkey", "c_name"),
    "player_club": ("customer", "c_custkey", "c_mktsegment"), "player_performance": ("part", "p_partkey", "p_name"),
    "player_stats": ("part", "p_partkey", "p_brand"), "stadium": ("nation", "n_nationkey", "n_regionkey"),
    "team_discipline": ("documents", "doc_id", "source"), "matches": ("pages", "page_id", "url"), "goal_leaders": ("documents", "doc_id", "lang"),
    "events": ("events", "event_id", "event_type"), "assist_leaders": ("benchmark", "item_id", "item_id"), "all_tables": ("embeddings", "vec_id", "label"),
}


@probe("source_export", " UNION ALL ".join(
    f"SELECT '{source}/{name}' AS dataset, count(*) AS n_rows, CAST(sum(length(concat({text}, ' é, \"ñ\" ü'))) AS BIGINT) AS n_chars FROM {table}"
    for source, names in football.SOURCES.items() for name in names for table, _, text in [_EXPORTED[name]]))
def source_export(t: Tables):
    """All 16 datasets, from files in the encoding of the sources to UTF-8 folders, read back."""
    root, target = t.scratch("sources"), t.scratch("exported")
    for source, names in football.SOURCES.items():
        for name in names:
            table, key, text = _EXPORTED[name]
            rows = getattr(t, table).select(F.col(key).alias("id"), F.concat(F.col(text).cast("string"), F.lit(' é, "ñ" ü')).alias("name"))
            files.write_csv(rows, f"{root}/{source}/{name}.csv", "iso-8859-1")  # the same bytes for these letters
    done = football.export_sources(t.spark, root, target)
    return files.read_all(t.spark, [
        files.read_csv(t.spark, path, infer=False).agg(F.count("id").alias("n_rows"), F.sum(F.length("name")).alias("n_chars"))
        .select(F.lit(dataset).alias("dataset"), "n_rows", "n_chars") for dataset, path in done.items()])


@probe("values_relation", """
SELECT v.rank, v.priority, count(o.o_orderkey) AS n
FROM (VALUES (1, '1-URGENT'), (2, '2-HIGH'), (9, 'NONE')) AS v(rank, priority)
LEFT JOIN orders o ON o.o_orderpriority = v.priority GROUP BY 1, 2
""")
def values_relation(t: Tables):
    listed = t.spark.sql("SELECT * FROM VALUES (1, '1-URGENT'), (2, '2-HIGH'), (9, 'NONE') AS v(rank, priority)")
    # Counted before the join: a common priority is one row there.
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("o_orderkey").alias("n"))
    joined = listed.join(counts, listed.priority == counts.o_orderpriority, "left")
    return joined.select("rank", "priority", F.coalesce("n", F.lit(0)).alias("n"))


@probe("repeat_insert", """
SELECT s_nationkey, count(*) AS n, max(copy) AS copies
FROM (SELECT s_nationkey, CAST(unnest(range(1, 101)) AS INTEGER) AS copy FROM supplier) GROUP BY 1
""")
def repeat_insert(t: Tables):
    path = t.scratch("repeated")
    name = "repeated_" + path[-12:]
    rows = repeat_rows(t.supplier.select("s_nationkey"), 100)
    tables.publish(rows.limit(0), name, path)
    tables.add_rows(rows, name)
    return t.spark.table(name).groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("copy").alias("copies")
    )


@probe("truncate_reload", "SELECT s_suppkey, s_name FROM supplier")
def truncate_reload(t: Tables):
    """Fill a table, empty it, fill it anew: only the second filling remains."""
    path = t.scratch("reloaded")
    name = "reloaded_" + path[-12:]
    tables.publish(t.customer.select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")), name, path)
    tables.empty_table(t.spark, name)
    tables.add_rows(t.supplier.select("s_suppkey", "s_name"), name)
    return t.spark.table(name)


@probe("folder_labelled_scan", """
SELECT CAST(label AS VARCHAR) AS label, CAST(dense_rank() OVER (ORDER BY CAST(label AS VARCHAR)) - 1 AS INTEGER) AS class_index,
       true AS has_content
FROM (SELECT DISTINCT 'class ' || label AS label FROM embeddings)
""")
def folder_labelled_scan(t: Tables):
    root = t.scratch("folders")
    rows = t.embeddings.select(F.concat(F.lit("class "), F.col("label").cast("string")).alias("label"), "vec_id",
                               F.col("embedding").cast("string").alias("value"))
    rows.select("label", "value").repartition("label").write.partitionBy("label").text(root)
    found = files.with_class_index(files.read_labelled_folders(t.spark, root, "*.txt"))
    name = F.replace(F.replace("label", F.lit("label="), F.lit("")), F.lit("%20"), F.lit(" "))
    return found.groupBy(name.alias("label"), "class_index").agg((F.sum("length") > 0).alias("has_content"))


@probe("json_record_scan", """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_record_scan(t: Tables):
    path = t.scratch("events_json")
    t.events.select(F.to_json(F.struct("event_id", "event_type", "props")).alias("value")).write.text(path)
    records = files.read_json_records(t.spark, path, "event_id long, event_type string, props string")
    return records.select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))


@probe("file_segment_report", """
SELECT 'lineitem.parquet' AS file, count(*) AS n_rows, min(l_shipdate) AS min_value, max(l_shipdate) AS max_value,
       true AS has_bytes
FROM lineitem
""")
def file_segment_report(t: Tables):
    report = files.segment_report(t.lineitem, "l_shipdate")
    return report.select("file", "n_rows", "min_value", "max_value", (F.col("bytes") > 0).alias("has_bytes"))


@probe("column_stats", """
SELECT 'o_custkey' AS col_name, 'bigint' AS data_type, CAST(min(o_custkey) AS VARCHAR) AS min,
       CAST(max(o_custkey) AS VARCHAR) AS max, CAST(sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS VARCHAR) AS num_nulls
FROM orders
UNION ALL
SELECT 'o_orderkey', 'bigint', CAST(min(o_orderkey) AS VARCHAR), CAST(max(o_orderkey) AS VARCHAR), '0' FROM orders
""")
def column_stats(t: Tables):
    path = t.scratch("orders_stats")
    name = "orders_stats_" + path[-12:]
    tables.publish(t.orders.select("o_orderkey", "o_custkey"), name, path)
    # distinct_count is an estimate and stays out of the comparison
    return tables.column_stats(t.spark, name, ["o_custkey", "o_orderkey"]).drop("distinct_count")


@probe("numbered_lines", r"""
SELECT doc_id, CAST(len(regexp_split_to_array(text, '\r\n|\r|\n')) AS BIGINT) AS n_lines, true AS in_order FROM documents WHERE text IS NOT NULL
""")
def numbered_lines(t: Tables):
    """Line numbers of files that hold the texts one line a row: those of a text follow each other, and a file's start at 0."""
    path = t.scratch("lines")
    lines = t.documents.filter(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", r"\r\n|\r|\n", -1)).alias("n", "line"))
    dealt = lines.repartition("doc_id").sortWithinPartitions("doc_id", "n")
    dealt.select(F.concat_ws("|", "doc_id", "n", "line").alias("value")).write.text(path)
    parts = F.split("text", r"\|", 3)
    read = files.read_lines(t.spark, path).select(
        "path", "line", parts[0].cast("long").alias("doc_id"), parts[1].cast("long").alias("n"))
    whole = read.groupBy("path").agg(F.min("line").alias("low"), F.max("line").alias("high"), F.count(F.lit(1)).alias("many"))
    texts = read.groupBy("path", "doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min(F.col("line") - F.col("n")).alias("least"), F.max(F.col("line") - F.col("n")).alias("most"))
    good = (F.col("least") == F.col("most")) & (F.col("low") == 0) & (F.col("high") == F.col("many") - 1)
    return texts.join(whole, "path").select("doc_id", "n_lines", good.alias("in_order"))
