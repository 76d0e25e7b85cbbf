import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import release_scratch, scratch_path, work_dir
from millrace.sources import files, jdbc, tables


def put(tmp_path, name, data: bytes):
    path = tmp_path / name
    path.write_bytes(data)
    return str(path)


def test_typed_gzip_files_as_one_frame(spark, tmp_path):
    head = b"VendorID,lpep_pickup_datetime,passenger_count,fare_amount\n"
    paths = []
    for month in ("10", "11"):
        p = tmp_path / f"green_{month}.csv.gz"
        p.write_bytes(gzip.compress(head + f"1,2020-{month}-01 00:10:00,,5.5\n,2020-{month}-02 00:10:00,2,\n".encode()))
        paths.append(str(p))
    df = files.read_csv(spark, paths, schema="VendorID long, lpep_pickup_datetime timestamp_ntz, passenger_count long, fare_amount double")
    got = df.orderBy("lpep_pickup_datetime").collect()
    assert len(got) == 4 and got[0].VendorID == 1 and got[0].passenger_count is None and got[1].VendorID is None


def test_inferred_types(spark, tmp_path):
    path = put(tmp_path, "a.csv", b'id,name,score\n1,"x, ""y""",2.5\n')
    df = files.read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "double"]
    assert df.first().name == 'x, "y"'


def test_cp1252_and_null_marker(spark, tmp_path):
    text = 'id,name\n1,Agüero “Kun” €\n2,\\N\n3,Null\n'
    path = put(tmp_path, "players.csv", text.encode("cp1252"))
    got = files.read_csv(spark, path, schema="id int, name string", encoding="cp1252", null_value=r"\N").orderBy("id").collect()
    assert [r.name for r in got] == ["Agüero “Kun” €", None, "Null"]
    utf8 = put(tmp_path, "clubs.csv", "id,name\n1,Ozanköy\n".encode())
    assert files.read_csv(spark, utf8, schema="id int, name string").first().name == "Ozanköy"


def test_header_in_the_first_data_row(spark, tmp_path):
    path = put(tmp_path, "p.csv", b"playerId,playerName\n1,A\n2,B\n")
    df = files.promote_header(spark, path)
    assert df.columns == ["playerId", "playerName"] and df.count() == 2


def test_texts_one_row_per_file(spark, tmp_path):
    put(tmp_path, "a.txt", b"x\ny\n")
    put(tmp_path, "b.txt", b"z")
    assert sorted(r.text for r in files.read_texts(spark, str(tmp_path)).collect()) == ["x\ny\n", "z"]


def test_labelled_folders(spark, tmp_path):
    for label in ("humans", "horses"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "1.png").write_bytes(b"\x89PNG")
        (tmp_path / label / "note.txt").write_bytes(b"no")
    got = files.with_class_index(files.read_labelled_folders(spark, str(tmp_path), "*.png")).orderBy("label").collect()
    assert [(r.label, r.class_index, r.length) for r in got] == [("horses", 0, 4), ("humans", 1, 4)]


def test_partitioned_table_is_pruned(spark, tmp_path):
    df = spark.range(100).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"))
    path = tables.write_partitioned(df, str(tmp_path / "t"), ["day"])
    one = spark.read.parquet(path).filter("day = date'2024-01-03'")
    assert one.count() == 20
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_clustered_files_have_narrow_ranges(spark, tmp_path):
    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"))
    path = tables.write_clustered(df, str(tmp_path / "c"), ["k"])
    report = files.segment_report(spark.read.parquet(path), "k").orderBy("min_value").collect()
    assert sum(r.n_rows for r in report) == 1000
    assert all(a.max_value <= b.min_value for a, b in zip(report, report[1:]))


def test_hot_key_is_spread_over_files(spark, tmp_path):
    df = spark.range(4000).select("id", F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"))
    # Small partitions would be merged again, which is not the point here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = tables.write_clustered(df, str(tmp_path / "h"), ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    report = files.segment_report(spark.read.parquet(path), "k").collect()
    assert len(report) == 4 and max(r.n_rows for r in report) < 1500
    assert sum(r.n_rows for r in report) == 4000


def test_fill_empty_refill(spark, tmp_path):
    name = "refilled_table"
    tables.publish(spark.range(5), name, str(tmp_path / "r"))
    tables.empty_table(spark, name)
    assert spark.table(name).count() == 0
    tables.add_rows(spark.range(3), name)
    tables.add_rows(spark.range(3), name)
    assert spark.table(name).count() == 6


def test_fruits(spark, tmp_path):
    """Three rows in, emptied, then three other rows a thousand times each."""
    from millrace.operators.rows import repeat_rows

    schema = "Name string, Type string, Amount int"
    first = spark.createDataFrame([("apple", "Granny Smith", 10), ("banana", "baby", 20), ("banana", "red", 30)], schema)
    later = spark.createDataFrame([("orange", "Valencia", 5), ("kiwi", "golden", 25), ("strawberry", "albion", 35)], schema)
    tables.publish(first, "fruits_t", str(tmp_path / "f"))
    tables.empty_table(spark, "fruits_t")
    tables.add_rows(repeat_rows(later, 1000).drop("copy"), "fruits_t")
    assert {r.Name: r["count"] for r in spark.table("fruits_t").groupBy("Name").count().collect()} == {
        "orange": 1000, "kiwi": 1000, "strawberry": 1000}


def test_column_stats(spark, tmp_path):
    tables.publish(spark.range(10).select("id", F.nullif("id", F.lit(3)).alias("v")), "stats_t", str(tmp_path / "s"))
    got = {r.col_name: r for r in tables.column_stats(spark, "stats_t", ["id", "v"]).collect()}
    assert (got["id"].min, got["id"].max, got["v"].num_nulls) == ("0", "9", "1")


def test_create_table_text():
    schema = T.StructType.fromDDL("VendorID long, t timestamp_ntz, d decimal(10,2), s string")
    text = jdbc.create_table_text("Green", schema)
    assert '"VendorID" BIGINT' in text and '"t" TIMESTAMP' in text and '"d" DECIMAL(10,2)' in text and '"s" TEXT' in text


class Session:
    """Only what the folder rule looks at."""

    def __init__(self, master, named=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-" + master})


def test_work_folder_comes_from_the_session(spark):
    assert work_dir(spark) == work_dir(spark)
    named = Session("spark://host:7077", "hdfs://shared/x/")
    assert work_dir(named) == "hdfs://shared/x"
    assert scratch_path(named, "t").startswith("hdfs://shared/x/t-")
    with pytest.raises(ValueError):
        work_dir(Session("yarn"))


def test_materialized_result(spark, tmp_path):
    df = tables.materialize(spark.range(7), str(tmp_path / "m"))
    assert df.count() == 7 and os.path.isdir(tmp_path / "m")


def test_lines_of_split_files(spark, tmp_path):
    from millrace.operators.blocks import block_lists, line_block_lists
    texts = {}
    for name, n in (("a", 700), ("b", 1), ("c", 61)):
        lines = [("" if (i // 6) % 4 == 2 else f" head {i % 30} ") if i % 6 == 0 else f"item {i}" for i in range(n)]
        texts[name] = lines
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "d.txt").write_text("")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    try:
        rows = files.read_lines(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 8
        got = [(os.path.basename(r.path)[0], r.line, r.text) for r in rows.collect()]
        assert sorted(got) == sorted((k, i, x) for k, lines in texts.items() for i, x in enumerate(lines))
        named = rows.withColumn("path", F.substring(F.element_at(F.split("path", "/"), -1), 1, 1))
        lists = {tuple(r) for r in line_block_lists(named, ["path"], blocks_per_chunk=3).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    whole = spark.createDataFrame([(k, "\n".join(v)) for k, v in texts.items()], "path string, text string")
    assert lists == {tuple(r) for r in block_lists(whole, ["path"], "text").collect()} and len(lists) > 5


def test_scratch_has_an_owner(spark):
    paths = [scratch_path(spark, "owned") for _ in range(2)]
    spark.range(3).write.parquet(paths[0])  # the other is never written
    release_scratch(spark)
    assert not os.path.exists(paths[0].removeprefix("file:"))
    release_scratch(spark)


def test_spread_scan_of_few_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from millrace.sources.tables import spread_scan

    path = str(tmp_path / "t.parquet")
    pq.write_table(pa.table({"i": list(range(20_000))}), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        rows = spread_scan(scan).rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(rows) == 20_000 and max(rows) < 5_000
