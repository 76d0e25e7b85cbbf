import os

import pytest
from pyspark.sql import functions as F

from millrace.plans import football, quality, taxi, telemetry
from millrace.plans.models import Model, build
from millrace.session import work_dir


def trips(spark, prefix):
    schema = (f"vendorid long, {prefix}_pickup_datetime timestamp_ntz, {prefix}_dropoff_datetime timestamp_ntz, store_and_fwd_flag string, "
              "ratecodeid string, pulocationid long, dolocationid long, passenger_count long, trip_distance double, fare_amount double, "
              "extra double, mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double, "
              "total_amount double, payment_type string, trip_type long")
    ts = __import__("datetime").datetime
    row = lambda v, h, pay, pu=1, do=2, dist=1.5: (v, ts(2020, 1, 1, h), ts(2020, 1, 1, h, 30), "N", "1", pu, do, 1, dist, 55.6, 0.5, 0.5,
                                                  2.0, 0.0, None, 0.3, 60.0, pay, 2)
    return spark.createDataFrame([row(1, 1, "1"), row(1, 1, "1", dist=0.5), row(1, 2, None), row(2, 1, "x", do=264), row(None, 1, "1"),
                                  row(2, 3, "7", pu=77)], schema)


ORDER = ["trip_distance", "fare_amount"]


def zones(spark):
    return spark.createDataFrame([(1, "Queens", "A", "Boro Zone"), (2, "Bronx", "B", "Yellow Zone"), (264, "Unknown", "N", "N/A")],
                                 "locationid int, borough string, zone string, service_zone string")


def test_staging(spark):
    got = taxi.stage_green(trips(spark, "lpep"), ORDER).orderBy("vendorid", "pickup_datetime").collect()
    assert len(got) == 4  # one duplicate and one row without vendor are gone
    assert float(got[0].trip_distance) == 0.5 and float(got[0].fare_amount) == 55.6
    assert [(r.payment_type, r.payment_type_description) for r in got] == [
        (1, "Credit card"), (0, "EMPTY"), (0, "EMPTY"), (7, "EMPTY")]
    yellow = taxi.stage_yellow(trips(spark, "tpep"), ORDER).collect()
    assert all(r.trip_type == 1 and float(r.ehail_fee) == 0 for r in yellow)


def test_models_by_name(spark, tmp_path):
    sources = {"green_tripdata": trips(spark, "lpep"), "yellow_tripdata": trips(spark, "tpep"), "taxi_zone_lookup": zones(spark),
               "fhv_tripdata": spark.sql("SELECT 'B1' dispatching_base_num, timestamp_ntz'2019-12-31 23:59:59' pickup_datetime, "
                                         "timestamp_ntz'2020-01-01 00:10:00' dropoff_datetime, '1' pulocationid, 2 dolocationid, null sr_flag")}
    built = build(spark, taxi.trip_models(ORDER), sources, ["fact_trips", "fact_fhv_trips", "dim_zones"], str(tmp_path), "t1_")
    fact = built["fact_trips"].collect()
    assert len(built["fact_trips"].columns) == 26
    # Unknown and missing zones take their trips away, on both sides.
    assert sorted((r.service_type, r.vendorid) for r in fact) == [("Green", 1), ("Green", 1), ("Yellow", 1), ("Yellow", 1)]
    assert {(r.pickup_zone, r.dropoff_zone) for r in fact} == {("A", "B")}
    assert built["fact_fhv_trips"].count() == 1
    assert {r.service_zone for r in built["dim_zones"].collect()} == {"Green Zone", "Yellow Zone", "N/A"}
    assert spark.catalog.tableExists("t1_fact_trips") and spark.catalog.tableExists("t1_stg_green_tripdata")


def test_model_errors(spark, tmp_path):
    with pytest.raises(KeyError):
        build(spark, {"a": Model(lambda x: x, ["missing"])}, {}, ["a"], str(tmp_path))
    loop = {"a": Model(lambda x: x, ["b"]), "b": Model(lambda x: x, ["a"])}
    with pytest.raises(ValueError):
        build(spark, loop, {}, ["a"], str(tmp_path))


def test_test_run_limit(spark):
    assert taxi.stage_green(trips(spark, "lpep"), ORDER, test_run=True, test_rows=2).count() == 2


def test_football_clean(spark):
    raw = spark.createDataFrame([(0, 5, "1999/00", "\\N"), (1, 6, "2000/01", "x")], "i int, `manager.id` int, season string, `note_(a)` string")
    got = football.clean("manager_club", raw, index_column=True)
    assert got.columns == ["managerId", "season", "noteA", "seasonStartYear"]
    assert [(r.noteA, r.seasonStartYear.year) for r in got.orderBy("managerId").collect()] == [(None, 1999), ("x", 2000)]
    players = spark.createDataFrame([(0, "player_id", "player_name"), (1, "7", "P")], "i int, a string, b string")
    assert football.clean("player", players, True).collect()[0].asDict() == {"playerId": "7", "playerName": "P"}
    stats = spark.createDataFrame([(0, "1", "2", "3")], "i int, match_id string, offsides string, offsides1 string")
    assert football.clean("club_stats", stats, True).columns == ["matchId", "offsides"]


def test_goal_scorers(spark):
    matches = spark.sql("SELECT 1 AS matchId, date'1999-01-01' AS seasonStartYear UNION ALL SELECT 2, date'2000-01-01'")
    perf = spark.createDataFrame([(7, 1, 1), (7, 2, 2), (7, 2, 3), (8, 2, 1)], "playerId int, matchId int, typeOfStat int")
    players = spark.createDataFrame([(7, "P"), (8, "Q")], "playerId int, playerName string")
    goals = football.goal_scorers(matches, perf, players)
    assert goals.count() == 3
    top = football.top_scorers(matches, perf, players, "1999-01-01", "2000-01-01", 1).first()
    assert (top.playerName, top.goals) == ("P", 2)


def test_report_and_enforcement(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "id int, v string")
    parent = spark.createDataFrame([(1,)], "id int")
    report = quality.report(
        quality.unique(df, "id", "warn"), quality.relationships(df, "id", parent, "id"), quality.accepted_values(df, "v", ["a"], "warn"),
        quality.row_checks(df, [quality.not_null("v"), quality.no_zero("id")]), quality.has_rows(df), quality.first_column(df, "id"),
    )
    got = {(r.check, r.column): (r.failures, r.status) for r in report.collect()}
    assert got == {
        ("unique", "id"): (1, "warn"), ("relationships", "id"): (1, "fail"), ("accepted_values", "v"): (1, "warn"),
        ("not_null", "v"): (1, "fail"), ("no_zero", "id"): (0, "pass"), ("has_rows", "*"): (0, "pass"), ("first_column", "id"): (0, "pass")}
    with pytest.raises(ValueError, match="relationships"):
        quality.enforce(report)
    assert quality.enforce(report.filter("severity = 'warn'")).count() == 2
    assert quality.has_rows(df.filter("id > 9")).first().status == "fail"


def test_health_of_unknown_states(spark):
    ag = spark.createDataFrame([(1, "G", "wsfc")], "group_id int, name string, cluster_type_desc string")
    replica = spark.createDataFrame([(i, 1, f"R{i}", "S", "A", "u") for i in range(4)],
                                    "replica_id int, group_id int, replica_server_name string, availability_mode_desc string, failover_mode_desc string, read_only_routing_url string")
    state = spark.createDataFrame([(0, "PRIMARY", None, None, None), (1, "SECONDARY", "OFFLINE", "CONNECTED", "HEALTHY"),
                                   (2, "SECONDARY", "ONLINE", "CONNECTED", "HEALTHY"), (3, "SECONDARY", "ONLINE", "CONNECTED", "HEALTHY")],
                                  "replica_id int, role_desc string, operational_state_desc string, connected_state_desc string, synchronization_health_desc string")
    db_state = spark.createDataFrame([(2, 5, "SYNC", 10241, 0, 0, 0), (3, 9, "SYNC", 10240, 0, None, 0)],
                                     "replica_id int, database_id int, synchronization_state_desc string, log_send_queue_size long, log_send_rate long, redo_queue_size long, redo_rate long")
    db = spark.createDataFrame([(5, "D")], "database_id int, name string")
    got = {r.replica_server_name: (r.health_status, r.database_name) for r in telemetry.health_report(ag, replica, state, db_state, db).collect()}
    assert got == {"R0": ("HEALTHY", None), "R1": ("ISSUE", None), "R2": ("PERFORMANCE_CONCERN", "D"), "R3": ("HEALTHY", None)}


def test_storage_summary_leaves_the_last_border_open(spark):
    one = lambda sql: spark.sql(sql)
    got = telemetry.storage_summary(
        one("SELECT 1 object_id, 1 index_id, p partition_number, 129L in_row_data_page_count, 256L used_page_count, 300L reserved_page_count, 5L row_count FROM VALUES (1),(2) t(p)"),
        one("SELECT 1 object_id, 'dbo' schema_name, 'T' name, 0 is_shipped"), one("SELECT 1 object_id, 1 index_id, 'PK' name, 2 data_space_id"),
        one("SELECT 2 data_space_id, 'ps' name"), one("SELECT 2 data_space_id, 'ps' name, 7 function_id"),
        one("SELECT 2 partition_scheme_id, 1 destination_id, 9 data_space_id"), one("SELECT 9 data_space_id, 'FG' name"),
        one("SELECT 7 function_id, 1 boundary_id, 100 value"),
    ).orderBy("partition_number").collect()
    assert [(r.lower_border, r.upper_border, r.filegroup_name, float(r.data_mb)) for r in got] == [(None, 100, "FG", 1.0), (100, None, "ps", 1.0)]
    assert got[0].table_name == "dbo.T" and got[0].type == "data"


def test_counters_case(spark):
    df = spark.createDataFrame([("x:database REPLICA", "c", "i", 1, 2), ("other", "c", "i", 1, 2)],
                               "object_name string, counter_name string, instance_name string, cntr_value int, cntr_type int")
    assert telemetry.counters(df, ["Database Replica"]).count() == 1
    assert telemetry.counters(df, ["Database Replica"], ignore_case=False).count() == 0


def test_plan_operators(spark):
    plans = spark.createDataFrame([(1, '<P><RelOp NodeId="2" PhysicalOp="Sort" EstimateRows="1.5" Parallel="0"/></P>'), (2, None)],
                                  "plan_id int, query_plan string")
    got = telemetry.plan_operators(plans).collect()
    assert [(r.plan_id, r.NodeId, r.PhysicalOp, r.EstimateRows, r.LogicalOp) for r in got] == [(1, 2, "Sort", 1.5, None)]


def test_plan_operators_split_no_text_in_the_sort(spark):
    texts = [(2, '<P><RelOp NodeId="2"/><RelOp NodeId="1"/></P>'), (1, '<P><RelOp NodeId="3"/></P>\n'), (3, '<P><RelOp NodeId="4"/>'), (2, None),
             (None, '<RelOp NodeId="5"/>')]
    got = telemetry.plan_operators(spark.createDataFrame(texts, "plan_id int, query_plan string"))
    assert [(r.plan_id, r.NodeId) for r in got.collect()] == [(None, 5), (1, 3), (2, 1), (2, 2)]
    assert "regexp_extract_all" not in got._jdf.queryExecution().executedPlan().toString()


def test_zone_joins_do_not_shuffle_the_trips(spark):
    staged = taxi.stage_green(trips(spark, "lpep"), ORDER)
    fact = taxi.fact_trips(staged, staged, taxi.dim_zones(zones(spark)))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_reach_the_scan(spark, tmp_path):
    from millrace.functions.expressions import same_day

    path = str(tmp_path / "e")
    spark.range(10).select(F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"), "id").write.parquet(path)
    plan = spark.read.parquet(path).filter(same_day(F.col("ts"), "2024-01-01")).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


HEAD = ("VendorID,lpep_pickup_datetime,lpep_dropoff_datetime,store_and_fwd_flag,RatecodeID,PULocationID,DOLocationID,passenger_count,"
        "trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,improvement_surcharge,total_amount,payment_type,trip_type,"
        "congestion_surcharge\n")


def trip_files(tmp_path):
    import gzip

    paths = []
    for month in ("10", "11"):
        lines = [f"2,2020-{month}-0{d} 10:00:00,2020-{month}-0{d} {h},N,1,{pu},{do},{n},{dist},10,0,0.5,{tip},0,,0.3,{total},1,1,0"
                 for d, h, pu, do, n, dist, tip, total in [
                     (1, "10:30:00", 1, 2, 1, 1.5, 3, 20), (1, "23:59:59", 1, 264, 2, 9.5, 7, 30), (2, "10:30:00", 264, 2, 0, 1.0, 1, 5),
                     (2, "10:40:00", 2, 1, "", 1.0, 1, 5), (3, "10:30:00", 2, 1, 1, 0, 1, 5)]]
        path = tmp_path / f"green_2020-{month}.csv.gz"
        path.write_bytes(gzip.compress((HEAD + "\n".join(lines) + "\n").encode()))
        paths.append(str(path))
    return paths


def test_trip_files_to_dataset(spark, tmp_path):
    paths = trip_files(tmp_path)
    raw = taxi.read_trips(spark, paths)
    assert raw.count() == 10
    out = taxi.load_trips(spark, paths, str(tmp_path / "out"))
    got = spark.read.parquet(out)
    # Trips without passengers (0 or null) or distance are gone.
    assert got.count() == 4 and got.columns[0] == "vendor_id" and "pulocation_id" in got.columns
    assert sorted(str(r[0]) for r in got.select("lpep_pickup_date").distinct().collect()) == ["2020-10-01", "2020-11-01"]
    bad = taxi.check_clean(raw)
    assert {(r.check, r.column): r.status for r in bad.collect()}[("first_column", "vendor_id")] == "fail"


def test_loads_add_up(spark, tmp_path):
    staged = lambda: {p for p in os.listdir(work_dir(spark).removeprefix("file:")) if p.startswith("load-")}
    earlier = staged()
    first, second = trip_files(tmp_path)
    out = str(tmp_path / "out")
    days = lambda: {str(r[0]): r[1] for r in spark.read.parquet(out).groupBy("lpep_pickup_date").count().collect()}
    taxi.load_trips(spark, first, out)
    taxi.load_trips(spark, [second], out)
    assert days() == {"2020-10-01": 2, "2020-11-01": 2}
    taxi.load_trips(spark, second, out, replace=True)
    assert days() == {"2020-10-01": 2, "2020-11-01": 2}
    taxi.load_trips(spark, second, out)
    assert days() == {"2020-10-01": 2, "2020-11-01": 4}
    # A load that fails its check changes nothing.
    empty = tmp_path / "empty.csv"
    empty.write_text(HEAD)
    with pytest.raises(ValueError, match="has_rows"):
        taxi.load_trips(spark, str(empty), out, replace=True)
    assert days() == {"2020-10-01": 2, "2020-11-01": 4}
    # Nothing is left of the staged files.
    assert staged() == earlier


def test_load_to_facts(spark, tmp_path):
    trips = spark.read.parquet(taxi.load_trips(spark, trip_files(tmp_path), str(tmp_path / "out")))
    sources = {"green_tripdata": trips, "yellow_tripdata": trips.withColumnsRenamed(
        {"lpep_pickup_datetime": "tpep_pickup_datetime", "lpep_dropoff_datetime": "tpep_dropoff_datetime"}).limit(0), "taxi_zone_lookup": zones(spark)}
    fact = build(spark, taxi.trip_models(ORDER), sources, ["fact_trips"], str(tmp_path / "models"), "t2_")["fact_trips"]
    # One trip of each day ends in a known zone.
    assert sorted((str(r.pickup_datetime), r.pickup_zone, r.dropoff_zone) for r in fact.collect()) == [
        ("2020-10-01 10:00:00", "A", "B"), ("2020-11-01 10:00:00", "A", "B")]


YELLOW = ("VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,store_and_fwd_flag,PULocationID,DOLocationID,"
          "payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,total_amount,congestion_surcharge\n")


def test_yellow_files(spark, tmp_path):
    path = tmp_path / "yellow.csv"
    path.write_text(YELLOW + "1,2020-10-01 10:00:00,2020-10-01 10:20:00,2,3.5,1,N,224,255,1,10,0.5,0.5,2,0,0.3,13.3,2.5\n")
    got = spark.read.parquet(taxi.load_trips(spark, str(path), str(tmp_path / "out"), "yellow")).first()
    assert (got.passenger_count, got.trip_distance, got.pulocation_id, got.dolocation_id, got.total_amount) == (2, 3.5, 224, 255, 13.3)
    staged = taxi.stage_yellow(spark.read.parquet(str(tmp_path / "out")), ["trip_distance"]).first()
    assert (staged.vendorid, staged.pickup_locationid, staged.trip_type, float(staged.ehail_fee)) == (1, 224, 1, 0.0)
    with pytest.raises(Exception):  # a file of the other kind
        taxi.read_trips(spark, str(path), "green").collect()


def test_file_without_index_column(spark):
    raw = spark.createDataFrame([("120", "7", "Arsenal", "x")], "club_id string, stadium_id string, club_name string, website string")
    assert football.clean("club", raw).columns == ["clubId", "stadiumId", "clubName", "website"]
    for name in ("", "_c0", "Unnamed: 0"):
        assert football.clean("club", spark.createDataFrame([(0, "120")], [name or "x", "club_id"]).toDF(name, "club_id")).columns == ["clubId"]


def test_trip_questions(spark, tmp_path):
    trips = taxi.read_trips(spark, trip_files(tmp_path))
    assert taxi.trips_within_day(trips, "2020-10-01").first().n == 2
    assert [(str(r.day), r.longest) for r in taxi.longest_by_day(trips).limit(2).collect()] == [("2020-10-01", 9.5), ("2020-11-01", 9.5)]
    assert {r.borough: r.total for r in taxi.total_by_borough(trips, zones(spark), "2020-10-02").collect()} == {"Bronx": 5.0}
    best = taxi.best_tip_by_dropoff(trips, zones(spark), "A", "2020-10-01", "2020-10-31").collect()
    assert [(r.dropoff_zone, r.max_tip) for r in best] == [("N", 7.0), ("B", 3.0)]


def test_league_files(spark, tmp_path):
    (tmp_path / "club.csv").write_text('"","club_id","club_name","website"\n"0","120","Arsenal","Null"\n')
    (tmp_path / "player.csv").write_bytes(',"a","b"\n0,player_id,player_name\n1,7,Agüero\n'.encode("cp1252"))
    raw = football.read_sources(spark, str(tmp_path), ["club", "player"], {"player": "cp1252"})
    got = football.clean_all(raw)
    assert got["club"].first().asDict() == {"clubId": "120", "clubName": "Arsenal", "website": "Null"}
    assert got["player"].first().asDict() == {"playerId": "7", "playerName": "Agüero"}


def test_laid_out_models_are_catalog_tables(spark, tmp_path):
    rows = spark.range(20).select("id", (F.col("id") % 3).alias("g"), F.lit("2001-02-03").cast("date").alias("day"))
    models = {"plain": Model(lambda x: x, ["s"], "table"), "sorted": Model(lambda x: x, ["s"], "table", ["g"]),
              "parted": Model(lambda x: x, ["s"], "table", ["g"], {"year": F.trunc("day", "year")}), "seen": Model(lambda x: x, ["parted"])}
    for _ in range(2):  # a second build replaces the tables
        built = build(spark, models, {"s": rows}, list(models), str(tmp_path), "lay_")
        listed = {t.name: t.isTemporary for t in spark.catalog.listTables() if t.name.startswith("lay_")}
        assert listed == {"lay_plain": False, "lay_sorted": False, "lay_parted": False, "lay_seen": True}
        assert spark.table("lay_parted").count() == 20 and built["seen"].columns == ["id", "g", "day", "year"]
    assert [c.name for c in spark.catalog.listColumns("lay_parted") if c.isPartition] == ["year"]
