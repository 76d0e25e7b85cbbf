"""Trip staging, zone dimension and trip facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import (
    days_between, is_text, numeric, payment_description, safe_int_of, same_day, surrogate_key,
)
from millrace.operators.joins import role_join
from millrace.functions.names import rename_all, to_snake
from millrace.operators.rows import first_per_key, keep_positive, limited, tag_union
from millrace.plans import quality
from millrace.plans.models import Model
from millrace.session import remove_path, scratch_path
from millrace.sources.files import read_csv
from millrace.sources.tables import add_partitions, write_partitioned

# Money columns of the trip files, accepted payment codes, the
# borough of unknown zones, the text replaced in service zones, the FHV year.
MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
         "total_amount"]
PAYMENT_CODES = [1, 2, 3, 4, 5, 6]
UNKNOWN_BOROUGH = "Unknown"
SERVICE_ZONE_TEXT = ("Boro", "Green")
FHV_DAYS = ("2019-01-01", "2019-12-31")


# Typed columns of the green and yellow trip files, in file order.
TRIP_SCHEMAS = {
    "green": (
        "VendorID long, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, store_and_fwd_flag string, "
        "RatecodeID long, PULocationID long, DOLocationID long, passenger_count long, trip_distance double, "
        "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
        "improvement_surcharge double, total_amount double, payment_type long, trip_type long, congestion_surcharge double"
    ),
    "yellow": (
        "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count long, "
        "trip_distance double, RatecodeID long, store_and_fwd_flag string, PULocationID long, DOLocationID long, "
        "payment_type long, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
        "improvement_surcharge double, total_amount double, congestion_surcharge double"
    ),
}
PREFIX = {"green": "lpep", "yellow": "tpep"}
# Snake-case names as a load writes them, and the names that staging uses.
STAGED_NAMES = {"vendor_id": "vendorid", "ratecode_id": "ratecodeid", "pulocation_id": "pulocationid", "dolocation_id": "dolocationid"}


def read_trips(spark: SparkSession, paths: str | list[str], kind: str = "green") -> DataFrame:
    """Monthly trip files (plain or gzip) as one typed frame; a header that does not name the kind's columns is an error."""
    return read_csv(spark, paths, schema=TRIP_SCHEMAS[kind], timestampNTZFormat="yyyy-MM-dd HH:mm:ss", enforceSchema=False)


def clean_trips(raw: DataFrame, kind: str = "green") -> DataFrame:
    """Trips with passengers and distance, their pick-up date, names in snake case."""
    prefix = PREFIX[kind]
    kept = keep_positive(raw, "passenger_count", "trip_distance")
    return rename_all(kept.withColumn(f"{prefix}_pickup_date", F.to_date(f"{prefix}_pickup_datetime")), to_snake)


def check_clean(trips: DataFrame) -> DataFrame:
    """Report of the step checks of cleaned trips."""
    zeros = [quality.no_zero("passenger_count"), quality.no_zero("trip_distance")]
    return quality.report(
        quality.has_rows(trips), quality.first_column(trips, "vendor_id"), quality.row_checks(trips, zeros)
    )


def load_trips(spark: SparkSession, paths: str | list[str], out: str, kind: str = "green", replace: bool = False) -> str:
    """Files to a checked Parquet dataset with one folder per pick-up date; earlier loads stay.

    Rows are added to the folders of their dates.  ``replace`` empties these
    folders first (to load a file again); other dates are never touched.  The
    load is staged and checked before any of it is published, so a failed check
    leaves the dataset as it was.
    """
    by = f"{PREFIX[kind]}_pickup_date"
    trips = clean_trips(read_trips(spark, paths, kind), kind)
    stage = scratch_path(spark, "load")
    try:
        # Checked on the staged files, so that the source is read once.
        staged = spark.read.schema(trips.schema).parquet(write_partitioned(trips, stage, [by]))
        quality.enforce(check_clean(staged))
        return add_partitions(staged, out, [by], replace)
    finally:
        remove_path(spark, stage)


def trips_within_day(trips: DataFrame, day: str, prefix: str = "lpep") -> DataFrame:
    """Number of trips that start and end on one day."""
    inside = same_day(F.col(f"{prefix}_pickup_datetime"), day) & same_day(F.col(f"{prefix}_dropoff_datetime"), day)
    return trips.filter(inside).agg(F.count(F.lit(1)).alias("n"))


def longest_by_day(trips: DataFrame, prefix: str = "lpep") -> DataFrame:
    days = trips.groupBy(F.to_date(f"{prefix}_pickup_datetime").alias("day"))
    return days.agg(F.max("trip_distance").alias("longest")).orderBy(F.desc("longest"), "day")


def total_by_borough(trips: DataFrame, zones: DataFrame, day: str, prefix: str = "lpep") -> DataFrame:
    """Amount per known pick-up borough on one day; summed per zone before the join."""
    per_zone = trips.filter(same_day(F.col(f"{prefix}_pickup_datetime"), day)).groupBy("PULocationID").agg(
        F.sum("total_amount").alias("_total")
    )
    known = known_zones(zones).select(F.col("locationid").alias("PULocationID"), "borough")
    return per_zone.join(known, "PULocationID").groupBy("borough").agg(F.sum("_total").alias("total"))


def best_tip_by_dropoff(
    trips: DataFrame, zones: DataFrame, pickup_zone: str, first: str, last: str, prefix: str = "lpep"
) -> DataFrame:
    """Greatest tip per drop-off zone of trips from one zone; taken per zone id before the names join."""
    span = days_between(F.col(f"{prefix}_pickup_datetime"), first, last)
    pickup = zones.filter(F.col("zone") == pickup_zone).select(F.col("locationid").alias("PULocationID"))
    names = zones.select(F.col("locationid").alias("DOLocationID"), F.col("zone").alias("dropoff_zone"))
    per_zone = trips.filter(span).join(pickup, "PULocationID", "left_semi").groupBy("DOLocationID").agg(
        F.max("tip_amount").alias("_tip")
    )
    best = per_zone.join(names, "DOLocationID").groupBy("dropoff_zone").agg(F.max("_tip").alias("max_tip"))
    return best.orderBy(F.desc("max_tip"), "dropoff_zone")


def stage_trips(
    raw: DataFrame, pickup: str, dropoff: str, order: list[str], fixed: dict | None = None,
    test_run: bool = False, test_rows: int = 100,
) -> DataFrame:
    """One typed row per (vendor, pick-up time).

    ``order`` makes the kept row certain; rows without vendor are left out;
    ``fixed`` gives columns the files do not have.
    """
    raw = raw.withColumnsRenamed(STAGED_NAMES)  # names as a load writes them are fine too
    for name, value in (fixed or {}).items():
        raw = raw.withColumn(name, F.lit(value))
    one = first_per_key(raw.filter(F.col("vendorid").isNotNull()), ["vendorid", pickup], order)
    whole = lambda name: safe_int_of(raw, name)
    staged = one.select(
        surrogate_key("vendorid", pickup).alias("tripid"),
        whole("vendorid").alias("vendorid"),
        whole("ratecodeid").alias("ratecodeid"),
        whole("pulocationid").alias("pickup_locationid"),
        whole("dolocationid").alias("dropoff_locationid"),
        F.col(pickup).cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(dropoff).cast("timestamp_ntz").alias("dropoff_datetime"),
        "store_and_fwd_flag",
        whole("passenger_count").alias("passenger_count"),
        numeric("trip_distance").alias("trip_distance"),
        whole("trip_type").alias("trip_type"),
        *[numeric(c).alias(c) for c in MONEY],
        F.coalesce(whole("payment_type"), F.lit(0)).alias("payment_type"),
        payment_description("payment_type", is_text(raw, "payment_type")).alias("payment_type_description"),
    )
    return limited(staged, test_run, test_rows)


def stage_green(raw: DataFrame, order: list[str], **options) -> DataFrame:
    return stage_trips(raw, "lpep_pickup_datetime", "lpep_dropoff_datetime", order, **options)


def stage_yellow(raw: DataFrame, order: list[str], **options) -> DataFrame:
    """Yellow cabs are always hailed on the street and take no e-hail fee."""
    fixed = {"trip_type": 1, "ehail_fee": 0}
    return stage_trips(raw, "tpep_pickup_datetime", "tpep_dropoff_datetime", order, fixed, **options)


def stage_fhv(raw: DataFrame, days: tuple[str, str] = FHV_DAYS, test_run: bool = False, test_rows: int = 100) -> DataFrame:
    """For-hire trips of one year; rows are not deduplicated."""
    staged = raw.filter(days_between(F.col("pickup_datetime"), *days)).select(
        surrogate_key("dispatching_base_num", "pickup_datetime").alias("tripid"),
        F.col("dispatching_base_num").cast("string").alias("vendorid"),
        F.col("pulocationid").cast("int").alias("pickup_locationid"),
        F.col("dolocationid").cast("int").alias("dropoff_locationid"),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        "sr_flag",
    )
    return limited(staged, test_run, test_rows)


def dim_zones(lookup: DataFrame, replaced: tuple[str, str] = SERVICE_ZONE_TEXT) -> DataFrame:
    old, new = (F.lit(v) for v in replaced)
    return lookup.select("locationid", "borough", "zone", F.replace("service_zone", old, new).alias("service_zone"))


def known_zones(zones: DataFrame) -> DataFrame:
    return zones.filter(F.col("borough") != UNKNOWN_BOROUGH)


def fact_trips(green: DataFrame, yellow: DataFrame, zones: DataFrame) -> DataFrame:
    trips = tag_union({"Green": green, "Yellow": yellow}, "service_type")
    roles = {
        "pickup_locationid": ("pickup_", {"borough": "pickup_borough", "zone": "pickup_zone"}),
        "dropoff_locationid": ("dropoff_", {"borough": "dropoff_borough", "zone": "dropoff_zone"}),
    }
    joined = role_join(trips, known_zones(zones), "locationid", roles)
    return joined.select(
        "tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid", "pickup_borough", "pickup_zone",
        "dropoff_locationid", "dropoff_borough", "dropoff_zone", "pickup_datetime", "dropoff_datetime",
        "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type", *MONEY, "payment_type",
        "payment_type_description",
    )


def fact_fhv_trips(fhv: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with a known zone at both ends; zone ids are unique."""
    known = known_zones(zones).select("locationid")
    out = fhv
    for key in ("pickup_locationid", "dropoff_locationid"):
        out = out.join(known, F.col(key) == known.locationid, "left_semi")
    return out.select("tripid", "vendorid", "pickup_locationid", "dropoff_locationid", "pickup_datetime",
                      "dropoff_datetime", "sr_flag")


def trip_models(order: list[str], **options) -> dict[str, Model]:
    """Staging models as views, facts and dimension as tables."""
    return {
        "stg_green_tripdata": Model(lambda raw: stage_green(raw, order, **options), ["green_tripdata"]),
        "stg_yellow_tripdata": Model(lambda raw: stage_yellow(raw, order, **options), ["yellow_tripdata"]),
        "stg_fhv_tripdata": Model(lambda raw: stage_fhv(raw, **options), ["fhv_tripdata"]),
        "dim_zones": Model(dim_zones, ["taxi_zone_lookup"], "table"),
        "fact_trips": Model(fact_trips, ["stg_green_tripdata", "stg_yellow_tripdata", "dim_zones"], "table"),
        "fact_fhv_trips": Model(fact_fhv_trips, ["stg_fhv_tripdata", "dim_zones"], "table"),
    }
