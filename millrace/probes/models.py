"""Staging, fact and mart models on stand-in tables.

Trips are order lines: vendor = line number, pick-up = order date, drop-off =
ship date.  Zones are nations; those of AFRICA count as unknown.  Matches are
orders, match statistics are order lines, clubs are suppliers, players are parts.
"""

from pyspark.sql import functions as F

from millrace.plans import football, taxi
from millrace.plans.models import build
from millrace.probes.registry import Tables, probe

_ORDER = ["orderkey", "partkey", "suppkey", "passenger_count", "fare_amount"]

_RAW_SQL = """
raw AS (SELECT l_linenumber AS vendorid, o_orderdate AS pickup, l_shipdate AS dropoff, l_returnflag AS store_and_fwd_flag,
               o_custkey % 6 + 1 AS ratecodeid, c_nationkey AS pu, s_nationkey AS dor, l_quantity AS passenger_count,
               l_tax * 100 AS trip_distance, l_extendedprice AS fare, l_tax AS tax, l_discount AS tip, l_linenumber AS payment_type,
               l_orderkey, l_partkey, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
one AS (SELECT *, CASE WHEN parity = 0 THEN 'Green' ELSE 'Yellow' END AS service_type FROM (SELECT *, l_orderkey % 2 AS parity FROM raw)
        QUALIFY row_number() OVER (PARTITION BY parity, vendorid, pickup ORDER BY l_orderkey, l_partkey, l_suppkey, passenger_count, fare) = 1),
stg AS (SELECT md5(vendorid || '-' || CAST(pickup AS VARCHAR)) AS tripid, CAST(vendorid AS INTEGER) AS vendorid, service_type,
               CAST(ratecodeid AS INTEGER) AS ratecodeid, CAST(pu AS INTEGER) AS pickup_locationid, CAST(dor AS INTEGER) AS dropoff_locationid,
               pickup AS pickup_datetime, dropoff AS dropoff_datetime, store_and_fwd_flag, CAST(passenger_count AS INTEGER) AS passenger_count,
               round(trip_distance, 2) AS trip_distance, CASE service_type WHEN 'Green' THEN 2 ELSE 1 END AS trip_type, fare AS fare_amount, tax AS mta_tax,
               tip AS tip_amount, CASE service_type WHEN 'Green' THEN 1.5 ELSE 0 END AS ehail_fee,
               CASE WHEN payment_type = 7 THEN 0 ELSE payment_type END AS payment_type,
               CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
                    WHEN 6 THEN 'Voided trip' ELSE 'EMPTY' END AS payment_type_description FROM one),
zones AS (SELECT n_nationkey AS locationid, CASE r_name WHEN 'AFRICA' THEN 'Unknown' ELSE r_name END AS borough, n_name AS zone,
                 replace(CASE WHEN n_nationkey % 3 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END, 'Boro', 'Green') AS service_zone
          FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


def _raw_trips(t: Tables):
    fares = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # Payment 7 is text that is no number, so staging must fall back to 0.
    payment = F.when(F.col("l_linenumber") == 7, "x").otherwise(F.col("l_linenumber").cast("string"))
    return fares.select(
        F.col("l_linenumber").alias("vendorid"), F.col("o_orderdate").alias("pickup"), F.col("l_shipdate").alias("dropoff"),
        F.col("l_returnflag").alias("store_and_fwd_flag"), (F.col("o_custkey") % 6 + 1).alias("ratecodeid"),
        F.col("c_nationkey").alias("pulocationid"), F.col("s_nationkey").alias("dolocationid"),
        F.col("l_quantity").alias("passenger_count"), (F.col("l_tax") * 100).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"), F.lit(0.5).alias("extra"), F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"), F.lit(0.0).alias("tolls_amount"), F.lit(0.3).alias("improvement_surcharge"),
        F.col("l_extendedprice").alias("total_amount"), payment.alias("payment_type"),
        F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
    )


def _sources(t: Tables):
    raw = _raw_trips(t)
    green = raw.filter(F.col("orderkey") % 2 == 0).withColumns({"trip_type": F.lit("2"), "ehail_fee": F.lit(1.5)})
    yellow = raw.filter(F.col("orderkey") % 2 != 0)
    rename = lambda df, p: df.withColumnsRenamed({"pickup": f"{p}_pickup_datetime", "dropoff": f"{p}_dropoff_datetime"})
    fhv = raw.select(
        F.concat(F.lit("B"), F.col("suppkey").cast("string")).alias("dispatching_base_num"), F.col("pickup").alias("pickup_datetime"),
        F.col("dropoff").alias("dropoff_datetime"), "pulocationid", "dolocationid", F.nullif("vendorid", F.lit(7)).alias("sr_flag"),
    )
    lookup = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("locationid"),
        F.when(F.col("r_name") == "AFRICA", "Unknown").otherwise(F.col("r_name")).alias("borough"), F.col("n_name").alias("zone"),
        F.when(F.col("n_nationkey") % 3 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone"),
    )
    return {"green_tripdata": rename(green, "lpep"), "yellow_tripdata": rename(yellow, "tpep"), "fhv_tripdata": fhv,
            "taxi_zone_lookup": lookup}


def _plain(df, *cols):
    """Decimals as doubles, for a comparison across engines."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in (*taxi.MONEY, "trip_distance") else c for c in cols])


_STAGED = ["tripid", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid", "pickup_datetime", "dropoff_datetime",
           "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type", "fare_amount", "mta_tax", "tip_amount", "ehail_fee",
           "payment_type", "payment_type_description"]


@probe("staging_trips", f"WITH {_RAW_SQL} SELECT {', '.join(_STAGED)} FROM stg WHERE service_type = 'Green'")
def staging_trips(t: Tables):
    return _plain(taxi.stage_green(_sources(t)["green_tripdata"], _ORDER), *_STAGED)


@probe("staging_yellow_trips", f"WITH {_RAW_SQL} SELECT {', '.join(_STAGED)} FROM stg WHERE service_type = 'Yellow'")
def staging_yellow_trips(t: Tables):
    return _plain(taxi.stage_yellow(_sources(t)["yellow_tripdata"], _ORDER), *_STAGED)


@probe("dim_zones", f"WITH {_RAW_SQL} SELECT * FROM zones")
def dim_zones(t: Tables):
    return taxi.dim_zones(_sources(t)["taxi_zone_lookup"])


_FACT = ["tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid", "pickup_borough", "pickup_zone", "dropoff_locationid",
         "dropoff_borough", "dropoff_zone", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count", "trip_distance",
         "trip_type", "fare_amount", "mta_tax", "tip_amount", "ehail_fee", "payment_type", "payment_type_description"]


@probe("fact_trips_model", f"""
WITH {_RAW_SQL}, known AS (SELECT * FROM zones WHERE borough <> 'Unknown'),
f AS (SELECT stg.*, p.borough AS pickup_borough, p.zone AS pickup_zone, d.borough AS dropoff_borough, d.zone AS dropoff_zone
      FROM stg JOIN known p ON pickup_locationid = p.locationid JOIN known d ON dropoff_locationid = d.locationid)
SELECT {', '.join(_FACT)} FROM f
""")
def fact_trips_model(t: Tables):
    """Staging views, zone table and fact table built by name."""
    root = t.scratch("trip_models")
    built = build(t.spark, taxi.trip_models(_ORDER), _sources(t), ["fact_trips"], root, prefix=f"m{root[-12:]}_")
    return _plain(built["fact_trips"], *_FACT)


@probe("fact_fhv_model", f"""
WITH {_RAW_SQL}, known AS (SELECT locationid FROM zones WHERE borough <> 'Unknown')
SELECT md5('B' || l_suppkey || '-' || CAST(pickup AS VARCHAR)) AS tripid, 'B' || l_suppkey AS vendorid, CAST(pu AS INTEGER) AS pickup_locationid,
       CAST(dor AS INTEGER) AS dropoff_locationid, pickup AS pickup_datetime, dropoff AS dropoff_datetime, nullif(vendorid, 7) AS sr_flag
FROM raw WHERE CAST(pickup AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
  AND pu IN (SELECT locationid FROM known) AND dor IN (SELECT locationid FROM known)
""")
def fact_fhv_model(t: Tables):
    src = _sources(t)
    fhv = taxi.stage_fhv(src["fhv_tripdata"], ("1997-01-01", "1997-12-31"))
    return taxi.fact_fhv_trips(fhv, taxi.dim_zones(src["taxi_zone_lookup"]))


_SEASON = "CAST(date_trunc('year', o_orderdate) AS DATE)"


def _league(t: Tables):
    """Raw files as their loader leaves them: an index column, odd names, numbers as text."""
    index = F.lit(0).alias("Unnamed: 0")
    season = F.concat(F.year("o_orderdate").cast("string"), F.lit("/"), F.right((F.year("o_orderdate") + 1).cast("string"), F.lit(2)))
    text = lambda c, n: F.col(c).cast("string").alias(n)
    return {
        "match": t.orders.select(index, F.col("o_orderkey").alias("match.id"), (F.col("o_custkey") % 100).alias("away_team_id"),
                                 season.alias("season"), F.col("o_orderstatus").alias("result_(ft)")),
        "club_stats": t.lineitem.select(
            index, F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("club_id"), text("l_discount", "possession"),
            F.col("l_quantity").cast("int").cast("string").alias("shots"), text("l_linenumber", "shots_on_target"),
            text("l_extendedprice", "passes"), F.lit("3").alias("Yellow_Cards"),
            F.when(F.col("l_returnflag") == "A", r"\N").otherwise("1").alias("red_cards"), F.lit("0").alias("offsides1")),
        "club": t.supplier.select(index, F.col("s_suppkey").alias("club_id"), F.col("s_name").alias("club_name")),
        "player_performance": t.lineitem.select(index, F.col("l_partkey").alias("player_id"), F.col("l_orderkey").alias("match_id"),
                                                F.col("l_linenumber").alias("type_of_stat")),
    }


_GAMES_SQL = f"""
games AS (SELECT o_orderkey AS "matchId", o_custkey % 100 AS "awayTeamId",
                 year(o_orderdate) || '/' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS season, o_orderstatus AS "resultFt",
                 {_SEASON} AS "seasonStartYear", l_discount AS possession, CAST(l_quantity AS INTEGER) AS shots, l_linenumber AS "shotsOnTarget",
                 l_extendedprice AS passes, 3 AS "yellowCards", CASE WHEN l_returnflag = 'A' THEN NULL ELSE 1 END AS "redCards", s_name AS "clubName"
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_custkey % 100 = l_suppkey JOIN supplier ON l_suppkey = s_suppkey)
"""


def _games(t: Tables):
    clean = football.clean_all({k: v for k, v in _league(t).items()})
    return football.away_games(clean["match"], clean["club_stats"], clean["club"])


@probe("away_games_mart", f"WITH {_GAMES_SQL} SELECT * FROM games")
def away_games_mart(t: Tables):
    return _games(t).withColumns({c: F.col(c).cast("double") for c in ("possession", "passes")})


@probe("best_away_possession", f"""
WITH {_GAMES_SQL}, m AS (SELECT "seasonStartYear", "clubName", round(avg(possession), 6) AS possession, count(*) AS games FROM games
                         WHERE "seasonStartYear" BETWEEN DATE '1996-01-01' AND DATE '1999-01-01' GROUP BY 1, 2)
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY "seasonStartYear" ORDER BY possession DESC, "clubName") <= 3
""")
def best_away_possession(t: Tables):
    return football.best_away_possession(_games(t), "1996-01-01", "1999-01-01", per_season=3)


_GOALS_SQL = f"""
goals AS (SELECT {_SEASON} AS "seasonStartYear", l_partkey AS "playerId", o_orderkey AS "matchId", l_linenumber AS "typeOfStat", p_name AS "playerName"
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linenumber IN (1, 2))
"""


def _goal_sources(t: Tables):
    raw = _league(t)
    clean = football.clean_all({k: raw[k] for k in ("match", "player_performance")})
    players = t.part.select(F.col("p_partkey").alias("playerId"), F.col("p_name").alias("playerName"))
    return clean["match"], clean["player_performance"], players


@probe("goal_scorers_mart", f"WITH {_GOALS_SQL} SELECT * FROM goals")
def goal_scorers_mart(t: Tables):
    return football.goal_scorers(*_goal_sources(t))


@probe("top_scorers", f"""
WITH {_GOALS_SQL} SELECT "playerId", count(*) AS goals, any_value("playerName") AS "playerName" FROM goals
WHERE "seasonStartYear" BETWEEN DATE '1996-01-01' AND DATE '1999-01-01' GROUP BY 1 ORDER BY goals DESC, "playerId" LIMIT 10
""")
def top_scorers(t: Tables):
    return football.top_scorers(*_goal_sources(t), "1996-01-01", "1999-01-01")


@probe("league_tables", f"""
WITH {_GAMES_SQL} SELECT "seasonStartYear", count(*) AS n, CAST(sum(shots) AS BIGINT) AS shots, max("clubName") AS last_club FROM games GROUP BY 1
""")
def league_tables(t: Tables):
    """Clean-up, clustered and season-partitioned tables and the mart, built by name."""
    root = t.scratch("league")
    raw = football.clean_all(_league(t))
    built = build(t.spark, football.league_models(), raw, ["MrtAwayGames"], root, prefix=f"m{root[-12:]}_")
    return built["MrtAwayGames"].groupBy("seasonStartYear").agg(
        F.count(F.lit(1)).alias("n"), F.sum("shots").alias("shots"), F.max("clubName").alias("last_club")
    )
