"""League data: clean-up of source files, dimension and fact models, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.expressions import numeric, season_start
from millrace.functions.names import columns_except, drop_first, rename_all, to_camel
from millrace.operators.rows import sentinel_to_null
from millrace.plans.models import Model
from millrace.sources.files import promote_first_row, read_csv, write_csv

# Dataset -> published table, cluster keys of the tables, tables
# partitioned by season, the duplicate column of the match statistics and the
# statistic codes that mean a goal.
TABLE_NAMES = {
    "club": "DimClub",
    "manager": "DimManager",
    "manager_club": "DimManagerClub",
    "club_stats": "DimMatchStats",
    "player": "DimPlayer",
    "player_club": "DimPlayerClub",
    "player_performance": "DimPlayerPerf",
    "player_stats": "DimPlayerStats",
    "stadium": "DimStadium",
    "match": "FactMatch",
}
CLUSTER_KEYS = {
    "DimClub": ["clubId"],
    "DimManager": ["managerId"],
    "DimManagerClub": ["managerId", "clubId"],
    "DimMatchStats": ["matchId", "clubId"],
    "DimPlayer": ["playerId"],
    "DimPlayerClub": ["playerId", "clubId"],
    "DimPlayerPerf": ["playerId", "matchId"],
    "DimPlayerStats": ["playerId", "matchId"],
    "DimStadium": ["stadiumId"],
    "FactMatch": ["matchId"],
}
# The datasets of each source and the encoding of their files.
SOURCES = {
    "DataSource1": ["club", "club_stats", "manager", "manager_club", "match", "player", "player_club", "player_performance", "player_stats", "stadium"],
    "DataSource2": ["team_discipline", "matches", "goal_leaders", "events", "assist_leaders", "all_tables"],
}
SOURCE_ENCODING = "windows-1252"
BY_SEASON = ["DimManagerClub", "DimPlayerClub", "FactMatch"]
DUPLICATE_STAT = "offsides1"
# Names of an index column: none in the header (as Spark reads it), or the exporter's own.
INDEX_NAMES = ("", "_c0", "Unnamed: 0")
GOAL_CODES = [1, 2]


def export_sources(spark: SparkSession, root: str, target: str, sources: dict[str, list[str]] | None = None,
                   encodings: dict[str, str] | None = None) -> dict[str, str]:
    """Every dataset of every source, ``root/source/dataset.csv``, as UTF-8 files in a folder of the same name below ``target``.

    Values stay text, as they are in the file.  A folder is replaced as a whole,
    so an export that stopped half-way is simply run again.  ``encodings``
    names datasets that are not in SOURCE_ENCODING.  Returns dataset -> folder,
    datasets by ``source/dataset``.
    """
    encodings, done = encodings or {}, {}
    for source, datasets in (sources or SOURCES).items():
        for name in datasets:
            rows = read_csv(spark, f"{root}/{source}/{name}.csv", encoding=encodings.get(name, SOURCE_ENCODING), infer=False)
            done[f"{source}/{name}"] = write_csv(rows, f"{target}/{source}/{name}.csv")
    return done


def read_sources(spark: SparkSession, root: str, datasets: list[str] | None = None, encodings: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The CSV files below ``root`` by dataset name, every column as text, header row as names.

    Only files that are not UTF-8 need an entry in ``encodings``.  The file of
    players carries its names in the first data row, which ``clean`` deals with.
    """
    encodings = encodings or {}
    return {
        name: read_csv(spark, f"{root}/{name}.csv", encoding=encodings.get(name, "utf-8"), infer=False)
        for name in datasets or list(TABLE_NAMES)
    }


def clean(dataset: str, raw: DataFrame, index_column: bool | None = None) -> DataFrame:
    """Drop the exporter's index column, fix the names, mark nulls, add the season start.

    The first column is an index if it is named like one; ``index_column`` says
    so where the name does not tell.
    """
    drop = raw.columns[0] in INDEX_NAMES if index_column is None else index_column
    df = drop_first(raw) if drop else raw
    if dataset == "player":
        df = promote_first_row(df)
    df = rename_all(df, to_camel)
    if dataset == "club_stats":
        df = df.select(*columns_except(df, DUPLICATE_STAT))
    df = sentinel_to_null(df)
    if "season" in df.columns:
        df = df.withColumn("seasonStartYear", season_start(F.col("season")))
    return df


def clean_all(raw: dict[str, DataFrame], index_column: bool | None = None) -> dict[str, DataFrame]:
    return {name: clean(name, df, index_column) for name, df in raw.items()}


def league_models() -> dict[str, Model]:
    """Pass-through tables with their layout, and the two marts as views."""
    out = {}
    for dataset, table in TABLE_NAMES.items():
        season = {"seasonYear": F.trunc("seasonStartYear", "year")} if table in BY_SEASON else {}
        out[table] = Model(lambda df: df, [dataset], "table", CLUSTER_KEYS[table], season)
    out["MrtAwayGames"] = Model(away_games, ["FactMatch", "DimMatchStats", "DimClub"])
    out["MrtGoalScorers"] = Model(goal_scorers, ["FactMatch", "DimPlayerPerf", "DimPlayer"])
    return out


def away_games(matches: DataFrame, stats: DataFrame, clubs: DataFrame) -> DataFrame:
    """Each match with the statistics and name of its away club."""
    s = stats.select(
        F.col("matchId").alias("_m"), F.col("clubId").alias("_c"),
        numeric("possession").alias("possession"), F.col("shots").cast("int").alias("shots"),
        F.col("shotsOnTarget").cast("int").alias("shotsOnTarget"), numeric("passes").alias("passes"),
        F.col("yellowCards").cast("int").alias("yellowCards"), F.col("redCards").cast("int").alias("redCards"),
    )
    names = clubs.select(F.col("clubId").alias("_club"), "clubName")
    joined = matches.join(s, (F.col("matchId") == F.col("_m")) & (F.col("awayTeamId") == F.col("_c")))
    return joined.join(names, F.col("_c") == F.col("_club")).drop("_m", "_c", "_club")


def goal_scorers(matches: DataFrame, performance: DataFrame, players: DataFrame) -> DataFrame:
    """One row per goal: season, player and match."""
    goals = performance.filter(F.col("typeOfStat").isin(*GOAL_CODES))
    seasons = matches.select("matchId", "seasonStartYear")
    names = players.select("playerId", "playerName")
    return goals.join(seasons, "matchId").join(names, "playerId").select(
        "seasonStartYear", *performance.columns, "playerName"
    )


def top_scorers(
    matches: DataFrame, performance: DataFrame, players: DataFrame, first: str, last: str, n: int = 10
) -> DataFrame:
    """Players with the most goals in a span of seasons.

    The same rows as the scorer mart, counted per player before names are
    joined, so a player with very many goals is one row there.
    """
    span = F.col("seasonStartYear").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    goals = performance.filter(F.col("typeOfStat").isin(*GOAL_CODES))
    counted = (
        goals.join(matches.filter(span).select("matchId"), "matchId")
        .groupBy("playerId").agg(F.count(F.lit(1)).alias("goals"))
    )
    named = counted.join(players.select("playerId", "playerName"), "playerId")
    return named.orderBy(F.desc("goals"), "playerId").limit(n)


def best_away_possession(games: DataFrame, first: str, last: str, per_season: int = 1) -> DataFrame:
    """Clubs with the highest mean possession in away games, per season."""
    span = F.col("seasonStartYear").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    means = games.filter(span).groupBy("seasonStartYear", "clubName").agg(
        F.round(F.avg("possession"), 6).cast("double").alias("possession"), F.count(F.lit(1)).alias("games")
    )
    order = Window.partitionBy("seasonStartYear").orderBy(F.desc("possession"), "clubName")
    return means.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= per_season).drop("_rn")
