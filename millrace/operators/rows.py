"""Row-level jobs: deduplication, fills, splits, generated and repeated rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that share a hash prefix when a split is cut, about.
PREFIX_ROWS = 100_000


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order`` (nulls first).

    The planner limits each map task's part of a key to its first row before the
    shuffle (WindowGroupLimit), and reads no column that is not asked for.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", first).filter("_rn = 1").drop("_rn")


def keep_positive(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.filter(F.col(c) > 0)
    return df


def sentinel_to_null(df: DataFrame, marker: str = r"\N", cols: list[str] | None = None) -> DataFrame:
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    cols = text if cols is None else cols
    return df.withColumns({c: F.nullif(F.col(c), F.lit(marker)) for c in cols})


def fill_mean(df: DataFrame, *cols: str) -> DataFrame:
    """Each null becomes the mean of its own column; the means are one scalar row."""
    for c in cols:
        mean = df.agg(F.avg(c)).scalar()
        df = df.withColumn(c, F.coalesce(F.col(c).cast("double"), mean))
    return df


def flag(cond: Column) -> Column:
    """1 where true, 0 where false or null."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def at_least_mean(df: DataFrame, value: str, out: str) -> DataFrame:
    return df.withColumn(out, flag(F.col(value) >= df.agg(F.avg(value)).scalar()))


def limited(df: DataFrame, test_run: bool = True, n: int = 100) -> DataFrame:
    """Test runs read a few rows only."""
    return df.limit(n) if test_run else df


def in_order(df: DataFrame, *keys) -> DataFrame:
    """Sorted by ``keys``, ties by a hash of the row.

    The order is total but for equal rows, and a key shared by very many rows
    can be cut into several ranges instead of ending up in one task.
    """
    return df.orderBy(*keys, F.xxhash64(*df.columns))


def repeat_rows(df: DataFrame, times: int, out: str = "copy") -> DataFrame:
    """Every row ``times`` times, numbered from 1, without a join or shuffle."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(times))))


def tag_union(tagged: dict[str, DataFrame], column: str) -> DataFrame:
    """All inputs by name under each other, a literal tag naming the input."""
    out = None
    for tag, df in tagged.items():
        part = df.withColumn(column, F.lit(tag))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def split_cuts(df: DataFrame, key: str, seeds: list[int], parts: list[tuple[str, float]], digits: int | None = None) -> dict:
    """Last (digest, key) of every part but the last, per seed.

    Two passes: hash prefixes are counted (``16 ** digits`` rows per seed), then
    only the rows of the prefixes that hold a cut are ranked.  Unless given, the
    digits follow the row count, so that a prefix holds about PREFIX_ROWS rows
    or less.  What reaches the driver is one row per cut.
    """
    if digits is None:
        digits = max(3, math.ceil(math.log(max(1, df.count()) / PREFIX_ROWS, 16)))
    rows = _digests(df.select(key), key, F.explode(F.array(*[F.lit(s) for s in seeds])))
    rows = rows.withColumn("_b", F.substring("_h", 1, digits))
    counts = rows.groupBy("_seed", "_b").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("_seed").orderBy("_b")
    total = F.sum("_n").over(Window.partitionBy("_seed"))
    counts = counts.select("_seed", "_b", "_n", F.sum("_n").over(order).alias("_upto"), total.alias("_total"))
    sizes = [F.floor(F.col("_total") * F.lit(f).cast("decimal(9,6)")) for _, f in parts[1:]]
    ends, end = [], F.col("_total")
    for (name, _), size in zip(reversed(parts[:-1]), reversed(sizes)):
        end = end - size
        ends.insert(0, F.struct(F.lit(name).alias("name"), end.alias("at")))
    cuts = counts.select("_seed", "_b", (F.col("_upto") - F.col("_n")).alias("_before"), "_upto", F.inline(F.array(*ends)))
    cuts = cuts.filter((F.col("at") > F.col("_before")) & (F.col("at") <= F.col("_upto")))
    wanted = cuts.groupBy("_seed", "_b").agg(
        F.collect_list(F.struct("name", (F.col("at") - F.col("_before")).alias("at"))).alias("_cuts")
    )
    rank = F.row_number().over(Window.partitionBy("_seed", "_b").orderBy("_h", key))
    ranked = rows.join(F.broadcast(wanted), ["_seed", "_b"]).withColumn("_rn", rank)
    hits = ranked.select("_seed", "_h", F.col(key).alias("_key"), "_rn", F.inline("_cuts")).filter("_rn = at")
    return {(r["_seed"], r["name"]): (r["_h"], r["_key"]) for r in hits.collect()}


def _digests(df: DataFrame, key: str, seed: Column) -> DataFrame:
    rows = df.withColumn("_seed", seed)
    return rows.withColumn("_h", F.md5(F.concat(F.col("_seed").cast("string"), F.lit("|"), F.col(key).cast("string"))))


def exact_split(
    df: DataFrame, key: str, seeds: int | list[int], parts: list[tuple[str, float]], out: str = "split"
) -> DataFrame:
    """Shuffle by seed and cut into parts of exact size.

    ``parts`` after the first have ``floor(n * fraction)`` rows; the first part
    takes the rest and comes first.  ``key`` must be unique.  A list of seeds
    gives every row once per seed, with a ``seed`` column, in the same pass.

    The cuts are found first; from then on a row's part is a comparison inside
    the row, with no shuffle, join or window.
    """
    many = [seeds] if isinstance(seeds, int) else list(seeds)
    cuts = split_cuts(df, key, many, parts)
    rows = _digests(df, key, F.lit(seeds) if isinstance(seeds, int) else F.explode(F.array(*[F.lit(s) for s in many])))
    here = F.struct(F.col("_h").alias("h"), F.col(key).alias("k"))

    def part_of(seed: int) -> Column:
        label = F.lit(parts[-1][0])
        for name, _ in reversed(parts[:-1]):
            if (seed, name) in cuts:  # a part without rows has no cut
                digest, last = cuts[seed, name]
                upto = F.struct(F.lit(digest).alias("h"), F.lit(last).cast(df.schema[key].dataType).alias("k"))
                label = F.when(here <= upto, F.lit(name)).otherwise(label)
        return label

    label = part_of(many[-1])
    for seed in many[:-1]:
        label = F.when(F.col("_seed") == seed, part_of(seed)).otherwise(label)
    if isinstance(seeds, int):
        return rows.withColumn(out, label).select(*df.columns, out)
    return rows.withColumn(out, label).select(*df.columns, F.col("_seed").alias("seed"), out)
