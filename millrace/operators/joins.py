"""Join shapes.  No side is forced to broadcast: the planner compares the known
size of each side with its broadcast limit, and the adaptive planner again with
the measured size; beyond it the join shuffles and skewed parts are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def role_join(fact: DataFrame, dim: DataFrame, key: str, roles: dict[str, tuple[str, dict[str, str]]]) -> DataFrame:
    """Join one dimension in several roles.

    ``roles``: fact key -> (role prefix, {dimension column: output column}).
    """
    for fact_key, (prefix, take) in roles.items():
        side = dim.select(
            F.col(key).alias(f"_{prefix}key"), *[F.col(c).alias(n) for c, n in take.items()]
        )
        fact = fact.join(side, F.col(fact_key) == F.col(f"_{prefix}key")).drop(f"_{prefix}key")
    return fact


def coalesced_join(left: DataFrame, right: DataFrame, left_keys: list[Column], right_key: Column) -> DataFrame:
    """Left join on the first left key that is not null."""
    return left.join(right, F.coalesce(*left_keys) == right_key, "left")


def left_join_many(few: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Left join of a short table to a long one on a key one value of which may hold much of the long one.

    The planner cannot split the right side of a left join.  As an inner join
    the long side can be split or streamed past a broadcast; rows of the short
    table without a partner are added, found by the distinct keys alone.
    """
    met = many.join(few, key)
    alone = few.join(many.select(key).distinct(), key, "left_anti")
    order = [key, *[c for c in few.columns if c != key], *[c for c in many.columns if c != key]]
    return met.select(*order).unionByName(alone, allowMissingColumns=True)


#: Rows of one key from which several tasks share them.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, least: int = HOT_ROWS) -> DataFrame | None:
    """(_hot, _copies): keys with more rows than a shuffle partition's even share, ``least`` at least, and how many shares they are.

    Null is a key as any other.  As each holds more than an even share, they are
    fewer than shuffle partitions, so their list may be collected and broadcast.
    One pass over the keys tells whether there are any.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    share = max(least, -(-(total or 0) // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    if (most or 0) <= share:
        return None
    hot = counts.filter(F.col("_n") > share).select("_hot", F.ceil(F.col("_n") / share).cast("int").alias("_copies"))
    return spark.createDataFrame(hot.collect(), hot.schema)


def spread_joins(long: DataFrame, key: str, sides: list[tuple[DataFrame, str]], least: int = HOT_ROWS) -> DataFrame:
    """``long`` joined to one short side after the other on the same key, as ``(side, how)``: inner or left.

    Such a chain runs within one shuffle, in which the planner splits no key.
    Rows of a hot key are dealt out by their content over several parts, and
    the short sides' rows are repeated for these keys and parts only.  Rows
    that are equal in every column stay together.
    """
    hot = hot_keys(long.select(key), key, least)
    if hot is None:
        for side, how in sides:
            long = long.join(side, key, how)
        return long

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), df[key].eqNullSafe(hot["_hot"]), "left").drop("_hot")

    out = marked(long).withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*long.columns), F.col("_copies")).cast("int"), F.lit(0))).drop("_copies")
    for side, how in sides:
        parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)) - 1))
        out = out.join(marked(side).withColumn("_part", parts).drop("_copies"), [key, "_part"], how)
    return out.drop("_part")


def borders_by_offset(parts: DataFrame, borders: DataFrame, keys: list[str], number: str, border_id: str,
                      value: str) -> DataFrame:
    """Lower and upper border of each part: border ``n - 1`` and border ``n``."""
    b = borders.select(*keys, border_id, value)
    upper = b.select(*keys, F.col(border_id).alias(number), F.col(value).alias("upper_border"))
    lower = b.select(*keys, (F.col(border_id) + 1).alias(number), F.col(value).alias("lower_border"))
    return parts.join(upper, [*keys, number], "left").join(lower, [*keys, number], "left")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them; null keys are ignored.

    Children are counted per key before the join, so a hot key is one row there.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    parents = parent.select(F.col(parent_key).alias("key"))
    return keys.join(parents, "key", "left_anti")
