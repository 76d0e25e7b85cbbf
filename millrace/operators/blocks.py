"""Text made of fixed-size blocks of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.running import before, chunked, upto


def block_rows(df: DataFrame, keys: list[str], text: str, size: int = 6) -> DataFrame:
    """One row per block of ``size`` lines: its number, head (line 0) and item (line 1).

    All lines count, blank ones too.
    """
    whole = F.col(text)
    unix = F.replace(F.replace(whole, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.split(F.when(F.contains(whole, F.lit("\r")), unix).otherwise(whole), "\n")
    # Only the two lines that count are trimmed.
    line = lambda at: F.regexp_replace(F.coalesce(F.get("_lines", at), F.lit("")), r"^\s+|\s+$", "")
    numbers = F.sequence(F.lit(0), F.floor((F.size("_lines") - 1) / size).cast("int"))
    blocks = F.transform(numbers, lambda b: F.struct(line(b * size).alias("head"), line(b * size + 1).alias("item")))
    rows = df.select(*keys, lines.alias("_lines")).select(*keys, F.posexplode(blocks).alias("block", "_r"))
    return rows.select(*keys, "block", "_r.head", "_r.item")


def block_lists(df: DataFrame, keys: list[str], text: str, size: int = 6) -> DataFrame:
    """Per text: each head with its items in text order, joined by ', '.

    A blank head leaves its block under the last head before it; a blank item
    is left out.  ``keys`` name one text each, so a group is never larger than
    the text of one row, and the grouping reuses the shuffle of the window.
    """
    rows = block_rows(df, keys, text, size)
    order = Window.partitionBy(*keys).orderBy("block")
    head = F.last(F.nullif(F.col("head"), F.lit("")), ignorenulls=True).over(order)
    items = F.collect_list(F.when(F.col("item") != "", F.struct("block", "item")))
    return (
        rows.withColumn("head", head)
        .filter(F.col("head").isNotNull())
        .groupBy(*keys, "head")
        .agg(
            F.min("block").alias("first_block"),
            F.array_join(F.transform(F.array_sort(items), lambda x: x["item"]), ", ").alias("items"),
        )
    )


def line_block_lists(lines: DataFrame, keys: list[str], size: int = 6, blocks_per_chunk: int = 100_000) -> DataFrame:
    """As ``block_lists``, for texts that come as numbered lines (``keys``, line from 0, text), however long.

    Only the first two lines of a block are grouped; heads are carried along
    chunks of blocks, so no task holds all lines of a text.
    """
    trimmed = F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "")
    place = F.col("line") % size
    rows = lines.filter(place < 2).groupBy(*keys, F.floor(F.col("line") / size).alias("block")).agg(
        F.max(F.when(place == 0, trimmed)).alias("_head"), F.coalesce(F.max(F.when(place == 1, trimmed)), F.lit("")).alias("item"))
    named = F.nullif(F.col("_head"), F.lit(""))
    got = chunked(
        rows, keys, F.floor(F.col("block") / blocks_per_chunk), [F.col("block")],
        local={"_in": lambda w: F.last(named, ignorenulls=True).over(upto(w))},
        summary={"_last": F.max_by(named, F.when(named.isNotNull(), F.col("block")))},
        carry={"_before": lambda w: F.last("_last", ignorenulls=True).over(before(w))},
    )
    items = F.collect_list(F.when(F.col("item") != "", F.struct("block", "item")))
    return (
        got.withColumn("head", F.coalesce("_in", "_before")).filter(F.col("head").isNotNull()).groupBy(*keys, "head")
        .agg(F.min("block").alias("first_block"), F.array_join(F.transform(F.array_sort(items), lambda x: x["item"]), ", ").alias("items"))
    )
