"""Published tables: partitioned, clustered, copied, appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a scan that is dealt out, per core or split.
TASKS_A_CORE = 4


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> str:
    """Parquet dataset with one folder per value of ``by``.

    Rows of one folder are gathered first, so tasks do not each write a small
    file into every folder.  The rebalance hint lets the adaptive planner split
    a folder that holds much of the data over several tasks and files.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def add_partitions(df: DataFrame, path: str, by: list[str], replace: bool = False) -> str:
    """Add rows to a dataset with one folder per value of ``by``.

    With ``replace`` the folders that ``df`` has rows for are emptied first;
    all others stay as they are.
    """
    writer = df.hint("rebalance", *by).write.partitionBy(*by)
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)
    return path


def _ranged(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows ranged and sorted by ``keys``.

    A hash of the row is the last range key: without it all rows of one hot key
    would fall into one range, that is one task and one file.
    """
    return df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)


def write_partitioned_clustered(
    df: DataFrame, path: str, partition: dict[str, Column], cluster: list[str]
) -> str:
    """Partition folders by derived columns, rows sorted by ``cluster`` inside.

    Rows are ranged over (partition, cluster): a large folder becomes several
    files with narrow key ranges, which Parquet statistics can skip.
    """
    parts = df.withColumns(partition)
    _ranged(parts, [*partition, *cluster]).write.mode("overwrite").partitionBy(*partition).parquet(path)
    return path


def write_clustered(df: DataFrame, path: str, cluster: list[str]) -> str:
    _ranged(df, cluster).write.mode("overwrite").parquet(path)
    return path


def publish(df: DataFrame, name: str, path: str, mode: str = "overwrite", cluster: list[str] | None = None,
            partition: dict[str, Column] | None = None) -> DataFrame:
    """Save as a named table at ``path``, sorted by ``cluster`` and with folders by ``partition``; returns the table."""
    partition = partition or {}
    rows = df.withColumns(partition) if partition else df
    if cluster or partition:
        rows = _ranged(rows, [*partition, *(cluster or [])])
    rows.write.mode(mode).option("path", path).partitionBy(*partition).saveAsTable(name)
    return df.sparkSession.table(name)


def publish_all(frames: dict[str, DataFrame], names: dict[str, str], root: str, database: str = "default") -> dict[str, str]:
    """Replace one table per named frame; ``names`` maps frame names to table names."""
    done = {}
    for frame, df in frames.items():
        table = names.get(frame, frame)
        publish(df, f"{database}.{table}", f"{root}/{table}")
        done[frame] = table
    return done


def external_table(spark: SparkSession, name: str, glob: str, fmt: str = "parquet") -> DataFrame:
    """Named view over all files a wildcard matches; a single folder may also be a table."""
    df = spark.read.format(fmt).load(glob)
    df.createOrReplaceTempView(name)
    return df


def empty_table(spark: SparkSession, name: str) -> None:
    """Remove all rows, keep the table.

    An overwrite with no rows also works on tables at a path of their own,
    which TRUNCATE refuses.
    """
    spark.createDataFrame([], spark.table(name).schema).write.mode("overwrite").insertInto(name)


def add_rows(df: DataFrame, name: str) -> None:
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def column_stats(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """Compute and list the optimizer statistics of a table's columns."""
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {listed}")
    out = None
    for c in columns:
        part = spark.sql(f"DESCRIBE EXTENDED {name} `{c}`").groupBy().pivot(
            "info_name", ["col_name", "data_type", "min", "max", "num_nulls", "distinct_count"]
        ).agg(F.first("info_value"))
        out = part if out is None else out.unionByName(part)
    return out


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a result that several queries read, in the shared folder, and read it back.

    Unlike cached blocks, the files outlive a lost executor.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread_scan(scan: DataFrame) -> DataFrame:
    """A plain scan, dealt out evenly over several tasks a core.

    For work that costs far more than a shuffle of the rows it starts from.  The
    number of splits does not say how the work lies: splits are cut by bytes,
    but a Parquet row group is read whole by one of them, and the rest are empty.
    """
    splits = max(scan.sparkSession.sparkContext.defaultParallelism, scan.rdd.getNumPartitions())
    return scan.repartition(TASKS_A_CORE * splits)
