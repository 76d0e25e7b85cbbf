"""Databases over JDBC (the driver jar and the server are the user's)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, url: str, table: str, key: str | None = None,
    low: int | None = None, high: int | None = None, parts: int = 1, **options,
) -> DataFrame:
    """A table, read in ``parts`` key ranges at once when a numeric key is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key is not None and parts > 1:
        reader = reader.options(partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def read_query(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """Result of a query the database runs, LIMIT included."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def replace_then_append(df: DataFrame, url: str, table: str, column_types: str | None = None, **options) -> None:
    """Create the table anew from the columns alone, then append the rows.

    A failed load leaves the empty table, not a half-replaced one.
    """
    writer = {"url": url, "dbtable": table, **options}
    head = df.limit(0).write.format("jdbc").options(**writer).mode("overwrite")
    if column_types:
        head = head.option("createTableColumnTypes", column_types)
    head.save()
    df.write.format("jdbc").options(**writer).mode("append").save()


def create_table_text(name: str, schema: T.StructType) -> str:
    """CREATE TABLE statement for a frame's columns."""
    # SQL type names of the Spark types.
    names = {
        "string": "TEXT", "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT",
        "double": "DOUBLE PRECISION", "float": "REAL", "boolean": "BOOLEAN", "date": "DATE",
        "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA",
    }
    lines = [
        f'    "{f.name}" {names.get(f.dataType.simpleString(), f.dataType.simpleString().upper())}'
        for f in schema.fields
    ]
    return f'CREATE TABLE "{name}" (\n' + ",\n".join(lines) + "\n)"
