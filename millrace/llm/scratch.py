"""Tables written and read again between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path

_left: list[str] = []


class Scratch:
    """A folder of written tables below the shared folder that the session names.

    A table that a step has read for the last time is dropped; those that the
    returned frame still reads stay until ``release``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, name)
        _left.append(self.base)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, f"{self.base}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete what the operators of this session have written; frames that read it end with that."""
    while _left:
        _delete(spark, _left.pop())
