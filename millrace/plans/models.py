"""Named models: each a function of its inputs, kept as a view or as a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import tables


@dataclass
class Model:
    fn: Callable[..., DataFrame]
    inputs: list[str]
    kind: str = "view"
    cluster: list[str] = field(default_factory=list)
    partition: dict = field(default_factory=dict)


def build(
    spark: SparkSession, models: dict[str, Model], sources: dict[str, DataFrame], wanted: list[str], root: str,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Build the wanted models and whatever they need, each once.

    Views stay lazy; tables are written below ``root`` (sorted and partitioned
    as declared), stand in the catalog and are read back, so later models read files.
    """
    done: dict[str, DataFrame] = dict(sources)
    open_: set[str] = set()

    def get(name: str) -> DataFrame:
        if name in done:
            return done[name]
        if name not in models:
            raise KeyError(f"no source or model named {name}")
        if name in open_:
            raise ValueError(f"model {name} needs itself")
        open_.add(name)
        model = models[name]
        df = model.fn(*[get(i) for i in model.inputs])
        done[name] = _keep(spark, df, model, prefix + name, f"{root}/{name}")
        return done[name]

    return {name: get(name) for name in wanted}


def _keep(spark: SparkSession, df: DataFrame, model: Model, name: str, path: str) -> DataFrame:
    if model.kind == "view":
        df.createOrReplaceTempView(name)
        return df
    return tables.publish(df, name, path, cluster=model.cluster, partition=model.partition)
