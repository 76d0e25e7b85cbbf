"""Column-name rules.  Each is a pure projection: no data is touched."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    names = [rule(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"rename rule gives the same name twice: {twice}")
    return df.toDF(*names)


def to_snake(name: str) -> str:
    """``PULocationID`` -> ``pulocation_id``: break only between a-z and A-Z."""
    return re.sub(r"([a-z])([A-Z])", r"\1_\2", name).lower()


def to_camel(name: str) -> str:
    """``Shots_On.Target(x)`` -> ``shotsOnTargetx``."""
    flat = name.replace(".", "_").translate({ord("("): None, ord(")"): None}).lower()
    return re.sub(r"_(.)", lambda found: found[1].upper(), flat)


def to_plain(name: str) -> str:
    """``Engine HP`` -> ``engine_hp``."""
    return name.replace(" ", "_").lower()


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def columns_except(df: DataFrame, *drop: str) -> list[str]:
    return [c for c in df.columns if c not in drop]


def drop_first(df: DataFrame, n: int = 1) -> DataFrame:
    """Drop columns by position (an index column added by an exporter)."""
    return df.select(*[f"`{c}`" for c in df.columns[n:]])
