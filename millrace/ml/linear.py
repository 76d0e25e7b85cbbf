"""Linear and ridge regression from distributed sums.

One pass adds up the products of all feature pairs; only that small square
matrix reaches the driver, where it is solved for any number of ridge values.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIAS = "bias"
#: Fits whose sums may reach the driver together.
MOST_FITS = 1000


def _terms(features: list[str], bias: bool = True) -> list[tuple[str, Column]]:
    return [(BIAS, F.lit(1.0))] * bias + [(f, F.col(f).cast("double")) for f in features]


def _sums(features: list[str], target: str, bias: bool = True) -> tuple[list[Column], list[tuple[str, str]]]:
    terms = _terms(features, bias)
    cols, names = [], []
    for i, (a, x) in enumerate(terms):
        for b, y in [*terms[i:], (target, F.col(target).cast("double"))]:
            cols.append(F.sum(F.when(_complete(features, target), x * y)).alias(f"s{len(cols)}"))
            names.append((a, b))
    cols.append(F.count_if(~_complete(features, target)).alias("n_null"))
    return cols, names


def _complete(features: list[str], target: str) -> Column:
    whole = F.col(target).isNotNull()
    for f in features:
        whole = whole & F.col(f).isNotNull()
    return whole


def _refuse_nulls(row) -> None:
    if row["n_null"]:
        raise ValueError(f"{row['n_null']} rows have no target or lack a feature; fill or drop them first")


def gram(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Long form of X'X and X'y: one row per (row, col); rows with a null take no part."""
    cols, names = _sums(features, target)
    row = df.agg(*cols)
    cells = [
        F.struct(F.lit(x).alias("row"), F.lit(y).alias("col"), F.col(f"s{i}").alias("value"))
        for i, (a, b) in enumerate(names)
        for x, y in ([(a, b)] if a == b or b == target else [(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


@dataclass
class Fit:
    """Weights by term; the bias, if there is one, comes first."""

    terms: list[str]
    weights: np.ndarray

    def predict(self) -> Column:
        out = F.lit(0.0)
        for term, w in self.named():
            out = out + (F.lit(w) if term == BIAS else F.col(term) * F.lit(w))
        return out

    def named(self) -> list[tuple[str, float]]:
        return list(zip(self.terms, map(float, self.weights)))


def _matrices(row, terms: list[str], target: str, names) -> tuple[np.ndarray, np.ndarray]:
    order = {n: i for i, n in enumerate(terms)}
    xtx, xty = np.zeros((len(order), len(order))), np.zeros(len(order))
    for i, (a, b) in enumerate(names):
        if b == target and b not in order:
            xty[order[a]] = row[f"s{i}"]
        else:
            xtx[order[a], order[b]] = xtx[order[b], order[a]] = row[f"s{i}"]
    return xtx, xty


def solve(xtx: np.ndarray, xty: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Normal equation; the ridge value is added for the bias too."""
    return np.linalg.solve(xtx + ridge * np.eye(len(xty)), xty)


def fit(
    df: DataFrame, features: list[str], target: str, ridges: tuple[float, ...] = (0.0,), bias: bool = True
) -> dict[float, Fit]:
    """One pass over the data for all ridge values."""
    if target in features:
        raise ValueError("the target must not be a feature")
    cols, names = _sums(features, target, bias)
    terms = [BIAS] * bias + list(features)
    row = df.agg(*cols).first()
    _refuse_nulls(row)
    xtx, xty = _matrices(row, terms, target, names)
    return {r: Fit(terms, solve(xtx, xty, r)) for r in ridges}


def fit_groups(df: DataFrame, group: str, features: list[str], target: str, ridge: float = 0.0) -> dict:
    """One fit per value of a short grouping column (seeds, folds), in one pass; MOST_FITS values at most."""
    cols, names = _sums(features, target)
    rows = df.groupBy(group).agg(*cols).limit(MOST_FITS + 1).collect()
    if len(rows) > MOST_FITS:
        raise ValueError(f"{group} has more than {MOST_FITS} values")
    for r in rows:
        _refuse_nulls(r)
    terms = [BIAS, *features]
    return {r[group]: Fit(terms, solve(*_matrices(r, terms, target, names), ridge)) for r in rows}


def rmse_of(fits: dict[float, Fit], df: DataFrame, target: str, label: str = "ridge") -> DataFrame:
    """RMSE of every fit on one frame, all in one pass."""
    error = lambda f: F.sqrt(F.avg(F.pow(F.col(target) - f.predict(), F.lit(2))))
    row = df.agg(*[error(f).alias(f"e{i}") for i, f in enumerate(fits.values())])
    cells = [F.struct(F.lit(r).alias(label), F.col(f"e{i}").alias("rmse")) for i, r in enumerate(fits)]
    return row.select(F.inline(F.array(*cells)))


def grouped_rmse(fits: dict, df: DataFrame, group: str, target: str) -> DataFrame:
    """RMSE per group, each group predicted by its own fit, and their spread over the groups."""
    predicted = F.lit(None).cast("double")
    for value, f in fits.items():
        predicted = F.when(F.col(group) == F.lit(value), f.predict()).otherwise(predicted)
    error = F.pow(F.col(target) - predicted, F.lit(2))
    out = df.groupBy(group).agg(F.sqrt(F.avg(error)).alias("rmse"))
    # One row per fit: a single task holds them all.
    return out.withColumn("std", F.stddev_pop("rmse").over(Window.partitionBy(F.lit(0))))
