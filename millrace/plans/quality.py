"""Declarative checks on frames, gathered in one report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import orphans


def _row(counted: DataFrame, check: str, column: str, severity: str) -> DataFrame:
    failures = F.coalesce(F.col("failures"), F.lit(0)).cast("long")
    bad = F.lit("warn" if severity == "warn" else "fail")
    return counted.select(
        F.lit(check).alias("check"), F.lit(column).alias("column"), failures.alias("failures"),
        F.lit(severity).alias("severity"), F.when(failures > 0, bad).otherwise("pass").alias("status"),
    )


def unique(df: DataFrame, column: str, severity: str = "error") -> DataFrame:
    """Failures = values that occur more than once; nulls are ignored."""
    twice = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _row(twice.agg(F.count(F.lit(1)).alias("failures")), "unique", column, severity)


def relationships(
    child: DataFrame, column: str, parent: DataFrame, key: str, severity: str = "error"
) -> DataFrame:
    """Failures = rows whose key has no parent; null keys are ignored."""
    lost = orphans(child, column, parent, key).agg(F.sum("n_rows").alias("failures"))
    return _row(lost, "relationships", column, severity)


def accepted_values(df: DataFrame, column: str, values: Sequence, severity: str = "error") -> DataFrame:
    """Failures = distinct values outside the list; nulls are ignored."""
    odd = df.filter(~F.col(column).isin(*values)).select(column).distinct()
    return _row(odd.agg(F.count(F.lit(1)).alias("failures")), "accepted_values", column, severity)


def row_checks(df: DataFrame, checks: Sequence[tuple[str, str, Column, str]]) -> DataFrame:
    """Checks that look at one row each, all in one pass.

    ``checks``: (name, column, condition of a bad row, severity).
    """
    counts = df.agg(*[F.count_if(bad).alias(f"n_{i}") for i, (_, _, bad, _) in enumerate(checks)])
    cells = [
        F.struct(
            F.lit(name).alias("check"), F.lit(column).alias("column"), F.col(f"n_{i}").alias("failures"),
            F.lit(severity).alias("severity"),
            F.when(F.col(f"n_{i}") > 0, "warn" if severity == "warn" else "fail").otherwise("pass").alias("status"),
        )
        for i, (name, column, _, severity) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*cells)))


def not_null(column: str, severity: str = "error") -> tuple[str, str, Column, str]:
    return ("not_null", column, F.col(column).isNull(), severity)


def no_zero(column: str, severity: str = "error") -> tuple[str, str, Column, str]:
    return ("no_zero", column, F.col(column) == 0, severity)


def has_rows(df: DataFrame, severity: str = "error") -> DataFrame:
    """Failure = no row at all; one row is enough to know."""
    some = df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("failures"))
    return _row(some, "has_rows", "*", severity)


def first_column(df: DataFrame, name: str, severity: str = "error") -> DataFrame:
    wrong = 0 if df.columns[0] == name else 1
    return _row(df.sparkSession.range(1).select(F.lit(wrong).alias("failures")), "first_column", name, severity)


def report(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def enforce(checked: DataFrame) -> DataFrame:
    """Raise if a check of severity error failed; a report has one row per check."""
    bad = checked.filter("status = 'fail'").collect()
    if bad:
        raise ValueError("; ".join(f"{r.check}({r.column}): {r.failures}" for r in bad))
    return checked
