"""Reusable column expressions; all stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payment codes and their texts.
PAYMENT_TEXT = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_OTHER = "EMPTY"

# Fixed value: how a null column takes part in a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c: Column | str, text: bool = False) -> Column:
    """Whole number or null.

    A failed cast costs an exception per row, so dirty ``text`` is looked at
    first and cast only where it has the shape of a whole number.
    """
    c = as_col(c)
    if not text:
        return c.try_cast("int")
    return F.when(F.regexp_like(c, F.lit(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$")), c.try_cast("int"))


def is_text(df: DataFrame, name: str) -> bool:
    return df.select(name).schema[0].dataType.simpleString() == "string"


def safe_int_of(df: DataFrame, name: str) -> Column:
    """``safe_int`` of a column of ``df``, guarded if it is text."""
    return safe_int(name, is_text(df, name))


def numeric(c: Column | str) -> Column:
    """Warehouse NUMERIC: 38 digits, 9 after the point."""
    return as_col(c).cast("decimal(38,9)")


def lookup_text(c: Column, texts: dict, other: str | None = None) -> Column:
    """Text for a code out of a small fixed table."""
    out = F.lit(other)
    for code, text in texts.items():
        out = F.when(c == F.lit(code), F.lit(text)).otherwise(out)
    return out


def payment_description(c: Column | str, text: bool = False) -> Column:
    return lookup_text(safe_int(c, text), PAYMENT_TEXT, PAYMENT_OTHER)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the text forms of the columns, joined by '-'."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def concat_empty(*cols: Column | str) -> Column:
    """Concatenation that reads null as empty text (``concat`` returns null instead)."""
    return F.concat(*[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def same_day(ts: Column, day: str) -> Column:
    """``date(ts) = day`` as a half-open range, so it reaches the scan."""
    start = F.lit(day).cast("timestamp_ntz")
    return (ts >= start) & (ts < start + F.expr("interval 1 day"))


def days_between(ts: Column, first: str, last: str) -> Column:
    """Both days included, as a half-open range."""
    end = F.lit(last).cast("timestamp_ntz") + F.expr("interval 1 day")
    return (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < end)


def between_midnights(ts: Column, first: str, last: str) -> Column:
    """Timestamp between two date literals: stops at midnight of ``last``."""
    return ts.between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))


def clock_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 on the clock the time was read from.

    A cast to a time with zone would bring in the session's zone, whose summer
    time skips and repeats an hour.
    """
    of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)).cast("long") * 86400 + of_day


def seconds_behind(ts: Column, as_of: Column) -> Column:
    """Second boundaries crossed from ``ts`` to ``as_of`` (fractions cut on both sides)."""
    return clock_seconds(as_of) - clock_seconds(ts)


def season_start(season: Column) -> Column:
    """``1999/00`` -> 1999-01-01."""
    return F.make_date(F.substring(season, 1, 4).try_cast("int"), F.lit(1), F.lit(1))


def int_div(a: Column, b: Column) -> Column:
    """Whole-number division that cuts toward zero; null where ``b`` is 0 or null."""
    guarded = F.when(b != 0, b)
    return F.call_function("div", a.cast("long"), guarded.cast("long"))


def ratio_if_positive(a: Column, b: Column) -> Column:
    """Whole part of a / b where b > 0, else null."""
    return F.when(b > 0, (a / b).cast("long"))


def _slice_units(text: Column, first: Column, size: Column) -> Column:
    """``size`` two-byte units of a text from unit ``first`` (from 1); half a character that is left at an end becomes U+FFFD."""
    units = F.encode(text, "UTF-16LE")
    # the second byte of a unit tells the halves of a character apart
    high = lambda at: F.hex(F.substring(units, at * 2, F.lit(1)))
    front = ((size > 0) & high(first).between("DC", "DF")).cast("int")
    back = ((size > 0) & high(first + size - 1).between("D8", "DB")).cast("int")
    whole = F.decode(F.substring(units, (first + front) * 2 - 1, (size - front - back) * 2), "UTF-16LE")
    return F.concat(F.repeat(F.lit("\ufffd"), front), whole, F.repeat(F.lit("\ufffd"), back))


def statement_slice(text: Column, start: Column, end: Column, first_shift: int = 1,
                    length_shift: int = 1) -> Column:
    """Part of a text given by two byte offsets into its two-byte units.

    ``end`` -1 means up to the end of the text.  The two callers differ in
    whether 1 is added to start and length, so both shifts are parameters.
    Characters beyond the first 65,536 are two units; only texts that hold one
    are encoded.
    """
    # such a character begins with one of five bytes, which begin or continue no other
    raw = text.cast("binary")
    wide = reduce(lambda a, b: a | b, [F.contains(raw, F.unhex(F.lit(lead))) for lead in ("F0", "F1", "F2", "F3", "F4")])
    units = F.when(wide, F.length(F.encode(text, "UTF-16LE")) / 2).otherwise(F.length(text)).cast("int")
    last = F.when(end == -1, units * 2).otherwise(end)
    first = F.floor(start / 2).cast("int") + first_shift
    size = F.floor((last - start) / 2).cast("int") + length_shift
    # A first position below 1 eats into the length, as in T-SQL SUBSTRING.
    size = F.greatest(F.when(first < 1, size + first - 1).otherwise(size), F.lit(0))
    first = F.greatest(first, F.lit(1))
    return F.when(wide, _slice_units(text, first, F.greatest(F.least(size, units - first + 1), F.lit(0)))).otherwise(F.substring(text, first, size))


def update_threshold(rows: Column) -> Column:
    """Number of changed rows after which statistics count as stale."""
    return (
        F.when(rows < 500, F.lit(500))
        .when(rows <= 25000, F.floor(rows * F.lit(0.20).cast("decimal(3,2)")))
        .otherwise(F.floor(F.sqrt(rows * F.lit(1000.0))))
        .cast("long")
    )
