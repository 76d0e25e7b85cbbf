"""Seeded random rows driven by a schema.

Every value is a hash of (seed, column, row id, draw), so a lost task that runs
again writes the same rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import clock_seconds

# Alphabet and pick range of random text (picks past the end give
# no character), value ranges of the numeric types, first time, bytes per binary.
ALPHABET = "0123456789-ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz"
PICKS = 80
INT_RANGE = 25000
TINY_LOW, TINY_RANGE = 50, 50
NUMBER_RANGE = 1000
FIRST_TIME = "2000-01-01 00:00:00"
BINARY_BYTES = 5
LONGEST_TEXT = 10000

# Hex digits of a digest that make a number below 2 ** 60.
DIGITS = 15

# Longest text written out as one expression.
UNROLLED_TEXT = 64

# Types of random tables, for one row and for many rows.
ONE_ROW_TYPES = [
    "TINYINT", "SMALLINT", "INT", "BIGINT", "BIT", "DECIMAL(10, 2)", "NUMERIC(10, 2)", "FLOAT", "REAL", "CHAR(10)",
    "VARCHAR(50)", "NCHAR(10)", "NVARCHAR(50)", "DATE", "TIME", "DATETIME", "UNIQUEIDENTIFIER",
]
MANY_ROW_TYPES = [
    "INT", "BIGINT", "SMALLINT", "TINYINT", "BIT", "CHAR(5)", "CHAR(10)", "VARCHAR(20)", "VARCHAR(50)", "DATE",
    "DATETIME", "TIME", "DECIMAL(10,2)", "DECIMAL(8,3)", "FLOAT", "REAL",
]
MOST_COLUMNS, MOST_ROWS = 20, 800


@dataclass(frozen=True)
class Spec:
    """Column of a table to fill; generated columns are skipped."""

    name: str
    type: str
    identity: bool = False
    computed: bool = False

    @property
    def kind(self) -> str:
        return re.sub(r"\(.*", "", self.type).strip().lower()

    @property
    def length(self) -> int | None:
        found = re.search(r"\((\d+)", self.type)
        return int(found.group(1)) if found else None


class Draw:
    """Hash numbers for one column."""

    def __init__(self, row: Column, seed: int, name: str):
        self.row, self.seed, self.name = row, seed, name

    def hash(self, part: Column | int = 0) -> Column:
        part = F.lit(part) if isinstance(part, int) else part
        return F.xxhash64(self.row, F.lit(self.seed), F.lit(self.name), part)

    def below(self, n: int, part: Column | int = 0) -> Column:
        return F.pmod(self.hash(part), F.lit(n))

    def unit(self, part: int = 0) -> Column:
        """Number in [0, 1)."""
        return self.below(1 << 53, part).cast("double") / F.lit(float(1 << 53))

    def factor(self) -> Column:
        """One number in [0, 1) for the whole column, as a factor drawn once per query."""
        return F.lit(random.Random(f"{self.seed}|{self.name}").random())

    def uuid(self) -> Column:
        h = F.md5(F.concat_ws("|", F.lit(str(self.seed)), F.lit(self.name), self.row.cast("string")))
        cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
        return F.upper(F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]))

    def text(self, length: int) -> Column:
        """``length`` picks, four out of each hash; a pick is a 16-bit number modulo the pick range."""
        if length < 1:
            return F.lit("")

        def pick(i: int | Column, part: int | Column, shift: int | Column) -> Column:
            number = F.shiftrightunsigned(self.hash(part), shift) if isinstance(shift, int) else F.call_function(
                "shiftrightunsigned", self.hash(part), shift)
            at = F.pmod(number.bitwiseAND(F.lit(65535)), F.lit(PICKS)) + 1
            return F.substring(F.lit(ALPHABET), at.cast("int"), F.lit(1))

        if length <= UNROLLED_TEXT:  # plain expressions are compiled, a lambda is interpreted
            return F.concat(*[pick(i, i // 4, 16 * (i % 4)) for i in range(length)])
        each = lambda i: pick(i, F.floor(i / 4).cast("int"), (i % 4 * 16).cast("int"))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(length - 1)), each), "")


class DigestDraw(Draw):
    """Hash numbers from a digest that other engines have too, so that these can state the same rows."""

    def hash(self, part: Column | int = 0) -> Column:
        part = F.lit(part) if isinstance(part, int) else part
        text = F.concat_ws("|", F.lit(str(self.seed)), F.lit(self.name), self.row.cast("string"), part.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def table_value(spec: Spec, draw: Draw, as_of: str) -> Column:
    """Value for a column of an existing table; types without a rule are null."""
    kind, first = spec.kind, F.lit(FIRST_TIME).cast("timestamp_ntz")
    if kind in ("varchar", "char", "nvarchar", "nchar", "ntext", "text", "string"):
        # A type without a length takes one drawn length for the whole column.
        length = spec.length or random.Random(f"{draw.seed}|{spec.name}").randrange(LONGEST_TEXT)
        return draw.text(length)
    if kind == "tinyint":
        return (F.lit(TINY_LOW) + draw.below(TINY_RANGE)).cast("short")
    if kind in ("int", "bigint", "smallint"):
        return draw.below(INT_RANGE).cast(kind)
    if kind == "uniqueidentifier":
        return draw.uuid()
    if kind in ("decimal", "float", "money", "smallmoney", "double"):
        return draw.below(NUMBER_RANGE).cast("double") * draw.factor()
    if kind in ("datetime", "smalldatetime", "datetime2", "timestamp", "timestamp_ntz"):
        minutes = F.floor((clock_seconds(F.lit(as_of).cast("timestamp_ntz")) - clock_seconds(first)) / 60) + 1
        return F.timestamp_add("MINUTE", F.floor(draw.unit() * minutes).cast("int"), first)
    if kind in ("bit", "boolean"):
        return draw.below(2).cast("int").cast("boolean")
    if kind in ("varbinary", "image", "binary"):
        return F.unhex(F.substring(F.md5(draw.hash().cast("string")), 1, 2 * BINARY_BYTES))
    return F.lit(None).cast("string")


def fill_table(rows: DataFrame, key: str, specs: list[Spec], seed: int, as_of: str) -> DataFrame:
    """One random row per row of ``rows``; ``key`` must be unique."""
    return rows.select(*[
        table_value(s, Draw(F.col(key), seed, s.name), as_of).alias(s.name)
        for s in specs if not (s.identity or s.computed)
    ])


def specs_of(df: DataFrame, text_length: int = 20) -> list[Spec]:
    """Specs from a frame's schema; Spark text has no length, so one is given."""
    def name(kind: str) -> str:
        return f"varchar({text_length})" if kind == "string" else kind

    return [Spec(f.name, name(f.dataType.simpleString())) for f in df.schema.fields]


def random_table(spark: SparkSession, specs: list[Spec], n: int, seed: int, as_of: str) -> DataFrame:
    return fill_table(spark.range(n), "id", specs, seed, as_of)


def random_specs(seed: int, types: list[str]) -> list[Spec]:
    """1..20 columns Col1, Col2, ... of types drawn from a list."""
    pick = random.Random(seed)
    return [Spec(f"Col{i}", pick.choice(types)) for i in range(1, pick.randint(1, MOST_COLUMNS) + 1)]


def random_row_count(seed: int) -> int:
    return random.Random(f"rows|{seed}").randint(1, MOST_ROWS)


def _day(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int"))


def _clock(ms: Column) -> Column:
    """Time of day as text; Spark's time type is switched off by default."""
    start = F.lit(FIRST_TIME).cast("timestamp_ntz")
    at = F.timestamp_add("MILLISECOND", F.pmod(ms, F.lit(86_400_000)).cast("int"), start)
    return F.date_format(at, "HH:mm:ss.SSS")


def many_row_values(as_of: str) -> dict[str, Callable[[Draw], Column]]:
    """Value of each type in a random table with many rows."""
    first = F.lit(FIRST_TIME).cast("timestamp_ntz")
    return {
        "TINYINT": lambda d: d.below(256).cast("short"),
        "SMALLINT": lambda d: d.below(32768).cast("short"),
        "INT": lambda d: d.below(1 << 31).cast("int"),
        "BIGINT": lambda d: d.below(1_000_000),
        "BIT": lambda d: d.below(2).cast("int").cast("boolean"),
        "CHAR(5)": lambda d: F.left(d.uuid(), F.lit(5)),
        "CHAR(10)": lambda d: F.left(d.uuid(), F.lit(10)),
        "VARCHAR(20)": lambda d: F.left(d.uuid(), F.lit(20)),
        "VARCHAR(50)": lambda d: F.left(d.uuid(), F.lit(50)),
        "DATE": lambda d: _day("2000-01-01", d.below(3650)),
        "DATETIME": lambda d: F.timestamp_add("SECOND", d.below(31_536_000).cast("int"), first),
        "TIME": lambda d: _clock(d.below(31_536_000)),
        "DECIMAL(10,2)": lambda d: (d.below(100_000).cast("decimal(10,0)") / 100).cast("decimal(10,2)"),
        "DECIMAL(8,3)": lambda d: (d.below(10_000).cast("decimal(10,0)") / 1000).cast("decimal(8,3)"),
        "FLOAT": lambda d: d.below(100_000) / F.lit(100.0),
        "REAL": lambda d: (d.below(100_000) / F.lit(1000.0)).cast("float"),
    }


def one_row_values(as_of: str) -> dict[str, Callable[[Draw], Column]]:
    """Value of each type in a random table with one row."""
    now = F.lit(as_of).cast("timestamp_ntz")
    money = lambda d: F.round(d.unit() * 1000, 2).cast("decimal(10,2)")
    short, whole = lambda d: F.left(d.uuid(), F.lit(10)), lambda d: d.uuid()
    return {
        "TINYINT": lambda d: d.below(256).cast("short"),
        "SMALLINT": lambda d: d.below(32768).cast("short"),
        "INT": lambda d: d.below(1 << 31).cast("int"),
        "BIGINT": lambda d: d.below(1 << 31) * 1000,
        "BIT": lambda d: d.below(2).cast("int").cast("boolean"),
        "DECIMAL(10, 2)": money,
        "NUMERIC(10, 2)": money,
        "FLOAT": lambda d: d.unit() * 1000,
        "REAL": lambda d: (d.unit() * 1000).cast("float"),
        "CHAR(10)": short,
        "VARCHAR(50)": whole,
        "NCHAR(10)": short,
        "NVARCHAR(50)": whole,
        "DATE": lambda d: _day("2020-01-01", d.below(365)),
        "TIME": lambda d: F.date_format(now, "HH:mm:ss"),
        "DATETIME": lambda d: now,
        "UNIQUEIDENTIFIER": whole,
    }


def fill_random(rows: DataFrame, key: str, specs: list[Spec], seed: int, as_of: str, many: bool = True) -> DataFrame:
    values = many_row_values(as_of) if many else one_row_values(as_of)
    return rows.select(*[values[s.type](DigestDraw(F.col(key), seed, s.name)).alias(s.name) for s in specs])


def tally(spark: SparkSession, n: int) -> DataFrame:
    """Numbers 1..n, made in parallel."""
    return spark.range(1, n + 1).withColumnRenamed("id", "n")
