"""Random rows beside the rows of a driver table."""

from pyspark.sql import functions as F

from millrace import datagen as dg
from millrace.probes.registry import Tables, probe

_AS_OF = "2024-06-01 00:00:00"
_SPECS = [
    dg.Spec("id", "int", identity=True), dg.Spec("label", "varchar(12)"), dg.Spec("level", "tinyint"), dg.Spec("amount", "int"),
    dg.Spec("price", "money"), dg.Spec("seen", "datetime"), dg.Spec("active", "bit"), dg.Spec("code", "uniqueidentifier"),
    dg.Spec("digest", "varbinary(8)"), dg.Spec("shape", "geometry"),
]


@probe("random_rows_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, {'count(*)' if c == 'shape' else 'CAST(0 AS BIGINT)'} AS n_null, "
    f"{'NULL' if c == 'shape' else 'true'} AS in_bounds FROM orders"
    for c in ["label", "level", "amount", "price", "seen", "active", "code", "digest", "shape"]
))
def random_rows_stats(t: Tables):
    """One random row per order; the identity column is skipped, unknown types are null."""
    rows = dg.fill_table(t.orders.select("o_orderkey"), "o_orderkey", _SPECS, 42, _AS_OF)
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    good = {
        "label": (F.length("label") <= 12) & F.regexp_like("label", F.lit("^[-0-9A-Za-z ]*$")),
        "level": F.col("level").between(50, 99), "amount": F.col("amount").between(0, 24999),
        "price": (F.col("price") >= 0) & (F.col("price") < 1000),
        "seen": (F.col("seen") >= stamp(dg.FIRST_TIME)) & (F.col("seen") <= stamp(_AS_OF)),
        "active": F.col("active").isin(True, False),
        "code": F.regexp_like("code", F.lit("^[0-9A-F]{8}(-[0-9A-F]{4}){3}-[0-9A-F]{12}$")),
        "digest": F.octet_length("digest") == 5, "shape": F.lit(None).cast("boolean"),
    }
    row = rows.agg(*[m for c, ok in good.items() for m in (
        F.count_if(F.col(c).isNull()).alias(f"{c}_null"), F.bool_and(ok).alias(f"{c}_ok"))], F.count(F.lit(1)).alias("n"))
    cells = [F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"{c}_null").alias("n_null"),
                      F.col(f"{c}_ok").alias("in_bounds")) for c in good]
    return row.select(F.inline(F.array(*cells)))


@probe("random_text_shape", """
SELECT count(*) AS n, true AS one_in_five_empty, true AS many_values FROM customer
""")
def random_text_shape(t: Tables):
    """About 16 of 80 picks give no character; texts differ from row to row."""
    rows = dg.fill_table(t.customer.select("c_custkey"), "c_custkey", [dg.Spec("label", "varchar(40)")], 7, _AS_OF)
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.length("label")).between(30.5, 33.5).alias("one_in_five_empty"),
        (F.approx_count_distinct("label") > F.count(F.lit(1)) * 0.9).alias("many_values"),
    )


def _digest(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def _stated(spec: dg.Spec, seed: int, key: str) -> str:
    """SQL of one column of a random table."""
    h = f"CAST('0x' || substr({_digest(f"'{seed}'", f"'{spec.name}'", f'CAST({key} AS VARCHAR)', "'0'")}, 1, 15) AS BIGINT)"
    whole = f"upper({_digest(f"'{seed}'", f"'{spec.name}'", f'CAST({key} AS VARCHAR)')})"
    dashed = " || '-' || ".join(f"substr({whole}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    rules = {
        "TINYINT": f"{h} % 256", "SMALLINT": f"{h} % 32768", "INT": f"{h} % 2147483648", "BIGINT": f"{h} % 1000000", "BIT": f"{h} % 2 = 1",
        "CHAR(5)": f"left({dashed}, 5)", "CHAR(10)": f"left({dashed}, 10)", "VARCHAR(20)": f"left({dashed}, 20)", "VARCHAR(50)": dashed,
        "DATE": f"DATE '2000-01-01' + CAST({h} % 3650 AS INTEGER)", "DATETIME": f"TIMESTAMP '2000-01-01' + to_seconds({h} % 31536000)",
        "TIME": f"strftime(TIMESTAMP '2000-01-01' + to_milliseconds({h} % 31536000 % 86400000), '%H:%M:%S.%g')",
        "DECIMAL(10,2)": f"CAST({h} % 100000 / 100.0 AS DECIMAL(10, 2))", "DECIMAL(8,3)": f"CAST({h} % 10000 / 1000.0 AS DECIMAL(8, 3))",
        "FLOAT": f"{h} % 100000 / 100.0", "REAL": f"CAST({h} % 100000 / 1000.0 AS FLOAT)",
    }
    return f'{rules[spec.type]} AS "{spec.name}"'


# Columns with all types of tables of many rows, then those of one seed.
_ALL_TYPES = [dg.Spec(f"All{i}", kind) for i, kind in enumerate(dg.MANY_ROW_TYPES, 1)]
_SCHEMA = [*_ALL_TYPES, *dg.random_specs(11, dg.MANY_ROW_TYPES)]


@probe("random_schema", f"SELECT {', '.join(_stated(s, 11, 'c_custkey') for s in _SCHEMA)} FROM customer")
def random_schema(t: Tables):
    """A table of random columns, one row per customer; seeds fix columns and values."""
    return dg.fill_random(t.customer.select("c_custkey"), "c_custkey", _SCHEMA, 11, _AS_OF)


# The one-row kind takes the given time for its two clock types.
_TYPE_LINES = [(f"Many{i}", k, True) for i, k in enumerate(dg.MANY_ROW_TYPES, 1)] + [
    (f"One{i}", k, k not in ("TIME", "DATETIME")) for i, k in enumerate(dg.ONE_ROW_TYPES, 1)]


@probe("random_schema_types", " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", '{kind}' AS type, count(*) AS n, {str(varies).lower()} AS varies FROM customer"
    for name, kind, varies in _TYPE_LINES))
def random_schema_types(t: Tables):
    """All types of both kinds of random tables: rows, nulls and distinct values per column."""
    keys = t.customer.select("c_custkey")
    many = [dg.Spec(f"Many{i}", k) for i, k in enumerate(dg.MANY_ROW_TYPES, 1)]
    one = [dg.Spec(f"One{i}", k) for i, k in enumerate(dg.ONE_ROW_TYPES, 1)]
    row = lambda df, specs: df.agg(*[m for s in specs for m in (
        F.count(s.name).alias(f"{s.name}_n"), F.approx_count_distinct(s.name).alias(f"{s.name}_d"))])
    lines = lambda r, specs: r.select(F.inline(F.array(*[
        F.struct(F.lit(s.name).alias("column"), F.lit(s.type).alias("type"), F.col(f"{s.name}_n").alias("n"),
                 (F.col(f"{s.name}_d") > 1).alias("varies")) for s in specs])))
    a = lines(row(dg.fill_random(keys, "c_custkey", many, 5, _AS_OF), many), many)
    return a.unionByName(lines(row(dg.fill_random(keys, "c_custkey", one, 5, _AS_OF, many=False), one), one))
