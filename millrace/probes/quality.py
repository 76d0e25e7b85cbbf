"""Data checks, passing and failing."""

from pyspark.sql import functions as F

from millrace.plans import quality
from millrace.probes.registry import Tables, probe


def _checks(sql: str, severity: str, check: str, column: str) -> str:
    bad = "warn" if severity == "warn" else "fail"
    return (f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", CAST(n AS BIGINT) AS failures, '{severity}' AS severity, "
            f"CASE WHEN n > 0 THEN '{bad}' ELSE 'pass' END AS status FROM ({sql})")


_UNIQUE = lambda table, c: f"SELECT count(*) AS n FROM (SELECT {c} FROM {table} GROUP BY 1 HAVING count(*) > 1)"
_UNIQUE_SQL = (
    _checks(_UNIQUE("orders", "o_orderkey"), "error", "unique", "o_orderkey")
    + " UNION ALL " + _checks(_UNIQUE("events", "user_id"), "warn", "unique", "user_id")
)
_NULL_SQL = " UNION ALL ".join(
    _checks(f"SELECT count(*) AS n FROM lineitem WHERE {cond}", sev, "not_null", c)
    for c, cond, sev in [("l_tax", "nullif(l_tax, 0) IS NULL", "warn"), ("l_discount", "l_discount IS NULL", "error")]
)
_ORPHAN_SQL = _checks("SELECT count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0)",
                      "error", "relationships", "l_partkey")
_VALUES_SQL = _checks("SELECT count(DISTINCT o_orderstatus) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O')", "warn",
                      "accepted_values", "o_orderstatus")
_STEP_SQL = (
    _checks("SELECT 0 AS n", "error", "has_rows", "*") + " UNION ALL " + _checks("SELECT 1 AS n", "error", "first_column", "vendor_id")
    + " UNION ALL " + _checks("SELECT count(*) AS n FROM lineitem WHERE l_tax = 0", "error", "no_zero", "l_tax")
)


def _unique(t: Tables):
    return quality.report(quality.unique(t.orders, "o_orderkey"), quality.unique(t.events, "user_id", "warn"))


def _not_null(t: Tables):
    dirty = t.lineitem.withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return quality.row_checks(dirty, [quality.not_null("l_tax", "warn"), quality.not_null("l_discount")])


def _relationships(t: Tables):
    # Every tenth parent is taken away so that the check finds orphans.
    return quality.relationships(t.lineitem, "l_partkey", t.part.filter(F.col("p_partkey") % 10 != 0), "p_partkey")


def _accepted(t: Tables):
    return quality.accepted_values(t.orders, "o_orderstatus", ["F", "O"], "warn")


def _steps(t: Tables):
    return quality.report(
        quality.has_rows(t.lineitem), quality.first_column(t.lineitem, "vendor_id"),
        quality.row_checks(t.lineitem, [quality.no_zero("l_tax")]),
    )


probe("dq_unique", _UNIQUE_SQL)(_unique)
probe("dq_not_null", _NULL_SQL)(_not_null)
probe("dq_relationships", _ORPHAN_SQL)(_relationships)
probe("dq_accepted_values", _VALUES_SQL)(_accepted)


@probe("dq_report", " UNION ALL ".join([_UNIQUE_SQL, _NULL_SQL, _ORPHAN_SQL, _VALUES_SQL, _STEP_SQL]))
def dq_report(t: Tables):
    return quality.report(_unique(t), _not_null(t), _relationships(t), _accepted(t), _steps(t))
