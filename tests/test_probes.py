"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from millrace.probes import ORACLES, QUERIES
from tools.check import compare, oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")



#: Fitted models: tested against their rules in test_ml.py.
NO_SQL = {"logreg_scores", "churn_auc", "batch_scoring", "feature_elimination", "param_grid", "mlp_train", "step_comparison"}


@pytest.fixture(scope="module")
def duck():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    state, n, detail = compare(QUERIES[name](spark, FOLDER), duck, ORACLES.get(name))
    assert state == ("rows only" if name in NO_SQL else "ok"), detail
    assert n > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["dropoff_zone", "max_tip"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
