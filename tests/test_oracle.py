"""Every registered query against its SQL on DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from ledgerbrook.plans.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = REGISTRY, {k: v for k, v in entry.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert difference(spark, duck, lambda *_: df, ORACLES[name], SMALL) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["date_id", "merchant_risk_category", "channel", "flagged_transactions",
                          "flagged_amount", "confirmed_fraud"]
    assert df.count() > 0
