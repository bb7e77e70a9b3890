"""Registered queries against their SQL on the smallest sample, and the shape of their plans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import database, difference
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
QUICK = ("changed_transactions", "scoped_transactions", "sales_daily", "sales_net_daily", "tax_daily", "compliment_raw",
         "utilization_daily", "reservation_summary_daily", "split_bill_children", "refund_only_keys_daily",
         "late_month_keys", "next_sequence_window", "period_closing", "cdc_decode", "cdc_offsets", "account_lookup")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns[0] == "merchant_id"


@pytest.mark.parametrize("name", QUICK)
def test_results_equal_sql(spark, con, name):
    assert difference(spark, con, name, FOLDER) is None


def plan(spark, name):
    return queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["sales_raw", "sales_net_daily", "tax_daily", "compliment_raw", "utilization_daily",
                                  "affected_daily_keys", "cdc_latest"])
def test_plans_stay_in_the_jvm_and_never_cross_join(spark, name):
    text = plan(spark, name)
    for unwanted in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                     "SinglePartition", "Window ["):
        assert unwanted not in text, unwanted


def test_scans_read_only_what_is_needed(spark):
    text = plan(spark, "commission_summary")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)" in text
    schema = next(s for s in text.split("ReadSchema: ")[1:] if "l_returnflag" in s).split("\n")[0]
    assert "l_quantity" not in schema and "l_shipdate" not in schema
