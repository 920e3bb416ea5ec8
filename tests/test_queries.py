"""Every registered query against its SQL, column by column."""

from __future__ import annotations

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as driver  # noqa: E402
from remitspark import sampledata  # noqa: E402
from remitspark import schema as S  # noqa: E402
from remitspark.oracle_sql import ORACLE_SQL  # noqa: E402
from remitspark.plans.analytics import QUERIES  # noqa: E402
from remitspark.plans.registry import REGISTRY  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "orders"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE_SQL)
    assert set(REGISTRY) <= set(driver.queries()) and set(ORACLE_SQL) <= set(driver.oracle_sql())


def test_every_order_has_its_customer(spark):
    """What leaves the region out may leave its tables out."""
    for scale in ("sf0.001", "sf0.01", "sf0.1"):
        folder = f"{os.path.dirname(DATA)}/{scale}"
        if os.path.isdir(folder):
            assert sampledata.transactions(spark, folder).count() == sampledata.transactions(spark, folder, False).count()


def test_only_orders_are_read_without_the_region(spark):
    plan = driver.queries()["total_transactions"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    result = duck.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    at = [result.columns.index(c) for c in df.columns]
    want = [tuple(row[i] for i in at) for row in result.fetchall()]
    if "ORDER BY" in driver.oracle_sql()[name].rsplit(")", 1)[-1] and name != "amount_by_device":
        assert got == want
    else:
        assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name, pushed", [("loaded_high_value", "GreaterThan(amount,100"), ("loaded_failed_declined", "In(status, [DECLINED,FAILED])")])
def test_filters_reach_the_loaded_rows(spark, name, pushed):
    plan = REGISTRY[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan[plan.index("PushedFilters") :].split("ReadSchema")[0]


def test_entry(spark):
    assert driver.entry(spark).columns == ["status", "transaction_count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, name):
    rows = QUERIES[name](spark.createDataFrame([], S.TRANSACTIONS)).collect()
    if QUERIES[name].__name__.startswith(("total_transactions", "fraud_count")):
        assert [tuple(r) for r in rows] == [(0,)]
    else:
        assert all(v is None for r in rows for v in r)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tx") / "tx")
    sampledata.transactions(spark, DATA).write.parquet(path)
    return spark.read.schema(S.TRANSACTIONS).parquet(path)


@pytest.mark.parametrize(
    "name, filters, columns",
    [
        ("high_value_fraud", ["EqualTo(is_fraud_flag,true)", "GreaterThan(amount,100"], None),
        ("failed_declined", ["In(status, [DECLINED,FAILED])"], ["amount", "status"]),
        ("daily_success_amount", ["EqualTo(status,SUCCESS)"], ["transaction_ts", "amount", "status"]),
        ("top_customers", ["IsNotNull(customer_id)"], ["customer_id", "amount"]),
        ("total_transactions", [], []),
    ],
)
def test_filters_and_columns_reach_the_scan(stored, name, filters, columns):
    plan = QUERIES[name](stored)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    for f in filters:
        assert f in pushed, plan
    if columns is not None:
        assert [part.split(":")[0] for part in schema.split("<")[1].rstrip(">").split(",") if ":" in part] == columns


def test_top_k_never_sorts_everything(stored):
    for name in ("top_merchants", "top_customers"):
        plan = QUERIES[name](stored)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
