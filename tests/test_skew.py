"""A third of all rows on one order, one person, one product: same answers, and no task that gets them all sorted."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import compare  # noqa: E402

from orderlens.plans import all_queries  # noqa: E402

NAMES = [n for n in all_queries() if n.startswith(("kpi_", "explore_", "report_", "service_headline", "service_kpis",
                                                   "quality_", "evidence_states", "risk_split", "etl_"))]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    import duckdb

    folder = str(tmp_path_factory.mktemp("skew"))
    source = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in compare.TABLES:
        select = f"SELECT * FROM read_parquet('{source}/{name}.parquet')"
        if name == "lineitem":  # 3000 more items of order 7, with one product and one seller
            select += (f" UNION ALL SELECT 7, 3, 1, i::int + 100, 5.0, 1000.25 + i, 0.0, 0.0, 'N', 'O', "
                       f"TIMESTAMP '1997-01-01' FROM range(3000) r(i)")
        if name == "orders":  # a third of all orders belong to one customer key
            select = (f"SELECT o_orderkey, if(o_orderkey % 30 IN (0, 10), 5, o_custkey) AS o_custkey, "
                      f"* EXCLUDE (o_orderkey, o_custkey) FROM ({select})")
        con.execute(f"COPY ({select}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture(scope="module")
def con(skewed):
    return compare.duck(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_same_answers(spark, skewed, con, name):
    # Joins are shuffled and skewed partitions split, as they would be on large tables.
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB"}
    before = {k: spark.conf.get(k) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        status, note = compare.check(spark, con, all_queries()[name], skewed)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert status in ("ok", "rows only"), note


def test_no_window_over_an_orders_items_or_a_persons_orders(spark, small):
    """Order and person grain come from aggregations; windows only run over finished groups."""
    for name in NAMES:
        frame = all_queries()[name].build(spark, small)
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line:
                assert "order_id" not in line and "customer_unique_id" not in line, (name, line)


def test_no_nested_loops_and_no_row_wise_python(spark, small):
    """Over all queries that are lazy; the others train a model or write files while they are built."""
    eager = ("risk_model", "risk_saved", "service_risk_scoring", "files_")
    for name, query in all_queries().items():
        if not name.startswith(eager):
            plan = query.build(spark, small)._jdf.queryExecution().executedPlan().toString()
            for operator in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython"):
                assert operator not in plan, (name, operator)
