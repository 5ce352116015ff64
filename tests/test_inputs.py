"""Inputs derived from the tables: the order in which tables meet changes no row."""

import pytest
from pyspark.sql import functions as F

from spanloom.plans import inputs
from spanloom.plans.dialect import SPARK

TABLES = {
    "customer": ("c_custkey bigint, c_mktsegment string", [(1, "BUILDING"), (1, "FURNITURE"), (2, None), (None, "X")]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
        [(10, 1, None), (10, 1, None), (11, 2, None), (12, 3, None), (None, 1, None), (13, None, None)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, "
        "l_returnflag string, l_linestatus string",
        [(o, n, 5, s, 1.5, flag, "F") for o in (10, 11, 12, 13, None) for n, s, flag in (
            (1, 7, "R"), (1, 7, "R"), (3, 8, "N"), (4, None, None), (7, 9, "A"))],
    ),
    "supplier": ("s_suppkey bigint, s_nationkey bigint", [(7, 1), (8, 1), (8, 2), (9, None)]),
    "nation": ("n_nationkey bigint, n_name string", [(1, "PERU"), (2, "CHINA")]),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    for name, (fields, rows) in TABLES.items():
        spark.createDataFrame(rows, fields).write.parquet(f"{place}/{name}.parquet")
    return place


def test_orders_meet_customers_before_line_items(spark, tables):
    columns = inputs.child_columns(SPARK)
    found = inputs.child_spans(spark, tables)
    named = [n for n, _ in columns if n != "order_key"]
    in_turn = inputs._project(inputs._join(spark, tables, inputs.ITEM_JOIN), columns)
    as_rows = [sorted(map(str, df.select(*named).collect())) for df in (found, in_turn)]
    assert as_rows[0] == as_rows[1] and len(as_rows[0]) > len(set(as_rows[0])) > 3
    assert found.filter(F.col("local_service") == "furniture").count() > 0
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {key: line.index("Join") for line in plan for key in ("o_orderkey", "c_custkey")
             if "Join Inner" in line and f"= {key}#" in line.replace("(", "")}
    assert depth["o_orderkey"] < depth["c_custkey"]
