"""Every text passes the gate once, also where the texts that fail it are left out."""

import datetime

import pytest

from policyscan.functions import text
from policyscan.plans import catalog


@pytest.mark.parametrize("name", ["custom_patterns", "extract_document", "pair_nearest"])
def test_gate_runs_once(spark, tmp_path, name):
    columns = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    orders = [(k, "O", "1-URGENT", datetime.datetime(1997, 1, 1)) for k in range(40)]
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(0, "one " * 30), (1, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = catalog.QUERIES[name](spark, str(tmp_path))
    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    searches = plan.count(f", {text._HIDDEN}) THEN")
    assert searches == 1 and done.count() > 5
