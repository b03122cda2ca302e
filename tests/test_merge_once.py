"""Adding to the mapping table looks into it and keeps its rows; the texts are matched once for both."""

import datetime

import pytest

from policyscan.plans import catalog


@pytest.mark.parametrize("name", ["db_merge", "db_add"])
def test_texts_are_read_once(spark, tmp_path, name):
    day = datetime.datetime(1997, 1, 1)
    orders = [(k, "O" if k % 2 else "F", "1-URGENT" if k % 3 else None, day) for k in [*range(60), 7, 7]]
    columns = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    texts = [(0, "one"), (1, None), (2, "three"), (3, "severity of a page " * 9)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = catalog.QUERIES[name](spark, str(tmp_path))
    assert not any("documents.parquet" in file for file in done.inputFiles())
    rows = [tuple(row) for row in done.collect()]
    first = {tuple(row) for row in catalog.mappings(spark, str(tmp_path)).collect()}
    assert first <= set(rows) and len(rows) == len(set(rows)) > len(first) > 5
