"""Chosen pages are picked by their short rows, before their texts are attached and shuffled."""

import datetime

from pyspark.sql import functions as F

from policyscan.plans import corpus


def test_chosen_pages_are_the_same_rows(spark, tmp_path):
    day = datetime.datetime(1997, 1, 1)
    orders = [(k, "O" if k % 2 else "F", "1-URGENT" if k % 3 else None, day) for k in [*range(40), 7, 7]]
    columns = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    texts = [(0, "one"), (1, None), (2, "three"), (2, "again")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = corpus.policy_pages(spark, str(tmp_path))
    some = whole.filter("k % 5 = 2").select("path").union(spark.sql("SELECT 'docs/none' UNION ALL SELECT NULL"))
    chosen = corpus.policy_pages(spark, str(tmp_path), some.union(some))
    expected = whole.join(some, "path", "left_semi").select(*whole.columns)
    assert sorted(map(str, chosen.collect())) == sorted(map(str, expected.collect())) and chosen.count() > 5
    plan = chosen.select("path", F.length("content"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("LeftSemi")  # the texts come in above the choice
