"""A text is read once for gate, hits and levels, and the rows are those of the separate searches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from policyscan.functions import text
from policyscan.operators import documents, matching
from policyscan.plans import catalog

WORDS = [
    "checkov", "CHECKOV", "sEveRity", "Severity", "checKov", "K", "severİty", "SEVERITYİ", "|Severity\n|HIGH ", "|Severity|LOW ",
    "[CKV_AWS_1]", "Checkov ID: CKV_GCP_22 ", "|Checkov ID\n|CKV_GCP_3 ", "é", "Ā一", "\x01\x02" * 20, "­", "words " * 9, "\U0001f600",
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(7)
    rows = [(str(i), "".join(rng.choices(WORDS, k=rng.randrange(0, 14)))) for i in range(1200)]
    return spark.createDataFrame([*rows, ("null", None), ("empty", "")], "path string, content string").repartition(4).cache()


@pytest.mark.parametrize(("contexts", "ranked"), [(True, True), (False, True), (True, False)])
def test_rows_equal_those_of_the_separate_searches(texts, contexts, ranked):
    one = documents.gated_searches(texts, contexts=contexts, ranked=ranked)
    gated = texts.withColumn("content", F.when(text.process_gate(F.col("content")), F.col("content")))
    hits = matching.find_ids("content", contexts=contexts) if ranked else matching.all_hits("content")
    apart = gated.select(
        "path", "content", F.coalesce(hits, F.array()).alias("hits"), F.coalesce(matching.find_severities("content"), F.array()).alias("severities")
    )
    rows, expected = ({r.path: r for r in frame.collect()} for frame in (one.drop("_turns"), apart))
    assert rows == expected
    passed = [r for r in rows.values() if r.content]
    assert 100 < len(passed) < len(rows) - 100 and sum(len(r.hits) > 1 for r in passed) > 100


def test_pairs_equal_those_of_sql(spark):
    """Hits that outnumber the levels take the closest, also around letters that grow when lower-cased."""
    rng = random.Random(11)
    words = ["|Severity\n|HIGH ", "|Severity|LOW ", "|Severity|INFO\n", "[CKV_AWS_%d] ", "low", "hIGHigh", "İnfo", "LOW", "é", "Ā", "İ" * 9, " , " * 9, "iNFO", "ſ"]
    made = ("".join(rng.choices(words, k=rng.randrange(8, 40))) for _ in range(800))
    rows = [(str(n), "".join(c if c != "%" else str(10 + rng.randrange(60)) for c in t.replace("%d", "%"))) for n, t in enumerate(made)]
    found = documents.gated_searches(spark.createDataFrame(rows, "path string, content string"))
    both = found.select(
        F.size("_turns").alias("turns"),
        documents.pair_severities("hits", "severities", "content", "_turns").alias("mine"),
        documents.pair_severities("hits", "severities", "content").alias("sql"),
    ).collect()
    assert all(r.mine == r.sql for r in both)
    assert sum(r.turns > 3 and len({m.severity for m in r.sql[2:]}) > 1 for r in both) > 20


def test_keywords_equal_those_of_sql(spark, texts):
    odd = [("%d-%d" % (n, i), w) for n, word in enumerate(["checkov", "severity"]) for i, w in enumerate(
        [word, word.upper(), word[:-1], word.replace("k", "K"), word.replace("i", "İ"), word.replace("i", "ı"), "ß" + word.title(), "Σ" + word.upper() + "Σ"]
    )]
    invalid = spark.sql("SELECT 'x' AS path, CAST(X'FF434845434B4F56FF' AS STRING) AS content UNION ALL SELECT 'y', CAST(X'C3534556455249545921' AS STRING)")
    frame = texts.union(spark.createDataFrame(odd, texts.schema)).union(invalid)
    found = frame.select(
        "path", matching.search_texts("content")["topical"].alias("mine"), F.coalesce(text.has_keyword(F.col("content")), F.lit(False)).alias("sql")
    ).collect()
    assert all(r.mine == r.sql for r in found) and {r.mine for r in found} == {True, False}


def test_patterns_that_are_not_known_are_refused():
    with pytest.raises(ValueError, match="not matched in batches"):
        matching.search_texts("content", "builtin")


@pytest.mark.parametrize("name", ["custom_validator", "dedup_matches", "dq_duplicates", "run_statistics"])
def test_one_function_reads_a_text(spark, tmp_path, name):
    columns = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    orders = [(k, "O", "1-URGENT", datetime.datetime(1997, 1, 1)) for k in range(40)]
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(0, "one " * 30), (1, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = catalog.QUERIES[name](spark, str(tmp_path))
    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == plan.count("batch_hits(content") == 1
    assert "plain(content" not in plan and "find(content" not in plan
    assert "lower(content" not in plan
    assert ", checkov)" not in plan.lower() and ", severity)" not in plan.lower()
    assert done.count() > 0
