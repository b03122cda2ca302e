"""Searches over batches of texts against the same searches as SQL, and that texts are moved once."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from policyscan.functions import text
from policyscan.operators import anchors, finder, matching
from policyscan.operators.patterns import PATTERN_SETS, resolve
from policyscan.plans import catalog

SPACES = ["\x1c", "\x1f", "\x85", "\xa0", " ", " ", "\r\n", "\t", "\x0b", " \n ", "\n", "\n\n"]
PARTS = [
    "|Checkov ID", "Checkov ID", "|", ":", "[", "]", "https://a.b/", "[CKV_AWS_1]", "[NOTE]", "[CKV_GCP_2]", "CKV_GCP_77", "CKV2_AWS_FOO",
    "|Severity", "|Severity|", "Severity", "HIGH", "LOW", "|HIGH", "| LOW", "|Severity\n|", "|Severity | LOW", "|Severity\n|MEDIUM", "|LOWER", "High", "tABLe", "é\xe9\U0001f600", "words " * 30,
    "\x01", "\x7f", "\xad", "Ā", *SPACES,
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randrange(0, 30)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "|Severity" * 2000 + "|HIGH"), (2003, "|Severity\n|SEVERE|Severity|LOW|Severity\n|INFO")]
    return spark.createDataFrame(rows, "i int, content string").repartition(8).cache()


def test_ranked_hits_equal_those_of_sql(texts):
    ids = resolve("config")["id"]
    in_sql = F.expr(matching._ranked(matching._distinct(matching._all_hits("content", ids))))
    rows = texts.select("i", matching.find_ids("content").alias("found"), in_sql.alias("expected")).collect()
    assert all(r.found == r.expected for r in rows)
    assert sum(len(r.expected) > 1 for r in rows) > 100


def test_levels_equal_those_of_sql(texts):
    expected = F.expr(matching.severities_sql("content"))
    rows = texts.select("i", matching.find_severities("content").alias("found"), expected.alias("expected")).collect()
    assert all(r.found == r.expected for r in rows)
    assert sum(len(r.expected) > 0 for r in rows) > 100


def test_plain_texts_equal_those_of_the_regex(texts):
    pattern = F.lit(rf"\A{text.SHOWN}*\z")
    rows = texts.select(finder.is_plain("content").alias("found"), F.rlike("content", pattern).alias("expected")).collect()
    assert all(r.found == bool(r.expected) for r in rows)
    assert {r.found for r in rows} == {True, False}


def test_texts_that_are_not_utf8_do_not_end_the_job(spark):
    row = spark.sql("SELECT CAST(X'FF5B434B565F4157535F315D' AS STRING) AS content")
    found = row.select(matching.find_ids("content")["checkov_id"].alias("id"), finder.is_plain("content").alias("plain")).first()
    assert found.id == ["CKV_AWS_1"] and not found.plain


def test_patterns_of_config_are_sought_in_batches():
    assert matching.in_batches("config") and not matching.in_batches("builtin")
    assert all(anchors.shape(p) for p in PATTERN_SETS["config"] if "severity" not in p.name)


QUERIES = [
    "throughput", "provider_counts", "sink_result_record", "custom_validator", "topk_providers", "dedup_matches",
    "dq_duplicates", "error_categories_sorted", "run_statistics", "result_statistics",
]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("throughput", "topk_providers")])
def test_texts_are_moved_once_and_no_regex_runs_over_them(spark, tmp_path, name):
    columns = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    orders = [(k, "O", "1-URGENT", datetime.datetime(1997, 1, 1)) for k in range(40)]
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(0, "one " * 30), (1, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = catalog.QUERIES[name](spark, str(tmp_path))
    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") >= 1 and plan.count("ArrowEvalPython [batch_hits(") + plan.count(", batch_hits(") == plan.count("ArrowEvalPython")
    assert anchors._REGEX not in plan and "regexp_extract_all(content" not in plan
    done.count()


def test_bytes_are_judged_in_batches(spark):
    """All of one to three bytes that begin an awkward sequence, read as Spark's own check would have them read."""
    from policyscan.sources import files

    odd = [0x41, 0x0D, 0x0A, 0x80, 0xBF, 0xC0, 0xC1, 0xC2, 0xE0, 0xED, 0x9F, 0xA0, 0xEF, 0xF0, 0x90, 0xF4, 0xF5]
    rows = [(bytes(t),) for n in (1, 2, 3, 4) for t in itertools.product(odd, repeat=n) if n < 4 or t[0] >= 0xE0]
    frame = spark.createDataFrame([*rows, (None,), (b"",)], "c binary")
    expected = F.coalesce(F.try_validate_utf8(F.col("c").cast("string")), F.decode("c", "ISO-8859-1"))
    both = frame.select("c", files.decode_utf8_or_latin1(F.col("c")).alias("mine"), text.newlines(expected).alias("expected"))
    assert both.select("mine")._jdf.queryExecution().optimizedPlan().toString().count("judged(") == 1
    assert "try_validate" not in both.select("mine")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert both.filter(~F.col("mine").eqNullSafe(F.col("expected"))).count() == 0
