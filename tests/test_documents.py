"""Golden documents: one page per rule of the extraction, with results worked out by hand."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from policyscan.frames import salted_join
from policyscan.functions.text import newlines
from policyscan.operators import database as db
from policyscan.operators import documents as pairing
from policyscan.operators.documents import (
    found_mappings,
    process_documents,
    result_mappings,
)

LINK = "|Checkov ID\n|https://example.test/{0}.py[{1}]\n"
GOLDEN = {
    "G1": "== T\n\n" + LINK.format("a", "CKV_AWS_7") + "\n|Severity\n|HIGH\n",
    "G2": "== Title of a page\n\n|Checkov ID\n|CKV3_SAST_96\n\n|Severity\n|MEDIUM\n",
    "G3": "Words that are long enough to pass.\n|Checkov ID |CKV_AWS_9\n|Severity |LOW\n",
    "G4": "Checkov ID: CKV_GCP_12\nSeverity: HIGH\nplain words to pass the gate\n",
    "G5": "| Checkov ID\n| https://example.test/a.py[CKV_AWS_7]\n\n| Severity\n| LOW\n",
    "G6": LINK.format("a", "CKV_AWS_1") + "|Severity\n|HIGH\n\n"
    + LINK.format("b", "CKV_AWS_2") + "|Severity\n|LOW\n",
    "G7": LINK.format("a", "CKV_AWS_1") + "|Severity\n|HIGH\n\n"
    + LINK.format("b", "CKV_AWS_2") + "|Severity\n|HIGH\n",
    "G8": "severity notes\n|Severity\n|HIGH\n|Severity\n|LOW\n[CKV_AWS_1] [CKV_AWS_2] highlight [CKV_AWS_3]\n",
    "G9": "== Title of a page\n\n|Checkov ID\n|CKV_AWS_5\n\n|Severity\n|High\n",
    "G10": "|Checkov ID\n|CKV2_AWS_FOO\n|Severity\n|HIGH\nalso [CKV_AWS_3] here\n",
    "G11": "[CKV_AWS_1] severity",
    "G12": "[CKV_AWS_1] has neither of the two words in it, but many others\n",
    "G13": "severity [CKV_AWS_1] " + "\x01\x02" * 30,
    "G14": ("== T\n\n" + LINK.format("a", "CKV_AWS_7") + "\n|Severity\n|HIGH\n").replace("\n", "\r\n"),
    "G16": "|Checkov ID\n|https://example.test/none\nnotes [NOTE] then [CKV_AWS_8]\n|Severity\n|LOW\n",
}
# id: (mapping, overall confidence, hash, matches as (id, severity, confidence, start, end), codes)
EXPECTED = {
    "G1": (("CKV_AWS_7", "HIGH"), 1.0, "bb75e71016cd2c69", [("CKV_AWS_7", "HIGH", 1.0, 6, 55)], []),
    "G2": (("CKV3_SAST_96", "MEDIUM"), 1.0, "040e3cf8c9929e38", [("CKV3_SAST_96", "MEDIUM", 1.0, 20, 45)], []),
    "G3": (None, 0.0, "6a4b56d12645addd", [], ["NO_MATCHES", "LOW_CONFIDENCE"]),
    "G4": (None, 0.0, "ed92de1ee87c8e91", [("CKV_GCP_12", None, 0.48, 0, 22)], ["LOW_CONFIDENCE", "MISSING_SEVERITY"]),
    "G5": (None, 0.0, "daa1e2e500709c08", [("CKV_AWS_7", None, 0.264, 40, 51)], ["LOW_CONFIDENCE", "MISSING_SEVERITY"]),
    "G6": (
        ("CKV_AWS_1", "HIGH"), 0.81, "701b0cc9738412bd",
        [("CKV_AWS_1", "HIGH", 1.0, 0, 49), ("CKV_AWS_2", "LOW", 0.264, 105, 116)],
        ["HIGH_CONFIDENCE_VARIATION"],
    ),
    "G7": (
        ("CKV_AWS_1", "HIGH"), 0.9, None,
        [("CKV_AWS_1", "HIGH", 1.0, 0, 49), ("CKV_AWS_2", "HIGH", 0.264, 105, 116)],
        ["HIGH_CONFIDENCE_VARIATION"],
    ),
    "G8": (
        ("CKV_AWS_1", "HIGH"), 0.19008, "6dc0bafe11ee353e",
        [
            ("CKV_AWS_1", "HIGH", 0.264, 46, 57),
            ("CKV_AWS_2", "LOW", 0.264, 58, 69),
            ("CKV_AWS_3", "HIGH", 0.264, 80, 91),
        ],
        ["LOW_CONFIDENCE"],
    ),
    "G9": (None, 0.0, "9683627edeac892b", [("CKV_AWS_5", None, 1.0, 20, 42)], ["LOW_CONFIDENCE", "MISSING_SEVERITY"]),
    "G10": (
        None, 0.9, "6e32e147bd281147",
        [("CKV2_AWS_FOO", "HIGH", 1.0, 0, 25), ("CKV_AWS_3", "HIGH", 0.264, 47, 58)],
        ["INVALID_CHECKOV_ID", "HIGH_CONFIDENCE_VARIATION"],
    ),
    "G11": (None, 0.0, "", [], []),
    "G12": (None, 0.0, "", [], []),
    "G13": (None, 0.0, "", [], []),
    "G14": (("CKV_AWS_7", "HIGH"), 1.0, "bb75e71016cd2c69", [("CKV_AWS_7", "HIGH", 1.0, 6, 55)], []),
    "G16": (("CKV_AWS_8", "LOW"), 0.3168, "a0921e2617d0e07d", [("CKV_AWS_8", "LOW", 0.264, 57, 68)], []),
}


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.createDataFrame(list(GOLDEN.items()), "path string, content string")
    return rows.withColumn("content", newlines(F.col("content"))).cache()


@pytest.fixture(scope="module")
def results(documents):
    return {r.path: r for r in process_documents(documents).collect()}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_golden(results, name):
    mapping, confidence, digest, matches, codes = EXPECTED[name]
    row = results[name]
    found = (row.checkov_id, row.severity) if row.checkov_id and row.severity else None
    assert found == mapping
    assert round(row.confidence, 6) == confidence
    if digest is not None:
        assert row.content_hash == digest
    got = [
        (m.checkov_id, m.severity, round(m.confidence, 6), m.start_position, m.end_position)
        for m in row.matches
    ]
    assert got == matches
    assert [i.code for i in row.validation_issues] == codes
    text = GOLDEN[name].replace("\r\n", "\n")
    for m in row.matches:
        assert m.checkov_id in text[m.start_position : m.end_position]


def test_inline_fields_need_the_builtin_set(documents):
    row = process_documents(documents.filter("path = 'G4'"), patterns="builtin").collect()[0]
    assert (row.checkov_id, row.severity, round(row.confidence, 6)) == ("CKV_GCP_12", "HIGH", 0.576)


def test_short_way_agrees_with_results(documents):
    short = {tuple(r) for r in found_mappings(documents).collect()}
    full = {tuple(r) for r in result_mappings(process_documents(documents)).collect()}
    assert short == full and len(short) == 7


def test_many_matches_in_one_document(spark):
    """Positions stay exact over more matches than one fold block holds."""
    ids = [f"CKV_AWS_{n}" for n in range(1500)]
    body = "severity é list: " + " ü ".join(f"[{i}]" for i in ids)
    frame = spark.createDataFrame([("p", body)], "path string, content string")
    matches = process_documents(frame, validate=False).collect()[0].matches
    assert [m.checkov_id for m in matches] == ids
    assert all(
        body[m.start_position : m.end_position] == f"[{m.checkov_id}]" for m in matches
    )


def test_file_order_decides_conflicts(spark):
    found = spark.createDataFrame(
        [("a-b/c.adoc", "CKV_X_1", "HIGH"), ("a/b.adoc", "CKV_X_1", "LOW"), ("z.adoc", "CKV_X_1", "LOW")],
        "path string, checkov_id string, severity string",
    )
    assert [tuple(r) for r in db.first_wins(found).collect()] == [("CKV_X_1", "LOW")]
    assert [tuple(r) for r in db.conflicts(found).collect()] == [("CKV_X_1", "LOW", "HIGH", "a-b/c.adoc")]
    assert [tuple(r) for r in db.extraction_stats(found).collect()] == [("LOW", 2)]
    row = db.assemble(found).collect()[0]
    assert (row.total_mappings, row.stats_total, row.severity_counts) == (1, 2, {"LOW": 2})


def test_pairing_time_grows_with_the_page(spark):
    def seconds(n):
        page = "\n".join(f"[CKV_AWS_{i}] level HIGH then LOW" for i in range(n)) + "\n|Severity\n|LOW\n|Severity|HIGH\n"
        page = "checkov severity\n" + page
        frame = spark.createDataFrame([("a", page)], "path string, content string")
        process_documents(frame).collect()
        began = time.perf_counter()
        (row,) = process_documents(frame).collect()
        assert len(row.matches) == n
        return time.perf_counter() - began

    small, large = seconds(4000), seconds(8000)
    assert large < 3.2 * small + 1


def test_nearest_levels_against_all_distances(spark):
    rng = random.Random(4)
    for _ in range(3):
        words = [rng.choice([f"[CKV_AWS_{i}]", "high", "Low", "info", "x", "y"]) for i in range(300)]
        text = " ".join(words)
        starts = [m.start() for m in re.finditer(r"\[CKV", text)]
        severities = ["LOW", "HIGH", "INFO"]
        places = [
            (m.start(), severities.index(m.group(1).upper()))
            for m in re.finditer(r"(?=(critical|high|medium|low|info))", text, re.IGNORECASE)
            if m.group(1).upper() in severities
        ]
        expected = [severities[min((abs(p - s), k) for p, k in places)[1]] for s in starts]
        frame = spark.createDataFrame([(text, severities, starts)], "t string, s array<string>, h array<int>")
        frame = frame.selectExpr("t", "s", "transform(h, x -> named_struct('checkov_id', 'i', 'start_position', x)) AS h")
        frame = frame.withColumn("o", pairing.level_occurrences("t", "s"))
        (row,) = frame.select(pairing.nearest_severities("h", "o", "s").alias("r")).collect()
        assert [r.severity for r in row.r] == expected


def test_a_hot_identifier_is_spread(spark):
    found = spark.range(20_000).selectExpr(
        "concat('f', id) AS path", "IF(id % 10 = 0, concat('CKV_X_', id), 'CKV_HOT_1') AS checkov_id",
        "IF(id % 3 = 0, 'LOW', 'HIGH') AS severity",
    )
    first = db.first_wins(found)
    salted = salted_join(found, first.withColumnRenamed("severity", "old"), "checkov_id", "path")
    assert salted.count() == 20_000
    spread = found.filter("checkov_id = 'CKV_HOT_1'").selectExpr("pmod(xxhash64(path), 16) AS s").groupBy("s").count()
    counts = [r["count"] for r in spread.collect()]
    assert len(counts) == 16 and max(counts) < 2 * min(counts)
    plan = db.conflicts(found)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
