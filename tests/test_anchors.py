"""The one-scan matcher against one regex pass per pattern, on texts made of awkward parts."""

import random

import pytest
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.operators import anchors, matching
from policyscan.operators.patterns import PATTERN_SETS, SHAPES, Pattern, resolve

PARTS = [
    "|Checkov ID", "Checkov ID", "checkov id", "|", ":", "\n", " ", "\t\n", " ", " ", "[", "]", "https://a.b/", "http://x",
    "[CKV_AWS_1]", "[NOTE]", "[BC_X_2]", "CKV_GCP_77", "CKV2_AWS_FOO", "AB", "text table ", "words and words ", "é\U0001f600",
    "|Checkov ID\n|", "|Checkov ID |", "Checkov ID:\n", "[CKV_AWS_9]]", "[[CKV_K8S_3]", "x" * 120, "\uffff", "\ufffe", "|Checkov ID\n|C", "Checkov ID C",
]
# Also the shapes whose names no pattern set runs, at every priority that changes what is kept.
EVERY_SHAPE = [Pattern(f"p{i}_{w}", regex, w, kind="id") for i, regex in enumerate(SHAPES) for w in (1, 3, 4, 6)]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randrange(0, 25)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "[CKV_AWS_1] " * 3000), (2003, "|Checkov ID\n|" * 2000 + "[CKV_AWS_1]"), (2004, "[" * 5000)]
    return spark.createDataFrame(rows, "i int, content string").repartition(8).cache()


@pytest.mark.parametrize("patterns", ["config", "builtin", EVERY_SHAPE])
def test_same_hits_as_one_pass_per_pattern(texts, patterns, monkeypatch):
    one = texts.select("i", matching.all_hits("content", patterns).alias("h"), F.expr(matching.top_id_sql("content", patterns)).alias("top"))
    mine = {r.i: (r.h, r.top) for r in one.collect()}
    monkeypatch.setattr(anchors, "shape", lambda pattern: None)
    each = texts.select("i", matching.all_hits("content", patterns).alias("h"), F.expr(matching.top_id_sql("content", patterns)).alias("top"))
    for r in each.collect():
        assert mine[r.i][0] == r.h, r.i
        assert mine[r.i][1] == r.top, r.i
    assert sum(len(h or ()) for h, _ in mine.values()) > 1000


def test_every_known_pattern_has_a_shape():
    for name in PATTERN_SETS:
        assert all(anchors.shape(p) for p in resolve(name)["id"])
    assert not any(anchors.shape(p) for p in resolve("builtin")["severity"])
    assert len(SHAPES) == 7 and all(fixed.CONFIG_PATTERNS)


def test_noncharacters_of_the_text_stay(spark):
    odd = "\uffff [CKV_AWS_1] \ufffe see \uffff"
    frame = spark.createDataFrame([(odd,)], "content string")
    hit = frame.select(matching.find_ids("content").alias("h")).first().h[0]
    assert hit.start_position == 2 and hit.context == odd
