"""Contexts of all matches of a text."""

from compare import connect, difference

from policyscan.operators import matching

SF = "/root/testdata/sf0.001"


def test_every_match_has_its_own_context(spark):
    content = "[A] one\n [B_1][A] é " + "x" * 200 + " [A]"
    row = spark.createDataFrame([(content,)], "content string").select(
        matching.match_contexts("content", r"\[[A-Z0-9_]+\]").alias("m")
    ).first()
    starts = [0, 9, 14, len(content) - 3]
    assert [(x.match, x.start_position) for x in row.m] == list(zip(["[A]", "[B_1]", "[A]", "[A]"], starts, strict=True))
    for x in row.m:
        around = content[max(0, x.start_position - 50) : x.start_position + len(x.match) + 50]
        assert x.context == " ".join(around.split())


def test_pages_agree_with_sql_and_hold_later_matches(spark):
    from __spark_entry__ import queries

    assert difference(spark, connect(SF), "text_match_contexts", SF) is None
    first = queries()["text_match_context"](spark, SF).count()
    assert queries()["text_match_contexts"](spark, SF).count() > first
