"""Level words and whole-word patterns against Python, on texts made of awkward parts."""

import random
import re

from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.operators import documents, matching
from policyscan.operators.patterns import Pattern, resolve

PARTS = ["critical", "low", "highigh", "mediumedium", "criticalow", "INFO", "High", " ", "é", "\U0001f600", "İ", "￿", "x_HIGH", "LOW.", "-INFO-", "CRITICAL", "lowinfo", "HIGHÉ", "\n", "MEDIUM"]


def texts(n):
    rng = random.Random(5)
    return ["".join(rng.choices(PARTS, k=rng.randrange(0, 30))) for _ in range(n)] + ["", "low" * 3000]


def test_every_place_of_the_levels_a_text_has(spark):
    rng, rows = random.Random(6), []
    for i, t in enumerate(texts(300)):
        rows.append((i, t, rng.sample(fixed.SEVERITIES, rng.randrange(0, 6))))
    rows += [(9000, None, ["LOW"]), (9001, "low", None), (9002, "low low", ["LOW", "LOW", "ODD"])]
    frame = spark.createDataFrame(rows, "i int, t string, s array<string>")
    found = {r.i: r.o for r in frame.select("i", documents.level_occurrences("t", "s").alias("o")).collect()}
    words = "|".join(fixed.SEVERITIES).lower()
    for i, t, s in rows:
        places = [(m.start(), s.index(m[1].upper())) for m in re.finditer(f"(?=({words}))", (t or "").lower()) if m[1].upper() in (s or ())]
        assert [tuple(o) for o in found[i]] == places, i


def test_levels_are_not_searched_by_trying_every_word_everywhere():
    assert "critical|high" not in documents.level_occurrences_sql("t", "s")


def test_whole_words(spark):
    generic = resolve("builtin")["severity"][-1]
    assert generic.name == "severity_generic" and generic.whole_words
    assert Pattern("x", r"\b(CKV)_(A|B)\b").whole_words is None and Pattern("x", r"\b([A-Z]+)\b").whole_words is None
    frame = spark.createDataFrame(list(enumerate(texts(400))), "i int, t string")
    shown = frame.select(
        F.expr(matching._captured("t", generic)).alias("quick"), F.regexp_extract_all("t", F.lit(generic.regex), F.lit(1)).alias("plain")
    ).collect()
    assert all(r.quick == r.plain for r in shown) and sum(len(r.plain) for r in shown) > 300
