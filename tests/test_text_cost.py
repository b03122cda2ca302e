"""Text screening touches each text a fixed, small number of times, and still counts all of it."""

import time

from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.functions import text

# ASCII, other letters, controls between them, and nothing at all.
PAGES = ["policy " * 9, "Ünïcode Rule \x00 \x1f\t\r\n" * 9, "\x01\x0b\x0c\x0e" * 20 + "CHECK", "", None, "Kheck \U0001f600\x7f\x85" * 12]


def test_control_count_and_suitability(spark):
    frame = spark.createDataFrame(list(enumerate(PAGES)), "i int, t string")
    rows = frame.select("i", text.control_count(F.col("t")).alias("n"), text.suitability(F.col("t")).alias("s")).orderBy("i").collect()
    for page, row in zip(PAGES, rows, strict=True):
        if page is None:
            assert row.n is None and row.s.is_valid is None
            continue
        n = sum(ord(c) < 32 and c not in "\n\r\t" for c in page)
        noisy = bool(page) and n / len(page) > fixed.MAX_CONTROL_RATIO
        assert row.n == n
        assert row.s.is_valid == (len(page) >= fixed.MIN_CONTENT_LENGTH and not noisy)
        assert row.s.relevant_keywords == [w for w in fixed.RELEVANT_KEYWORDS if w in page.lower()]


def test_screening_costs_little_more_than_one_pass(spark):
    """Ranges in a negated class cost some hundred passes over the text."""
    frame = spark.range(800).select(F.repeat(F.concat(F.lit("plain words "), "id"), 4000).alias("t")).repartition(8).cache()
    frame.count()

    def seconds(value):
        def run():
            start = time.time()
            frame.select(value.alias("v")).write.format("noop").mode("overwrite").save()
            return time.time() - start

        return min(run() for _ in range(3))

    one_pass = seconds(F.length(F.regexp_replace("t", "[~]", "")))
    assert seconds(text.control_count(F.col("t"))) < 6 * one_pass + 0.3
    assert seconds(text.suitability(F.col("t"))["is_valid"]) < 12 * one_pass + 0.3
