"""Line ends are stripped of every kind of blank, at about the cost of one pass; screening tells plain texts in one run."""

import random
import time

from pyspark.sql import functions as F

from policyscan.functions import text

# As the functions were first written.
INLINE = r"[\s\x1c-\x1f&&[^\n]]"
ENDS = rf"(?U)(?<!{INLINE}){INLINE}++(?=\n|\z)"
HIDDEN = r"[\p{C}&&[^\t-\r\x1c-\x1f\x85]]"


def test_every_letter_is_judged_as_before(spark):
    """Each code point between letters, at a line's end, at the text's end and after a blank."""
    codes = [*range(0xD800), *range(0xE000, 0x11000), 0x1D7FF, 0x1F600, 0xE0001, 0xF0000, 0x10FFFF]
    frame = spark.createDataFrame([(c, f"a{chr(c)}b{chr(c)}\n {chr(c)}\nc{chr(c)}{chr(c)}") for c in codes], "c int, t string")
    t = F.col("t")
    hidden = F.regexp_count(t, F.lit(HIDDEN)) / F.length(t) > 1 - 0.7
    ends = ~text.rstrip_lines(t).eqNullSafe(F.regexp_replace(t, ENDS, ""))
    foreign = ~text.nfkc(t).eqNullSafe(text._nfkc_udf()(t))
    binary = ~text.appears_binary(t).eqNullSafe(hidden)
    assert frame.filter(ends | foreign | binary).select("c").collect() == []


def test_random_runs_of_blanks(spark):
    pick = random.Random(3)
    rows = ["".join(pick.choices("a\U0001f600 \t\r\n\x1c\x85\xa0 　​", k=pick.randrange(30))) for _ in range(3000)]
    frame = spark.createDataFrame([(r,) for r in [*rows, "", None]], "t string")
    assert frame.filter(~text.rstrip_lines(F.col("t")).eqNullSafe(F.regexp_replace("t", ENDS, ""))).collect() == []


def test_line_ends_cost_little_more_than_one_pass(spark):
    frame = spark.range(800).select(F.repeat(F.concat(F.lit("plain words "), "id"), 4000).alias("t")).repartition(8).cache()
    frame.count()

    def seconds(value):
        def run():
            start = time.time()
            frame.select(value.alias("v")).write.format("noop").mode("overwrite").save()
            return time.time() - start

        return min(run() for _ in range(3))

    before = seconds(F.regexp_replace("t", ENDS, ""))
    assert seconds(text.rstrip_lines(F.col("t"))) < 0.6 * before
