"""Rows without an id in the near-dup stage."""

from policyscan.llm import minhash


def test_a_repeated_id_does_not_collapse_rows_without_id(spark):
    rows = [(None, "same text"), (None, "same text"), (None, None), (None, None), (1, "a"), (2, "b c")]
    for again in ([], [(2, "b c")]):
        docs = spark.createDataFrame(rows + again, "doc_id long, text string")
        kept = minhash.keep_one(docs).collect()
        assert sorted(map(tuple, kept), key=str) == sorted(rows, key=str)
