"""Mined rules of any length, and long urls that occur often."""

import time

from policyscan.llm import url_rules


def test_a_rule_of_four_tokens_is_mined_and_pruning_is_exact(spark):
    four = ["ending:php", "path:p", "query:q", "site:x"]
    rows = [(four, "block")] * 50
    rows += [([x for x in four if x != left], "allow") for left in four for _ in range(10)]
    # Nested around it: more tokens without more confidence, by one and by two.
    rows += [([*four, "path:r", "path:s"], "block")] * 30
    rows += [(["path:alone", "site:y"], "block")] * 20
    rows += [(["site:y", "site:z"], "allow")] * 20
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = {tuple(r.antecedent): (r.confidence, r.support) for r in url_rules.mine(labelled).collect()}
    assert rules[tuple(four)] == (1.0, 80 / len(rows))
    assert rules[("path:alone",)] == (1.0, 20 / len(rows))
    assert set(rules) == {tuple(four), ("path:alone",), ("path:r",), ("path:s",)}


def test_a_long_url_that_is_often_repeated(spark):
    long = "/".join(f"s{k}" for k in range(30))
    rows = [(i, f"http://h.net/es/{long}") for i in range(40)]
    rows += [(100 + i, f"http://h{i % 9}.net/es/casino/{i}") for i in range(60)]
    rows += [(200 + i, f"http://h{i % 9}.com/es/news/{i}") for i in range(340)]
    rows += [(900, "http://q.org/s3/x"), (901, f"http://q.org/{long}"), (902, "http://q.org/casino"), (903, "http://q.org/es/")]
    rows += [(904, "http://q.org/" + "n/" * 50_000 + "s7/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    began = time.time()
    got = {r.page_id: (r.verdict, r.confidence) for r in url_rules.filtered(pages).collect()}
    assert time.time() - began < 90
    assert [got[k] for k in (900, 901, 902, 904)] == [("block", 1.0)] * 4
    assert got[903] == ("allow", None)


def test_equal_tokens_are_one_item(spark):
    rows = [(1, ["path:a", "path:b", "site:x", "site:y"]), (2, ["path:a", "path:b", "path:c", "site:x", "site:y"]), (3, ["site:z"])]
    labelled = spark.createDataFrame(rows, "row long, tokens array<string>")
    got = {r.token: r.item for r in url_rules.merged(labelled, 0.3).collect()}
    expected = {"path:a": "path:a", "path:b": "path:a", "path:c": "path:c", "site:x": "site:x", "site:y": "site:x", "site:z": "site:z"}
    assert got == expected
    assert set(url_rules.merged(labelled, 0.6).toPandas()["token"]) == {"path:a", "path:b", "site:x", "site:y"}
    assert url_rules.merged(labelled.limit(0)).collect() == []
