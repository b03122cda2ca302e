"""Explicit rules and mined rules against brute force over all token sets."""

from itertools import combinations

from policyscan.llm import url_rules

SF = "/root/testdata/sf0.001"


def explicit(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        end = min([rest.find(c, cut) for c in "?#" if rest.find(c, cut) >= 0], default=len(rest))
        path = rest[cut:end]
    best = None
    for rule, verdict in url_rules.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, *(best or (None, None))


def brute(rows, min_support, min_confidence, max_tokens):
    """Verdict of every row of (tokens, rule verdict) from all token sets, counted one by one."""
    labelled = [(frozenset(t), v) for t, v in rows if v and t]
    least = -(-min_support * len(labelled) // 1)
    sets = {frozenset(c) for t, v in labelled if v == "block" for n in range(1, max_tokens + 1) for c in combinations(t, n)}
    rules = []
    for s in sets:
        with_set = [v for t, v in labelled if s <= t]
        blocked = with_set.count("block")
        after = any(x.split(":")[0] in ("path", "ending", "query") for x in s)
        if blocked >= least and after and blocked / len(with_set) >= min_confidence:
            rules.append(s)
    return ["block" if any(r <= set(t) for r in rules) else "allow" for t, v in rows], rules


def test_pages_agree_with_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").unionByName(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    parsed = url_rules.parsed(pages.dropDuplicates(["url"])).collect()
    expected, rules = brute([(r.tokens, r.verdict) for r in parsed], 0.005, 0.9, 3)
    assert rules
    by_url = {(r.page_id, r.host, r.path): (r.rule, r.verdict or v) for r, v in zip(parsed, expected, strict=True)}
    got = url_rules.filtered(pages.dropDuplicates(["url"])).collect()
    assert {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in got} == by_url
    assert any(r.rule is None and r.verdict == "block" for r in got) == any(
        v == "block" and r.rule is None for r, v in zip(parsed, expected, strict=True)
    )


def test_explicit_rules(spark):
    urls = [
        "http://a.com/x", "http://A.COM/x", "http://com", "http://com/", "http://example.com/en/1", "http://www.example.com/en/1",
        "http://notexample.com/en/", "https://x.net/es/1?a=b", "x.net/es/1", "http://x.net?q=/es/", "http://x.net/fr", None, "",
        "ftp://h.org/a://b", "http://É.net/fr/#z", "http://u@x.net:80/fr/", "http://sub.www.example.com/en/q.html",
    ]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, tokens string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.parsed(pages).collect()}
    assert got == {i: explicit(u) for i, u in enumerate(urls)}


def test_mined_rules_are_pruned_and_fire(spark):
    rows = [(i, f"http://h{i % 9}.net/es/casino/{i}") for i in range(60)]
    rows += [(100 + i, f"http://h{i % 9}.com/es/news/{i}") for i in range(60)]
    rows += [(200, "http://q.org/en/casino/7"), (201, "http://q.org/es/news/7"), (202, None), (202, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.filtered(pages).collect()}
    assert got[200] == "block" and got[201] == "allow" and got[202] == "allow"
    labelled = url_rules.parsed(pages).filter("rule is not null")
    rules = {tuple(r.antecedent) for r in url_rules.mine(labelled).collect()}
    assert ("path:casino",) in rules
    assert not any(len(r) > 1 and "path:casino" in r for r in rules)


def test_empty_and_unlabelled(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (None, "http://b.org/")], "page_id long, url string")
    assert {r.verdict for r in url_rules.filtered(pages).collect()} == {"allow"}
    assert url_rules.filtered(pages.limit(0)).collect() == []
