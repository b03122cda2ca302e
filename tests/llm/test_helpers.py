"""Components and running totals against plain Python."""

import random
from collections import defaultdict

from policyscan.llm import prefix
from policyscan.llm.components import components


def plain(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in list(parent)}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    edges = [e for e in edges if e[0] != e[1]] * 2
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = components(frame).collect()
    assert {r.node: r.component for r in rows} == plain(edges) and len(rows) == len(plain(edges))
    assert components(frame.limit(0)).collect() == []


def test_running_totals(spark):
    rng = random.Random(2)
    rows = [(k, "hot" if k % 3 else f"g{k % 5}", rng.randrange(1 << 63), rng.randrange(9)) for k in range(2000)]
    frame = spark.createDataFrame(rows, "id long, g string, key long, size long")
    for buckets in (1, 7):
        got = {r.id: r.before for r in prefix.running(frame, "g", ["key", "id"], {"before": "size"}, buckets).collect()}
        totals, expected = defaultdict(int), {}
        for k, g, key, size in sorted(rows, key=lambda r: r[2]):
            expected[k] = totals[g]
            totals[g] += size
        assert got == expected
