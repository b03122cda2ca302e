"""Links, counts and components against all pairs."""

import numpy as np
import pytest

from policyscan.llm import embedding_dedup as e


def brute(rows, least=e.COSINE):
    """rows: (vec_id, vector, label); n_links and component of every row."""
    good = [
        k for k, (i, v, l) in enumerate(rows)
        if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    near = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    near[a].add(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for n in near[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        root = min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)
        out.append((i, len(near[k]), root, i is None or i == root))
    return sorted(out, key=str)


def data(rng, n, dims=16):
    rows = []
    while len(rows) < n:
        base = rng.normal(size=dims)
        for _ in range(rng.integers(1, 12)):
            rows.append((len(rows) * 3 + 1, (base + rng.normal(size=dims) * rng.choice([0, 0.1, 0.2])).tolist(), int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    rng = np.random.default_rng(int(small))
    if small:
        monkeypatch.setattr(e, "ROWS_PER_CELL", 20)
        monkeypatch.setattr(e, "BLOCK_ROWS", 7)
    rows = data(rng, 300)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, e.dedup(frame).collect()), key=str) == brute(rows)


def test_guests_cover_every_border():
    rng = np.random.default_rng(3)
    x = e.unit(rng.normal(size=(800, 6)))
    y = e.unit(x + rng.normal(size=x.shape) * 0.08)
    centers = e.fit(x, 25)
    both = np.concatenate((x, y))
    row, cell, home = e.places(both, centers, 0.98)
    at = {}
    for r, c, h in zip(row, cell, home, strict=True):
        at.setdefault(r, set()).add(c)
        if h:
            at.setdefault(("home", r), c)
    for k in range(len(x)):
        if x[k] @ y[k] >= 0.98:
            assert at[("home", k)] in at[k + len(x)] and at[("home", k + len(x))] in at[k]
    assert len(row) < len(both) * len(centers)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1),
        (12, [1e100, 1e99], 2), (13, [1e-100, 1e-101], 2), (14, [1.0, 0.0], 1), (14, [1.0, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, weight int")
    assert sorted(map(tuple, e.dedup(frame).collect()), key=str) == brute(rows)
    huge = spark.createDataFrame([(1, [1e300, 0.0], 1), (2, [1.0, 0.0], 1)], frame.schema.fieldNames()[:3])
    assert [r.n_links for r in e.dedup(huge).collect()] == [1, 1]
    assert e.dedup(frame.limit(0)).collect() == []
