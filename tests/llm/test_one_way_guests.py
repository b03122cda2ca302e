"""Guests go to later cells alone, and every link across cells is still seen, once."""

import numpy as np

from policyscan.llm import embedding_dedup as e
from test_embedding_dedup import brute


def test_each_link_meets_in_the_later_cell():
    rng = np.random.default_rng(8)
    x = e.unit(rng.normal(size=(600, 6)))
    both = np.concatenate((x, e.unit(x + rng.normal(size=x.shape) * 0.08)))
    row, cell, home = e.places(both, e.fit(x, 25), 0.98)
    sent = e.one_way(row, cell, home)
    assert sent[home].all() and sent.sum() < len(row)
    own = cell[home]
    there = set(zip(row[sent].tolist(), cell[sent].tolist(), strict=True))
    for k in range(len(x)):
        a, b = k, k + len(x)
        if both[a] @ both[b] >= 0.98 and own[a] != own[b]:
            first, last = sorted((a, b), key=lambda v: own[v])
            assert (first, own[last]) in there and (last, own[first]) not in there


def test_counts_of_both_ends(spark, monkeypatch):
    monkeypatch.setattr(e, "ROWS_PER_CELL", 8)
    monkeypatch.setattr(e, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    # A thin arc over many cells: nearly every link crosses a border, and some vectors repeat.
    turns = rng.uniform(0, 3.0, 240)
    turns[:40] = turns[40:80]
    rows = [(k, [float(np.cos(t)), float(np.sin(t))], 1) for k, t in enumerate(turns)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, e.dedup(frame).collect()), key=str) == brute(rows)
