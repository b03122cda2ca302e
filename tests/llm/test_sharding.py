"""Differencing against its definition, and the laws of the shards."""

import random

import numpy as np

from policyscan.llm import prefix, sharding

SF = "/root/testdata/sf0.001"


def check(rows, texts, shards=8):
    """Every row once, slots gapless, equal texts together unless their group is large."""
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in texts)
    total = sum(r.size for r in rows)
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    where = {r.doc_id: r.shard for r in rows}
    groups = {}
    for i, t in texts:
        groups.setdefault(t, []).append(i)
    for text, ids in groups.items():
        size = (len(text.encode()) if text else 0) + 1
        if size * len(ids) <= total // (shards * sharding.PIECES_PER_SHARD):
            assert len({where[i] for i in ids}) == 1
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def test_difference_places_every_column_once():
    rng = np.random.default_rng(1)
    sums = rng.integers(0, 10_000, (300, 8))
    ends = sharding.difference(sums)
    assert (np.sort(ends, axis=1) == np.arange(8)).all()
    totals = np.zeros(8, np.int64)
    np.add.at(totals, ends, sums)
    assert totals.max() - totals.min() < 200


def test_two_way_differencing_by_hand():
    sums = np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    totals = np.zeros(2, np.int64)
    np.add.at(totals, sharding.difference(sums), sums)
    assert sorted(totals) == [14, 16]  # 8-7, 6-5, 4-1, 3-1: a difference of 2


def test_shards_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs).collect()
    sizes = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.shard(docs.repartition(5)).collect()))


def test_levels_and_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ITEMS_PER_BUCKET", 20)
    monkeypatch.setattr(prefix, "ROWS_PER_BUCKET", 50)
    rng = random.Random(4)
    texts = [(i, "hot" if i % 3 == 0 else f"{rng.random()}" * rng.randrange(1, 9)) for i in range(1500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sizes = check(sharding.shard(docs).collect(), texts)
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes)


def test_nulls_empty_long_repeated_and_clashing(spark):
    texts = [(1, None), (2, None), (3, ""), (3, ""), (4, "é"), (5, "x" * 200_000), (None, "a")]
    docs = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, slot int")
    rows = sharding.shard(docs).collect()
    assert sorted((r.size, r.text_crc32) for r in rows if r.doc_id in (1, 3, 4)) == [(1, 0), (1, 0), (1, 0), (3, 235179326)]
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len(rows) == len(texts)
    assert sharding.shard(docs.limit(0)).collect() == []
