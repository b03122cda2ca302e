"""The splitting tree with very many blocks, sources and shards."""

import numpy as np

from policyscan.llm import mixing


def test_more_blocks_than_can_be_drawn():
    words = 10**9 * mixing.BLOCK_WORDS * 7  # seven times the blocks that numpy draws from
    sizes = [words // 2, words // 3, words - words // 2 - words // 3, 1, 0]
    block = mixing.fitting_block(words, mixing.BLOCK_WORDS)
    quotas = np.array([mixing.quota(n, n, block) for n in sizes], np.int64)
    assert quotas.sum() <= mixing.MAX_BLOCKS + len(sizes) and quotas[3:].tolist() == [1, 0]
    shards = 1 << 20
    runs = [mixing.run_draws(quotas, shards, first, first + 64, 3) for first in (0, 4096, shards - 64)]
    for run in runs:
        found = list(run)
        assert [f[0] for f in found] == list(range(found[0][0], found[0][0] + 64))
        for shard, _, _, counts in found:
            assert counts.sum() == (shard + 1) * int(quotas.sum()) // shards - shard * int(quotas.sum()) // shards
    assert mixing.fitting_block(10**9, mixing.BLOCK_WORDS) == mixing.BLOCK_WORDS


def test_runs_agree_and_meet_every_quota():
    rng = np.random.default_rng(4)
    quotas = rng.integers(0, 3, 100_000)
    quotas[17] = 50_000
    shards, taken = 300, np.zeros(len(quotas), np.int64)
    whole = list(mixing.run_draws(quotas, shards, 0, shards, 9))
    parts = [f for first in range(0, shards, 70) for f in mixing.run_draws(quotas, shards, first, min(first + 70, shards), 9)]
    for (shard, ranks, offsets, counts), other in zip(whole, parts, strict=True):
        assert shard == other[0] and all((a == b).all() for a, b in zip((ranks, offsets, counts), other[1:], strict=True))
        assert (offsets == taken[ranks]).all() and counts.all()
        taken[ranks] += counts
    assert (taken == quotas).all()


def test_very_many_small_sources(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('s', id) AS source", "repeat('word ', 10 + int(id % 5)) AS text")
    rows = mixing.draw(docs, block_words=8, shards=50).collect()
    assert len(rows) == 30_000
    for row in rows:
        assert all(d.words == row.size and 0 <= d.shard < 50 for d in row.draws)
        assert abs(sum(d.words for d in row.draws) - row.target) <= row.size / 2 + 1
