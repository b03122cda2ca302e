"""Groups of equal texts up to a shard's size stay in one shard, and the shards stay level."""

import random

import pytest

from policyscan.llm import prefix, sharding


@pytest.mark.parametrize("bucket", [4096, 300])
def test_groups_up_to_a_shard_stay_whole(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "ITEMS_PER_BUCKET", bucket)
    monkeypatch.setattr(prefix, "ROWS_PER_BUCKET", 500)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdef") for _ in range(rng.randrange(20, 200))) for _ in range(3000)]
    # Of about 650,000 bytes in all, a shard holds 81,000; the groups hold 70,000, 50,000 and 25,000; the last, 180,000.
    texts += ["p" * 99] * 700 + ["q" * 99] * 500 + ["r" * 99] * 250 + ["s" * 99] * 1800
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = sharding.shard(docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    total = sum(r.size for r in rows)
    where, sizes = {}, [0] * 8
    for r in rows:
        where.setdefault(texts[r.doc_id], []).append(r.shard)
        sizes[r.shard] += r.size
    for text, shards in where.items():
        whole = (len(text) + 1) * len(shards) <= total // 8
        assert (len(set(shards)) == 1) == whole
    assert max(sizes) - min(sizes) <= 0.02 * total
