"""Targets by resharing, the splitting tree's laws, and the drawn rows."""

import numpy as np
import pytest

from policyscan.llm import mixing, prefix

SF = "/root/testdata/sf0.001"


def reshared(sizes, share=1.5, weights=(3, 1, 2), cap=2):
    """Sources in order: share by weight, cap, share the excess again."""
    w = [weights[i % 3] for i in range(len(sizes))]
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_ and left > 1e-9:
        total = sum(w[i] for i in open_)
        given = {i: left * w[i] / total for i in open_}
        left = 0.0
        for i in list(open_):
            target[i] += given[i]
            if target[i] >= cap * sizes[i]:
                left += target[i] - cap * sizes[i]
                target[i] = cap * sizes[i]
                open_.discard(i)
    return target


def words(text):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, rows):
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(order, reshared([sizes[s] for s in order]), strict=True))
    source = {r.doc_id: r.source for r in docs}
    text = {r.doc_id: r.text for r in docs}
    taken = dict.fromkeys(order, 0)
    for r in rows:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (words(text[r.doc_id]), sizes[s])
        assert r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 2 * r.size and all(x is not None for x in r.shards)
        taken[s] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    for s in order:
        largest = max(words(text[i]) for i in text if source[i] == s)
        assert abs(taken[s] - targets[s]) <= largest / 2 + 0.5


def test_the_tree_keeps_quotas_and_shard_sizes():
    quotas = np.array([70, 0, 13, 200, 1])
    taken = [set() for _ in quotas]
    for shard in range(7):
        offsets, counts = mixing.path_draws(quotas, 7, shard, 5)
        assert abs(counts.sum() - quotas.sum() / 7) <= 1
        for rank, (o, c) in enumerate(zip(offsets, counts, strict=True)):
            mine = set(mixing.permuted(np.arange(o, o + c), max(1, int(quotas[rank])), 5).tolist())
            assert len(mine) == c and not taken[rank] & mine
            taken[rank] |= mine
    assert [len(t) for t in taken] == quotas.tolist()


def test_draws_vary_like_the_hypergeometric():
    quotas = np.array([300, 100])
    counts = [mixing.path_draws(quotas, 8, s, seed)[1][1] for seed in range(60) for s in range(8)]
    variance = 50 * 0.25 * 0.75 * (350 / 399)
    assert np.var(counts) == pytest.approx(variance, rel=0.35)


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(prefix, "ROWS_PER_BUCKET", 30)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.report(docs).collect()
    assert len(rows) == docs.count()
    check(docs.collect(), rows)
    again = mixing.report(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mixed_rows_hold_the_taken_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.report(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = dict.fromkeys(taken, 0)
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        got[r.doc_id] += words(r.text)
        assert r.text == whole[r.doc_id] and r.n_chars == len(r.text)
    assert got == taken


def test_nulls_empty_repeated_and_clashing(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "one two\x0bthree", None), (4, "x " * 50_000, "é"), (5, "u v", "z")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, row int")
    check(docs.collect(), mixing.report(docs).collect())
    assert mixing.report(docs.union(docs)).count() == 10
    assert mixing.report(docs.filter("doc_id = 1")).collect()[0].target == 0
    assert mixing.report(docs.limit(0)).collect() == []
    assert mixing.mixed(docs).columns == docs.columns


def test_many_small_sources_give_whole_documents(spark):
    rows = [(i, f"w{i} " * 100, f"s{i:03d}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = {i: t for i, t, _ in rows}
    out = mixing.mixed(docs).collect()
    assert out and all(r.text == texts[r.doc_id] for r in out)
