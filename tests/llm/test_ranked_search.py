"""Ranked search against scores worked out document by document."""

import math
import random
import re

import numpy as np
import pyarrow as pa

from policyscan.llm import ranked_search

SF = "/root/testdata/sf0.001"
TERM = re.compile(ranked_search.TERM)


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    held = [(i, t) for i, t in ((i, terms(t)) for i, t in docs) if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df, counts = {}, []
    for i, t in held:
        tf = {}
        for x in t:
            tf[x] = tf.get(x, 0) + 1
        counts.append((i, len(t), tf))
        for x in tf:
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        asked = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if t in df}
        scored = []
        for i, n, tf in counts:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(w * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t, w in asked.items() if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, missing, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if missing else i, -score))
    return sorted(out, key=str)


def both(spark, docs, items, parts=3, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    q = spark.createDataFrame(items, "item_id long, text string")
    mine = [(r.item_id, r.rank, r.doc_id, r.score) for r in ranked_search.rank(d, q, **settings).collect()]
    assert sorted(mine, key=str) == brute(docs, items)
    return mine


SMALL = ranked_search.Layout(block=4, shard_bytes=2000, range_docs=8, priming_shards=2)


def test_random_texts_in_many_shards(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 40)))) for i in range(900)]
    items = [(q, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for q in range(25)]
    assert len(both(spark, docs, items, 4, layout=SMALL)) == 50 * 25


def test_given_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    both(spark, docs, items)


def test_groups_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "GROUP_TERMS", 10)
    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(60)]
    both(spark, docs, [(q, f"a{q} b{q % 5} C zzz") for q in range(9)])


def test_defined_results(spark):
    docs = [
        (1, None), (2, ""), (3, " .;- "), (4, "Ärger IST ärger x"), (5, "ist"), (5, "ist"), (None, "ist"),
        (6, "日本 x"), (7, "x " * 9000), (2**53 + 1, "ist y"), (2**53 + 2, "ist y"), (8, "\x00a\x7fa"),
    ] + [(100 + i, "same words here") for i in range(70)]
    items = [(1, "IST"), (1, "IST"), (1, "x"), (2, "same"), (3, None), (4, "?"), (5, "nowhere"), (None, "日本"), (6, "a here")]
    found = both(spark, docs, items, layout=SMALL)
    assert (2**53 + 1) in {r[2] for r in found} and any(r[0] is None for r in found)
    assert [r[2] for r in sorted(found, key=str) if r[0] == 2 and r[1] <= 3]
    clashing = spark.createDataFrame([(1, "x", 1, 2)], "doc_id long, text string, rank int, term int")
    asked = spark.createDataFrame([(1, "x", 3)], "item_id long, text string, doc_id int")
    assert len(ranked_search.rank(clashing, asked).collect()) == 1
    assert ranked_search.rank(clashing.limit(0), asked).collect() == []
    assert ranked_search.rank(clashing, asked.limit(0)).collect() == []


def lists_of(tfs, lengths, weights, statistics):
    """Postings of one shard from term to {document: tf}."""
    owner = np.concatenate([np.array(sorted(t), np.int64) for t in tfs])
    tf = np.concatenate([np.array([t[d] for d in sorted(t)], np.int64) for t in tfs])
    df = np.array([len(t) for t in tfs])
    first = np.cumsum(df) - df
    packed = ranked_search.compressed(owner, tf, lengths, first, df, 128)
    out = []
    for i, weight in enumerate(weights):
        (a, b), (c, d) = packed.block_at[i : i + 2], packed.data_at[i : i + 2]
        heads, widths, data = packed.heads[a:b].astype("<i4"), packed.widths[a:b], packed.data[c:d]
        damping = statistics.damping(lengths)
        parts = heads.tobytes(), widths.tobytes(), data.tobytes()
        out.append(ranked_search.Postings(*parts, int(df[i]), weight, statistics, damping, 128))
    return out


def test_blocks_hold_their_postings():
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 100_000, 300_000)
    tfs = [{int(d): int(rng.choice([1, 300, 70_000])) for d in rng.choice(300_000, n, replace=False)} for n in (1, 128, 129, 1000)]
    statistics = ranked_search.Statistics(1000, 50_000)
    for postings, held in zip(lists_of(tfs, lengths, [3] * 4, statistics), tfs, strict=True):
        documents, scores = postings.between(0, 300_000)
        assert documents.tolist() == sorted(held)
        m = 50 + (50 * lengths[documents] * 1000) // 50_000
        tf = np.array([held[d] for d in documents.tolist()])
        assert (scores == 3 * ((10**9 * tf) // (1000 * tf + 20 * m))).all()
        assert (postings.block_bounds(documents) >= scores).all()


def test_rejected_blocks_stay_closed():
    """A rare, heavy term is essential; of a frequent, light one only the blocks of its documents open."""
    n = 100_000
    rng = np.random.default_rng(9)
    lengths = np.full(n, 100)
    rare = {int(d): int(rng.integers(1, 60)) for d in rng.choice(n, 400, replace=False)}
    common = {d: 1 for d in range(n)}
    statistics = ranked_search.Statistics(n, 100 * n)
    heavy, light = lists_of([rare, common], lengths, [9000, 10], statistics)
    top, scores = ranked_search.best([heavy, light], n, np.arange(n), 10, 0, 2048)
    total = np.zeros(n, np.int64)
    for postings in lists_of([rare, common], lengths, [9000, 10], statistics):
        documents, own = postings.between(0, n)
        total[documents] += own
    expected = np.lexsort((np.arange(n), -total))[:10]
    assert sorted(top.tolist()) == sorted(expected.tolist()) and sorted(scores) == sorted(total[expected])
    assert len(light.last) - light.closed < 0.2 * len(light.last)  # 400 candidates fall in about half of the blocks


def test_terms():
    buffer, hashed, begin, end, owner = ranked_search.terms_of(pa.array(["Ab ab", None, "x-É É"]))
    spelled = [bytes(buffer[a:b]).decode() for a, b in zip(begin, end, strict=True)]
    assert spelled == ["ab", "ab", "x", "É", "É"] and owner.tolist() == [0, 0, 2, 2, 2]
    assert hashed[0] == hashed[1] != hashed[2] and hashed[3] == hashed[4]
