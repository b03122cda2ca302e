"""ProbMinHash classes against all pairs compared one by one."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from policyscan.llm import minhash
from policyscan.llm.shingles import shingles

SF = "/root/testdata/sf0.001"


def weights(text, size=5):
    words = (text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def probability_jaccard(x, y):
    if set(x.values()) == set(y.values()) == {1}:
        return len(x.keys() & y.keys()) / len(x.keys() | y.keys())
    union = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in union) for i in set(x) & set(y))


def brute_classes(rows):
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, weights(t)) for i, t in rows]
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and (x == y or x.keys() & y.keys()) and probability_jaccard(x, y) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i, _ in rows}


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        out.append(" ".join(words))
    return out


def test_similarity_agrees_with_its_definition():
    rng = random.Random(3)
    for _ in range(40):
        a = " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 30)))
        b = " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 30)))
        got = minhash.similarity(shingles(pa.array([a]), 5)[1:], shingles(pa.array([b]), 5)[1:])
        assert got == pytest.approx(probability_jaccard(weights(a), weights(b)), abs=1e-9)


def test_signatures_estimate_the_similarity():
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)] + [f"w{i % 7}" for i in range(60)]
    texts = [" ".join(base)] + family(rng, base, 6, 20)
    owner, hashed, weight = shingles(pa.array(texts), 5)
    chosen = minhash.signatures(owner, hashed, weight, len(texts), 4096)
    for i in range(1, len(texts)):
        exact = probability_jaccard(weights(texts[0]), weights(texts[i]))
        assert np.mean(chosen[0] == chosen[i]) == pytest.approx(exact, abs=0.04)


def test_signature_does_not_depend_on_the_batch():
    texts = ["one two three", " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(900))]
    together = minhash.signatures(*shingles(pa.array(texts), 5), 3, 64)
    for i, text in enumerate(texts):
        assert (minhash.signatures(*shingles(pa.array([text]), 5), 1, 64)[0] == together[i]).all()


def test_classes_agree_with_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_classes([(r.doc_id, r.text) for r in rows])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    assert got == expected
    assert len(set(got.values())) < len(got)


def test_families_chains_and_copies(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = list(enumerate(family(rng, base, 40, 4) + [" ".join(base)] * 30))
    # A chain: neighbours are similar, its ends are not.
    words = [f"c{i}" for i in range(120)]
    for step in range(12):
        rows.append((1000 + step, " ".join(words)))
        for k in range(2):
            words[step * 6 + k] = f"x{step}-{k}"
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    assert got == brute_classes(rows)
    kept = [r.doc_id for r in minhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted(set(got.values()))


def test_families_whose_copies_are_apart_from_their_base(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_BLOCK_TEXTS", 16)
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = list(enumerate(text for edits in range(8) for text in family(rng, base, 25, edits)))
    rows += [(1000 + k, text + " tail of a line" * 9) for k, (_, text) in enumerate(rows[50:62])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.class_id for r in minhash.classes(docs).collect()} == brute_classes(rows)


def test_nulls_empty_short_long_and_repeated(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "two words", "x"), (5, "two words", None),
        (6, "two  words ", "x"), (None, "two words", "x"), (7, long, "x"), (8, long + " more", "x"),
        (9, "same id", "x"), (9, "same id", "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = sorted(map(tuple, minhash.classes(docs).collect()), key=str)
    expected = [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 4, False), (None, None, True),
        (7, 7, True), (8, 7, False), (9, 9, True), (9, 9, True),
    ]
    assert got == sorted(expected, key=str)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "7", "9", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.classes(docs).collect() == []
