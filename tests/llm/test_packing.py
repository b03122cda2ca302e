"""Packing: ids against the tokenizer file, cuts against all cuts, and the laws of the pieces."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from policyscan.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.TOKENIZER)


def reference(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, texts, tokenizer, capacity=1024):
    """Every id lies in one piece; sequences are gapless and not too long. Returns the padding's share."""
    lengths, by_document = {}, {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == lengths.get(r.sequence_id, 0)
        lengths[r.sequence_id] = r.offset + r.length
        by_document.setdefault(r.doc_id, []).append(r)
    assert max(lengths.values()) <= capacity
    assert set(by_document) == set(texts)
    for key, text in texts.items():
        ids, at = reference(tokenizer, text), 0
        for r in sorted(by_document[key], key=lambda r: r.start):
            piece = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, list(r.ids)) == (at, len(ids), piece)
            assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths.values())
    return padding / sum(lengths.values())


def test_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(packing.pack(docs).collect(), texts, tokenizer) < 0.01
    assert check(packing.pack(docs.repartition(5)).collect(), texts, tokenizer) < 0.01


def test_order_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").coalesce(1)
    rows = sorted(packing.pack(docs).collect(), key=lambda r: (r.sequence_id, r.offset))
    places = [(r.doc_id, r.start) for r in rows]
    assert places == sorted(places)


def test_streamed_plans(spark, tokenizer, monkeypatch):
    """Many small plans give the same laws, also where one document spans several."""
    monkeypatch.setattr(packing, "PLAN_TOKENS", 3000)
    texts = {1: "word and word. " * 4000, 2: "a", 3: None, 4: "x" * 30_000, 5: "Short one. " * 20}
    line = packing.Line(packing.encoder(packing.TOKENIZER, packing.RANKS), 1024, 7)
    seen = []
    for key, text in texts.items():
        line.add(key, line.model.ids(text))
        seen += list(line.packed(last=False))
    seen += list(line.packed(last=True))
    from types import SimpleNamespace

    rows = []
    for out in seen:
        ids, begins = out["ids"]
        ends = np.append(begins[1:], len(ids))
        for i, key in enumerate(out["key"]):
            values = {k: int(out[k][i]) for k in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            rows.append(SimpleNamespace(doc_id=key, ids=ids[begins[i] : ends[i]].tolist(), **values))
    assert len(seen) > 3
    assert check(rows, texts, tokenizer) < 0.02


def cost(at, penalty, path, capacity):
    total = 0
    for a, b in zip(path[:-1], path[1:], strict=True):
        n = at[b] - at[a]
        assert 0 < n <= capacity
        total += (0 if n & (n - 1) == 0 else capacity - n) + penalty[b]
    return total


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(6)
    for _ in range(60):
        capacity = int(rng.choice([8, 16, 64]))
        at = np.concatenate(([0], np.cumsum(rng.integers(1, capacity + 1, rng.integers(1, 60)))))
        penalty = rng.integers(0, 20, len(at))
        best = [0] + [None] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(
                best[i] + cost(at, penalty, [i, j], capacity) for i in range(j) if at[j] - at[i] <= capacity
            )
        assert cost(at, penalty, packing.cuts(at, penalty, capacity), capacity) == best[-1]


def test_places_to_cut():
    model = packing.encoder(packing.TOKENIZER, packing.RANKS)
    ids = model.ids("One two. Three 3.5 four\nfive")
    at, penalty = packing.places(ids, np.array([len(ids)]), model)
    words = [model.fast.decode(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert words[:2] == ["One two.", " Three 3.5 four\n"] and penalty[-1] == 0 and penalty[1] == packing.SENTENCE_PENALTY


def test_ids_of_odd_texts(tokenizer):
    model = packing.encoder(packing.TOKENIZER, packing.RANKS)
    odd = ["", " ", "\n\n  x", "it's they'LL", "日本語。テスト", "\U0001f600é́", "a<|endoftext|>b", "\x00\x7f", " " * 1_000_000 + "x"]
    long = "some words, 1234 and more's\n" * 30_000  # several parts
    for text in [*odd, long, "no" * 300_000]:
        assert model.ids(text).tolist() == reference(tokenizer, text)


def test_defined_results(spark, tokenizer):
    rows = [(1, None, 5), (2, "", 5), (3, "same text", 5), (3, "same text", 5), (None, "x", 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    out = packing.pack(table, with_ids=False).collect()
    assert out[0].__fields__ == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = {}
    for r in out:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole == {1: 1, 2: 1, 3: 6, None: 2}
    assert packing.pack(table.limit(0)).collect() == []
    named = table.select(table.doc_id.cast("string").alias("name"), table.text.alias("body"))
    assert {r.doc_id for r in packing.pack(named, "name", "body").collect()} == {"1", "2", "3", None}
