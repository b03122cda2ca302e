"""Encoding against the model's own library, a plain Viterbi, and exact round trips."""

import random

import pytest
import sentencepiece

from policyscan.llm.sentencepiece_codec import MARK, MODEL, Model, decode, encode

SF = "/root/testdata/sf0.001"
HAND = [
    "", " ", "  ", "a", " a", "  a", "   a b    c     ", "Hello  wörld 漢字 \n\tx<s>", " " * 15, "x" + " " * 37 + "y",
    "def f(x):\n        return x    \n", "1234 567", "<0x0A> <unk> </s>", "\U0001f600\x00é", "aaaaaaaaaaaaaaaaaaaaaaaaa",
]


@pytest.fixture(scope="module")
def model():
    return Model.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(model, n):
    rng = random.Random(7)
    pieces = [p.replace(MARK, " ") for p in model.text[259:]]
    mixed = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))) for _ in range(n)]
    return mixed + ["".join(rng.choice("  abehinorst.") for _ in range(rng.randrange(1, 50))) for _ in range(n)]


def test_ids_equal_the_library(spark, model, library):
    texts = HAND + random_texts(model, 800)
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    assert [ids.tolist() for ids in model.encode(texts)] == library.encode(texts)


def test_decoding_is_an_exact_round_trip(model):
    texts = HAND + random_texts(model, 300)
    assert model.decode([ids.tolist() for ids in model.encode(texts)]) == texts


def test_long_words_and_runs(model, library):
    texts = ["ab" * 20_000, " " * 50_000, "x" + " " * 999 + "y"]
    assert [ids.tolist() for ids in model.encode(texts)] == library.encode(texts)


def test_unigram_scores_by_plain_viterbi():
    rng = random.Random(2)
    alphabet = "abcd"
    pieces = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))) for _ in range(60)})
    scores = [("<unk>", 0.0)] + [(p, -rng.random() * 10 - 0.1) for p in pieces]
    model = Model(scores, None, 0, "unigram", {0}, prefix=False)
    worst = min(s for _, s in scores[1:]) - 10

    def plain(word):
        best = [0.0] + [float("-inf")] * len(word)
        for end in range(1, len(word) + 1):
            for begin in range(end):
                score = model.lookup.get(word[begin:end])
                gain = model.score[score] if score is not None else worst if end - begin == 1 else None
                if gain is not None:
                    best[end] = max(best[end], best[begin] + gain)
        return best[-1]

    words = ["".join(rng.choice(alphabet + "z") for _ in range(rng.randrange(1, 15))) for _ in range(400)]
    for word, ids in zip(words, model.words(words), strict=True):
        total = sum(model.score[i] if i else worst for i in ids)
        assert total == pytest.approx(plain(word))


def test_frames_nulls_extra_and_clashing_columns(spark, model):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (3, "a b", "y"), (4, f"a{MARK}b", None)],
        "doc_id long, text string, ids string",
    )
    coded = decode(encode(docs, model), model)
    rows = {(r.doc_id, r.text, r.decoded, None if r.ids is None else len(r.ids)) for r in coded.collect()}
    assert rows == {(1, None, None, None), (2, "", "", 0), (3, "a b", "a b", 2), (4, f"a{MARK}b", "a b", 2)}
    assert encode(docs.limit(0), model).collect() == []


def test_texts_without_blanks(model, library):
    import base64
    import random
    import time

    rng = random.Random(12)
    raw = base64.b64encode(rng.randbytes(300_000)).decode()
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(200_000))
    for text in (raw, chinese, "Thelongword" * 500, "x" * 3000, "a-b_c." * 400):
        started = time.perf_counter()
        assert model.encode([text])[0].tolist() == library.encode(text)
        assert time.perf_counter() - started < 10
