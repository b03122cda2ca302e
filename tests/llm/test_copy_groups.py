"""Groups of equal texts through the stages of the pipeline."""

import random

import sentencepiece

import corpus_pipeline
from policyscan.llm import line_dedup, sentencepiece_codec


def page(rng, lines=8):
    return "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) for _ in range(lines))


def test_one_text_of_a_hot_copy_group_reaches_the_last_stage(spark):
    rng = random.Random(3)
    hot = page(rng)
    rows = [(i, "a", "en", hot) for i in range(40)]
    rows += [(100 + i, "a", "en", "Menu\n" + page(rng)) for i in range(100)]
    docs = spark.createDataFrame([(*r, len(r[-1])) for r in rows], "doc_id long, source string, lang string, text string, n_chars int")
    cleaned = line_dedup.clean(docs).collect()
    assert all(r.text == hot for r in cleaned if r.doc_id < 100)
    assert not any("Menu" in r.text for r in cleaned)  # boilerplate still goes
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, "")
        if name == "minhash_near_dedup":
            assert [r.text for r in docs.filter("doc_id < 100").collect()] == [hot]
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    assert any(list(r.ids) == library.encode(hot) for r in docs.filter("doc_id < 100").collect())


def test_copies_count_once_in_lines_and_total(spark):
    rows = [(i, "s", "x\ny") for i in range(3)] + [(10 + i, "s", f"x\nown {i}") for i in range(2)]
    rows += [(20 + i, None, "z") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.clean(docs).collect()}
    assert got == {0: "y", 1: "y", 2: "y", 10: "own 0", 11: "own 1"} | {20 + i: "z" for i in range(5)}


def test_one_of_a_hot_group_of_near_copies_reaches_the_last_stage(spark):
    rng = random.Random(4)
    common = page(rng, 19).split("\n")
    rows = []
    for i in range(40):
        near = list(common)
        near[7] = page(rng, 1)
        rows.append((i, "a", "en", "\n".join(near)))
    rows += [(100 + i, "a", "en", "Menu\n" + page(rng)) for i in range(100)]
    docs = spark.createDataFrame([(*r, len(r[-1])) for r in rows], "doc_id long, source string, lang string, text string, n_chars int")
    given = {r[0]: r[3] for r in rows}
    cleaned = {r.doc_id: r.text for r in line_dedup.clean(docs).collect()}
    assert all(cleaned[i] == given[i] for i in range(40)) and not any("Menu" in t for t in cleaned.values())
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, "")
        if name == "minhash_near_dedup":
            left = {r.doc_id for r in docs.collect() if r.doc_id < 100}
            assert len(left) == 1
    assert {r.doc_id for r in docs.collect() if r.doc_id < 100} <= left
