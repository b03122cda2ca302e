"""Every stage on its own input, against plain versions of its rules."""

import collections

import pytest
import sentencepiece

import corpus_pipeline
from policyscan.llm import line_dedup, minhash, quality_rules, sentencepiece_codec
from policyscan.llm.quality_rules import judge

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        target = str(tmp_path_factory.mktemp("pipeline") / f"{k}")
        stage(spark, docs, SF).write.parquet(target)
        docs = out[name] = spark.read.parquet(target)
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes
        assert all(r.n_chars == len(r.text) for r in stages[name].collect())


def test_quality_keeps_and_cleans(stages):
    before, after = texts(stages["documents"]), texts(stages["quality_rules"])
    kept = {r.doc_id for r in judge(stages["documents"]).collect() if r.kept}
    assert set(after) == kept and 0 < len(kept) < len(before)
    for i, text in after.items():
        lines = iter(before[i].split("\n"))
        assert all(line in lines for line in text.split("\n"))  # in order, none added


def test_line_dedup(stages):
    rows = stages["quality_rules"].collect()
    pages, counts = collections.Counter(r.source for r in rows), collections.Counter()
    for r in rows:
        counts.update((r.source, line) for line in {x.strip(" \t\n\v\f\r") for x in r.text.split("\n")} - {""})
    after = texts(stages["line_dedup"])
    assert len(after) == len(rows)
    for r in rows:
        stay = [
            x for x in r.text.split("\n")
            if not (n := counts[r.source, x.strip(" \t\n\v\f\r")]) >= line_dedup.MIN_PAGES
            or n <= line_dedup.BOILERPLATE_RATIO * pages[r.source]
        ]
        all_lines = r.text.split("\n")
        worded = sum(1 for x in all_lines if x.strip(" \t\n\v\f\r"))
        if len(all_lines) - len(stay) >= line_dedup.COPY_SHARE * worded:
            stay = all_lines  # a copy, not boilerplate
        assert after[r.doc_id] == "\n".join(stay)


def test_one_of_each_class_stays(stages):
    classes = {r.doc_id: r.class_id for r in minhash.classes(stages["line_dedup"]).collect()}
    after = texts(stages["minhash_near_dedup"])
    assert sorted(after) == sorted(set(classes.values())) and len(after) < len(classes)
    assert after.items() <= texts(stages["line_dedup"]).items()


def test_mix(stages):
    before = {r.doc_id: r for r in stages["minhash_near_dedup"].collect()}
    total, taken = sum(len(r.text.split()) for r in before.values()), 0
    times = collections.Counter()
    for r in stages["mixing"].collect():
        assert before[r.doc_id].text == r.text
        times[r.doc_id] += 1
        taken += len(r.text.split())
    halves = {}
    for r in before.values():
        halves[r.source] = max(halves.get(r.source, 0), len(r.text.split()) / 2)
    assert max(times.values()) <= 2 and abs(taken - 1.5 * total) <= sum(halves.values()) + len(halves)


def test_ids(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in stages["sentencepiece"].collect())
    assert got == collections.Counter((r.doc_id, tuple(library.encode(r.text))) for r in stages["mixing"].collect())


def test_run_and_empty(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["sentencepiece"].count()
    docs = stages["documents"].limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_quality_rules_are_native(spark, stages):
    plan = quality_rules.clean(stages["documents"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
