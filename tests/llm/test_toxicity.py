"""Held-out accuracy, the label model on known votes, and odd rows."""

import random
import zlib

import numpy as np

from policyscan.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_label_model_recovers_rates_and_shares_weight():
    rng = np.random.default_rng(1)
    truth = rng.random(6000) < 0.3
    first = np.where(truth, rng.random(6000) < 0.8, rng.random(6000) < 0.02)
    second = np.where(truth, rng.random(6000) < 0.7, rng.random(6000) < 0.05)
    third = np.where(truth, rng.random(6000) < 0.6, rng.random(6000) < 0.05)
    votes = np.stack((first, first, second, third), axis=1).astype(float)
    model = toxicity.LabelModel(4, 0.3)
    for _ in range(10):
        sums = model.sums(votes, np.ones(6000), np.full(6000, np.nan))
        model.update(**sums)
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.93
    assert model.weight[0] < 0.65 * model.weight[3]  # the repeated voter counts about once


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    true = sum(r.predicted and r.toxic for r in held)
    assert true / sum(r.predicted for r in held) > 0.95
    assert true / sum(r.toxic for r in held) > 0.7


def test_held_out_labels_are_not_learnt_from(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["tree", "house", "river"]) for _ in range(30)) + (" vilebad" * 3 if i % 4 == 0 else "")) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = [(i, int(i % 4 == 0)) for i in range(400)]
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    a, b = (
        sorted((r.doc_id, r.score) for r in toxicity.score(frame, spark.createDataFrame(x, "doc_id long, toxic int")).collect())
        for x in (labels, flipped)
    )
    assert a == b
    assert all((s >= 0.7) == (i % 4 == 0) for i, s in a)


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "idiot", 3), (4, "x " * 90_000, 3), (4, "y", 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(7, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 5 and all(r.score == rows[0].score for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {None}
    assert toxicity.score(docs.limit(0), labels.limit(0)).collect() == []
