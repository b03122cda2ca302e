"""A vocabulary of more terms than any fixed number."""

import random

from policyscan.llm import toxicity


def test_every_supported_term_is_learnt(spark):
    rng = random.Random(6)
    words = [a + b + "lorn" for a in ("qua", "zib", "vro", "xem", "jup", "kyd", "wof", "gna", "plu", "fyx") for b in "bcdfghkm"]
    plain = ["tree", "house", "river", "stone", "cloud", "field"]
    docs = [(i, " ".join(rng.choice(plain) for _ in range(20)), None) for i in range(4800)]
    docs += [(5000 + i, " ".join(rng.choice(plain) for _ in range(20)) + f" {w} {w} {w}", w) for i, w in enumerate(words * 30)]
    frame = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(d[0], int(d[2] is not None)) for d in docs], "doc_id long, toxic int")
    terms = toxicity.lexicon(frame.join(labels, "doc_id"))
    assert len(terms) == len(words) == 80
    assert all(any(w.startswith(t.strip("=*")) for t in terms) for w in words)
    scored = {r.doc_id: r for r in toxicity.score(frame, labels).collect()}
    assert {w for i, _, w in docs if w and scored[i].held_out and scored[i].predicted} == set(words)
    assert not any(scored[i].predicted for i, _, w in docs if not w)
