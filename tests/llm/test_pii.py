"""Base spans against the plain patterns, votes, reliabilities and whole tables."""

import hashlib
import random
import re
import time

import numpy as np

from policyscan.llm import pii

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digit(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and check_digit(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("1234567890.@+- ()aé%\n") for _ in range(rng.randrange(80))) for _ in range(6000)]
    texts += ["a@b.c@d.e", "@x.y@z.w", "1.2.3.4.5.6.7.8", "0001.2.3.255", "4111-1111 1111 1111", "+1 (017) 555-7713", "a@b..c"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    began = time.time()
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "@a" * 200_000, "a at b " * 60_000, "1 " * 200_000):
        text = run + " x"
        pii.candidates(text, pii.base_spans(text))
    assert time.time() - began < 60


def test_reliability_finds_good_and_bad_labelers():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.4
    accuracy = [0.95, 0.85, 0.8, 0.6, 0.5]
    vote = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    model = pii.Reliability().fit(vote, np.ones(4000), np.zeros(4000, bool))
    assert np.mean((model.posterior(vote) > 0.5) == truth) > 0.95
    gain = model.rates[1, :, 2] - model.rates[0, :, 2]
    assert gain[0] > gain[2] > gain[4]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find(docs).collect():
        base = plain_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in base) for k in PLAIN]
        shown = ",".join(f"{k}:{b}:{e}" for k, b, e in base)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(filter(None, shown.split(","))) <= set(filter(None, r.spans.split(",")))


def test_added_spans_and_odd_rows(spark):
    plain = [(i, f"Call me: phone 212-555-{1000 + i} or mail jo{i} [at] site [dot] org today", "x") for i in range(40)]
    plain += [(100 + i, f"Part order 12-345-{6000 + i} version 1.2.3 costs 10", "x") for i in range(40)]
    odd = [(900, None, "x"), (901, "", "x"), (None, "a@b.org", "x"), (902, "é +1 555 123 4567", "x"), (902, "z", None)]
    docs = spark.createDataFrame(plain + odd, "doc_id long, text string, spans string")
    rows = pii.find(docs).collect()
    assert len(rows) == len(plain) + len(odd)
    got = {(r.doc_id, r.spans) for r in rows}
    assert {(900, ""), (901, ""), (None, "email:0:7"), (902, "phone:2:17"), (902, "")} <= got
    for r in rows:
        if r.doc_id is not None and r.doc_id < 40:
            text = plain[r.doc_id][1]
            mail, phone = text.index("jo"), text.index("212")
            assert r.spans == f"email:{mail}:{text.index(' today')},phone:{phone}:{phone + 12}"
        elif r.doc_id is not None and 100 <= r.doc_id < 200:
            assert r.spans == ""
    assert pii.find(docs.limit(0)).collect() == []
