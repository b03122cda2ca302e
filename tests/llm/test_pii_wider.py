"""Wider forms and decoys planted in the given documents: precision and recall of the added spans per kind."""

import random

from policyscan.llm import pii

SF = "/root/testdata/sf0.001"


def card(rng, length=16, first="4"):
    body = first + "".join(rng.choice("0123456789") for _ in range(length - 2))
    return next(body + d for d in "0123456789" if pii.luhn(body + d))


def number(rng):
    return f"{rng.randrange(200, 990)}", f"{rng.randrange(200, 990)}", f"{rng.randrange(1000, 9999)}"


def plant(rng, kind, form):
    """A wider form of personal data."""
    a, b, c = number(rng)
    n = card(rng)
    groups = [n[k : k + 4] for k in (0, 4, 8, 12)]
    octets = [str(rng.randrange(10, 224)), *(str(rng.randrange(256)) for _ in range(3))]
    hexes = [f"{rng.randrange(0x1000, 0x10000):x}" for _ in range(8)]
    words = "zero one two three four five six seven eight nine".split()
    forms = {
        "email": [f"jo{a} [at] site{b} [dot] org", f"jo.{a}(at)mail{b}.com", f"jo{a} @ site.net"],
        "ip": ["[.]".join(octets), " dot ".join(octets), ":".join(["2001", *hexes[1:]]), f"2001:db8::{hexes[0]}:{hexes[1]}"],
        "card": [".".join(groups), "  ".join(groups), "/".join(groups)],
        "phone": [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"0044 20 {b}0 {c}", " ".join(words[int(d)] for d in a + b + c)],
    }
    return forms[kind][form % len(forms[kind])]


def decoy(rng, form):
    """Something of a similar look that is nobody's."""
    a, b, c = number(rng)
    forms = [
        f"order {a[:2]}-{b}-{c}", f"version {a} . 1 . 2 . 900", f"at {a[0]}:{b[:2]}:{c[:2]}", f"std::max{a}",
        f"invoice {a}{b}.{c}.{c}", f"mac {a[:2]}:{b[:2]}:{c[:2]}:aa:bb:cc", f"total {a}={b}-{c}-{c}", f"one two three {a}",
    ]
    return forms[form % len(forms)]


def test_recall_and_precision_per_kind(spark):
    rng = random.Random(5)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    base = {t: pii.base_spans(t) for t in texts}
    rows, truth = [], set()
    for k, text in enumerate(t for t in texts for _ in range(4)):
        kind = pii.KINDS[k % 4]
        where = text.find(" ", rng.randrange(len(text))) + 1
        if k % 3 == 0:
            put = decoy(rng, k)
        else:
            put = plant(rng, kind, rng.randrange(60))
        whole = f"{text[:where]}{put} {text[where:]}"
        if k % 3:
            truth.add((k, f"{kind}:{where}:{where + len(put)}"))
        rows.append((k, whole))
    assert len(base) and len(truth) > 100
    found = set()
    for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        mine = set(filter(None, r.spans.split(",")))
        assert r.n_spans == len(mine)
        found |= {(r.doc_id, s) for s in mine - {f"{k}:{b}:{e}" for k, b, e in pii.base_spans(rows[r.doc_id][1])}}
    for kind in pii.KINDS:
        wanted = {t for t in truth if t[1].startswith(kind)}
        got = {t for t in found if t[1].startswith(kind)}
        assert len(wanted & got) >= 0.9 * len(wanted), (kind, sorted((rows[k][1][int(s.split(":")[1]) :][:40], s) for k, s in wanted - got)[:8])
        # Documents hold local numbers of their own; what counts as wrong is a decoy.
        wrong = {(k, s) for k, s in got if k % 3 == 0}
        assert len(wrong) <= 0.1 * len(got), (kind, sorted((rows[k][1][int(s.split(":")[1]) :][:40], s) for k, s in wrong)[:8])


def test_numbers_swallowed_by_their_neighbours():
    text = "call +1 (853) 555-7168 4913187196670932 or +1 (438) 555-5817 63.51.224.77 now"
    base = pii.base_spans(text)
    assert [s[0] for s in base] == ["ip"]
    more = pii.candidates(text, base)
    assert [(k, text[b:e]) for k, b, e in more] == [
        ("phone", "+1 (853) 555-7168"), ("card", "4913187196670932"), ("phone", "+1 (438) 555-5817"),
    ]
    assert pii.card_groups("555-4111 1111 1111 1111") == [(4, 23)]
    assert pii.card_groups("555-4111 1111 1111 1112") == []
    assert pii.card_groups("12 4111 1111 1111 1111 7") == [(3, 22)]
    assert pii.first_phone("+1 2 3 4") == 0


def test_addresses():
    for good in ("2001:db8::1", "::1", "fe80::1:2", "1:2:3:4:5:6:7:8"):
        assert pii.candidates(f"host {good} up", []) == [("ip", 5, 5 + len(good))]
    for bad in ("12:30:45", "aa:bb:cc:dd:ee:ff", "std::max", "::", "1:2:3:4:5:6:7:8:9"):
        assert [s for s in pii.candidates(f"host {bad} up", []) if s[0] == "ip"] == []
