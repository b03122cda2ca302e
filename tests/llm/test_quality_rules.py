"""Line rules by hand, base measures against plain Python, odd rows."""

import re
from collections import Counter

from policyscan.llm import quality_rules

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_measures(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality_rules.judge(docs).collect():
        assert tuple(r[c] for c in COLUMNS) == base(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    rows = judged.filter("NOT base_failed").collect()
    good = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_line_rules(spark):
    good = "This is a line of plain words, nothing else."
    bad = [
        "Home", "  Skip to content  ", "Home | About | Contact | Login", "a » b » c", "a# b$ c% d&", "BUY!! NOW!! OR!! NEVER!!",
        "All rights reserved.", "We use cookies to make this better.", "Please ENABLE JavaScript",
    ]
    docs = spark.createDataFrame([(i, f"{good}\n{b}\n\n{good}") for i, b in enumerate(bad)], "doc_id long, text string")
    for r in quality_rules.measure(docs).collect():
        assert (r.clean_text, r.n_lines, r.n_lines_failed) == (f"{good}\n\n{good}", 3, 1)


def test_documents_that_lose_too_much_go(spark):
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    menu = "\n".join(f"Item{i} | Thing{i} | More{i}" for i in range(40))
    rows = [(1, prose, "a"), (2, prose + "\n" + menu, "a"), (3, prose + "\nHome\nLogin", "a"), (4, None, "a"), (5, "", "a"), (3, prose, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = quality_rules.clean(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, prose), (3, prose), (3, prose)]
    assert quality_rules.judge(docs.limit(0)).collect() == []
    long = spark.createDataFrame([(1, "a b c d e f " * 60_000)], "doc_id long, text string")
    (row,) = quality_rules.judge(long).collect()
    assert (row.n_words, row.n_repeat_words, row.kept) == (360_000, 360_000, False)
