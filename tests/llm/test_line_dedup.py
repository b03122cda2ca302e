"""Site-relative frequencies against counting in Python, odd rows, a hot site."""

from collections import Counter

from policyscan.llm import line_dedup

SF = "/root/testdata/sf0.01"
BLANK = " \t\n\v\f\r"


def plain(rows, ratio=line_dedup.BOILERPLATE_RATIO, least=line_dedup.MIN_PAGES):
    pages, counts = Counter(s for _, s, _ in rows), Counter()
    for _, s, t in rows:
        counts.update((s, line) for line in {x.strip(BLANK) for x in (t or "").split("\n")} - {""})
    out = []
    for i, s, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if counts[s, x.strip(BLANK)] < least or counts[s, x.strip(BLANK)] <= ratio * pages[s]]
        out.append((i, s, sum(bool(x.strip(BLANK)) for x in lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    got = sorted(map(tuple, line_dedup.report(docs).collect()), key=str)
    assert got == plain(rows)
    assert sum(r[3] for r in got) > 0


def test_odd_rows_and_a_hot_site(spark):
    rows = [(i, "hot", f"Menu\n text {i}\n\n  Menu \nfoot\t") for i in range(300)]
    rows += [(i, None, "Menu\nown") for i in range(4)] + [(1, "small", "Menu"), (2, "small", "Menu")]
    rows += [(3, "x", None), (None, "x", ""), (3, "x", None), (9, "long", "line\n" * 50_000)]
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, source string, text string, lines int, site string")
    got = sorted(map(tuple, line_dedup.report(docs).collect()), key=str)
    assert got == plain(rows)
    cleaned = line_dedup.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert line_dedup.report(docs.limit(0)).collect() == []


def test_no_python_on_the_path(spark):
    plan = line_dedup.report(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
