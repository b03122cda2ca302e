"""Compact documents of one line, read in pieces; UTF-16 recognised by one match."""

import json
import time

from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.sources import files
from policyscan.sources.database_json import compact_mappings, read_compact, read_compact_pieces

HEAD = {"v": "2.0", "t": "2024-01-01T00:00:00", "c": 3, "g": "3.1"}


def entries(frame):
    return sorted((r.checkov_id, r.severity) for r in frame.collect())


def test_one_long_line_is_read_by_several_tasks(spark, tmp_path):
    mapping = {f"CKV_AWS_{k}": fixed.SEVERITIES[k % len(fixed.SEVERITIES)] for k in range(60_000)}
    (tmp_path / "db.json").write_text(json.dumps({**HEAD, "s": mapping}, separators=(",", ":")))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(200_000))
    try:
        found = read_compact_pieces(spark, str(tmp_path))
        assert entries(found) == sorted(mapping.items())
        pieces = spark.read.text(str(tmp_path), lineSep='",')
        assert pieces.rdd.getNumPartitions() > 4
        assert pieces.agg(F.max(F.length("value"))).first()[0] < 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_pieces_equal_whole_documents(spark, tmp_path):
    plain = {"CKV_A_1": "HIGH", "with, comma": "LOW", "é{}:": "HIGH", 'a "quoted" one': "LOW", "back\\slash\\": "HIGH", "": "LOW", "bad": "none"}
    cut = {'tail", of': "HIGH", 'x\\",y': "LOW", "CKV_A_2": "LOW"}
    texts = {
        "a.json": json.dumps({**HEAD, "s": plain}, separators=(",", ":")),
        "b.json": json.dumps({**HEAD, "s": plain}, indent=2),
        "c.json": json.dumps({**HEAD, "s": cut}),
        "d.json": json.dumps({**HEAD, "s": {}}),
        "e.json": "",
        "f.json": json.dumps({"s": plain, **HEAD}, ensure_ascii=False),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    expected = entries(compact_mappings(read_compact(spark, str(tmp_path))))
    assert ("CKV_A_2", "LOW") in expected and ('tail", of', "HIGH") in expected and len(expected) == 3 * 6 + 3
    assert entries(read_compact_pieces(spark, str(tmp_path))) == expected


def test_utf16_units(spark):
    def utf16(units, order):
        return b"".join(u.to_bytes(2, order) for u in units)

    cases = [[], [0x41], [0xD83D, 0xDE00], [0xD83D], [0xDE00], [0xD83D, 0x41, 0xDE00], [0xD83D, 0xD83D, 0xDE00, 0xDE00], [0x0A, 0xDBFF, 0xDFFF, 0xD7FF, 0xE000]]
    for big, order in ((True, "big"), (False, "little")):
        codec = f"utf-16-{order[0]}e"
        rows = [(utf16(units, order),) for units in cases] + [(b"a",), (b"abc",)]
        got = spark.createDataFrame(rows, "content binary").select("content", files._is_utf16(F.col("content"), big).alias("ok"))
        for r in got.collect():
            try:
                bytes(r.content).decode(codec)
                valid = True
            except UnicodeDecodeError:
                valid = False
            assert r.ok == valid, (codec, bytes(r.content))


def test_a_long_utf16_file(spark):
    content = ("policy \U0001f600 " * 500_000).encode("utf-16-le")
    began = time.time()
    frame = spark.createDataFrame([(content,), (content + b"\x00\xd8",)], "content binary")
    assert [r[0] for r in frame.select(files._is_utf16(F.col("content"), False)).collect()] == [True, False]
    assert time.time() - began < 30
