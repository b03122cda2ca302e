"""Scalar functions against Python's own string functions and hand-made cases."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from policyscan.functions import ids, paths, text
from policyscan.sources.files import choose_encoding, decode_declared, decode_utf8_or_latin1

TEXTS = [
    "",
    " \n\t\x1c ",
    "a  \n b\t\x0b\n\n\n\n\n c  ",
    "x\r\ny\rz",
    "﻿start ﬁne Ａ",
    "severity " + "\x01\x02" * 9,
    "line one\x85\n line two 　",
]


def apply(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in frame.select("i", expression(F.col("t"))).orderBy("i").collect()]


def rstrip_lines(value):
    return "\n".join(line.rstrip() for line in value.split("\n"))


@pytest.mark.parametrize(
    "ours, theirs",
    [
        (text.strip, str.strip),
        (text.is_blank, lambda t: not t.strip()),
        (text.newlines, lambda t: t.replace("\r\n", "\n").replace("\r", "\n")),
        (text.rstrip_lines, rstrip_lines),
        (text.nfkc, lambda t: unicodedata.normalize("NFKC", t)),
        (text.strip_bom, lambda t: t.removeprefix("﻿")),
        (text.line_count, lambda t: len(t.split("\n"))),
        (text.non_ascii_count, lambda t: sum(ord(c) > 127 for c in t)),
        (text.control_count, lambda t: sum(ord(c) < 32 and c not in "\n\r\t" for c in t)),
        (
            text.appears_binary,
            lambda t: bool(t) and sum(c.isprintable() or c.isspace() for c in t) / len(t) < 0.7,
        ),
    ],
)
def test_text_functions(spark, ours, theirs):
    assert apply(spark, TEXTS, ours) == [theirs(t) for t in TEXTS]


def test_collapse_blank_lines(spark):
    assert apply(spark, ["a\n\n\n\n\n\nb\n\n\nc"], text.collapse_blank_lines) == ["a\n\n\nb\n\n\nc"]


@pytest.mark.parametrize(
    "value, parts",
    [
        ("CKV_IBM_58", ("CKV_IBM_58", "CKV", "IBM", "58")),
        ("ckv_k8s_40", ("CKV_K8S_40", "CKV", "K8S", "40")),
        ("CKV2_OCI_7", ("CKV2_OCI_7", "CKV2", "OCI", "7")),
        ("CKV3_TF_181", ("CKV3_TF_181", "CKV3", "TF", "181")),
        (" BC_LIC_3\n", ("BC_LIC_3", "BC", "LIC", "3")),
        ("CKV_AWS_1_2", ("CKV_AWS_1_2", "CKV", "AWS", "1_2")),
        ("CKV_3A_1", ("CKV_3A_1", "CKV", "3A", "1")),
        ("CKV2_AWS_FOO", None),
        ("BC_LIC_X", None),
        ("CKV_AWS_", None),
        ("AWS_1", None),
        ("NOTE", None),
    ],
)
def test_parse_id(spark, value, parts):
    parsed = apply(spark, [value], ids.parse_id)[0]
    assert (tuple(parsed) if parsed else None) == parts


def test_accept_id(spark):
    values = ["CKV2_AWS_FOO", "BC_LIC_X", "SOME_CONST_NAME", "CKV_3A_1", "NOTE", "A_B", "1_A_B", ""]
    accepted = apply(spark, values, lambda _: ids.accept_id("t"))
    assert accepted == [True, True, True, True, False, False, False, False]


def test_globs():
    cases = {
        "*index*": (["index.adoc", "my-index"], ["inde"]),
        "a?c": (["abc"], ["ac", "abbc"]),
        "[!0-9]x": (["ax"], ["1x"]),
        ".*": ([".git"], ["git"]),
        "a[": (["a["], ["a"]),
    }
    for glob, (good, bad) in cases.items():
        regex = re.compile(paths.glob_regex(glob).replace(r"\z", r"\Z"))
        assert all(regex.match(g) for g in good) and not any(regex.match(b) for b in bad)


def test_suffix_and_order(spark):
    names = ["a/b.adoc", "a/.hidden", "a/x.tar.gz", "a/plain", "a/dot."]
    assert apply(spark, names, paths.suffix) == [".adoc", "", ".gz", "", ""]
    unordered = spark.createDataFrame([("a-b/c",), ("a/b",)], "p string")
    assert [r.p for r in unordered.orderBy(paths.path_key(F.col("p"))).collect()] == ["a/b", "a-b/c"]


@pytest.mark.parametrize(
    "data, encoding, expected",
    [
        ("é\r\n".encode(), "utf-8", "é\n"),
        (b"\xe9t", "iso-8859-1", "ét"),
        (b"\xe9t", "utf-8", "�t"),
        ("é".encode(), "ascii", "é"),
        ("é\U0001f600".encode("utf-16"), "utf-16", "é\U0001f600"),
        (b"\xff\xfe\x00\xd8a\x00", "utf-16", None),
        (b"\xef\xbb\xbfa", "utf-8-sig", "a"),
    ],
)
def test_declared_encodings(spark, data, encoding, expected):
    frame = spark.createDataFrame([(bytearray(data), encoding)], "c binary, e string")
    assert frame.select(decode_declared(F.col("c"), F.col("e"))).collect()[0][0] == expected


def test_latin1_fallback_and_choice(spark):
    frame = spark.createDataFrame([(bytearray(b"\xe9t\r\n"),), (bytearray("é".encode()),)], "c binary")
    assert [r[0] for r in frame.select(decode_utf8_or_latin1(F.col("c"))).collect()] == ["ét\n", "é"]
    assert [r[0] for r in frame.select(choose_encoding(F.col("c"), "latin-1")).collect()] == ["latin-1", "utf-8"]
