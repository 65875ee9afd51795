"""P1, P2, P4, P6, P7 and S6 on literal edge rows (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from streamledger.functions.text import (
    comma_fields, java_length, parse_pair, space_tokens, text_lines, whitespace_tokens)

WS_CASES = [
    ("", [""]),
    (" ", []),
    (" a b", ["", "a", "b"]),
    ("a  b ", ["a", "b"]),
    ("\ta\n", ["", "a"]),
    ("a\x0bb", ["a", "b"]),
    ("a b", ["a b"]),
    ("a\r\n\f b", ["a", "b"]),
]

COMMA_CASES = [
    ("abc,3", ["abc", "3"]),
    ("abc,", ["abc"]),
    (",3", ["", "3"]),
    ("a,b,", ["a", "b"]),
    (",", []),
    ("a,b,c", ["a", "b", "c"]),
    ("", [""]),
    ("a,,b,,", ["a", "", "b"]),
]


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_whitespace_split_matches_java(spark):
    got = _eval(spark, [c for c, _ in WS_CASES], whitespace_tokens)
    assert got == [e for _, e in WS_CASES]


def test_comma_split_matches_java(spark):
    got = _eval(spark, [c for c, _ in COMMA_CASES], comma_fields)
    assert got == [e for _, e in COMMA_CASES]


def test_space_split_keeps_inner_empty_tokens(spark):
    got = _eval(spark, ["a  b", "a b  ", "  ", " a"], space_tokens)
    assert got == [["a", "", "b"], ["a", "b"], [], ["", "a"]]


def test_null_value_gives_null_tokens(spark):
    assert _eval(spark, [None], whitespace_tokens) == [None]


def test_java_length_counts_utf16_units(spark):
    got = _eval(spark, ["abc", "", "a\U0001F600", "é"], java_length)
    assert got == [3, 0, 3, 1]


@pytest.mark.parametrize("strict", [True, False])
def test_parse_pair_edge_rows(spark, strict):
    rows = ["abc,3", "abc,", ",3", "a,b,", ",", "a,b,c", "", "abc,x", None]
    got = _eval(spark, rows, lambda c: parse_pair(c, strict))
    ok = [r["ok"] for r in got]
    if strict:
        assert ok == [True, False, True, True, False, False, False, True, False]
    else:
        assert ok == [True, False, True, True, False, True, False, True, False]
    assert (got[0]["name"], got[0]["id"]) == ("abc", "3")
    assert (got[2]["name"], got[2]["id"]) == ("", "3")
    assert got[1]["name"] is None and got[1]["id"] is None
    if not strict:
        assert (got[5]["name"], got[5]["id"]) == ("a", "b")


def test_text_lines_like_a_text_file(spark):
    got = _eval(spark, ["a\nb", "a\n\nb\n", "", "x\r\ny\rz"], text_lines)
    assert got == [["a", "b"], ["a", "", "b", ""], [""], ["x", "y", "z"]]


def test_split_stays_jvm_side(spark):
    df = spark.createDataFrame([("a b",)], "v string").select(
        F.explode(whitespace_tokens("v")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan
