"""Property test: java_split equals a model of Java's String.split."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from streamledger.functions.text import comma_fields, space_tokens, whitespace_tokens


def java_split_model(s: str, regex: str) -> list[str]:
    """Java: split everywhere, then drop trailing empty strings; "" -> [""]."""
    if s == "":
        return [""]
    parts = re.split(regex, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


TEXT = st.lists(st.text(alphabet=" \t\n\x0b\f\r,ab ", max_size=12), min_size=1,
                max_size=40)


@settings(max_examples=15, deadline=None)
@given(TEXT)
def test_split_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.orderBy("i").select(whitespace_tokens("v"), space_tokens("v"),
                                  comma_fields("v")).collect()
    for v, (ws, sp, cm) in zip(values, rows):
        assert ws == java_split_model(v, r"[ \t\n\x0b\f\r]+"), repr(v)
        assert sp == java_split_model(v, " "), repr(v)
        assert cm == java_split_model(v, ","), repr(v)
