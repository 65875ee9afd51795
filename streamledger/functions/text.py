"""Tokenisers and message parsers as native Spark expressions.

Java's ``String.split(regex)`` drops trailing empty strings, Spark's ``split``
keeps them.  ``java_split`` reproduces the Java result with three JVM-side
expressions (rtrim or regexp_replace, split, when), so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's ``\s`` class without the Unicode flag is exactly
# space, tab, newline, vertical tab, form feed and carriage return.
JAVA_WHITESPACE = " \t\n\x0b\f\r"
WHITESPACE_RUN = r"[ \t\n\x0B\f\r]+"   # same set as Java's \s+
SPACE = " "                            # single-space separator (P2)
COMMA = ","                            # pair separator (P6, P7)
LINE_BREAK = r"\r\n|\r|\n"             # text-file line terminators (S6)



def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, pattern: str, trailing_chars: str | None = None) -> Column:
    """``c.split(pattern)`` with Java's rules, as an ``array<string>``.

    ``""`` gives ``[""]``; a non-empty string made only of separators gives
    ``[]``; trailing empty fields are dropped; leading and inner ones kept.

    ``trailing_chars``: when every separator match is a run of these
    characters (true for ``\\s+``, ``" "`` and ``","``), trailing separators
    are stripped with ``rtrim`` instead of a regex.  Otherwise a regex anchored
    at the very end of the input (``\\z``) strips them.
    """
    v = _col(c)
    if trailing_chars is not None:
        stripped = F.rtrim(v, F.lit(trailing_chars))
    else:
        stripped = F.regexp_replace(v, f"(?:{pattern})+\\z", "")
    return F.when((stripped == "") & (v != ""), F.array().cast("array<string>")).otherwise(
        F.split(stripped, pattern))


def whitespace_tokens(c) -> Column:
    """``split("\\\\s+")`` as Java does it."""
    return java_split(c, WHITESPACE_RUN, JAVA_WHITESPACE)


def space_tokens(c) -> Column:
    """``Pattern.compile(" ").split`` -- inner empty tokens are kept."""
    return java_split(c, SPACE, SPACE)


def comma_fields(c) -> Column:
    return java_split(c, COMMA, COMMA)


def text_lines(c) -> Column:
    """S6 on a text column: the lines a text file holding it would yield.

    Each value is taken as one file record followed by a line terminator, so
    inner and trailing empty lines are kept (Spark's plain ``split``).
    """
    return F.split(_col(c), LINE_BREAK)


def java_length(c) -> Column:
    """``String.length()`` counts UTF-16 code units, not code points.

    Pure-ASCII strings (bytes == characters) skip the UTF-16 encoding.
    """
    v = _col(c)
    n = F.length(v).cast("bigint")
    return F.when(F.octet_length(v) == n, n).otherwise(
        (F.octet_length(F.encode(v, "UTF-16BE")) / 2).cast("bigint"))


def parse_pair(c, strict: bool = True) -> Column:
    """P6 (strict) / P7 (lenient) parse of ``name,id``.

    Returns ``struct<ok boolean, name string, id string>``.  Strict accepts
    exactly two fields, lenient two or more (extra fields ignored).  Rows that
    fail keep ``ok = false`` and null fields, so callers choose between
    failing the batch and quarantining the row.
    """
    fields = comma_fields(c)
    n = F.size(fields)
    ok = (n == 2) if strict else (n >= 2)
    ok = F.coalesce(ok, F.lit(False))
    return F.struct(
        ok.alias("ok"),
        F.when(ok, F.get(fields, 0)).alias("name"),
        F.when(ok, F.get(fields, 1)).alias("id"),
    )


# Fixed value: what counts as a whole number in an id field.
WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def typed_pair(c) -> Column:
    """P7 with its id as a number: ``struct<ok, name, id bigint>``.

    ``ok`` needs two or more fields and an id of digits that fits in 64 bits;
    rows that fail have null fields.
    """
    p = parse_pair(c, strict=False)
    number = F.when(p["id"].rlike(WHOLE_NUMBER), p["id"].try_cast("bigint"))
    ok = p["ok"] & F.coalesce(number.isNotNull(), F.lit(False))
    return F.struct(ok.alias("ok"), F.when(ok, p["name"]).alias("name"), F.when(ok, number).alias("id"))


def fail_unless(ok: Column, message: str) -> Column:
    """Raise inside the task when ``ok`` is false (P6 ``fail`` mode)."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(message)))
