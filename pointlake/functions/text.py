"""Escapes and number printing of the line format, as column expressions.

Everything here uses plain string replacement, which Spark compiles into the
generated code of the stage; no regular expression runs on user text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BACKSLASH = "\\"

# Fixed values of the line format: the characters each kind of name escapes.
TAG_ESCAPED = (",", "=", " ")
MEASUREMENT_ESCAPED = (",", " ")
QUOTED_ESCAPED = (BACKSLASH, '"')


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _double_first_escaped_apostrophe(text: Column) -> Column:
    """The format doubles the backslash of the first ``\\'`` in a value."""
    at = F.instr(text, BACKSLASH + "'")
    return F.when(at > 0, F.overlay(text, F.lit(BACKSLASH * 2 + "'"), at, F.lit(2))).otherwise(text)


def _escape(text: Column, characters: tuple[str, ...]) -> Column:
    out = _double_first_escaped_apostrophe(text)
    for character in characters:
        out = _replace(out, character, BACKSLASH + character)
    return out


def escape_tag(text: Column) -> Column:
    """For tag names, tag values and field names."""
    return _escape(text, TAG_ESCAPED)


def escape_measurement(text: Column) -> Column:
    return _escape(text, MEASUREMENT_ESCAPED)


def quote(text: Column) -> Column:
    """A string field value: wrapped in double quotes, quotes and backslashes escaped."""
    return F.concat(F.lit('"'), _escape(text, QUOTED_ESCAPED), F.lit('"'))


def unescape_name(text: Column) -> Column:
    out = text
    for character in TAG_ESCAPED:
        out = _replace(out, BACKSLASH + character, character)
    return out


def unquote(text: Column) -> Column:
    """Inverse of the escapes of ``quote`` for the text between the quotes."""
    return _replace(_replace(text, BACKSLASH + '"', '"'), BACKSLASH * 2, BACKSLASH)


def _strip_zeros(decimal_text: Column) -> Column:
    return F.regexp_replace(decimal_text, r"\.?0+$", "")


def _exponent_text(shortest: Column) -> Column:
    """``1.0E21`` as ``1e+21``."""
    short = _replace(_replace(shortest, ".0E", "E"), "E", "e+")
    return _replace(short, "e+-", "e-")


def number_text(value: Column) -> Column:
    """A double in its shortest form: ``43`` and not ``43.0``; exponents only
    below 1e-6 and from 1e21; NULL for what is no finite number."""
    size = F.abs(value)
    shortest = value.cast("string")
    return (
        F.when(
            (size < F.lit(float(2**53))) & (value == F.rint(value)),
            value.cast("bigint").cast("string"),
        )
        .when((size >= 1e-3) & (size < 1e7), shortest)
        .when(
            (size >= 1e-6) & (size < 1.0),
            _strip_zeros(shortest.cast("decimal(38,30)").cast("string")),
        )
        .when(
            (size >= 1e7) & (size < 1e21),
            _strip_zeros(shortest.cast("decimal(38,17)").cast("string")),
        )
        .when(size < float("inf"), _exponent_text(shortest))
    )


def scalar_text(value: Column, kind: T.DataType) -> Column:
    """Any supported scalar as plain text."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return number_text(value.cast("double"))
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return _strip_zeros(value.cast("string"))
    return value.cast("string")


# Fixed pattern: the decimal numbers the line format knows.
NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def is_numeric_text(text: Column) -> Column:
    return text.rlike(NUMERIC)
