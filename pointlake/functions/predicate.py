"""Filter expressions built step by step, compiled to a Spark ``Column``.

Values from untrusted callers become literals of the plan; no query text is
ever assembled from them.

    e = Expression().tag("host").equals.value("a").and_.field("cpu").gt.value(0.5)
    df.filter(e.to_column(df))

``* /`` bind tighter than ``+ -``, those tighter than comparisons, then AND, then OR.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.columns import ref
from pointlake.model import FIELD_VALUE, NanoTime


@dataclass(frozen=True)
class _Operand:
    """One side of an operator; ``kind`` says how a comparison must treat it."""

    column: Column | None
    kind: str = "column"  # column, time, regex, text, number, flag, map_field
    payload: object = None
    spark_type: T.DataType | None = None


@dataclass(frozen=True)
class _Reference:
    name: str
    is_tag: bool


@dataclass(frozen=True)
class _Group:
    inner: Expression


_ARITHMETIC: dict[str, Callable[[Column, Column], Column]] = {
    "*": operator.mul,
    "/": F.try_divide,
    "+": operator.add,
    "-": operator.sub,
}
_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "!=": operator.ne,
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}
_LOGIC: dict[str, Callable[[Column, Column], Column]] = {
    "AND": operator.and_,
    "OR": operator.or_,
}
_LEVELS = [("*", "/"), ("+", "-"), (*_COMPARE, "=~", "!~"), ("AND",), ("OR",)]


def _operator(symbol: str) -> property:
    def chain(self: Expression) -> Expression:
        self._items.append(symbol)
        return self

    return property(chain, doc=f"Chains the operator {symbol}.")


class Expression:
    """A chain of operands and operators."""

    def __init__(self) -> None:
        self._items: list[object] = []

    def tag(self, name: str) -> Expression:
        self._items.append(_Reference(name, True))
        return self

    def field(self, name: str) -> Expression:
        self._items.append(_Reference(name, False))
        return self

    def exp(self, build: Callable[[Expression], Expression]) -> Expression:
        """A parenthesised part."""
        self._items.append(_Group(build(Expression())))
        return self

    def value(self, value: object) -> Expression:
        self._items.append(_value_operand(value))
        return self

    and_ = _operator("AND")
    or_ = _operator("OR")
    plus = _operator("+")
    minus = _operator("-")
    times = _operator("*")
    div = _operator("/")
    equals = _operator("=")
    not_equal = _operator("!=")
    gt = _operator(">")
    gte = _operator(">=")
    lt = _operator("<")
    lte = _operator("<=")
    matches = _operator("=~")
    doesnt_match = _operator("!~")

    def to_column(self, df: DataFrame | None = None) -> Column:
        """Compiles the chain. ``df`` gives the types of the referenced columns, which
        times need: an integer column holds nanoseconds, a timestamp column an instant."""
        return self._compile(df).column

    def _compile(self, df: DataFrame | None) -> _Operand:
        items = [item if isinstance(item, str) else _resolve(item, df) for item in self._items]
        for level in _LEVELS:
            items = _fold(items, level)
        if len(items) != 1 or isinstance(items[0], str):
            raise ValueError("Operands and operators of the expression do not alternate")
        return items[0]


def _fold(items: list, symbols: tuple[str, ...]) -> list:
    """Combines neighbours of the given operators, left to right."""
    out: list = []
    for item in items:
        joins = len(out) >= 2 and out[-1] in symbols if not isinstance(item, str) else False
        if joins:
            symbol, left = out.pop(), out.pop()
            item = _combine(symbol, left, item)
        out.append(item)
    return out


def _value_operand(value: object) -> _Operand:
    if value is None:
        raise ValueError("Cannot use None as a value of a filter expression")
    if isinstance(value, bool):
        return _Operand(F.lit(value), "flag", value)
    if isinstance(value, NanoTime):
        return _Operand(F.lit(int(value)).cast("bigint"), "time", int(value))
    if isinstance(value, datetime):
        return _value_operand(NanoTime.from_datetime(value))
    if isinstance(value, (int, float, Decimal)):
        return _Operand(F.lit(value), "number", value)
    if isinstance(value, re.Pattern):
        return _Operand(None, "regex", _unflagged(value))
    text = str(value)
    return _Operand(F.lit(text), "text", text)


def _unflagged(pattern: re.Pattern) -> str:
    if pattern.flags & ~re.UNICODE or re.match(r"\(\?[a-zA-Z]+[):]", pattern.pattern):
        raise ValueError("Regular expressions with flags are not supported in filters")
    return pattern.pattern


def _resolve(item: object, df: DataFrame | None) -> _Operand:
    if isinstance(item, _Group):
        return item.inner._compile(df)
    if isinstance(item, _Reference):
        types = {f.name: f.dataType for f in df.schema.fields} if df is not None else {}
        if item.name not in types and isinstance(types.get("tags"), T.MapType):
            if item.is_tag:
                return _Operand(F.col("tags")[F.lit(item.name)])
            if types["fields"].valueType == FIELD_VALUE:
                return _Operand(F.col("fields")[F.lit(item.name)], "map_field")
        return _Operand(ref(item.name), spark_type=types.get(item.name))
    return item


def _combine(symbol: str, left: _Operand, right: _Operand) -> _Operand:
    if symbol in _LOGIC:
        return _Operand(_LOGIC[symbol](left.column, right.column))
    if symbol in ("=~", "!~"):
        found = _member(left, "text").column.rlike(_pattern_of(right))
        return _Operand(found if symbol == "=~" else ~found)
    if symbol in _ARITHMETIC:
        a, b = _member(left, "number").column, _member(right, "number").column
        return _Operand(_ARITHMETIC[symbol](a, b), "number")
    for one, other in ((left, right), (right, left)):
        if one.kind == "time" and isinstance(
            other.spark_type, (T.TimestampType, T.TimestampNTZType)
        ):
            flip = {">": "<", ">=": "<=", "<": ">", "<=": ">="} if one is left else {}
            return _Operand(_compare_instant(flip.get(symbol, symbol), other, one.payload))
    if "map_field" in (left.kind, right.kind):
        return _Operand(_compare_members(symbol, left, right))
    if symbol in ("=", "!="):
        left, right = _as_number(left, right), _as_number(right, left)
    a, b = _as_text(left, right), _as_text(right, left)
    return _Operand(_COMPARE[symbol](a, b))


def _as_number(side: _Operand, other: _Operand) -> _Operand:
    """A text that is how a whole number prints, next to a column of whole numbers: the
    number, so that the filter reaches the file scan."""
    whole = isinstance(other.spark_type, T.IntegralType) and side.kind == "text"
    if whole and re.fullmatch(r"0|-?[1-9][0-9]{0,17}", str(side.payload)):
        return _Operand(F.lit(int(side.payload)).cast("bigint"), "number", int(side.payload))
    return side


def _as_text(side: _Operand, other: _Operand) -> Column:
    """A number column next to a text: the text form, which no text can make fail."""
    if other.kind == "text" and isinstance(side.spark_type, T.NumericType):
        return side.column.cast("string")
    return side.column


def _compare_members(symbol: str, left: _Operand, right: _Operand) -> Column:
    """Map-form values by the member both sides have: integers as integers, other numbers
    as doubles, strings and booleans as they are."""
    compare = _COMPARE[symbol]

    def member(side: _Operand, name: str) -> Column | None:
        if side.kind == "map_field":
            return side.column[name]
        kinds = {"text": "s", "flag": "b", "number": "f"}
        if name == "i":
            whole = side.kind == "number" and isinstance(side.payload, int)
            whole = whole or side.kind == "time" or isinstance(side.spark_type, T.IntegralType)
            return side.column.cast("bigint") if whole else None
        return side.column if kinds.get(side.kind, name) == name else None

    def number(side: _Operand) -> Column | None:
        if side.kind == "map_field":
            return F.coalesce(side.column["f"], side.column["i"].cast("double"))
        return side.column.cast("double") if side.kind in ("number", "time") or isinstance(
            side.spark_type, T.NumericType
        ) else None

    found = []
    for name in ("i", "s", "b"):
        a, b = member(left, name), member(right, name)
        if a is not None and b is not None:
            found.append(F.when(a.isNotNull() & b.isNotNull(), compare(a, b)))
    a, b = number(left), number(right)
    if a is not None and b is not None:
        found.append(compare(a, b))
    return F.coalesce(*found)


def _member(side: _Operand, other_kind: str) -> _Operand:
    """Picks the typed member of a map-form field by what it is combined with."""
    if side.kind != "map_field":
        return side
    value = side.column
    if other_kind == "text":
        return _Operand(value["s"])
    if other_kind == "flag":
        return _Operand(value["b"])
    return _Operand(F.coalesce(value["f"], value["i"].cast("double")))


def _pattern_of(side: _Operand) -> str:
    if side.kind not in ("regex", "text"):
        raise ValueError("The right side of a match must be a regular expression")
    text = str(side.payload)
    if side.kind == "text" and len(text) > 1 and text[0] == text[-1] == "/":
        return text[1:-1]
    return text


def _compare_instant(symbol: str, side: _Operand, ns: int) -> Column:
    """Compares a microsecond timestamp column with a nanosecond instant, as a
    literal of the column's own type so that the filter reaches the file scan."""
    floor_us, rest = divmod(ns, 1_000)
    if rest and symbol in ("=", "!="):
        return side.column.isNotNull() & F.lit(symbol == "!=")
    micros = floor_us + 1 if rest and symbol in (">=", "<") else floor_us
    instant = F.timestamp_micros(F.lit(micros).cast("bigint"))
    if isinstance(side.spark_type, T.TimestampNTZType):
        instant = F.timestamp_add(
            "MICROSECOND", F.lit(micros).cast("bigint"), F.lit("1970-01-01").cast("timestamp_ntz")
        )
    return _COMPARE[symbol](side.column, instant)


Where = Column | str | Expression | Callable[[Expression], Expression]


def parse_where(where: Where, df: DataFrame | None = None) -> Column:
    """A builder function, a finished expression, a ``Column``, or Spark SQL text
    (text only from trusted callers)."""
    if isinstance(where, Column):
        return where
    if isinstance(where, str):
        return F.expr(where)
    if isinstance(where, Expression):
        return where.to_column(df)
    return where(Expression()).to_column(df)


def time_bounds(where: Where, time: str = "time_ns") -> tuple[int | None, int | None]:
    """Lowest time and first time beyond that a builder condition leaves: from its
    comparisons of ``time`` with whole numbers or instants that are joined by AND only.
    Spark SQL text and columns say nothing."""
    if callable(where) and not isinstance(where, (Column, Expression)):
        where = where(Expression())
    if not isinstance(where, Expression) or "OR" in where._items:
        return None, None
    parts: list[list] = [[]]
    for item in where._items:
        if item == "AND":
            parts.append([])
        else:
            parts[-1].append(item)
    low = high = None
    flipped = {">": "<", ">=": "<=", "<": ">", "<=": ">=", "=": "="}
    for part in parts:
        if len(part) != 3 or part[1] not in flipped:
            continue
        left, symbol, right = part
        if isinstance(right, _Reference):
            left, symbol, right = right, flipped[symbol], left
        known = isinstance(left, _Reference) and left.name == time and isinstance(right, _Operand)
        if not known or right.kind not in ("time", "number") or not isinstance(right.payload, int):
            continue
        value = right.payload
        if symbol in (">", ">=", "="):
            first = value + (symbol == ">")
            low = first if low is None else max(low, first)
        if symbol in ("<", "<=", "="):
            beyond = value + (symbol != "<")
            high = beyond if high is None else min(high, beyond)
    return low, high
