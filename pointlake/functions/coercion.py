"""Field coercion: a typed or untyped value to its line-format text, or a reason.

Two shapes of the same rules:

* columns of a wide table: one expression per declared field, chosen at plan time
  from the declared type and the column's own Spark type;
* map-form values (``FIELD_VALUE`` structs): the same per declared field of each
  schema, on the members of the value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.text import is_numeric_text, number_text, quote, scalar_text
from pointlake.model import FieldType

# Doubles from here on do not fit a BIGINT; its lowest value does.
INTEGER_LIMIT = 2.0**63


@dataclass(frozen=True)
class Coerced:
    """``text`` is NULL for an absent value; ``reason`` is NULL for a good one."""

    text: Column
    reason: Column


def no_text() -> Column:
    return F.lit(None).cast("string")


def numeric_reason(ref: Column, shown: Column) -> Column:
    return F.concat(
        F.lit("Expected numeric value for "), ref, F.lit(", but got '"), shown, F.lit("'")
    )


def boolean_reason(ref: Column, kind: Column) -> Column:
    return F.concat(F.lit("Expected boolean value for "), ref, F.lit(", but got a "), kind)


def extraneous_reason(what: str, ref: Column, names: Column) -> Column:
    return F.concat(
        F.lit(f"Extraneous {what} in "), ref, F.lit(": `"), F.array_join(names, "`, `"), F.lit("`")
    )


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def _floored(value: Column) -> Column:
    return F.when((value < INTEGER_LIMIT) & (value >= -INTEGER_LIMIT), F.floor(value))


def integer_of_text(text: Column) -> Column:
    """Exact for digit strings; other numbers are floored."""
    trimmed = F.trim(text)
    return F.when(
        is_numeric_text(text),
        F.coalesce(trimmed.try_cast("bigint"), _floored(trimmed.try_cast("double"))),
    )


def integer_of_double(value: Column) -> Column:
    return F.when(_finite(value), _floored(value))


def _integer_text(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("i"))


def _is_fractional(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def typed_value(column: Column, kind: T.DataType, declared: FieldType) -> Column:
    """The column as the declared Spark type; NULL where it does not fit."""
    if declared is FieldType.STRING:
        return scalar_text(column, kind)
    if declared is FieldType.BOOLEAN:
        return column if isinstance(kind, T.BooleanType) else F.lit(None).cast("boolean")
    if isinstance(kind, T.BooleanType):
        return F.lit(None).cast(declared.spark_type)
    if declared is FieldType.INTEGER:
        if isinstance(kind, T.StringType):
            return integer_of_text(column)
        if isinstance(kind, T.IntegralType):
            return column.cast("bigint")
        return integer_of_double(column.cast("double"))
    if isinstance(kind, T.StringType):
        return F.when(is_numeric_text(column), F.trim(column).try_cast("double"))
    number = column.cast("double")
    return F.when(_finite(number), number) if _is_fractional(kind) else number


def coerce_column(
    column: Column, kind: T.DataType, declared: FieldType, ref: str
) -> Coerced:
    """One declared field of a wide table."""
    if declared is FieldType.STRING:
        return Coerced(quote(scalar_text(column, kind)), no_text())
    if declared is FieldType.BOOLEAN:
        if isinstance(kind, T.BooleanType):
            return Coerced(F.when(column, F.lit("T")).when(~column, F.lit("F")), no_text())
        shown = F.lit("string" if isinstance(kind, T.StringType) else "number")
        return Coerced(no_text(), F.when(column.isNotNull(), boolean_reason(F.lit(ref), shown)))
    shown = numeric_reason(F.lit(ref), column.cast("string"))
    if isinstance(kind, T.BooleanType):
        return Coerced(no_text(), F.when(column.isNotNull(), shown))
    if declared is FieldType.INTEGER:
        typed = typed_value(column, kind, declared)
        bad = None if isinstance(kind, T.IntegralType) else column.isNotNull() & typed.isNull()
        text = _integer_text(typed)
    elif isinstance(kind, T.StringType):
        bad = ~is_numeric_text(column)
        text = F.when(~bad, column)
    else:
        bad = ~_finite(column) if _is_fractional(kind) else None
        text = scalar_text(column, kind)
    return Coerced(text, no_text() if bad is None else F.when(bad, shown))


# -- map form ------------------------------------------------------------------


def plain_text(value: Column) -> Column:
    """Any member of a field value, printed; NULL for an unsupported kind."""
    return F.coalesce(
        value["s"], number_text(value["f"]), value["i"].cast("string"), value["b"].cast("string")
    )


def untyped_text(value: Column) -> Column:
    """The guess for undeclared fields: strings quoted, everything else printed."""
    return F.coalesce(
        quote(value["s"]),
        number_text(value["f"]),
        value["i"].cast("string"),
        value["b"].cast("string"),
    )


def coerce_member(value: Column, declared: FieldType, where: Column) -> Coerced:
    """One declared field of the map form; ``where`` is how reasons name it."""
    present = value.isNotNull()
    if declared is FieldType.STRING:
        known = F.coalesce(
            value["s"].isNotNull() | value["f"].isNotNull() | value["i"].isNotNull(),
            F.lit(False),
        ) | value["b"].isNotNull()
        return Coerced(
            quote(plain_text(value)),
            F.when(present & ~known, F.concat(F.lit("Unsupported value for "), where)),
        )
    if declared is FieldType.BOOLEAN:
        kind = F.when(value["s"].isNotNull(), F.lit("string")).otherwise(F.lit("number"))
        return Coerced(
            F.when(value["b"], F.lit("T")).when(~value["b"], F.lit("F")),
            F.when(present & value["b"].isNull(), boolean_reason(where, kind)),
        )
    shown = F.coalesce(
        value["s"],
        value["f"].cast("string"),
        value["b"].cast("string"),
        F.lit("an unsupported value"),
    )
    if declared is FieldType.INTEGER:
        number = member_value(value, declared)
        text, fits = _integer_text(number), number.isNotNull()
    else:
        text = F.coalesce(
            number_text(value["f"]),
            value["i"].cast("string"),
            F.when(is_numeric_text(value["s"]), value["s"]),
        )
        fits = F.coalesce(
            _finite(value["f"]), is_numeric_text(value["s"]), value["i"].isNotNull()
        )
    return Coerced(text, F.when(present & ~fits, numeric_reason(where, shown)))


def member_value(value: Column, declared: FieldType) -> Column:
    """A map-form value as the declared Spark type; NULL where it does not fit."""
    if declared is FieldType.STRING:
        return plain_text(value)
    if declared is FieldType.BOOLEAN:
        return value["b"]
    if declared is FieldType.INTEGER:
        return F.coalesce(value["i"], integer_of_double(value["f"]), integer_of_text(value["s"]))
    return F.coalesce(
        value["f"],
        value["i"].cast("double"),
        F.when(is_numeric_text(value["s"]), F.trim(value["s"]).try_cast("double")),
    )
