"""Small helpers for referring to columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ref(name: str) -> Column:
    """Column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    for field in df.schema.fields:
        if field.name == name:
            return field.dataType
    raise ValueError(f"No column {name!r} among {df.columns}")


def any_present(names: Iterable[str]) -> Column:
    """Whether any of the columns holds a value."""
    out = F.lit(False)
    for name in names:
        out = out | ref(name).isNotNull()
    return out


def computed_once(
    df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None
) -> DataFrame:
    """Adds costly columns so that they are evaluated once per row.

    A filter on a computed column is otherwise moved below its projection, where the
    whole expression is evaluated a second time. Columns that come out of a generator
    stay where they are. The generator only passes columns on: the expressions
    themselves stay in a projection, which is compiled even around lambda functions.
    """
    kept = [ref(c) for c in (df.columns if keep is None else keep)]
    staged = df.select(*kept, *[c.alias("_" + n) for n, c in columns.items()])
    row = F.struct(*[ref("_" + n).alias(n) for n in columns])
    return staged.select(*kept, F.inline(F.array(row)))
