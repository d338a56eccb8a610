"""Ordinary tables as points, and changes between the two point forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.coercion import member_value, typed_value
from pointlake.functions.columns import ref, type_of
from pointlake.functions.text import scalar_text
from pointlake.functions.timecol import time_ns_of
from pointlake.model import FIELD_VALUE, FieldType, MeasurementSchema

Names = Sequence[str] | Mapping[str, str | Column]


def _named(names: Names) -> dict[str, Column]:
    if isinstance(names, Mapping):
        return {k: v if isinstance(v, Column) else ref(v) for k, v in names.items()}
    return {n: ref(n) for n in names}


def guess_field_type(kind: T.DataType) -> FieldType:
    """Field type of an undeclared column."""
    if isinstance(kind, T.BooleanType):
        return FieldType.BOOLEAN
    if isinstance(kind, T.IntegralType):
        return FieldType.INTEGER
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return FieldType.FLOAT
    return FieldType.STRING


def points_from_table(
    df: DataFrame,
    measurement: str,
    tags: Names,
    fields: Names,
    time: str,
    time_unit: str = "n",
    schema: MeasurementSchema | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A table in the wide point form: ``measurement, <tags>, <fields>, time_ns``.

    With a schema, fields become their declared types; a value that does not fit
    becomes NULL (use the checks in ``operators.validate`` to keep such rows apart).
    """
    tag_columns, field_columns = _named(tags), _named(fields)
    shaped = df.select(
        *[ref(k) for k in keep],
        *[c.alias(n) for n, c in tag_columns.items()],
        *[c.alias(n) for n, c in field_columns.items()],
        time_ns_of(df, time, time_unit).alias("time_ns"),
    )
    out = [F.lit(measurement).alias("measurement")]
    for name in tag_columns:
        out.append(scalar_text(ref(name), type_of(shaped, name)).alias(name))
    for name in field_columns:
        kind = type_of(shaped, name)
        declared = schema.fields[name] if schema else guess_field_type(kind)
        out.append(typed_value(ref(name), kind, declared).alias(name))
    return shaped.select(*[ref(k) for k in keep], *out, "time_ns")


def to_point_form(
    df: DataFrame,
    schema: MeasurementSchema,
    db: str | Column | None = None,
    rp: str | Column | None = None,
    measurement: Column | None = None,
    keep: Sequence[str] = (),
    raw_time: Column | None = None,
) -> DataFrame:
    """Wide table to map form. NULL tags and fields leave no entry. A field column may
    hold another type than the declared one; its own type then names the member."""

    def constant(value: str | Column | None) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("string")

    tag_entries = [
        F.when(
            ref(t).isNotNull(),
            F.struct(
                F.lit(t).alias("key"), scalar_text(ref(t), type_of(df, t)).alias("value")
            ),
        )
        for t in schema.tag_names
    ]
    field_entries = []
    for name in schema.field_names:
        own = guess_field_type(type_of(df, name))
        value = typed_value(ref(name), type_of(df, name), own)
        members = [
            (value if m.name == own.member else F.lit(None).cast(m.dataType)).alias(m.name)
            for m in FIELD_VALUE.fields
        ]
        field_entries.append(
            F.when(
                ref(name).isNotNull(),
                F.struct(F.lit(name).alias("key"), F.struct(*members).alias("value")),
            )
        )
    extra = [raw_time.cast("string").alias("raw_time")] if raw_time is not None else []
    return df.select(
        *[ref(k) for k in keep],
        constant(db).alias("db"),
        constant(rp).alias("rp"),
        (measurement if measurement is not None else F.lit(schema.measurement)).alias(
            "measurement"
        ),
        _map_of(tag_entries, "map<string,string>").alias("tags"),
        _map_of(field_entries, f"map<string,{FIELD_VALUE.simpleString()}>").alias("fields"),
        (ref("time_ns") if "time_ns" in df.columns else F.lit(None).cast("bigint")).alias(
            "time_ns"
        ),
        *extra,
    )


def _map_of(entries: list[Column], kind: str) -> Column:
    if not entries:
        return F.create_map().cast(kind)
    return F.map_from_entries(F.array_compact(F.array(*entries))).cast(kind)


def to_wide(points: DataFrame, schema: MeasurementSchema, keep: Sequence[str] = ()) -> DataFrame:
    """Points of one measurement as its wide table; the caller filters the measurement."""
    return points.select(
        *[ref(k) for k in keep],
        *[F.col("tags")[F.lit(t)].alias(t) for t in schema.tag_names],
        *[
            member_value(F.col("fields")[F.lit(f)], schema.fields[f]).alias(f)
            for f in schema.field_names
        ],
        "time_ns",
    )


def points_of(points: DataFrame, schema: MeasurementSchema) -> DataFrame:
    """The wide table of one declared measurement out of map-form points."""
    mine = F.col("measurement") == schema.measurement
    if schema.database:
        mine = mine & (F.col("db") == schema.database)
    return to_wide(points.filter(mine), schema)
