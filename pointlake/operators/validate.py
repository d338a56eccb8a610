"""Checks and coercion of point tables against declared schemas.

Each check adds a ``reason`` column (NULL for a good point) in a narrow projection:
no shuffle, and a bad point never aborts the others. ``split`` gives the good and the
rejected rows; ``require_all`` stops the job at the first bad point instead.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.coercion import (
    Coerced,
    coerce_column,
    coerce_member,
    extraneous_reason,
    no_text,
    untyped_text,
)
from pointlake.functions.columns import computed_once, ref, type_of
from pointlake.functions.lineformat import (
    line,
    map_field_pairs,
    map_tag_pairs,
)
from pointlake.functions.text import is_numeric_text
from pointlake.functions.timecol import to_precision
from pointlake.model import FieldType, MeasurementSchema, SchemaSet

PAIRS = "array<struct<name:string,text:string>>"


# -- timestamps ----------------------------------------------------------------


def cast_timestamp(
    df: DataFrame, precision: str, time: str = "time_ns", raw_time: str | None = None
) -> tuple[Column, Column]:
    """``(casted text, reason)``. Instants are converted to the precision; a timestamp
    that came as text or number is taken as it is, and must be numeric."""
    absent = F.lit(None).cast("string")
    converted = (
        to_precision(ref(time), precision).cast("string") if time in df.columns else absent
    )
    raw_time = raw_time or ("raw_time" if "raw_time" in df.columns else None)
    if raw_time is None:
        return converted, no_text()
    raw = ref(raw_time).cast("string")
    bad = raw.isNotNull() & ~is_numeric_text(raw)
    reason = F.when(
        bad, F.concat(F.lit("Expected numeric value for timestamp, but got '"), raw, F.lit("'"))
    )
    return F.coalesce(raw, converted), reason


# -- wide tables ---------------------------------------------------------------


def coerced_fields(
    df: DataFrame, schema: MeasurementSchema, fields: Sequence[str] | None = None
) -> dict[str, Coerced]:
    """Text and reason of each declared field the table has, in name order."""
    have = set(df.columns if fields is None else fields)
    return {
        name: coerce_column(
            ref(name), type_of(df, name), schema.fields[name], schema.ref(name)
        )
        for name in schema.field_names
        if name in have
    }


def _present(names: Sequence[str]) -> Column:
    """Names of the columns that hold a value in this row."""
    return F.array_compact(F.array(*[F.when(ref(n).isNotNull(), F.lit(n)) for n in names]))


def table_reason(
    df: DataFrame,
    schema: MeasurementSchema,
    coerced: dict[str, Coerced],
    fields: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    time_reason: Column | None = None,
) -> Column:
    """The first failing check: fields by name, undeclared fields, undeclared tags, time."""
    checks = [c.reason for c in coerced.values()]
    for what, given, declared in (
        ("fields", fields or (), schema.fields),
        ("tags", tags or (), schema.tags),
    ):
        unknown = sorted(n for n in given if n not in declared)
        if unknown:
            found = _present(unknown)
            checks.append(
                F.when(
                    F.size(found) > 0, extraneous_reason(what, F.lit(schema.ref()), found)
                )
            )
    return F.coalesce(*checks, no_text() if time_reason is None else time_reason)


def check_table(
    df: DataFrame,
    schema: MeasurementSchema,
    precision: str = "n",
    fields: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    time: str = "time_ns",
) -> DataFrame:
    """Wide table with ``fields_pairs``, ``tags_names``, ``casted_timestamp``, ``reason``.

    ``fields`` and ``tags`` name the columns the points carry when that is more than
    the schema declares; an undeclared one with a value rejects its row.
    """
    coerced = coerced_fields(df, schema, fields)
    casted, time_reason = cast_timestamp(df, precision, time)
    pairs = [
        F.struct(F.lit(n).alias("name"), c.text.alias("text")) for n, c in coerced.items()
    ]
    tag_names = sorted(tags if tags is not None else [t for t in schema.tags if t in df.columns])
    return df.select(
        "*",
        with_text(pairs).cast(PAIRS).alias("fields_pairs"),
        (_present(tag_names) if tag_names else F.array()).cast("array<string>").alias(
            "tags_names"
        ),
        casted.alias("casted_timestamp"),
        table_reason(df, schema, coerced, fields, tags, time_reason).alias("reason"),
    )


def coerce_fields(df: DataFrame, schema: MeasurementSchema) -> DataFrame:
    """Each declared field replaced by its line-format text (NULL where absent or bad)."""
    coerced = coerced_fields(df, schema)
    return df.withColumns({name: c.text for name, c in coerced.items()})


# -- map form ------------------------------------------------------------------


def check_points(
    points: DataFrame,
    schemas: SchemaSet | Sequence[MeasurementSchema] = (),
    precision: str = "n",
    database: str | None = None,
) -> DataFrame:
    """Map-form points with ``fields_pairs``, ``tags_names``, ``casted_timestamp``,
    ``reason``; the schema is chosen per row by database and measurement, and rows
    without one are written by guessing from the value."""
    placed = with_schema(points, schemas, database)
    casted, time_reason = cast_timestamp(points, precision)
    return computed_once(
        placed,
        {
            "fields_pairs": F.coalesce(_pairs().cast(PAIRS), F.array().cast(PAIRS)),
            "tags_names": F.coalesce(F.array_sort(_present_keys("tags")), F.array().cast("array<string>")),
            "casted_timestamp": casted,
            "reason": _points_reason(time_reason),
        },
        points.columns,
    )


def check_lines(
    points: DataFrame,
    schemas: SchemaSet | Sequence[MeasurementSchema] = (),
    precision: str = "n",
    database: str | None = None,
    escape_name: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Map-form points as ``line`` and ``reason``, tags and fields in name order."""
    placed = with_schema(points, schemas, database)
    casted, time_reason = cast_timestamp(points, precision)
    text = line(
        F.col("measurement"),
        map_tag_pairs(F.col("tags")),
        map_field_pairs(_pairs()),
        casted,
        escape_name,
    )
    return computed_once(placed, {"line": text, "reason": _points_reason(time_reason)}, list(keep))


SCHEMA = "_schema"
SCHEMA_KIND = "struct<ref:string,fields:map<string,string>,names:array<string>,tags:array<string>>"


def schema_table(spark: SparkSession, schemas: SchemaSet) -> DataFrame:
    """A row for each declared measurement, as a table of known size, so that the planner's
    own size check decides how to join it."""
    rows = list(schemas)
    return spark.createDataFrame(
        pa.table(
            {
                "_db": pa.array([s.database for s in rows], pa.string()),
                "_measurement": pa.array([s.measurement for s in rows], pa.string()),
                "ref": pa.array([s.ref() for s in rows], pa.string()),
                "fields": pa.array(
                    [[(n, s.fields[n].value) for n in s.field_names] for s in rows],
                    pa.map_(pa.string(), pa.string()),
                ),
                "names": pa.array([s.field_names for s in rows], pa.list_(pa.string())),
                "tags": pa.array([s.tag_names for s in rows], pa.list_(pa.string())),
            }
        )
    ).select("_db", "_measurement", F.struct("ref", "fields", "names", "tags").cast(SCHEMA_KIND).alias(SCHEMA))


def with_schema(
    points: DataFrame, schemas: SchemaSet | Sequence[MeasurementSchema], database: str | None
) -> DataFrame:
    """Each point with the schema of its measurement, NULL where none is declared. The
    plan is the same for one schema and for thousands."""
    declared = schemas if isinstance(schemas, SchemaSet) else SchemaSet(schemas, database)
    if not len(declared):
        return points.withColumn(SCHEMA, F.lit(None).cast(SCHEMA_KIND))
    table = schema_table(points.sparkSession, declared)
    db = F.coalesce(F.col("db"), F.lit(database).cast("string"))
    here = (db == F.col("_db")) & (F.col("measurement") == F.col("_measurement"))
    return points.join(table, here, "left").select(*[ref(c) for c in points.columns], SCHEMA)


def _by_type(value: Column, kind: Column, where: Column, part: str) -> Column:
    """The text or the reason of a field value, by its declared type."""
    out = F.lit(None).cast("string")
    for declared in FieldType:
        one = getattr(coerce_member(value, declared, where), part)
        out = F.when(kind == declared.value, one).otherwise(out)
    return out


def _declared(part: str) -> Column:
    """Name and text (or reason) of every declared field, in name order."""
    schema = F.col(SCHEMA)

    def one(name: Column) -> Column:
        value, where = F.col("fields")[name], F.concat(schema["ref"], F.lit("."), name)
        return F.struct(name.alias("name"), _by_type(value, schema["fields"][name], where, part).alias("text"))

    return F.filter(F.transform(schema["names"], one), lambda p: p["text"].isNotNull())


def _pairs() -> Column:
    return F.when(F.col(SCHEMA).isNotNull(), _declared("text")).otherwise(_guessed_pairs())


def _declared_reason() -> Column:
    schema = F.col(SCHEMA)
    checks = [F.get(_declared("reason"), F.lit(0))["text"]]
    for what, names in (("fields", schema["names"]), ("tags", schema["tags"])):
        unknown = F.array_sort(F.array_except(F.map_keys(what), names))
        checks.append(F.when(F.size(unknown) > 0, extraneous_reason(what, schema["ref"], unknown)))
    return F.coalesce(*checks)


def with_text(pairs: Sequence[Column]) -> Column:
    """Array of those ``name, text`` structs that have a text."""
    if not pairs:
        return F.array().cast(PAIRS)
    return F.filter(F.array(*pairs), lambda p: p["text"].isNotNull())


def _present_keys(name: str) -> Column:
    return F.map_keys(F.map_filter(name, lambda _, v: v.isNotNull()))


def _guessed_pairs() -> Column:
    """Pairs of an undeclared point, in name order."""
    guessed = F.transform(
        F.array_sort(F.map_entries("fields")),
        lambda e: F.struct(e["key"].alias("name"), untyped_text(e["value"]).alias("text")),
    )
    return F.filter(guessed, lambda p: p["text"].isNotNull())


def _guess_reason() -> Column:
    bad = F.array_sort(
        F.map_keys(
            F.map_filter("fields", lambda _, v: v.isNotNull() & untyped_text(v).isNull())
        )
    )
    where = F.concat_ws(".", "db", "measurement", F.get(bad, F.lit(0)))
    return F.when(F.size(bad) > 0, F.concat(F.lit("Unsupported value for "), where))


def _points_reason(time_reason: Column) -> Column:
    unnamed = F.coalesce(F.length("measurement"), F.lit(0)) == 0
    return F.coalesce(
        F.when(unnamed, F.lit("Missing measurement")),
        F.when(F.col(SCHEMA).isNotNull(), _declared_reason()).otherwise(_guess_reason()),
        time_reason,
    )


def coerce_untyped(points: DataFrame) -> DataFrame:
    """Pairs of points without any schema: strings quoted, other values printed."""
    return check_points(points)


def check_tags(points: DataFrame, schema: MeasurementSchema) -> DataFrame:
    """Undeclared tag names of each map-form point, as ``unknown_tags``."""
    allowed = F.array(*[F.lit(t) for t in schema.tag_names]).cast("array<string>")
    return points.withColumn(
        "unknown_tags", F.array_except(F.array_sort(F.map_keys("tags")), allowed)
    )


# -- outcome -------------------------------------------------------------------


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without ``reason``, and rejected rows with it."""
    good = checked.filter(F.col("reason").isNull()).drop("reason")
    return good, checked.filter(F.col("reason").isNotNull())


def require_all(checked: DataFrame) -> DataFrame:
    """Stops the job with the reason of the first bad point."""
    fine = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(F.col("reason")).cast("boolean")
    )
    return checked.filter(fine).drop("reason")


# How the reasons of each kind begin.
REASON_KINDS = {
    "missing_name": "Missing", "wrong_type": "Expected", "extraneous_fields": "Extraneous fields",
    "extraneous_tags": "Extraneous tags", "unsupported_value": "Unsupported value",
}


class CheckCounts:
    """Counts of a check, taken while its rows go by: no second pass counts them.

    They are there once an action has read all rows of the checked table, or of its good or rejected
    part; asking earlier waits for it. A counter counts one action.
    """

    def __init__(self) -> None:
        self.observation = Observation()

    def on(self, checked: DataFrame) -> DataFrame:
        reason, known = F.col("reason"), F.lit(False)
        counts = [F.count(F.lit(1)).alias("points"), F.count_if(reason.isNull()).alias("good")]
        for kind, start in REASON_KINDS.items():
            counts.append(F.count_if(reason.startswith(start)).alias(kind))
            known = known | reason.startswith(start)
        counts.append(F.count_if(reason.isNotNull() & ~known).alias("other"))
        return checked.observe(self.observation, *counts)

    @property
    def found(self) -> dict[str, int]:
        """``points``, ``good`` and the rejected ones by kind; kinds without points are left out."""
        counts = self.observation.get
        return {k: n for k, n in counts.items() if n or k in ("points", "good")}


def parse_points(
    points: DataFrame,
    schemas: SchemaSet | Sequence[MeasurementSchema] = (),
    precision: str = "n",
    mode: str = "split",
    database: str | None = None,
    counts: CheckCounts | None = None,
) -> tuple[DataFrame, DataFrame] | DataFrame:
    """Checked points: ``split`` returns (good, rejects), ``fail`` only good points and
    an error at the first bad one. ``counts`` fills with the first action on either."""
    checked = check_points(points, schemas, precision, database)
    if counts is not None:
        checked = counts.on(checked)
    if mode == "split":
        return split(checked)
    if mode == "fail":
        return require_all(checked)
    raise ValueError(f"Unknown mode {mode!r}, expected 'split' or 'fail'")
