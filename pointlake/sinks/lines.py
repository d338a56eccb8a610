"""Points to line protocol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.functions.columns import any_present, computed_once, ref, type_of
from pointlake.functions.lineformat import (
    line,
    wide_field_pairs,
    wide_tag_pairs,
)
from pointlake.functions.text import scalar_text
from pointlake.model import MeasurementSchema, SchemaSet
from pointlake.operators.validate import (
    cast_timestamp,
    check_lines,
    coerced_fields,
    require_all,
    table_reason,
)

LINE_BREAK = "line break in value"
# A line whose breaks all stand inside strings; possessive, as user text goes through it.
BREAKS_IN_STRINGS = (
    r'(?s)^(?:[^\\ \r\n]++|\\[^\r\n])++'
    r'(?: (?:[^\\=, \r\n]++|\\[^\r\n])++=(?:"(?:[^"\\]++|\\.)*+"|[^", \r\n]++)'
    r'(?:,(?:[^\\=, \r\n]++|\\[^\r\n])++=(?:"(?:[^"\\]++|\\.)*+"|[^", \r\n]++))*+)?(?: -?\d++)?$'
)


def table_lines(
    df: DataFrame,
    schema: MeasurementSchema,
    precision: str = "n",
    time: str = "time_ns",
    measurement: Column | None = None,
    escape_name: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines of a wide table, as ``line`` and ``reason`` (NULL for a good row).

    The order of tags and fields is fixed while planning; nothing is sorted per row.
    """
    coerced = coerced_fields(df, schema)
    tags = {t: scalar_text(ref(t), type_of(df, t)) for t in schema.tag_names if t in df.columns}
    casted, time_reason = cast_timestamp(df, precision, time)
    text = line(
        measurement if measurement is not None else F.lit(schema.measurement),
        wide_tag_pairs(tags),
        wide_field_pairs({n: c.text for n, c in coerced.items()}, any_present(coerced)),
        casted,
        escape_name,
    )
    reason = table_reason(df, schema, coerced, time_reason=time_reason)
    return computed_once(df, {"line": text, "reason": reason}, list(keep))


def to_line_protocol(
    points: DataFrame,
    schema: MeasurementSchema | SchemaSet | Sequence[MeasurementSchema] = (),
    precision: str = "n",
    database: str | None = None,
    escape_name: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Column ``line`` of a wide table (one schema) or of map-form points (any number
    of schemas, or none). The job stops at a point that fails its checks."""
    if isinstance(schema, MeasurementSchema):
        marked = table_lines(points, schema, precision, escape_name=escape_name, keep=keep)
    else:
        marked = check_lines(points, schema, precision, database, escape_name, keep)
    return require_all(marked)


def mark_line_breaks(lines: DataFrame, in_strings: bool = False) -> DataFrame:
    """The format escapes no line breaks; such a line cannot stand in a text file that is read
    line by line. With ``in_strings`` those within strings are let through, for readers of
    whole records."""
    broken = F.col("line").contains("\n") | F.col("line").contains("\r")
    if in_strings:
        broken = broken & ~F.col("line").rlike(BREAKS_IN_STRINGS)
    known = F.col("reason") if "reason" in lines.columns else F.lit(None).cast("string")
    return lines.withColumn("reason", F.coalesce(known, F.when(broken, F.lit(LINE_BREAK))))


def write_line_protocol(
    lines: DataFrame,
    path: str,
    reject_path: str | None = None,
    max_records_per_file: int | None = None,
    mode: str = "errorifexists",
    line_breaks: bool = False,
) -> None:
    """Writes good lines as text files, and with ``reject_path`` the others as a table
    of ``line`` and ``reason``; without it a bad line stops the job. With ``line_breaks``
    strings keep theirs, to be read with the same option."""
    marked = mark_line_breaks(lines, line_breaks)
    if reject_path is None:
        good = require_all(marked)
    else:
        good = marked.filter(F.col("reason").isNull())
        rejects = marked.filter(F.col("reason").isNotNull())
        rejects.select("line", "reason").write.mode(mode).parquet(reject_path)
    writer = good.select(F.col("line").alias("value")).write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.text(path)


def fill_measurement(points: DataFrame, measurement: str) -> DataFrame:
    """The default measurement; a point's own name wins."""
    if "measurement" not in points.columns:
        return points.withColumn("measurement", F.lit(measurement))
    return points.withColumn("measurement", F.coalesce("measurement", F.lit(measurement)))


def write_measurement(
    points: DataFrame,
    measurement: str,
    path: str,
    schemas: SchemaSet | Sequence[MeasurementSchema] = (),
    precision: str = "n",
    database: str | None = None,
    reject_path: str | None = None,
) -> None:
    named = fill_measurement(points, measurement)
    write_line_protocol(check_lines(named, schemas, precision, database), path, reject_path)
