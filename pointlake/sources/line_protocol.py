"""Line-protocol text to points; lines that are not points go to a reject set."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.coercion import integer_of_text
from pointlake.functions.columns import computed_once, ref
from pointlake.functions.text import (
    MEASUREMENT_ESCAPED,
    TAG_ESCAPED,
    is_numeric_text,
    unescape_name,
    unquote,
)
from pointlake.functions.timecol import from_epoch
from pointlake.model import FIELD_VALUE, FieldType, MeasurementSchema
from pointlake.sources.records import read_records

# Fixed patterns of the format. Every quantifier is possessive: a backtracking
# form recurses once per character and overflows the stack on long values.
# One value, and one pair, inside the field section.
ONE_VALUE = r'(?:"(?:[^"\\]++|\\.)*+"|[^", ]++)'
ONE_PAIR = rf'(?:[^\\=, ]++|\\.)++={ONE_VALUE}'
LINE = (
    r'(?s)^((?:[^\\ ]++|\\.)++)'
    rf'(?: ({ONE_PAIR}(?:,{ONE_PAIR})*+))?'
    r'(?: (-?\d++))?$'
)
FIELD_PAIRS = r'(?s)((?:[^\\=,]++|\\.)++=(?:"(?:[^"\\]++|\\.)*+"|[^",]++))(?:,|$)'
HEAD_PARTS = r'(?s)((?:[^\\,]++|\\.)++)(?:,|$)'
PAIR = r'(?s)^((?:[^\\=]++|\\.)++)=(.++)$'
DIGITS = r'^-?\d++$'
INTEGER = r'^[+-]?\d++i$'

# The spellings of the two booleans.
TRUE_WORDS = ("t", "T", "true", "True", "TRUE")
FALSE_WORDS = ("f", "F", "false", "False", "FALSE")

NOT_A_LINE = "not a line"

# Column of the line's text beside the point columns.
TEXT = "_line"


def _complete(parts: Column, whole: Column) -> Column:
    """The parts and the commas between them make up the whole text."""
    lengths = F.aggregate(parts, F.lit(0), lambda total, part: total + F.length(part))
    return lengths + F.greatest(F.size(parts) - 1, F.lit(0)) == F.length(whole)


def _field_value(text: Column) -> Column:
    quoted = text.startswith('"')
    number = F.when(~quoted & is_numeric_text(text), text.try_cast("double"))
    integer = F.when(
        text.rlike(INTEGER), F.substring(text, F.lit(1), F.length(text) - 1).try_cast("bigint")
    )
    flag = F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(
        text.isin(*FALSE_WORDS), F.lit(False)
    )
    string = F.when(quoted, unquote(F.substring(text, F.lit(2), F.length(text) - 2)))
    return F.struct(
        number.alias("f"), integer.alias("i"), string.alias("s"), flag.alias("b")
    ).cast(FIELD_VALUE)


def _pair(text: Column, plain: Column) -> Column:
    """Key and raw value of ``key=value``. A pair of a plain line is cut by position;
    the pattern runs on the others."""
    at = F.instr(text, "=")
    key = F.when(plain, F.substring(text, F.lit(1), at - 1)).otherwise(
        unescape_name(F.regexp_extract(text, PAIR, 1))
    )
    value = F.when(plain, F.substring(text, at + 1, F.length(text))).otherwise(
        F.regexp_extract(text, PAIR, 2)
    )
    return F.struct(key.alias("key"), value.alias("value"))


def _pairs(texts: Column, plain: Column, value: Callable[[Column], Column]) -> Column:
    """Pairs with their values converted. Cutting and converting are separate walks, so
    that a conversion that looks at its text several times does not cut it each time."""
    return F.transform(
        F.transform(texts, lambda t: _pair(t, plain)),
        lambda e: F.struct(e["key"].alias("key"), value(e["value"]).alias("value")),
    )


def _has_value(entry: Column) -> Column:
    value = entry["value"]
    return F.coalesce(value["s"], value["f"].cast("string"), value["i"].cast("string"),
                      value["b"].cast("string")).isNotNull()


def _sections(lines: DataFrame, keep: list[str]) -> DataFrame:
    """Each line cut into ``_head`` (name and tags), ``_body`` (fields) and ``_stamp``,
    with ``_plain`` (no escapes or quotes) and ``_misplaced`` (cannot be a line).

    Most lines hold neither a backslash nor a quote; those are cut at spaces. The
    pattern runs only on the others.
    """
    text = F.col(TEXT)
    is_plain = (F.instr(text, "\\") == 0) & (F.instr(text, '"') == 0)
    cut = computed_once(
        lines, {"_plain": is_plain, "_words": F.when(is_plain, F.split(text, " ", 4))}, keep
    )
    plain, words = F.col("_plain"), F.col("_words")

    def section(group: int) -> Column:
        simple = F.coalesce(F.get(words, F.lit(group - 1)), F.lit(""))
        return F.when(plain, simple).otherwise(F.regexp_extract(text, LINE, group))

    misplaced = plain & ((F.size(words) > 3) | F.array_contains(words, ""))
    cut = computed_once(
        cut,
        {
            "_head": section(1),
            "_section": section(2),
            "_time": section(3),
            "_misplaced": F.coalesce(misplaced, F.lit(True)),
        },
        [*keep, "_plain"],
    )
    bare_time = (F.col("_time") == "") & F.col("_section").rlike(DIGITS)
    return cut.select(
        *[ref(c) for c in keep],
        "_plain",
        "_head",
        "_misplaced",
        F.when(bare_time, F.col("_section")).otherwise(F.col("_time")).alias("_stamp"),
        F.when(bare_time, F.lit("")).otherwise(F.col("_section")).alias("_body"),
    )


def annotate_lines(
    lines: DataFrame,
    precision: str = "n",
    column: str = "value",
    database: str | None = None,
    retention_policy: str | None = None,
) -> DataFrame:
    """Map-form point columns and a ``reason`` (NULL for a good line) for each line."""
    lines = lines.select(ref(column).alias(TEXT))
    own = [TEXT]
    cut = _sections(lines, own)
    plain = F.col("_plain")

    def parts(name: str, pattern: str) -> Column:
        whole = F.col(name)
        found = F.when(plain, F.split(whole, ",")).otherwise(
            F.regexp_extract_all(whole, F.lit(pattern), F.lit(1))
        )
        return F.when(whole == "", F.array().cast("array<string>")).otherwise(found)

    cut = computed_once(
        cut, {"_names": parts("_head", HEAD_PARTS), "_pairs": parts("_body", FIELD_PAIRS)}
    )
    tag_texts = F.slice(
        F.col("_names"), F.lit(2), F.greatest(F.size("_names") - 1, F.lit(0))
    )
    complete = plain | (
        _complete(F.col("_names"), F.col("_head")) & _complete(F.col("_pairs"), F.col("_body"))
    )
    cut = computed_once(
        cut,
        {
            "_name": unescape_name(F.get("_names", F.lit(0))),
            "_tags": _pairs(
                tag_texts, plain, lambda v: F.when(plain, v).otherwise(unescape_name(v))
            ),
            "_fields": _pairs(F.col("_pairs"), plain, _field_value),
            "_whole": complete,
            "_number": F.col("_stamp").try_cast("bigint"),
        },
        [*own, "_stamp", "_misplaced"],
    )

    def distinct_keys(entries: str) -> Column:
        keys = F.col(entries)["key"]
        return F.size(F.array_distinct(keys)) == F.size(keys)

    timed = F.col("_stamp") != ""
    reason = (
        F.when(
            F.col("_misplaced")
            | (F.coalesce(F.col("_name"), F.lit("")) == "")
            | (timed & ~F.col("_stamp").rlike(DIGITS))
            | ~F.col("_whole"),
            F.lit(NOT_A_LINE),
        )
        .when(
            F.exists("_tags", lambda e: (e["key"] == "") | (e["value"] == "")),
            F.lit("tag without name or value"),
        )
        .when(
            F.exists("_fields", lambda e: (e["key"] == "") | ~_has_value(e)),
            F.lit("field without name or with an unreadable value"),
        )
        .when(~distinct_keys("_tags"), F.lit("repeated tag"))
        .when(~distinct_keys("_fields"), F.lit("repeated field"))
        .when(timed & from_epoch(F.col("_number"), precision).isNull(), F.lit("time out of range"))
    )
    cut = computed_once(
        cut, {"reason": reason}, [*own, "_name", "_tags", "_fields", "_number"]
    )
    good = F.col("reason").isNull()
    return cut.select(
        *own,
        F.lit(database).cast("string").alias("db"),
        F.lit(retention_policy).cast("string").alias("rp"),
        F.when(good, F.col("_name")).alias("measurement"),
        F.when(good, F.map_from_entries("_tags")).alias("tags"),
        F.when(good, F.map_from_entries("_fields")).alias("fields"),
        F.when(good, from_epoch(F.col("_number"), precision)).alias("time_ns"),
        "reason",
    )


def _declared_value(text: Column, declared: FieldType) -> Column:
    """The text of a field as its declared type; NULL where it is another type."""
    if declared is FieldType.STRING:
        inner = F.substring(text, F.lit(2), F.length(text) - 2)
        return F.when(text.startswith('"'), unquote(inner))
    if declared is FieldType.BOOLEAN:
        return F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(
            text.isin(*FALSE_WORDS), F.lit(False)
        )
    digits = F.substring(text, F.lit(1), F.length(text) - 1)
    if declared is FieldType.INTEGER:
        return F.when(text.rlike(INTEGER), digits.try_cast("bigint")).otherwise(
            integer_of_text(text)
        )
    return F.when(is_numeric_text(text), text.try_cast("double")).when(
        text.rlike(INTEGER), digits.try_cast("double")
    )


def _quoted_pattern(name: str) -> str:
    """A name as it stands in a line, as a literal of a pattern."""
    for character in TAG_ESCAPED:
        name = name.replace(character, "\\" + character)
    return re.escape(name)


def annotate_table_lines(
    lines: DataFrame,
    schema: MeasurementSchema,
    precision: str = "n",
    column: str = "value",
) -> DataFrame:
    """Lines of one declared measurement as its wide columns plus ``reason``; lines of
    other measurements are left out.

    Each declared tag and field is taken from the line by a pattern that steps over the
    other pairs, so no map or array is built. The lengths of what was found must add up
    to the line; otherwise it holds something undeclared, repeated or malformed.
    """
    lines = lines.select(ref(column).alias(TEXT))
    own = [TEXT]
    cut = _sections(lines, own)
    name = schema.measurement
    for character in MEASUREMENT_ESCAPED:
        name = name.replace(character, "\\" + character)
    head = F.col("_head")
    nameless = (head == "") | head.startswith(",")
    cut = cut.filter((head == name) | head.startswith(name + ",") | nameless)

    found = {}
    for tag in schema.tag_names:
        key = _quoted_pattern(tag)
        pattern = rf"(?s)^(?:(?!{key}=)(?:[^\\,]++|\\.)++,)++{key}=((?:[^\\,]++|\\.)++)(?:,|$)"
        found["_tag_" + tag] = F.regexp_extract("_head", pattern, 1)
    for field in schema.field_names:
        key = _quoted_pattern(field)
        pattern = rf"(?s)^(?:(?!{key}=){ONE_PAIR},)*+{key}=({ONE_VALUE})(?:,|$)"
        found["_field_" + field] = F.regexp_extract("_body", pattern, 1)
    cut = computed_once(cut, found, [*own, "_head", "_body", "_misplaced", "_stamp"])

    def pair_length(prefix: str, key: str) -> Column:
        written = len(key) + sum(key.count(c) for c in TAG_ESCAPED)
        text = ref(prefix + key)
        return F.when(text != "", F.length(text) + (written + 2)).otherwise(F.lit(0))

    head_length, body_length = F.lit(len(name)), F.lit(0)
    for tag in schema.tag_names:
        head_length = head_length + pair_length("_tag_", tag)
    for field in schema.field_names:
        body_length = body_length + pair_length("_field_", field)
    whole = (F.length("_head") == head_length) & (
        F.when(F.col("_body") == "", F.lit(0)).otherwise(F.length("_body") + 1) == body_length
    )

    typed, checks = {}, []
    for field in schema.field_names:
        text = F.when(ref("_field_" + field) != "", ref("_field_" + field))
        typed[field] = _declared_value(text, schema.fields[field])
        expected = schema.fields[field].value
        checks.append(
            F.when(
                text.isNotNull() & typed[field].isNull(),
                F.concat(F.lit(f"Expected {expected} value for {schema.ref(field)}, but got "),
                         text),
            )
        )
    number = F.col("_stamp").try_cast("bigint")
    reason = F.coalesce(
        F.when(F.col("_misplaced") | nameless, F.lit(NOT_A_LINE)),
        *checks,
        F.when(~whole, F.lit(f"undeclared, repeated or malformed part for {schema.ref()}")),
        F.when((F.col("_stamp") != "") & number.isNull(), F.lit("not a time")),
        F.when(number.isNotNull() & from_epoch(number, precision).isNull(), F.lit("time out of range")),
    )
    return cut.select(
        *[ref(c) for c in own],
        *[
            F.when(ref("_tag_" + t) != "", unescape_name(ref("_tag_" + t))).alias(t)
            for t in schema.tag_names
        ],
        *[typed[f].alias(f) for f in schema.field_names],
        from_epoch(number, precision).alias("time_ns"),
        reason.alias("reason"),
    )


def parse_lines(
    lines: DataFrame,
    schema: MeasurementSchema | None = None,
    precision: str = "n",
    column: str = "value",
    database: str | None = None,
    retention_policy: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Good points (map form, or the wide table of ``schema``) and rejected lines."""
    if schema is not None:
        marked = annotate_table_lines(lines, schema, precision, column)
    else:
        marked = annotate_lines(lines, precision, column, database, retention_policy)
    good = marked.filter(F.col("reason").isNull()).drop("reason", TEXT)
    rejects = marked.filter(F.col("reason").isNotNull()).select(F.col(TEXT).alias("line"), "reason")
    return good, rejects


def read_line_protocol(
    spark: SparkSession,
    path: str | list[str],
    schema: MeasurementSchema | None = None,
    precision: str = "n",
    database: str | None = None,
    retention_policy: str | None = None,
    line_breaks: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Line files to points; Spark splits large files between tasks. Blank lines and
    comments (``#``) are no points and are passed over. With ``line_breaks``, strings may
    go over several lines; the files are read twice then and their lines shuffled once."""
    lines = read_records(spark, path) if line_breaks else spark.read.text(path)
    lines = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return parse_lines(lines, schema, precision, "value", database, retention_policy)
