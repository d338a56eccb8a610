"""Points to lines: ``measurement[,tag=val...][ field=val[,...]][ time]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pointlake.functions.text import escape_measurement, escape_tag


def name_text(name: str) -> Column:
    """An escaped constant name; folded while planning."""
    return escape_tag(F.lit(name))


def line(
    measurement: Column,
    tag_pairs: Column,
    field_pairs: Column,
    time: Column,
    escape_name: bool = False,
) -> Column:
    """Assembles a line. ``field_pairs`` and ``time`` are NULL where there are none. The
    measurement is written as it is unless ``escape_name`` asks for escapes.

    No part appears twice in the expression, which keeps the generated code small.
    """
    head = escape_measurement(measurement) if escape_name else measurement
    return F.concat_ws(" ", F.concat(head, tag_pairs), field_pairs, time)


def wide_tag_pairs(tags: dict[str, Column]) -> Column:
    """``,tag=val...`` of a wide table, in name order; NULL tags are left out."""
    return F.concat_ws(
        "",
        *[
            F.concat(F.lit(","), name_text(t), F.lit("="), escape_tag(tags[t]))
            for t in sorted(tags)
        ],
    )


def wide_field_pairs(texts: dict[str, Column], present: Column) -> Column:
    """``field=val,...`` of known fields in name order, NULL unless ``present``."""
    pairs = [F.concat(name_text(f), F.lit("="), texts[f]) for f in sorted(texts)]
    return F.when(present, F.concat_ws(",", *pairs))


def map_tag_pairs(tags: Column) -> Column:
    """``,tag=val...`` of a tag map; nothing for a NULL map."""
    present = F.filter(F.map_entries(tags), lambda e: e["value"].isNotNull())
    joined = F.array_join(
        F.transform(
            F.array_sort(present),
            lambda e: F.concat(
                F.lit(","), escape_tag(e["key"]), F.lit("="), escape_tag(e["value"])
            ),
        ),
        "",
    )
    return F.coalesce(joined, F.lit(""))


def map_field_pairs(pairs: Column) -> Column:
    """``field=val,...`` of checked pairs, NULL without any."""
    joined = F.array_join(
        F.transform(pairs, lambda p: F.concat(escape_tag(p["name"]), F.lit("="), p["text"])), ","
    )
    return F.when(F.size(pairs) > 0, joined)


def series_key(measurement: Column, tag_pairs: Column) -> Column:
    """``measurement,tag=val,...`` in tag-name order."""
    return F.concat(escape_measurement(measurement), tag_pairs)
