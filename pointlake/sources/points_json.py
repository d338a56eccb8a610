"""JSON point objects to map-form points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.timecol import from_epoch
from pointlake.model import FIELD_VALUE

# The variant type keeps whether a value was a string, number or boolean.
JSON_SCHEMA = (
    "measurement STRING, tags MAP<STRING,STRING>, fields MAP<STRING,VARIANT>, timestamp VARIANT"
)


def _with_kind(value: Column) -> Column:
    return F.struct(F.schema_of_variant(value).alias("kind"), value.alias("value"))


def _scalar(kinded: Column) -> Column:
    kind, value = kinded["kind"], kinded["value"]
    return F.when(
        kind != "VOID",
        F.struct(
            F.when(
                (kind == "DOUBLE") | kind.startswith("DECIMAL") | (kind == "FLOAT"),
                F.try_variant_get(value, "$", "double"),
            ).alias("f"),
            F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint")).alias("i"),
            F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).alias("s"),
            F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).alias("b"),
        ).cast(FIELD_VALUE),
    )


def read_points_json(
    spark: SparkSession,
    path: str | list[str],
    precision: str = "n",
    database: str | None = None,
    retention_policy: str | None = None,
    array_files: bool = False,
) -> DataFrame:
    """One point object per line, or, with ``array_files``, one array per file.

    Line files are split between tasks; an array file is read by a single task, so
    large input belongs in line files. ``raw_time`` keeps the written timestamp for
    the checks; ``time_ns`` is NULL where it is not an integer.
    """
    raw = (
        spark.read.schema(JSON_SCHEMA)
        .option("multiLine", array_files)
        .json(path)
    )
    kind = F.schema_of_variant("timestamp")
    raw_time = F.when(kind != "VOID", F.try_variant_get("timestamp", "$", "string"))
    empty_tags = F.create_map().cast("map<string,string>")
    empty_fields = F.create_map().cast(f"map<string,{FIELD_VALUE.simpleString()}>")
    kinded = F.transform_values("fields", lambda _, v: _with_kind(v))
    points = raw.select(
        F.lit(database).cast("string").alias("db"),
        F.lit(retention_policy).cast("string").alias("rp"),
        "measurement",
        F.coalesce("tags", empty_tags).alias("tags"),
        F.coalesce(F.transform_values(kinded, lambda _, v: _scalar(v)), empty_fields).alias(
            "fields"
        ),
        F.when(raw_time != "", raw_time).alias("raw_time"),
    )
    # Only digits are a time: 1e9 and 5.5 go to the checks as they are written.
    digits = F.col("raw_time").rlike(r"^-?[0-9]+$")
    return points.withColumn(
        "time_ns", F.when(digits, from_epoch(F.col("raw_time").try_cast("bigint"), precision))
    )
