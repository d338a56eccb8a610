"""Stored response documents to a flat table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from pointlake.operators.results import assert_no_errors, flatten_responses, parse_documents


def read_responses(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    columns: Mapping[str, str] | None = None,
    tags: Sequence[str] | None = None,
    precision: str | None = None,
    document: str = "value",
    whole_files: bool = False,
    require_success: bool = True,
) -> DataFrame:
    """Documents from text files (one per line, or one per file) or from a column of a
    DataFrame. A document with an error stops the job unless ``require_success`` is off.
    Without ``columns`` the documents name them; they are read twice then."""
    if not isinstance(source, DataFrame):
        source = spark.read.text(source, wholetext=whole_files)
        document = "value"
    parsed = parse_documents(source, document, typed=columns is None)
    if require_success:
        parsed = assert_no_errors(parsed)
    return flatten_responses(parsed, columns, tags, precision)
