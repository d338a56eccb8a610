"""Time-series points as Spark DataFrames: intake, checks, queries, lifecycle and streams."""

from pointlake.functions.predicate import Expression, parse_where
from pointlake.model import (
    FieldType,
    MeasurementSchema,
    NanoTime,
    Precision,
    RetentionPolicy,
    SchemaSet,
)

__all__ = [
    "Expression",
    "FieldType",
    "MeasurementSchema",
    "NanoTime",
    "Precision",
    "RetentionPolicy",
    "SchemaSet",
    "parse_where",
]
