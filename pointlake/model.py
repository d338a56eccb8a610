"""Data model: schemas, policies and the two DataFrame forms of a point.

Wide form (one DataFrame per measurement): ``time_ns BIGINT, <tag> STRING...,
<field> ...``. Map form (many measurements in one DataFrame): ``POINT_SCHEMA``.
Schemas and policies are small driver-side declarations.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from enum import Enum, StrEnum

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Precision(StrEnum):
    """Units of integer times."""

    HOURS = "h"
    MINUTES = "m"
    SECONDS = "s"
    MILLISECONDS = "ms"
    MICROSECONDS = "u"
    NANOSECONDS = "n"


class FieldType(Enum):
    FLOAT = "float"
    INTEGER = "integer"
    STRING = "string"
    BOOLEAN = "boolean"

    @property
    def spark_type(self) -> T.DataType:
        return {
            FieldType.FLOAT: T.DoubleType(),
            FieldType.INTEGER: T.LongType(),
            FieldType.STRING: T.StringType(),
            FieldType.BOOLEAN: T.BooleanType(),
        }[self]

    @property
    def member(self) -> str:
        """Name of the struct member that holds this type in the map form."""
        return {"float": "f", "integer": "i", "string": "s", "boolean": "b"}[self.value]


# One field value in the map form. Exactly one member is set; a struct without
# any set member stands for a value of an unsupported kind (object, array).
FIELD_VALUE = T.StructType(
    [
        T.StructField("f", T.DoubleType()),
        T.StructField("i", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("b", T.BooleanType()),
    ]
)

POINT_SCHEMA = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("rp", T.StringType()),
        T.StructField("measurement", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fields", T.MapType(T.StringType(), FIELD_VALUE)),
        T.StructField("time_ns", T.LongType()),
    ]
)


class NanoTime(int):
    """An instant as exact nanoseconds since the epoch."""

    @classmethod
    def from_string(cls, digits: str) -> NanoTime:
        return cls(int(digits))

    @classmethod
    def from_datetime(cls, value: datetime) -> NanoTime:
        if value.tzinfo is None:
            value = value.replace(tzinfo=UTC)
        delta = value - datetime(1970, 1, 1, tzinfo=UTC)
        micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
        return cls(micros * 1_000)


@dataclass(frozen=True)
class MeasurementSchema:
    """Declared fields and tags of one measurement; meant to be complete."""

    measurement: str
    fields: Mapping[str, FieldType]
    tags: tuple[str, ...] = ()
    database: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "tags", tuple(self.tags))
        for name, kind in self.fields.items():
            if not isinstance(kind, FieldType):
                raise ValueError(f"Unknown field type {kind!r} for {name} in {self.ref()}")

    @property
    def field_names(self) -> list[str]:
        return sorted(self.fields)

    @property
    def tag_names(self) -> list[str]:
        return sorted(self.tags)

    def ref(self, field: str | None = None) -> str:
        parts = [self.database, self.measurement, field]
        return ".".join(p for p in parts if p)

    def in_database(self, database: str | None) -> MeasurementSchema:
        if self.database:
            return self
        if not database:
            raise ValueError(f"Schema {self.measurement} names no database and none is given")
        return MeasurementSchema(self.measurement, self.fields, self.tags, database)

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType(
            [T.StructField("time_ns", T.LongType())]
            + [T.StructField(t, T.StringType()) for t in self.tag_names]
            + [T.StructField(f, self.fields[f].spark_type) for f in self.field_names]
        )


class SchemaSet:
    """Schemas by (database, measurement); a later declaration replaces an earlier one."""

    def __init__(self, schemas: Iterable[MeasurementSchema] = (), database: str | None = None):
        self._default_database = database
        self._by_key: dict[tuple[str, str], MeasurementSchema] = {}
        for schema in schemas:
            self.add(schema)

    def add(self, schema: MeasurementSchema) -> None:
        schema = schema.in_database(self._default_database)
        self._by_key[(schema.database, schema.measurement)] = schema

    def get(self, database: str, measurement: str) -> MeasurementSchema | None:
        return self._by_key.get((database, measurement))

    def __iter__(self):
        return iter(self._by_key.values())

    def __len__(self) -> int:
        return len(self._by_key)


WEEK_S = 7 * 86_400


@dataclass(frozen=True)
class RetentionPolicy:
    """One policy row; ``duration_s`` 0 keeps points forever."""

    db: str
    name: str
    duration_s: int = 0
    shard_s: int = WEEK_S
    replica_n: int = 1
    is_default: bool = False


POLICY_SCHEMA = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("rp", T.StringType()),
        T.StructField("duration_s", T.LongType()),
        T.StructField("shard_s", T.LongType()),
        T.StructField("replica_n", T.IntegerType()),
        T.StructField("is_default", T.BooleanType()),
    ]
)


def policy_table(spark: SparkSession, policies: Iterable[RetentionPolicy]) -> DataFrame:
    """Policies as a table of known size, so that the planner's own size check
    (``spark.sql.autoBroadcastJoinThreshold``) decides how to join it."""
    rows = list(policies)
    table = pa.table(
        {
            "db": pa.array([p.db for p in rows], pa.string()),
            "rp": pa.array([p.name for p in rows], pa.string()),
            "duration_s": pa.array([p.duration_s for p in rows], pa.int64()),
            "shard_s": pa.array([p.shard_s for p in rows], pa.int64()),
            "replica_n": pa.array([p.replica_n for p in rows], pa.int32()),
            "is_default": pa.array([p.is_default for p in rows], pa.bool_()),
        }
    )
    return spark.createDataFrame(table)
