"""The partitioned store: ``db=/rp=/measurement=/shard_s=/shard=`` directories of Parquet.

``shard`` is the start of a time bucket in seconds and ``shard_s`` its length, so the
data itself says which times a directory holds, whatever the policy says later. Reads
prune by both, retention and shard drops remove whole directories, and updates rewrite
only the buckets they touch. Rewrites use Spark's dynamic partition overwrite, which
writes to a staging directory and swaps partitions in when the job commits; the file
system needs renames (HDFS, a local disk) or a committer that supports the mode. A store
takes one writer at a time.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.coercion import typed_value
from pointlake.functions.columns import ref, type_of
from pointlake.functions.predicate import Where, parse_where, time_bounds
from pointlake.functions.text import scalar_text
from pointlake.functions.timecol import SECOND_NS, duration_ns, floor_div, from_epoch, now_ns
from pointlake.model import (
    WEEK_S,
    FieldType,
    MeasurementSchema,
    NanoTime,
    RetentionPolicy,
    SchemaSet,
)
from pointlake.operators.catalog import shard_listing
from pointlake.operators.lifecycle import keep_unless, upsert_points
from pointlake.operators.query import empty_measurement
from pointlake.operators.shards import (
    defaults_by_database,
    shard_id_of,
    shard_start_s,
    start_of,
    with_default_policy,
    with_policy,
)
from pointlake.operators.validate import CheckCounts, check_points
from pointlake.session import fresh_path
from pointlake.sources.tables import to_wide

DEFAULT_POLICY = "autogen"
V1_SOURCES = "spark.sql.sources.useV1SourceList"
SERIES_FOLDER = "_series"
COLUMNS_FILE = "_columns.json"  # Spark passes over names that start with an underscore

# The characters Spark writes as %XX in partition directory names.
ESCAPED_IN_PATHS = '"#%\'*/:=?\\{[]^\x7f'


def path_part(name: str) -> str:
    return "".join(
        f"%{ord(c):02X}" if c in ESCAPED_IN_PATHS or ord(c) < 0x20 else c for c in name
    )


@dataclass(frozen=True)
class MeasurementRef:
    """``db.rp.measurement``; database and policy may be left to the defaults."""

    name: str
    policy: str | None = None
    db: str | None = None

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError(f"A measurement needs a name, got {self.name!r}")


# Columns that say where a point belongs; they are not stored with it.
PLACE_COLUMNS = {"time_ns", "db", "rp", "measurement"}


def moment_of(write_time: datetime | NanoTime | None) -> NanoTime:
    if isinstance(write_time, NanoTime):
        return write_time
    return NanoTime.from_datetime(write_time or datetime.now(UTC))


def overlapping(
    wanted: Sequence[tuple[int, int]], stored: Sequence[tuple[int, int]]
) -> list[tuple[int, int]]:
    """The stored buckets ``(length, start)`` that share times with the wanted ones, or
    with a bucket that does: all that has to be rewritten together."""
    spans = sorted((start, start + length) for length, start in wanted)
    found: set[tuple[int, int]] = set()
    while True:
        merged: list[list[int]] = []
        for low, high in sorted(spans):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        starts = [m[0] for m in merged]
        new = []
        for bucket in stored:
            length, start = bucket
            at = bisect_left(starts, start + length) - 1
            if bucket not in found and at >= 0 and any(
                low < start + length and start < high for low, high in merged[max(0, at - 1) : at + 1]
            ):
                new.append(bucket)
        if not new:
            return sorted(found)
        found.update(new)
        spans = [tuple(m) for m in merged] + [(start, start + length) for length, start in new]


def _schema_of(target: MeasurementRef, kinds: dict[str, set[str]], tags: set[str]) -> MeasurementSchema:
    """Fields and tags as the points of an undeclared measurement have them."""
    plain = {"f": FieldType.FLOAT, "i": FieldType.INTEGER, "b": FieldType.BOOLEAN, "s": FieldType.STRING}
    types = {
        name: plain[min(found)] if len(found) == 1 else FieldType.FLOAT if found == {"f", "i"} else FieldType.STRING
        for name, found in kinds.items()
    }
    clash = sorted(tags & set(types))
    if clash:
        raise ValueError(f"Both tags and fields of {target.name}: {', '.join(clash)}")
    return MeasurementSchema(target.name, types, tuple(sorted(tags)), target.db)


def placed_schemas(points: DataFrame, declared: SchemaSet) -> dict[MeasurementRef, MeasurementSchema]:
    """The schema of every place of map-form points, declared or found in them, in one pass. The
    driver receives a row for each place and for each tag, field name and kind in it."""
    value = lambda e, name: e["value"][name].isNotNull()
    entry = lambda part, key, kind: F.struct(part.alias("part"), key.alias("key"), kind.alias("kind"))
    none = F.lit(None).cast("string")
    tags = F.transform(
        F.filter(F.map_entries("tags"), lambda e: e["value"].isNotNull()), lambda e: entry(F.lit("tag"), e["key"], none)
    )
    fields = F.filter(
        F.transform(
            F.map_entries("fields"),
            lambda e: entry(
                F.lit("field"), e["key"],
                F.when(value(e, "f"), "f").when(value(e, "i"), "i").when(value(e, "b"), "b").when(value(e, "s"), "s"),
            ),
        ),
        lambda e: e["kind"].isNotNull(),
    )
    own = entry(F.lit("place"), none, none)
    parts = points.select(*PLACES, F.explode(F.concat(F.array(own), tags, fields)).alias("p")).select(*PLACES, "p.*")
    kinds: dict[MeasurementRef, dict[str, set[str]]] = {}
    names: dict[MeasurementRef, set[str]] = {}
    for row in parts.distinct().toLocalIterator():
        target = MeasurementRef(row["_measurement"], row["_rp"], row["_db"])
        kinds.setdefault(target, {})
        names.setdefault(target, set())
        if row["part"] == "tag":
            names[target].add(row["key"])
        elif row["part"] == "field":
            kinds[target].setdefault(row["key"], set()).add(row["kind"])
    return {
        target: declared.get(target.db, target.name) or _schema_of(target, kinds[target], names[target])
        for target in sorted(kinds, key=lambda t: (t.db, t.policy, t.name))
    }


# Columns of one write of many places; beyond that, and where columns of two places cannot be
# columns of one table, places are written one group after another.
MAX_COLUMNS = 400
LEVELS = ("db", "rp", "measurement", "shard_s", "shard")
PLACES = ("_db", "_rp", "_measurement")


@dataclass
class PlaceGroup:
    """Places whose columns agree, so that one table holds the points of all."""

    places: dict[MeasurementRef, MeasurementSchema] = field(default_factory=dict)
    columns: dict[str, tuple[str, FieldType | None]] = field(default_factory=dict)

    def takes(self, columns: dict[str, tuple[str, FieldType | None]]) -> bool:
        agree = all(self.columns.get(low, column) == column for low, column in columns.items())
        return agree and (not self.places or len(self.columns.keys() | columns.keys()) <= MAX_COLUMNS)

    @property
    def schema(self) -> MeasurementSchema:
        columns = sorted(self.columns.values(), key=lambda c: c[0])
        return MeasurementSchema("all", {n: k for n, k in columns if k}, tuple(n for n, k in columns if not k))


def grouped_places(schemas: dict[MeasurementRef, MeasurementSchema]) -> tuple[list[PlaceGroup], list[MeasurementRef]]:
    """Groups of places, and the places with a column that is named like a directory level."""
    groups, alone = [], []
    for target, schema in schemas.items():
        kinds = [(t, None) for t in schema.tag_names] + [(f, schema.fields[f]) for f in schema.field_names]
        columns = {name.lower(): (name, kind) for name, kind in kinds}
        if len(columns) < len(kinds) or columns.keys() & set(LEVELS):
            alone.append(target)
            continue
        group = next((g for g in groups if g.takes(columns)), None)
        if group is None:
            groups.append(group := PlaceGroup())
        group.places[target] = schema
        group.columns |= columns
    return groups, alone


@dataclass(frozen=True)
class Store:
    """A store root with its declared policies and default database."""

    spark: SparkSession
    root: str
    policies: Sequence[RetentionPolicy] = field(default_factory=tuple)
    database: str | None = None
    # Bloom filters on the tags of the files, so that a look for one tag value skips row groups
    # that cannot hold it even where the values of many series lie between its smallest and largest.
    tag_filters: bool = False
    # A table of the distinct series of every bucket, kept up by all writes, beside the points.
    series_table: bool = False

    # -- names -----------------------------------------------------------------

    def resolve(self, measurement: str | MeasurementRef) -> MeasurementRef:
        if isinstance(measurement, str):
            measurement = MeasurementRef(measurement)
        db = measurement.db or self.database
        if not db:
            raise ValueError("Name a database, or give the store a default database")
        policy = measurement.policy or defaults_by_database(self.policies).get(db, DEFAULT_POLICY)
        return MeasurementRef(measurement.name, policy, db)

    def policy_of(self, target: MeasurementRef) -> RetentionPolicy:
        for policy in self.policies:
            if (policy.db, policy.name) == (target.db, target.policy):
                return policy
        return RetentionPolicy(target.db, target.policy, shard_s=WEEK_S)

    def path_of(self, target: MeasurementRef) -> str:
        return (
            f"{self.root}/db={path_part(target.db)}/rp={path_part(target.policy)}"
            f"/measurement={path_part(target.name)}"
        )

    # -- file system -----------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        handle = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return handle.getFileSystem(conf), handle

    def _exists(self, path: str) -> bool:
        fs, handle = self._fs(path)
        return fs.exists(handle)

    def remove(self, path: str) -> None:
        fs, handle = self._fs(path)
        fs.delete(handle, True)

    def children(self, path: str, prefix: str) -> list[str]:
        """Names below a directory, from the file system's listing alone."""
        fs, handle = self._fs(path)
        if not fs.exists(handle):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(handle)]
        return sorted(n for n in names if n.startswith(prefix))

    def buckets(self, measurement: str | MeasurementRef) -> list[tuple[int, int]]:
        """``(length, start)`` of every stored bucket in seconds, from directory names."""
        path = self.path_of(self.resolve(measurement))
        found = []
        for length in self.children(path, "shard_s="):
            size = int(length.removeprefix("shard_s="))
            found += [
                (size, int(n.removeprefix("shard=")))
                for n in self.children(f"{path}/{length}", "shard=")
            ]
        return sorted(found, key=lambda b: (b[1], b[0]))

    def shard_starts(self, measurement: str | MeasurementRef) -> list[int]:
        return sorted({start for _, start in self.buckets(measurement)})

    # -- read ------------------------------------------------------------------

    def read(
        self,
        measurement: str | MeasurementRef,
        schema: MeasurementSchema | None = None,
        start: NanoTime | None = None,
        end: NanoTime | None = None,
        where: Where | None = None,
    ) -> DataFrame:
        """The wide table; a missing measurement is an empty one. Without ``schema`` the
        columns are those of the files. ``start`` (included) and ``end`` (excluded) prune
        buckets and reach the Parquet scan; so do the times that a builder condition
        compares ``time_ns`` with."""
        return self._read_shards(measurement, schema, start, end, where).drop("shard_s", "shard")

    def since(
        self,
        measurement: str | MeasurementRef,
        span: str,
        schema: MeasurementSchema | None = None,
        now: datetime | NanoTime | None = None,
    ) -> DataFrame:
        """Points later than ``span`` before now; older buckets are not opened."""
        moment = NanoTime.from_datetime(now or datetime.now(UTC)) if not isinstance(now, int) else now
        return self.read(measurement, schema, start=NanoTime(int(moment) - duration_ns(span) + 1))

    def _read_shards(
        self,
        measurement: str | MeasurementRef,
        schema: MeasurementSchema | None = None,
        start: NanoTime | None = None,
        end: NanoTime | None = None,
        where: Where | None = None,
    ) -> DataFrame:
        target = self.resolve(measurement)
        path = self.path_of(target)
        if not self._exists(path):
            if schema is None:
                raise ValueError(f"{target.name} is not stored, and no schema says its columns")
            df = empty_measurement(self.spark, schema).withColumns(
                {"shard_s": F.lit(None).cast("bigint"), "shard": F.lit(None).cast("bigint")}
            )
            return df if where is None else df.filter(parse_where(where, df))
        if schema is None:
            df = self.spark.read.option("mergeSchema", True).parquet(path)
            known = self._noted_columns(target)
            if known is not None:
                df = df.select(*[ref(c) for c in df.columns if c in known or c in ("shard_s", "shard")])
            df = df.withColumns({c: F.col(c).cast("bigint") for c in ("shard_s", "shard")})
        else:
            kind = T.StructType(
                [
                    *schema.struct_type.fields,
                    T.StructField("shard_s", T.LongType()),
                    T.StructField("shard", T.LongType()),
                ]
            )
            df = self.spark.read.schema(kind).parquet(path)
        low, high = (None if start is None else int(start)), (None if end is None else int(end))
        if low is not None:
            df = df.filter(F.col("time_ns") >= F.lit(low).cast("bigint"))
        if high is not None:
            df = df.filter(F.col("time_ns") < F.lit(high).cast("bigint"))
        if where is not None:
            df = df.filter(parse_where(where, df))
            found = time_bounds(where)
            low = found[0] if low is None else low if found[0] is None else max(low, found[0])
            high = found[1] if high is None else high if found[1] is None else min(high, found[1])
        if low is not None:
            df = df.filter(F.col("shard") + F.col("shard_s") > F.lit(low // SECOND_NS).cast("bigint"))
        if high is not None:
            df = df.filter(F.col("shard") <= F.lit((high - 1) // SECOND_NS).cast("bigint"))
        return df

    # -- the table of series ------------------------------------------------------

    def series_path(self, target: MeasurementRef) -> str:
        """Beside the databases, below a name that reads of points pass over."""
        return self.path_of(target).replace(self.root, f"{self.root}/{SERIES_FOLDER}", 1)

    def _series_of(self, points: DataFrame, tags: Sequence[str]) -> DataFrame:
        keys = [*[ref(t) for t in tags], F.col("shard_s"), F.col("shard")]
        return points.groupBy(*keys).agg(
            F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"), F.count(F.lit(1)).alias("n_points")
        )

    def _add_series(self, laid: DataFrame, tags: Sequence[str], target: MeasurementRef) -> None:
        """Adds the series of points that were appended; rows of one series add up when they are read."""
        if self.series_table:
            self._series_of(laid, tags).write.mode("append").partitionBy("shard_s", "shard").parquet(self.series_path(target))

    def _renew_series(
        self, target: MeasurementRef, buckets: Sequence[tuple[int, int]], tags: Sequence[str] | None = None
    ) -> None:
        """Lists the series of rewritten buckets anew, from their tags and times."""
        if not self.series_table or not buckets:
            return
        for length, start in buckets:
            self.remove(f"{self.series_path(target)}/shard_s={length}/shard={start}")
        if not self._exists(self.path_of(target)):
            return
        points = self._read_shards(target)
        if tags is None:
            tags = [f.name for f in points.schema.fields if f.name in self._series_tags(target)]
        chosen = points.filter(self._in_buckets(buckets))
        self._series_of(chosen, tags).write.mode("append").partitionBy("shard_s", "shard").parquet(self.series_path(target))

    def _series_tags(self, target: MeasurementRef) -> list[str]:
        if not self.children(self.series_path(target), "shard_s="):
            return []
        columns = self.spark.read.option("mergeSchema", True).parquet(self.series_path(target)).columns
        return [c for c in columns if c not in ("first_ns", "last_ns", "n_points", "shard_s", "shard")]

    def show_series(
        self, measurement: str | MeasurementRef, start: NanoTime | None = None, end: NanoTime | None = None
    ) -> DataFrame:
        """``<tags>, first_ns, last_ns, n_points`` of every series of a measurement, from the table of series: no
        points are read. With ``start`` (included) and ``end`` (excluded), of the buckets in that time."""
        target = self.resolve(measurement)
        if not self.children(self.series_path(target), "shard_s="):
            return self.spark.createDataFrame([], "first_ns bigint, last_ns bigint, n_points bigint")
        tags = self._series_tags(target)
        rows = self.spark.read.option("mergeSchema", True).parquet(self.series_path(target))
        if start is not None:
            rows = rows.filter(F.col("shard") + F.col("shard_s") > F.lit(int(start) // SECOND_NS).cast("bigint"))
        if end is not None:
            rows = rows.filter(F.col("shard") <= F.lit((int(end) - 1) // SECOND_NS).cast("bigint"))
        return rows.groupBy(*[ref(t) for t in tags]).agg(
            F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"), F.sum("n_points").alias("n_points")
        )

    # -- what the files say of themselves ----------------------------------------

    def bucket_stats(self, db: str | None = None) -> DataFrame:
        """``db, rp, measurement, shard_s, shard, n, first_ns, last_ns`` of every stored bucket, of one
        database or of all. The numbers come from the footers of the files: no column is read."""
        kind = "time_ns bigint, db string, rp string, measurement string, shard_s bigint, shard bigint"
        if not self._exists(self.root):
            points = self.spark.createDataFrame([], kind)
        else:
            # Only the second version of the source hands aggregates to the files.
            conf = self.spark.conf
            sources = conf.get(V1_SOURCES)
            conf.set("spark.sql.parquet.aggregatePushdown", "true")
            conf.set(V1_SOURCES, ",".join(x for x in sources.split(",") if x != "parquet"))
            try:
                points = self.spark.read.schema(kind).parquet(self.root)
            finally:
                conf.set(V1_SOURCES, sources)
        if db is not None:
            points = points.filter(F.col("db") == db)
        return points.groupBy(*LEVELS).agg(
            F.count(F.lit(1)).alias("n"), F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns")
        )

    def show_shards(self, db: str | None = None) -> DataFrame:
        """The time buckets of the store with their points, as ``catalog.show_shards`` lists them."""
        buckets = with_policy(self.bucket_stats(db).withColumnRenamed("shard_s", "_length"), self.policies)
        return shard_listing(
            buckets.groupBy("db", "rp", F.col("_length").alias("shard_s"), "duration_s", F.col("shard").alias("start_s"))
            .agg(F.sum("n").alias("n"))
        )

    # -- write -----------------------------------------------------------------

    def _typed(self, df: DataFrame, schema: MeasurementSchema, moment: NanoTime) -> DataFrame:
        """Declared columns in their declared types, the time filled. A column that is
        not declared is an error; a value that does not fit stops the job."""
        known = {f.name for f in schema.struct_type.fields} | PLACE_COLUMNS
        extra = sorted(set(df.columns) - known)
        if extra:
            raise ValueError(f"Not declared in {schema.ref()}: {', '.join(extra)}")
        out = [F.coalesce(ref("time_ns"), F.lit(int(moment)).cast("bigint")).alias("time_ns")]
        for tag in schema.tag_names:
            value = scalar_text(ref(tag), type_of(df, tag)) if tag in df.columns else F.lit(None).cast("string")
            out.append(value.alias(tag))
        for name in schema.field_names:
            declared = schema.fields[name]
            if name not in df.columns:
                out.append(F.lit(None).cast(declared.spark_type).alias(name))
                continue
            kind = type_of(df, name)
            value = typed_value(ref(name), kind, declared)
            if kind != declared.spark_type or declared is FieldType.FLOAT:
                message = F.concat(
                    F.lit(f"Expected {declared.value} value for {schema.ref(name)}, but got '"),
                    ref(name).cast("string"), F.lit("'"),
                )
                wrong = ref(name).isNotNull() & value.isNull()
                value = F.when(wrong, F.raise_error(message).cast(declared.spark_type)).otherwise(value)
            out.append(value.alias(name))
        return df.select(*out)

    def _laid_out(self, df: DataFrame, schema: MeasurementSchema, target: MeasurementRef) -> DataFrame:
        """The typed points with their bucket, placed for writing: rebalanced by bucket, so
        that a hot bucket spreads over several tasks and small ones share files, and
        sorted by series and time, so that file statistics prune tag and time filters."""
        shard_s = self.policy_of(target).shard_s
        placed = df.withColumns(
            {"shard_s": F.lit(shard_s).cast("bigint"), "shard": shard_start_s(F.col("time_ns"), shard_s)}
        )
        order = ["shard", *schema.tag_names, "time_ns"]
        return placed.hint("rebalance", F.col("shard")).sortWithinPartitions(
            *[ref(c) for c in order]
        )

    def append(
        self,
        df: DataFrame,
        schema: MeasurementSchema,
        measurement: str | MeasurementRef | None = None,
        precision: str = "n",
        write_time: datetime | None = None,
    ) -> None:
        """Adds points that are known to be new; ``upsert`` also takes those that are stored
        already. ``precision`` is the unit of an integer ``time_ns`` column; points without
        time get the one ``write_time`` of the job."""
        target = self.resolve(measurement or MeasurementRef(schema.measurement, None, schema.database))
        if precision != "n":
            df = df.withColumn("time_ns", from_epoch(F.col("time_ns"), precision))
        typed = self._typed(df, schema, moment_of(write_time))
        laid = self._laid_out(typed, schema, target)
        self._writer(laid, schema).mode("append").partitionBy("shard_s", "shard").parquet(self.path_of(target))
        self._add_series(laid, schema.tag_names, target)
        self._note_columns(target, schema)

    def write_points(
        self,
        points: DataFrame,
        schemas: Sequence[MeasurementSchema] = (),
        retention_policy: str | None = None,
        write_time: datetime | None = None,
        reject_path: str | None = None,
        known_new: bool = False,
    ) -> dict[str, int]:
        """Map-form points of any measurements; a stored point of the same series and time
        is updated (``known_new`` skips the look for it).

        The batch is checked whole, once, into a staging table of the shared folder, with
        a directory for each place; then all places whose columns agree are written at once. Points that fail go to a table at ``reject_path`` with
        their ``reason``; without it they stop the job before anything is written. A row's
        own ``rp`` comes first, then ``retention_policy``, then the database's default.
        Measurements without a declared schema take fields and tags from their points;
        a field with numbers of both kinds is FLOAT, with other mixtures STRING.

        Returns how many points were good, and rejected by kind of reason, counted on the way.
        """
        moment = moment_of(write_time)
        declared = SchemaSet(schemas, self.database)
        db = F.coalesce(F.col("db"), F.lit(self.database).cast("string"))
        checked = check_points(points, declared, database=self.database)
        reason = F.coalesce("reason", F.when(db.isNull(), F.lit("Missing database")))
        if "raw_time" in checked.columns:
            untimed = F.concat(F.lit("Expected a whole time in range, but got '"), F.col("raw_time"), F.lit("'"))
            reason = F.coalesce(reason, F.when(F.col("raw_time").isNotNull() & F.col("time_ns").isNull(), untimed))
        chosen = with_default_policy(
            checked.withColumns({"reason": reason, "db": db}), self.policies
        ).withColumn("rp", F.coalesce("rp", F.lit(retention_policy).cast("string"), "default_rp", F.lit(DEFAULT_POLICY)))
        counts = CheckCounts()
        chosen = counts.on(chosen)
        kept = ["db", "rp", "measurement", "tags", "fields", "time_ns", "reason"]
        places = ["_failed", "_db", "_rp", "_measurement"]
        staged_path = fresh_path(self.spark, "staged")
        (
            chosen.select(
                *kept, F.col("reason").isNotNull().alias("_failed"), F.col("db").alias("_db"),
                F.col("rp").alias("_rp"), F.col("measurement").alias("_measurement"),
            )
            .write.partitionBy(*places).parquet(staged_path)
        )
        kind = T.StructType(
            [f for f in chosen.select(*kept).schema.fields]
            + [T.StructField("_failed", T.BooleanType()), *(T.StructField(p, T.StringType()) for p in places[1:])]
        )
        staged = self.spark.read.schema(kind).parquet(staged_path)
        failed = staged.filter("_failed").drop(*places)
        if reject_path is not None:
            failed.write.parquet(reject_path)
        elif (first := failed.select("reason").first()) is not None:
            raise ValueError(first.reason)
        good = staged.filter("NOT _failed")
        schemas_by_place = placed_schemas(good, declared)
        groups, alone = grouped_places(schemas_by_place)
        for group in groups:
            self._write_group(good, group, moment, known_new)
        for target in alone:
            own = good.filter(
                (F.col("_db") == target.db) & (F.col("_rp") == target.policy) & (F.col("_measurement") == target.name)
            )
            wide = to_wide(own, schemas_by_place[target])
            if known_new:
                self.append(wide, schemas_by_place[target], target, write_time=moment)
            else:
                self.upsert(wide, schemas_by_place[target], target, write_time=moment)
        return counts.found

    def _write_group(self, good: DataFrame, group: PlaceGroup, moment: NanoTime, known_new: bool) -> None:
        """Writes the points of all places of a group as one table: the jobs are as many for one
        measurement as for a thousand. Points of a place only fill its own columns."""
        schema, levels = group.schema, list(LEVELS)
        rows = [(t.db, t.policy, t.name, self.policy_of(t).shard_s) for t in group.places]
        # One row for each place.
        lengths = self.spark.createDataFrame(rows, "_db string, _rp string, _measurement string, shard_s bigint")
        own = good.join(F.broadcast(lengths), list(PLACES))
        filled = own.withColumn("time_ns", F.coalesce("time_ns", F.lit(int(moment)).cast("bigint")))
        names = [F.col(c).alias(c.removeprefix("_")) for c in PLACES]
        wide = to_wide(filled.select(*names, "tags", "fields", "time_ns", "shard_s"), schema, keep=["db", "rp", "measurement", "shard_s"])
        placed = wide.withColumn("shard", start_of(floor_div(F.col("time_ns"), SECOND_NS), F.col("shard_s")))
        gone: dict[MeasurementRef, list[tuple[int, int]]] = {}
        if not known_new:
            # One row for each bucket that the points fall into.
            touched: dict[MeasurementRef, list[tuple[int, int]]] = {}
            for r in placed.select(*levels).distinct().toLocalIterator():
                touched.setdefault(MeasurementRef(r.measurement, r.rp, r.db), []).append((r.shard_s, r.shard))
            read = {t: overlapping(b, self.buckets(t)) for t, b in touched.items()}
            gone = {t: [b for b in found if b[0] != self.policy_of(t).shard_s] for t, found in read.items()}
            paths = [f"{self.path_of(t)}/shard_s={size}/shard={start}" for t, found in read.items() for size, start in found]
            kind = T.StructType([*schema.struct_type.fields, *(T.StructField(c, T.StringType()) for c in levels[:3])])
            # The directories of other points are never listed.
            stored = (
                self.spark.read.schema(kind).option("basePath", self.root).parquet(*paths) if paths
                else self.spark.createDataFrame([], kind)
            )
            merged = upsert_points(stored, placed, [*levels[:3], *schema.tag_names], schema.field_names)
            keyed = merged.join(
                F.broadcast(lengths.select(*[F.col(c).alias(c.removeprefix("_")) for c in PLACES], "shard_s")), levels[:3]
            )
            placed = keyed.withColumn("shard", start_of(floor_div(F.col("time_ns"), SECOND_NS), F.col("shard_s")))
        columns = [*schema.struct_type.names, *levels]
        laid = (
            placed.select(*[ref(c) for c in columns]).hint("rebalance", *[F.col(c) for c in levels if c != "shard_s"])
            .sortWithinPartitions(*levels, *[ref(t) for t in schema.tag_names], "time_ns")
        )
        writer = self._writer(laid, schema).partitionBy(*levels)
        if known_new:
            writer.mode("append").parquet(self.root)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.root)
        for target, schema in group.places.items():
            self._note_columns(target, schema)
            self._remove_shards(target, sorted(gone.get(target, [])))
        if self.series_table and known_new:
            self._group_series(laid, group.schema.tag_names)
        elif self.series_table:
            for target, found in touched.items():
                self._renew_series(target, sorted({*found, *read[target]} - {*gone.get(target, [])}), group.places[target].tag_names)

    def _group_series(self, laid: DataFrame, tags: Sequence[str]) -> None:
        """Adds the series of all places of one write of new points."""
        keys = [ref(c) for c in (*tags, *LEVELS)]
        series = laid.groupBy(*keys).agg(
            F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"), F.count(F.lit(1)).alias("n_points")
        )
        series.write.partitionBy(*LEVELS).mode("append").parquet(f"{self.root}/{SERIES_FOLDER}")

    # -- which columns of the files are a measurement's own --------------------------------

    def _noted_columns(self, target: MeasurementRef) -> set[str] | None:
        fs, handle = self._fs(f"{self.path_of(target)}/{COLUMNS_FILE}")
        if not fs.exists(handle):
            return None
        stream = fs.open(handle)
        try:
            return set(json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def _note_columns(self, target: MeasurementRef, schema: MeasurementSchema) -> None:
        """Adds the schema's columns to those that reads without a schema show: files of many
        measurements have the columns of all of them."""
        known = self._noted_columns(target)
        columns = {"time_ns", *schema.tag_names, *schema.field_names}
        if known is None or not columns <= known:
            fs, handle = self._fs(f"{self.path_of(target)}/{COLUMNS_FILE}")
            out = fs.create(handle, True)
            try:
                out.write(bytearray(json.dumps(sorted(columns | (known or set()))).encode()))
            finally:
                out.close()

    def append_points(
        self, points: DataFrame, schemas: Sequence[MeasurementSchema] = (), **options
    ) -> dict[str, int]:
        """``write_points`` for points known to be new."""
        return self.write_points(points, schemas, known_new=True, **options)

    def write_into(
        self,
        aggregated: DataFrame,
        schema: MeasurementSchema,
        measurement: str | MeasurementRef,
    ) -> None:
        """Keeps an aggregate as a measurement of its own; existing points of the same
        series and time are updated."""
        self.upsert(aggregated, schema, measurement)

    # -- update and delete -----------------------------------------------------

    def _writer(self, laid: DataFrame, schema: MeasurementSchema | Sequence[str]) -> DataFrameWriter:
        writer = laid.write
        if self.tag_filters:
            tags = schema.tag_names if isinstance(schema, MeasurementSchema) else schema
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
            for tag in tags:
                writer = writer.option(f"parquet.bloom.filter.enabled#{tag}", "true")
        return writer

    def _replace(self, laid: DataFrame, target: MeasurementRef, tags: Sequence[str] | None = None) -> None:
        strings = [f.name for f in laid.schema.fields if isinstance(f.dataType, T.StringType)]
        (
            self._writer(laid, strings if tags is None else tags).mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("shard_s", "shard")
            .parquet(self.path_of(target))
        )

    def _rewrite(
        self, merged: DataFrame, schema: MeasurementSchema, target: MeasurementRef,
        read: Sequence[tuple[int, int]], emptied: bool = False,
    ) -> None:
        """Writes points in place of the buckets they were read from. Buckets of another
        length than the policy's are removed afterwards, as their points have moved."""
        laid = self._laid_out(merged, schema, target)
        tags = schema.tag_names
        self._note_columns(target, schema)
        gone = {b for b in read if b[0] != self.policy_of(target).shard_s}
        if emptied:
            filled = {(r.shard_s, r.shard) for r in laid.select("shard_s", "shard").distinct().toLocalIterator()}
            gone = set(read) - filled
        # Before the files that the points are read from are replaced.
        renewed = {*self._touched(merged, target), *read} - gone if self.series_table else set()
        self._replace(laid, target, tags)
        self._remove_shards(target, sorted(gone))
        self._renew_series(target, sorted(renewed), tags)

    def _in_buckets(self, buckets: Sequence[tuple[int, int]]) -> Column:
        chosen = F.lit(False)
        for length in sorted({b[0] for b in buckets}):
            starts = [start for size, start in buckets if size == length]
            chosen = chosen | ((F.col("shard_s") == length) & F.col("shard").isin(starts))
        return chosen

    def upsert(
        self,
        incoming: DataFrame,
        schema: MeasurementSchema,
        measurement: str | MeasurementRef | None = None,
        write_seq: str | None = None,
        write_time: datetime | NanoTime | None = None,
    ) -> None:
        """Updates by series and time; only the buckets of the incoming points are read
        and rewritten. Repeating it with the same points and ``write_time`` changes
        nothing. Points without time get that time first, so they meet their bucket too."""
        target = self.resolve(measurement or MeasurementRef(schema.measurement, None, schema.database))
        moment = moment_of(write_time)
        carried = schema
        if write_seq:  # the order of writes goes along with the typed columns
            fields = {**schema.fields, write_seq: FieldType.INTEGER}
            carried = MeasurementSchema(schema.measurement, fields, schema.tags, schema.database)
        typed = self._typed(incoming, carried, moment)
        self._merge(
            typed, schema, target,
            lambda stored, points: upsert_points(stored, points, schema.tag_names, schema.field_names, write_seq),
        )

    def merge(
        self,
        incoming: DataFrame,
        schema: MeasurementSchema,
        measurement: str | MeasurementRef,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> None:
        """Puts ``combine(stored, incoming)`` in place of the stored points of the buckets that
        the incoming ones fall into. Columns of the schema that these lack are NULL."""
        target = self.resolve(measurement)
        self._merge(self._typed(incoming, schema, moment_of(None)), schema, target, combine)

    def _touched(self, points: DataFrame, target: MeasurementRef) -> list[tuple[int, int]]:
        """The buckets that the points fall into: one row each."""
        shard_s = self.policy_of(target).shard_s
        starts = points.select(shard_start_s(F.col("time_ns"), shard_s).alias("shard")).distinct()
        return [(shard_s, row.shard) for row in starts.toLocalIterator()]

    def _merge(
        self, typed: DataFrame, schema: MeasurementSchema, target: MeasurementRef,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> None:
        touched = self._touched(typed, target)
        if not touched:
            return
        read = overlapping(touched, self.buckets(target))
        stored = self._read_shards(target, schema).filter(self._in_buckets(read)).drop("shard_s", "shard")
        self._rewrite(combine(stored, typed), schema, target, read)

    def read_touched(
        self, points: DataFrame, schema: MeasurementSchema, measurement: str | MeasurementRef
    ) -> DataFrame:
        """The stored points of the buckets that other points fall into; no other is opened."""
        target = self.resolve(measurement)
        read = overlapping(self._touched(points, target), self.buckets(target))
        return self._read_shards(target, schema).filter(self._in_buckets(read)).drop("shard_s", "shard")

    def drop_before(self, measurement: str | MeasurementRef, moment: NanoTime) -> None:
        """Removes the buckets that end by ``moment``: directories only."""
        target = self.resolve(measurement)
        limit = int(moment) // SECOND_NS
        self._remove_shards(target, [b for b in self.buckets(target) if sum(b) <= limit])

    def replace_from(
        self,
        incoming: DataFrame,
        schema: MeasurementSchema,
        measurement: str | MeasurementRef,
        start: NanoTime,
    ) -> None:
        """Puts the points in place of all stored ones from ``start`` on."""
        target = self.resolve(measurement)
        typed = self._typed(incoming, schema, start).filter(F.col("time_ns") >= F.lit(int(start)).cast("bigint"))
        first = int(start) // SECOND_NS
        late = [b for b in self.buckets(target) if b[0] + b[1] > first]
        read = overlapping(late, self.buckets(target))
        kept = (
            self._read_shards(target, schema).filter(self._in_buckets(read)).drop("shard_s", "shard")
            .filter(F.col("time_ns") < F.lit(int(start)).cast("bigint"))
        )
        merged = kept.unionByName(typed)
        if read or not merged.isEmpty():
            self._rewrite(merged, schema, target, read, emptied=True)

    def delete(
        self,
        schema: MeasurementSchema | None = None,
        measurement: str | MeasurementRef | None = None,
        where: Where | None = None,
        db: str | None = None,
    ) -> None:
        """Deletes points. Buckets without a hit stay untouched, buckets that lose all
        their points are removed, the others are rewritten. Without ``measurement`` the
        condition goes to every measurement of the database that has its columns."""
        if where is None:
            raise ValueError("Deleting needs a condition; drop_measurement drops everything")
        if measurement is None:
            for target in self.targets():
                if target.db == (db or self.database):
                    self._delete_known(target, where)
            return
        self._delete(self.resolve(measurement), schema, where)

    def _delete_known(self, target: MeasurementRef, where: Where) -> None:
        try:
            self._read_shards(target, where=where)
        except AnalysisException as missing:
            if "UNRESOLVED_COLUMN" not in str(missing):
                raise
            return  # the measurement lacks a column of the condition: no point meets it
        self._delete(target, None, where)

    def _delete(self, target: MeasurementRef, schema: MeasurementSchema | None, where: Where) -> None:
        hit = self._read_shards(target, schema, where=where)
        # One row for each bucket with a hit; buckets outside the condition's times are not opened.
        hits = {
            (r.shard_s, r.shard): r.n
            for r in hit.groupBy("shard_s", "shard").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()
        }
        if not hits:
            return
        stored = self._read_shards(target, schema).filter(self._in_buckets(list(hits)))
        sizes = {
            (r.shard_s, r.shard): r.n
            for r in stored.groupBy("shard_s", "shard").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()
        }
        partial = [b for b in hits if hits[b] < sizes[b]]
        if partial:
            chosen = stored.filter(self._in_buckets(partial))
            dropped = F.coalesce(parse_where(where, chosen), F.lit(False))
            # The rows stay in their buckets.
            laid = keep_unless(chosen, dropped).hint("rebalance", F.col("shard")).sortWithinPartitions("shard", "time_ns")
            self._replace(laid, target)
            self._renew_series(target, partial, None if schema is None else schema.tag_names)
        self._remove_shards(target, [b for b in hits if hits[b] == sizes[b]])

    def _remove_shards(self, target: MeasurementRef, buckets: Sequence[tuple[int, int]]) -> None:
        for length, start in buckets:
            self.remove(f"{self.path_of(target)}/shard_s={length}/shard={start}")
            if self.series_table:
                self.remove(f"{self.series_path(target)}/shard_s={length}/shard={start}")

    def drop_measurement(self, measurement: str, db: str | None = None) -> None:
        """Removes the measurement under every policy of the database."""
        db = db or self.resolve(measurement).db
        base = f"{self.root}/db={path_part(db)}"
        for rp in self.children(base, "rp="):
            for root in (base, base.replace(self.root, f"{self.root}/{SERIES_FOLDER}", 1)):
                self.remove(f"{root}/{rp}/measurement={path_part(measurement)}")

    def drop_retention_policy(self, rp: str, db: str | None = None) -> None:
        db = db or self.database
        for root in (self.root, f"{self.root}/{SERIES_FOLDER}"):
            self.remove(f"{root}/db={path_part(db)}/rp={path_part(rp)}")

    def drop_database(self, db: str) -> None:
        for root in (self.root, f"{self.root}/{SERIES_FOLDER}"):
            self.remove(f"{root}/db={path_part(db)}")

    def databases(self) -> list[str]:
        return sorted({t.db for t in self.targets()})

    def measurements(self, db: str | None = None) -> list[str]:
        return sorted({t.name for t in self.targets() if t.db == (db or self.database)})

    def targets(self) -> list[MeasurementRef]:
        """Every stored measurement, from directory names."""
        found = []
        for db in self.children(self.root, "db="):
            for rp in self.children(f"{self.root}/{db}", "rp="):
                for m in self.children(f"{self.root}/{db}/{rp}", "measurement="):
                    parts = [unquote(x.split("=", 1)[1]) for x in (m, rp, db)]
                    found.append(MeasurementRef(*parts))
        return found

    def drop_shard(self, number: int) -> None:
        """Removes the bucket of that id from every measurement: directories only."""
        for target in self.targets():
            for length, start in self.buckets(target):
                if shard_id_of(target.db, target.policy, start) == number:
                    self._remove_shards(target, [(length, start)])

    def apply_retention(self, now: datetime | NanoTime) -> None:
        """Removes the buckets whose last point is past its policy's duration. Buckets
        that are only partly past it stay whole until then, and ``keep_valid`` hides
        their old points from reads."""
        moment = NanoTime.from_datetime(now) if isinstance(now, datetime) else now
        for target in self.targets():
            policy = self.policy_of(target)
            if policy.duration_s == 0:
                continue
            oldest_s = int(moment) // SECOND_NS - policy.duration_s
            gone = [b for b in self.buckets(target) if sum(b) <= oldest_s]
            self._remove_shards(target, gone)

    def keep_valid(self, measurement: str | MeasurementRef, now: datetime | None = None) -> Column:
        """Filter for the points the policy still keeps."""
        policy = self.policy_of(self.resolve(measurement))
        if policy.duration_s == 0:
            return F.lit(True)
        span = F.lit(policy.duration_s * SECOND_NS).cast("bigint")
        return F.col("time_ns") >= now_ns(now) - span


def read_measurement(
    store: Store,
    name: str,
    schema: MeasurementSchema,
    rp: str | None = None,
    db: str | None = None,
    start: NanoTime | None = None,
    end: NanoTime | None = None,
) -> DataFrame:
    return store.read(MeasurementRef(name, rp, db), schema, start, end)


def write_points(
    df: DataFrame,
    store: Store,
    schema: MeasurementSchema,
    database: str | None = None,
    retention_policy: str | None = None,
    precision: str = "n",
    write_time: datetime | None = None,
    known_new: bool = False,
) -> None:
    """A wide table; stored points of the same series and time are updated."""
    target = MeasurementRef(
        schema.measurement, retention_policy, database or schema.database or store.database
    )
    if known_new:
        store.append(df, schema, target, precision, write_time)
        return
    if precision != "n":
        df = df.withColumn("time_ns", from_epoch(F.col("time_ns"), precision))
    store.upsert(df, schema, target, write_time=write_time)
