"""Intake, checks, times and line output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.lineformat import map_field_pairs
from pointlake.functions.timecol import (
    from_epoch,
    from_nano_string,
    to_precision,
    with_epoch,
    with_nano_iso,
    with_time_from_iso,
    with_time_literal,
)
from pointlake.model import FieldType, MeasurementSchema
from pointlake.operators import validate
from pointlake.plans.registry import query
from pointlake.plans.tables import (
    EVENTS,
    K_SQL,
    MEAN_SQL,
    ORDERS,
    POINTS_SQL,
    POLICIES,
    VALUE_TEXT_SQL,
    event_points,
    k_of_props,
    order_points,
    rounded_mean,
    table,
    with_wall_time,
)
from pointlake.operators.query import mean
from pointlake.session import fresh_path
from pointlake.sinks import lines
from pointlake.sinks.store import MeasurementRef, Store, read_measurement as read_stored
from pointlake.sinks.store import write_points
from pointlake.sources.line_protocol import read_line_protocol as read_lines
from pointlake.sources.points_json import read_points_json as read_json
from pointlake.sources.tables import points_of, to_point_form, to_wide

POINT_COLUMNS = ["measurement", "event_type", "user_id", "value", "k", "time_ns"]


def _as_points(df: DataFrame) -> DataFrame:
    return df.withColumn("measurement", F.lit("events")).select(POINT_COLUMNS)


# -- sources and sinks -----------------------------------------------------------


@query(POINTS_SQL)
def points_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_points(spark, sf_dir).select(POINT_COLUMNS)


@query(POINTS_SQL)
def read_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    text = lines.to_line_protocol(event_points(spark, sf_dir), EVENTS)
    lines.write_line_protocol(text, path)
    good, _ = read_lines(spark, path, EVENTS, database="app")
    return _as_points(good)


@query(POINTS_SQL)
def read_points_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json")
    points = event_points(spark, sf_dir)
    points.select(
        "measurement",
        F.struct("event_type", "user_id").alias("tags"),
        F.struct("value", "k").alias("fields"),
        F.col("time_ns").cast("string").alias("timestamp"),
    ).write.json(path)
    good, _ = validate.parse_points(read_json(spark, path, database="app"), [EVENTS])
    return _as_points(points_of(good, EVENTS))


@query(POINTS_SQL)
def write_points_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, fresh_path(spark, "store"), POLICIES)
    write_points(event_points(spark, sf_dir), store, EVENTS)
    return _as_points(read_stored(store, "events", EVENTS, db="app"))


@query(
    """
    SELECT 'events' AS measurement, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events
    UNION ALL
    SELECT 'orders', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
    FROM orders
    """
)
def write_points_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of two databases in one table, checked and stored by measurement."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES)
    points = to_point_form(event_points(spark, sf_dir), EVENTS, db="app").unionByName(
        to_point_form(order_points(spark, sf_dir), ORDERS, db="sales")
    )
    store.append_points(points, [EVENTS, ORDERS])

    def summed(schema: MeasurementSchema, field: str) -> DataFrame:
        stored = read_stored(store, schema.measurement, schema, db=schema.database)
        total = F.sum(F.col(field).cast("decimal(18,2)")).cast("double")
        return stored.agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(
            F.lit(schema.measurement).alias("measurement"), "n", "total"
        )

    return summed(EVENTS, "value").unionByName(summed(ORDERS, "o_totalprice"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def read_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="sales")
    # Orders of one day, status and priority are points of one series and time: all are kept.
    write_points(order_points(spark, sf_dir), store, ORDERS, known_new=True)
    return read_stored(store, "orders", ORDERS).select("o_orderkey", "o_totalprice")


@query(
    f"SELECT 'events,event_type=' || event_type || ',user_id=' || user_id || ' k=' || {K_SQL}"
    f" || 'i,value=' || {VALUE_TEXT_SQL} || ' ' || (epoch_us(ts) * 1000) AS line FROM events"
)
def write_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    text = lines.to_line_protocol(event_points(spark, sf_dir), EVENTS)
    lines.write_line_protocol(text, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


DOCUMENTS = MeasurementSchema("documents", {"text": FieldType.STRING}, ("lang",))


@query(
    r"""
    SELECT doc_id, 'documents,lang=' || lang || ' text="'
           || replace(replace(text, '\', '\\'), '"', '\"') || '"' AS line
    FROM documents
    """
)
def line_protocol_escaping(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return lines.to_line_protocol(documents, DOCUMENTS, keep=["doc_id"])


@query(
    """
    SELECT CASE WHEN text LIKE '%' || chr(10) || '%' OR text LIKE '%' || chr(13) || '%'
                THEN 'line break in value' END AS reason,
           count(*) AS n
    FROM documents GROUP BY 1
    """
)
def line_break_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    marked = lines.mark_line_breaks(lines.table_lines(documents, DOCUMENTS))
    return marked.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


TEXTS = MeasurementSchema("texts", {"text": FieldType.STRING, "id": FieldType.INTEGER}, ("lang", "source"))


@query("SELECT doc_id AS id, text, lang, source FROM documents")
def line_breaks_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts, with their line breaks, through line files and back."""
    path = fresh_path(spark, "lines")
    documents = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    lines.write_line_protocol(lines.to_line_protocol(documents, TEXTS), path, line_breaks=True)
    good, _ = read_lines(spark, path, TEXTS, line_breaks=True)
    return good.select("id", "text", "lang", "source")


@query(
    """
    SELECT CASE WHEN event_type = 'error' THEN 'failures' ELSE 'events' END AS measurement,
           count(*) AS n
    FROM events GROUP BY 1
    """
)
def write_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    own_name = F.when(F.col("event_type") == "error", F.lit("failures"))
    points = to_point_form(event_points(spark, sf_dir), EVENTS, db="app", measurement=own_name)
    lines.write_measurement(points, "events", path, [EVENTS])
    good, _ = read_lines(spark, path)
    return good.groupBy("measurement").agg(F.count(F.lit(1)).alias("n"))


HOURLY = MeasurementSchema("hourly", {"mean": FieldType.FLOAT}, (), database="app")


@query(f"SELECT date_trunc('hour', ts) AS time, {MEAN_SQL} AS mean FROM events GROUP BY 1")
def downsample_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mean`` per hour, kept as a measurement of its own under the policy ``7d``."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    into = MeasurementRef("hourly", "7d")
    hourly = mean(event_points(spark, sf_dir), "value", every="1h")
    store.write_into(hourly, HOURLY, into)
    return with_wall_time(rounded_mean(store.read(into, HOURLY)))


# -- checks ------------------------------------------------------------------------

STRICT = MeasurementSchema(
    "events", {"value": FieldType.FLOAT}, ("event_type", "user_id"), database="app"
)
# What the points below carry, declared or not.
CARRIED = MeasurementSchema(
    "events",
    {"value": FieldType.STRING, "note": FieldType.STRING},
    ("event_type", "user_id", "zone"),
)


def faulty_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map-form events; errors carry text as a number, signups an undeclared field,
    views an undeclared tag."""
    kind = F.col("event_type")
    events = event_points(spark, sf_dir, keep=["event_id"])
    marked = events.select(
        "event_id",
        "event_type",
        "user_id",
        F.when(kind == "view", F.lit("z")).alias("zone"),
        F.when(kind == "error", F.lit("oops"))
        .otherwise(F.col("value").cast("string"))
        .alias("value"),
        F.when(kind == "signup", F.lit("x")).alias("note"),
        "time_ns",
    )
    return to_point_form(marked, CARRIED, db="app", keep=["event_id"])


@query(
    """
    SELECT event_id, value FROM events WHERE event_type NOT IN ('error', 'signup', 'view')
    """
)
def parse_points_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = validate.parse_points(faulty_points(spark, sf_dir), [STRICT])
    return to_wide(good, STRICT, keep=["event_id"]).select("event_id", "value")


@query(
    """
    SELECT CASE event_type
             WHEN 'error' THEN 'Expected numeric value for app.events.value, but got ''oops'''
             WHEN 'signup' THEN 'Extraneous fields in app.events: `note`'
             ELSE 'Extraneous tags in app.events: `zone`' END AS reason,
           count(*) AS n
    FROM events WHERE event_type IN ('error', 'signup', 'view') GROUP BY 1
    """
)
def parse_points_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = validate.parse_points(faulty_points(spark, sf_dir), [STRICT])
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT 'events' AS measurement, event_type NOT IN ('error', 'signup', 'view') AS ok,
           count(*) AS n
    FROM events GROUP BY 2
    UNION ALL
    SELECT 'orders', o_orderstatus <> 'P', count(*) FROM orders GROUP BY 2
    """
)
def parse_points_multi_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_points(spark, sf_dir).withColumn(
        "batch", F.when(F.col("o_orderstatus") == "P", F.lit("1"))
    )
    carried = MeasurementSchema("orders", ORDERS.fields, (*ORDERS.tags, "batch"))
    points = (
        faulty_points(spark, sf_dir)
        .drop("event_id")
        .unionByName(to_point_form(orders, carried, db="sales"))
    )
    checked = validate.check_points(points, [STRICT, ORDERS])
    return checked.groupBy("measurement", F.col("reason").isNull().alias("ok")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    """
    SELECT CASE event_type WHEN 'error' THEN 'wrong_type' WHEN 'signup' THEN 'extraneous_fields'
             WHEN 'view' THEN 'extraneous_tags' ELSE 'good' END AS kind, count(*) AS n
    FROM events GROUP BY 1
    UNION ALL SELECT 'points', count(*) FROM events
    """
)
def parse_points_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a check finds, counted while its good points are written."""
    counts = validate.CheckCounts()
    good, _ = validate.parse_points(faulty_points(spark, sf_dir), [STRICT], counts=counts)
    good.write.parquet(fresh_path(spark, "good"))
    return spark.createDataFrame(list(counts.found.items()), "kind string, n bigint")


LINEITEM = MeasurementSchema(
    "lineitem",
    {
        "price": FieldType.INTEGER,
        "returned": FieldType.BOOLEAN,
        "quantity": FieldType.FLOAT,
        "discount": FieldType.FLOAT,
        "status": FieldType.STRING,
    },
)


@query(
    r"""
    SELECT l_orderkey, l_linenumber,
           CAST(floor(l_extendedprice) AS BIGINT) || 'i' AS price,
           CASE WHEN l_returnflag = 'R' THEN 'T' ELSE 'F' END AS returned,
           regexp_replace(CAST(l_quantity AS VARCHAR), '\.0$', '') AS quantity,
           regexp_replace(CAST(l_discount AS VARCHAR), '\.0$', '') AS discount,
           '"' || l_linestatus || '"' AS status
    FROM lineitem
    """
)
def coerce_fields_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_linestatus").alias("status"),
    )
    return validate.coerce_fields(items, LINEITEM)


UNDECLARED = MeasurementSchema(
    "events", {"event_type": FieldType.STRING, "value": FieldType.FLOAT}
)


@query(
    f"""
    SELECT event_id, 'event_type="' || event_type || '",value=' || {VALUE_TEXT_SQL} AS pairs
    FROM events
    """
)
def coerce_fields_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = to_point_form(table(spark, sf_dir, "events"), UNDECLARED, keep=["event_id"])
    guessed = validate.coerce_untyped(points)
    return guessed.select("event_id", map_field_pairs(F.col("fields_pairs")).alias("pairs"))


# -- times ---------------------------------------------------------------------------


@query(
    """
    SELECT event_id, CAST(epoch_us(ts) * 1000 AS VARCHAR) AS n,
           CAST(epoch_us(ts) AS VARCHAR) AS u,
           CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms,
           CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS s,
           CAST(epoch_us(ts) // 60000000 AS VARCHAR) AS m,
           CAST(epoch_us(ts) // 3600000000 AS VARCHAR) AS h
    FROM events
    """
)
def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    units = ["n", "u", "ms", "s", "m", "h"]
    casted = [validate.cast_timestamp(points, u)[0].alias(u) for u in units]
    return points.select("event_id", *casted)


@query(
    """
    SELECT event_id, epoch_us(ts) // 3600000000 * 3600000000000 AS from_h,
           epoch_us(ts) // 60000000 * 60000000000 AS from_m,
           epoch_us(ts) // 1000000 * 1000000000 AS from_s,
           epoch_us(ts) // 1000 * 1000000 AS from_ms, epoch_us(ts) * 1000 AS from_u,
           epoch_us(ts) * 1000 AS time_ns
    FROM events
    """
)
def time_from_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    ns = F.col("time_ns")
    back = [
        from_epoch(to_precision(ns, unit), unit).alias(f"from_{unit}")
        for unit in ("h", "m", "s", "ms", "u")
    ]
    texts = points.select("event_id", *back, ns.cast("string").alias("digits"))
    return from_nano_string(texts, "digits").drop("digits", "time")


@query("SELECT event_id, epoch_us(ts) * 1000 AS time_ns FROM events")
def time_from_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = with_nano_iso(event_points(spark, sf_dir, keep=["event_id"]))
    return with_time_from_iso(points.select("event_id", "iso"), "iso").drop("iso")


@query(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '000Z' AS iso,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '000' AS literal
    FROM events
    """
)
def nano_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    return with_time_literal(with_nano_iso(points)).select("event_id", "iso", "literal")


@query("SELECT event_id, epoch_us(ts) // 1000000 AS time, value FROM events")
def epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    return with_epoch(points, "s").select("event_id", "time", "value")


