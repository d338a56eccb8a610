"""Stored response documents. They are made from events first: one document per event
type and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.operators import results
from pointlake.plans.registry import query
from pointlake.plans.tables import event_points
from pointlake.session import fresh_path
from pointlake.sources.responses import read_responses as read_documents


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir).select("event_type", "time_ns", "value")
    series = results.series_rows(points, "events", ["event_type"], "1d")
    return results.response_documents(series, ["event_type"])


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = event_documents(spark, sf_dir).withColumnRenamed("event_type", "kind")
    return results.parse_documents(documents, "document")


@query("SELECT event_type, epoch_us(ts) * 1000 AS time_ns, value FROM events")
def flatten_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = results.flatten_responses(
        _parsed(spark, sf_dir), {"value": "double"}, tags=["event_type"]
    )
    return flat.select("event_type", "time_ns", "value")


@query("SELECT event_type, epoch_us(ts) * 1000 AS time_ns, value FROM events")
def read_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through text files, one document per line."""
    path = fresh_path(spark, "responses")
    event_documents(spark, sf_dir).select("document").write.text(path)
    flat = read_documents(spark, path, {"value": "double"}, tags=["event_type"])
    return flat.select("event_type", "time_ns", "value")


@query(
    """
    SELECT 'events' AS name, event_type, epoch_us(date_trunc('day', ts)::TIMESTAMP) * 1000 AS bucket,
           'time,value' AS columns,
           string_agg(epoch_us(ts) * 1000 || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';'
                      ORDER BY ts, value) AS rows
    FROM events GROUP BY event_type, bucket
    """
)
def series_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir).select("event_type", "time_ns", "value")
    series = results.series_rows(points, "events", ["event_type"], "1d")
    shown = F.transform("values", lambda v: F.concat(v[0], F.lit("="), v[1].cast("decimal(18,2)").cast("string")))
    return series.select(
        "name", "event_type", "bucket", F.array_join("columns", ",").alias("columns"), F.array_join(shown, ";").alias("rows")
    )


@query(
    "SELECT DISTINCT event_type, 'statement failed' AS error FROM events"
    " WHERE event_type = 'error'"
)
def response_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the event type ``error`` carry a statement error instead."""
    failed = F.to_json(
        F.struct(F.array(F.struct(F.lit("statement failed").alias("error"))).alias("results"))
    )
    documents = event_documents(spark, sf_dir).withColumn(
        "document", F.when(F.col("event_type") == "error", failed).otherwise(F.col("document"))
    )
    errors = results.error_rows(results.parse_documents(documents, "document"))
    return errors.select("event_type", "error").distinct()


@query("SELECT DISTINCT event_type, CAST(1 AS BIGINT) AS n_results FROM events")
def response_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = results.parse_documents(event_documents(spark, sf_dir), "document")
    single = results.assert_single(results.assert_no_errors(parsed))
    return single.select(
        "event_type", F.size("response.results").cast("bigint").alias("n_results")
    ).distinct()


@query("SELECT event_type, epoch_us(ts) * 1000 AS time_ns, value FROM events"
       " WHERE event_type = 'view'")
def response_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one group of each document whose tags equal the matcher."""
    matched = results.group_of_response(_parsed(spark, sf_dir), {"event_type": "view"})
    flat = results.flatten_responses(matched, {"value": "double"}, tags=["event_type"])
    return flat.select("event_type", "time_ns", "value")


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose columns and kinds differ: errors have whole values and a code of their
    own, views have text where others have numbers."""
    points = event_points(spark, sf_dir).select("event_type", "user_id", "time_ns", "value", "k")
    kind = F.col("event_type")
    common = ["event_type", "time_ns", "value", "k", (F.col("k") > 4).alias("high")]
    views = points.where(kind == "view").select(*common, F.concat(F.lit("page "), F.col("k").cast("string")).alias("note"))
    plain = points.where(~kind.isin("view", "error")).select(*common, F.col("k").alias("note"))
    errors = points.where(kind == "error").select(
        "event_type", "time_ns", F.floor("value").cast("bigint").alias("value"), F.col("user_id").alias("code"),
        F.lit(None).cast("string").alias("empty"),
    )
    tables = [results.series_rows(t, "events", ["event_type"], "1d", typed=True) for t in (views, plain, errors)]
    first, *others = [results.response_documents(t, ["event_type"]).select("document") for t in tables]
    for more in others:
        first = first.unionByName(more)
    return first


MIXED_SQL = """
    SELECT event_type, epoch_us(ts) * 1000 AS time_ns,
           CASE WHEN event_type = 'error' THEN floor(value) ELSE value END AS value,
           CASE WHEN event_type <> 'error' THEN k END AS k,
           CASE WHEN event_type <> 'error' THEN k > 4 END AS high,
           CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'page ' || k ELSE CAST(k AS VARCHAR) END AS note,
           CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) END AS code, CAST(NULL AS VARCHAR) AS empty
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
"""


@query(MIXED_SQL)
def flatten_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is declared: columns, types and tags come from the documents, through text files."""
    path = fresh_path(spark, "responses")
    mixed_documents(spark, sf_dir).write.text(path)
    return read_documents(spark, path).drop("result_index", "series_index", "row_index", "name")


@query(
    """
    WITH kinds AS (
      SELECT CASE WHEN event_type = 'error' THEN 'integer' ELSE 'number' END AS value, 'integer' AS time,
             CASE WHEN event_type <> 'error' THEN 'integer' END AS k, CASE WHEN event_type <> 'error' THEN 'flag' END AS high,
             CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'text' ELSE 'integer' END AS note,
             CASE WHEN event_type = 'error' THEN 'text' END AS code, CASE WHEN event_type = 'error' THEN 'none' END AS empty
      FROM events
    )
    SELECT name, false AS is_tag, kind, count(*) AS cells
    FROM (UNPIVOT kinds ON value, time, k, high, note, code, empty INTO NAME name VALUE kind)
    GROUP BY name, kind
    UNION ALL
    SELECT 'event_type', true, 'text', count(DISTINCT (event_type, date_trunc('day', ts))) FROM events
    """
)
def response_column_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cells of each kind the columns of the documents hold."""
    parsed = results.parse_documents(mixed_documents(spark, sf_dir), "document", typed=True)
    return results.column_kinds(parsed).drop("result_index")
