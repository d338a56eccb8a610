"""Stored query-response documents to tables, and tables to per-series rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.columns import ref, type_of
from pointlake.functions.text import scalar_text
from pointlake.functions.timecol import bucket_start, duration_ns, from_epoch, from_iso

SERIES_SCHEMA = (
    "STRUCT<name: STRING, tags: MAP<STRING,STRING>, columns: ARRAY<STRING>, "
    "values: ARRAY<ARRAY<STRING>>>"
)
RESULTS_SCHEMA = f"ARRAY<STRUCT<error: STRING, series: ARRAY<{SERIES_SCHEMA}>>>"
# Cells of a typed document keep whether they were a number, text or a boolean.
TYPED_RESULTS_SCHEMA = RESULTS_SCHEMA.replace("ARRAY<ARRAY<STRING>>", "ARRAY<ARRAY<VARIANT>>")


def parse_documents(df: DataFrame, document: str, out: str = "response", typed: bool = False) -> DataFrame:
    """JSON text to the nested response structure; cells are text, or keep their kind if ``typed``."""
    kind = TYPED_RESULTS_SCHEMA if typed else RESULTS_SCHEMA
    read = F.from_json(ref(document), f"STRUCT<results: {kind}, error: STRING>")
    # Text that is no JSON object becomes a document with an error, so that it is seen.
    unread = F.named_struct(
        F.lit("results"), F.lit(None).cast(kind), F.lit("error"), F.lit("not a response document")
    )
    is_object = F.coalesce(F.trim(ref(document)).startswith("{") & F.try_parse_json(ref(document)).isNotNull(), F.lit(False))
    parsed = F.when(ref(document).isNotNull() & ~is_object, unread).otherwise(read)
    return df.select(*[ref(c) for c in df.columns if c != document], parsed.alias(out))


def time_of_response(text: Column, precision: str | None) -> Column:
    """Response times are ISO text, or numbers in the query's precision."""
    return F.when(
        text.rlike(r"^-?[0-9]+$"), from_epoch(text.try_cast("bigint"), precision or "n")
    ).otherwise(from_iso(text))


# -- columns that the data itself names ------------------------------------------------

MAX_COLUMNS = 2_000
TEXT_KIND, INTEGER_KIND, NUMBER_KIND, FLAG_KIND, NESTED_KIND, NO_KIND = (
    "text", "integer", "number", "flag", "nested", "none",
)


@dataclass(frozen=True)
class ResultColumns:
    """Result columns with their Spark types, and the tags that become columns."""

    columns: Mapping[str, str]
    tags: tuple[str, ...] = ()


def _cell_type(df: DataFrame, response: str) -> T.DataType:
    series = type_of(df, response)["results"].dataType.elementType["series"].dataType.elementType
    return series["values"].dataType.elementType.elementType


def _kind(cell: Column, kind: T.DataType) -> Column:
    """What a cell holds; numbers without decimals are apart from others."""
    if not isinstance(kind, T.VariantType):
        return F.when(cell.isNull(), NO_KIND).otherwise(TEXT_KIND)
    name = F.schema_of_variant(cell)
    return (
        F.when(cell.isNull() | (name == "VOID"), NO_KIND)
        .when(name == "BIGINT", INTEGER_KIND)
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), NUMBER_KIND)
        .when(name == "BOOLEAN", FLAG_KIND)
        .when(name == "STRING", TEXT_KIND)
        .otherwise(NESTED_KIND)
    )


def _as_kind(cell: Column, kind: T.DataType, wanted: str) -> Column:
    return F.try_variant_get(cell, "$", wanted) if isinstance(kind, T.VariantType) else cell.try_cast(wanted)


def widened(kinds: Iterable[str]) -> str:
    """The type that holds all these kinds: whole numbers widen to doubles, any other
    mix and nested values to text. A column without values is text."""
    seen = set(kinds) - {NO_KIND}
    if seen == {INTEGER_KIND}:
        return "bigint"
    if seen and seen <= {INTEGER_KIND, NUMBER_KIND}:
        return "double"
    return "boolean" if seen == {FLAG_KIND} else "string"


def column_kinds(df: DataFrame, response: str = "response") -> DataFrame:
    """``result_index, name, is_tag, kind, cells``: what the documents hold, one row for
    each column or tag and kind.

    One pass; every task counts its own cells before the shuffle. Of a name that a series
    repeats, the last column counts. Tags are those of a result's first series.
    """
    kind = _cell_type(df, response)
    results = df.select(F.posexplode(f"{response}.results").alias("result_index", "_result"))
    names = F.coalesce(F.col("_series.columns"), F.array().cast("array<string>"))
    last = F.transform(
        F.array_distinct(names),
        lambda n: F.named_struct(
            F.lit("name"), n, F.lit("at"), (F.size(names) - F.array_position(F.reverse(names), n)).cast("int")
        ),
    )
    cells = (
        results.select("result_index", F.explode("_result.series").alias("_series"))
        .select("result_index", last.alias("_columns"), F.explode("_series.values").alias("_row"))
        .select("result_index", "_row", F.inline("_columns"))
        .select("result_index", "name", F.lit(False).alias("is_tag"), _kind(F.get("_row", F.col("at")), kind).alias("kind"))
    )
    first = F.get(F.col("_result.series"), F.lit(0))
    tags = results.select("result_index", F.explode(F.map_keys(first["tags"])).alias("name")).select(
        "result_index", "name", F.lit(True).alias("is_tag"), F.lit(TEXT_KIND).alias("kind")
    )
    counted = cells.unionByName(tags).groupBy("result_index", "name", "is_tag", "kind")
    return counted.agg(F.count(F.lit(1)).alias("cells")).withColumn("result_index", F.col("result_index").cast("bigint"))


def result_columns(
    df: DataFrame, response: str = "response", limit: int = MAX_COLUMNS
) -> dict[int, ResultColumns]:
    """The columns of each statement's result, from the data. Names are in order.

    The driver receives a row for each name and kind; more names than ``limit`` stop it.
    """
    rows = column_kinds(df, response).where("name IS NOT NULL").limit(limit * 8 + 1).collect()
    kinds: dict[int, dict[str, set[str]]] = {}
    tags: dict[int, set[str]] = {}
    for r in rows:
        kinds.setdefault(r.result_index, {})
        tags.setdefault(r.result_index, set())
        if r.is_tag:
            tags[r.result_index].add(r.name)
        else:
            kinds[r.result_index].setdefault(r.name, set()).add(r.kind)
    if len(rows) > limit * 8 or any(len(kinds[i].keys() | tags[i]) > limit for i in kinds):
        raise ValueError(f"More than {limit} result columns; declare the wanted ones")
    return {
        i: ResultColumns({n: widened(kinds[i][n]) for n in sorted(kinds[i])}, tuple(sorted(tags[i])))
        for i in sorted(kinds)
    }


def merged_columns(found: Iterable[ResultColumns]) -> ResultColumns:
    """The columns of several results in one table; types that differ widen like kinds."""
    kind_of = {"bigint": INTEGER_KIND, "double": NUMBER_KIND, "boolean": FLAG_KIND, "string": TEXT_KIND}
    kinds: dict[str, set[str]] = {}
    tags: set[str] = set()
    for one in found:
        tags |= set(one.tags)
        for name, kind in one.columns.items():
            kinds.setdefault(name, set()).add(kind_of[kind])
    return ResultColumns({n: widened(kinds[n]) for n in sorted(kinds)}, tuple(sorted(tags)))


def _free_names(wanted: Sequence[str], taken: Iterable[str]) -> dict[str, str]:
    """Each name, behind underscores if a column of the results has it."""
    used, out = {t.lower() for t in taken}, {}
    for name in wanted:
        free = name
        while free.lower() in used:
            free = "_" + free
        used.add(free.lower())
        out[name] = free
    return out


def flatten_responses(
    df: DataFrame,
    columns: Mapping[str, str] | None = None,
    tags: Sequence[str] | None = None,
    precision: str | None = None,
    response: str = "response",
    result_index: int | None = None,
) -> DataFrame:
    """One row per value row of every result and series, or of the results at ``result_index``.

    ``columns`` gives the wanted result columns with their Spark types; ``time`` is
    always converted and comes out as ``time_ns``. ``tags`` become columns too and
    take the place of a column of the same name. Only tag names that the first series
    of a result has count. Missing series, columns or values mean no rows.

    Without ``columns`` the data names them: a first pass finds all columns, tags and
    kinds of cells (documents should be parsed as ``typed``), and the columns beside
    them that would have a name of theirs get an underscore in front.
    """
    declared = columns is not None
    if not declared:
        seen = result_columns(df, response)
        kept = seen.values() if result_index is None else [seen[result_index]] if result_index in seen else []
        merged = merged_columns(kept)
        columns, tags = merged.columns, merged.tags if tags is None else tags
    tags = list(tags or ())
    carried = [c for c in df.columns if c != response]
    others = [*carried, "result_index", "series_index", "row_index", "name", "time_ns"]
    data = [c for c in columns if c != "time"]
    named = {c: c for c in others} if declared else _free_names(others, [*data, *tags])
    kind = _cell_type(df, response)

    # Inner names are numbered: names of the data may differ in case alone.
    own = {c: f"_carried_{i}" for i, c in enumerate(carried)}
    results = df.select(
        *[ref(c).alias(own[c]) for c in carried],
        F.posexplode_outer(f"{response}.results").alias("_result_index", "_result"),
    )
    if result_index is not None:
        results = results.filter(F.col("_result_index") == result_index)
    first = F.get(F.col("_result.series"), F.lit(0))
    series = results.select(
        *own.values(),
        "_result_index",
        F.coalesce(F.map_keys(first["tags"]), F.array().cast("array<string>")).alias("_tag_keys"),
        F.posexplode("_result.series").alias("_series_index", "_series"),
    )
    wanted = ["time", *data]

    def last_position(name: str) -> Column:
        names = F.coalesce("_series.columns", F.array().cast("array<string>"))
        from_end = F.array_position(F.reverse(names), name)
        return F.when(from_end > 0, F.size(names) - from_end)

    located = series.select(
        *own.values(),
        "_result_index",
        "_series_index",
        F.col("_series.name").alias("_name"),
        *[
            F.when(F.array_contains("_tag_keys", t), F.col("_series.tags")[t]).alias(f"_tag_{i}")
            for i, t in enumerate(tags)
        ],
        *[F.array_contains("_tag_keys", t).alias(f"_has_{i}") for i, t in enumerate(tags)],
        *[last_position(c).cast("int").alias(f"_at_{i}") for i, c in enumerate(wanted)],
        F.posexplode("_series.values").alias("_row_index", "_row"),
    )

    def cell(name: str) -> Column:
        return F.get("_row", F.col(f"_at_{wanted.index(name)}"))

    out = [time_of_response(_as_kind(cell("time"), kind, "string"), precision).alias(named["time_ns"])]
    for name in data:
        if name not in tags:
            out.append(_as_kind(cell(name), kind, columns[name]).alias(name))
    for i, tag in enumerate(tags):
        value = F.col(f"_tag_{i}")
        if tag in columns:
            text = time_of_response(_as_kind(cell(tag), kind, "string"), precision).cast("string") if tag == "time" else (
                _as_kind(cell(tag), kind, "string")
            )
            value = F.when(F.col(f"_has_{i}"), value).otherwise(text)
        out.append(value.alias(tag))
    return located.select(
        *[F.col(own[c]).alias(named[c]) for c in carried],
        F.col("_result_index").cast("bigint").alias(named["result_index"]),
        F.col("_series_index").cast("bigint").alias(named["series_index"]),
        F.col("_row_index").cast("bigint").alias(named["row_index"]),
        F.col("_name").alias(named["name"]),
        *out,
    )


def flatten_statements(
    df: DataFrame, precision: str | None = None, response: str = "response"
) -> list[DataFrame] | DataFrame:
    """A table per statement with the columns of that statement's results, all found in one
    pass; a single statement gives its table itself."""
    found = result_columns(df, response)
    count = max(found, default=0) + 1
    none = ResultColumns({})
    tables = [
        flatten_responses(df, found.get(i, none).columns, found.get(i, none).tags, precision, response, i)
        for i in range(count)
    ]
    return tables[0] if count == 1 else tables


def split_results(flat: DataFrame, statements: int) -> list[DataFrame] | DataFrame:
    """One table per statement; a single statement gives its table itself."""
    tables = [
        flat.filter(F.col("result_index") == i).drop("result_index") for i in range(statements)
    ]
    return tables[0] if statements == 1 else tables


def error_rows(df: DataFrame, response: str = "response") -> DataFrame:
    """Statement errors, and document errors with a NULL ``result_index``."""
    carried = [ref(c) for c in df.columns if c != response]
    document = F.struct(
        F.lit(None).cast("bigint").alias("result_index"),
        F.col(f"{response}.error").alias("error"),
    )
    statements = F.transform(
        F.coalesce(
            F.col(f"{response}.results.error"), F.array().cast("array<string>")
        ),
        lambda e, i: F.struct(i.cast("bigint").alias("result_index"), e.alias("error")),
    )
    found = F.filter(
        F.concat(F.array(document), statements),
        lambda e: F.coalesce(F.length(e["error"]), F.lit(0)) > 0,
    )
    exploded = df.select(*carried, F.explode(found).alias("_e"))
    return exploded.select(
        *[ref(c) for c in df.columns if c != response], "_e.result_index", "_e.error"
    )


def assert_no_errors(df: DataFrame, response: str = "response") -> DataFrame:
    """Stops the job at a document with an error."""
    statement = F.get(
        F.filter(F.col(f"{response}.results.error"), lambda e: F.length(e) > 0), F.lit(0)
    )
    error = F.coalesce(F.col(f"{response}.error"), statement)
    fine = F.when(error.isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Error in a query response: "), error)).cast("boolean")
    )
    return df.filter(fine)


def assert_single(df: DataFrame, response: str = "response") -> DataFrame:
    """Stops the job at a document that does not hold exactly one result."""
    n = F.coalesce(F.size(F.col(f"{response}.results")), F.lit(0))
    fine = F.when(n == 1, F.lit(True)).otherwise(
        F.raise_error(
            F.concat(F.lit("Expected exactly one result, but got "), n.cast("string"))
        ).cast("boolean")
    )
    return df.filter(fine)


def group_of_response(
    df: DataFrame, matcher: Mapping[str, str], result_index: int = 0, response: str = "response"
) -> DataFrame:
    """Each document reduced to the first series of a result whose tags equal the matcher."""
    kind = type_of(df, response)["results"].dataType.elementType["series"].dataType
    series = F.coalesce(
        F.get(F.col(f"{response}.results"), F.lit(result_index))["series"], F.array().cast(kind)
    )
    keys = F.coalesce(F.map_keys(F.get(series, F.lit(0))["tags"]), F.array().cast("array<string>"))

    def equal(one: Column) -> Column:
        test = F.size(keys) == len(matcher)
        for name, value in matcher.items():
            test = test & F.array_contains(keys, name) & (one["tags"][name] == value)
        return test

    found = F.slice(F.filter(series, equal), 1, 1) if matcher else F.slice(series, 1, 0)
    result = F.array(F.struct(F.lit(None).cast("string").alias("error"), found.alias("series")))
    return df.withColumn(
        response, F.struct(result.alias("results"), F.col(f"{response}.error").alias("error"))
    )


def group(df: DataFrame, tags: Sequence[str], matcher: Mapping[str, str]) -> DataFrame:
    """Rows of the one group whose tag set equals the matcher; empty when the matcher
    names other tags than the groups have."""
    if not tags or set(tags) != set(matcher):
        return df.filter(F.lit(False))
    for name in tags:
        df = df.filter(ref(name) == F.lit(matcher[name]))
    return df


def groups(
    df: DataFrame,
    name: str,
    tags: Sequence[str],
    every: str,
    time: str = "time_ns",
    descending: bool = False,
) -> DataFrame:
    """Rows nested per tag set and time bucket:
    ``name, <tags>, bucket, first_time, last_time, rows``.

    ``every`` is the length of the buckets, so it bounds the rows of one list; the
    result depends on the rows alone, not on how they are spread. Rows are in order of
    time, then of their other columns. One shuffle. ``order_groups`` gives whole groups
    as flat sorted rows.
    """
    others = [c for c in df.columns if c not in tags and c != time]
    row = F.struct(*[ref(c) for c in [time, *others]])
    nested = df.groupBy(
        *[ref(t) for t in tags], bucket_start(ref(time), duration_ns(every)).alias("bucket")
    ).agg(
        F.sort_array(F.collect_list(row), asc=not descending).alias("rows"),
        F.min(ref(time)).alias("first_time"),
        F.max(ref(time)).alias("last_time"),
    )
    return nested.select(
        F.lit(name).alias("name"), *[ref(t) for t in tags], "bucket", "first_time", "last_time", "rows"
    )


def series_rows(
    df: DataFrame, name: str, tags: Sequence[str], every: str, time: str = "time_ns", typed: bool = False
) -> DataFrame:
    """The raw response shape: ``name, <tags>, bucket, columns, values``, values as text, or
    with their kind if ``typed``; a series has a row for each time bucket."""
    columns = [time, *[c for c in df.columns if c not in tags and c != time]]
    nested = groups(df, name, tags, every, time)
    values = F.transform(
        "rows",
        lambda r: F.array(*[r[c].cast("variant") if typed else scalar_text(r[c], type_of(df, c)) for c in columns]),
    )
    return nested.select(
        "name",
        *[ref(t) for t in tags],
        "bucket",
        F.array(*[F.lit("time" if c == time else c) for c in columns]).alias("columns"),
        values.alias("values"),
    )


def response_documents(series: DataFrame, tags: Sequence[str]) -> DataFrame:
    """One JSON document (column ``document``) per row of ``series_rows``."""
    entries = [x for t in tags for x in (F.lit(t), ref(t))]
    tag_map = F.create_map(*entries).cast("map<string,string>")
    one = F.struct("name", tag_map.alias("tags"), "columns", "values")
    result = F.array(F.struct(F.array(one).alias("series")))
    return series.select(
        *[ref(t) for t in tags], F.to_json(F.struct(result.alias("results"))).alias("document")
    )
