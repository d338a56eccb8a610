"""Exact nanosecond times as BIGINT columns, and their other spellings."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.columns import ref, type_of
from pointlake.model import NanoTime

# Nanoseconds per precision unit.
UNIT_NS = {
    "n": 1,
    "u": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60 * 1_000_000_000,
    "h": 3_600 * 1_000_000_000,
}

# Nanoseconds per duration unit.
DURATION_NS = {
    "ns": 1,
    "u": 1_000,
    "µ": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60 * 1_000_000_000,
    "h": 3_600 * 1_000_000_000,
    "d": 86_400 * 1_000_000_000,
    "w": 7 * 86_400 * 1_000_000_000,
}

_DURATION = re.compile(r"([0-9]+)(ns|ms|u|µ|s|m|h|d|w)")

SECOND_NS = UNIT_NS["s"]

ISO_TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z$"


def unit_ns(precision: str) -> int:
    if precision not in UNIT_NS:
        raise ValueError(f"Unknown precision {precision!r}, expected one of {list(UNIT_NS)}")
    return UNIT_NS[precision]


def duration_ns(text: str) -> int:
    """``'7d'``, ``'36h'``, ``'1h30m'``, ``'168h0m0s'``; ``'INF'`` is 0 (no end)."""
    if text.upper() == "INF":
        return 0
    if not text or _DURATION.sub("", text):
        raise ValueError(f"Not a duration: {text!r}")
    return sum(int(n) * DURATION_NS[unit] for n, unit in _DURATION.findall(text))


def floor_div(value: Column, divisor: int) -> Column:
    """Floor division of BIGINTs, exact for every sign and size."""
    if divisor == 1:
        return value
    d = F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, d), d)


def to_precision(time_ns: Column, precision: str) -> Column:
    return floor_div(time_ns, unit_ns(precision))


def from_epoch(value: Column, precision: str) -> Column:
    """Nanoseconds; NULL where they do not fit a BIGINT."""
    return F.try_multiply(value.cast("bigint"), F.lit(unit_ns(precision)).cast("bigint"))


def bucket_start(time_ns: Column, every_ns: int) -> Column:
    """Start of the half-open bucket ``[start, start + every)`` that holds the time."""
    return time_ns - F.pmod(time_ns, F.lit(every_ns).cast("bigint"))


def from_iso(text: Column) -> Column:
    """RFC 3339 text in UTC with 0 to 9 decimals; NULL where the text is not one."""
    seconds = F.unix_seconds(F.try_to_timestamp(F.concat(F.substring(text, 1, 19), F.lit("Z"))))
    tail = F.translate(F.substring(text, 20, 2**31 - 1), ".Z", "")
    fraction = F.rpad(tail, 9, "0").try_cast("bigint")
    whole = F.try_multiply(seconds, F.lit(SECOND_NS).cast("bigint"))
    return F.when(text.rlike(ISO_TIME), F.try_add(whole, fraction))


def from_timestamp(value: Column, kind: T.DataType, session_zone: str) -> Column:
    """Nanoseconds of a timestamp column. A timestamp without zone is read as UTC."""
    if isinstance(kind, T.TimestampNTZType) and session_zone not in ("UTC", "Etc/UTC", "Z"):
        # Calendar arithmetic instead of a cast, which would apply the session's zone.
        seconds = (
            F.unix_date(value.cast("date")).cast("bigint") * 86_400
            + F.hour(value) * 3_600
            + F.minute(value) * 60
        )
        second = F.extract(F.lit("SECOND"), value)
        return seconds * F.lit(SECOND_NS).cast("bigint") + (second * SECOND_NS).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint") * F.lit(86_400 * SECOND_NS).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        value = value.cast("timestamp")
    return F.unix_micros(value) * F.lit(1_000).cast("bigint")


def time_ns_of(df: DataFrame, name: str, precision: str = "n") -> Column:
    """Nanoseconds of a time column of any supported type."""
    kind = type_of(df, name)
    column = ref(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        return from_timestamp(column, kind, zone)
    if isinstance(kind, T.IntegralType):
        return from_epoch(column, precision)
    if isinstance(kind, T.StringType):
        return F.coalesce(from_epoch(column.try_cast("bigint"), precision), from_iso(column))
    raise ValueError(f"Column {name!r} of type {kind.simpleString()} is not a time")


def to_timestamp(time_ns: Column) -> Column:
    """Instant at microsecond precision (Spark's TIMESTAMP)."""
    return F.timestamp_micros(floor_div(time_ns, 1_000))


def to_timestamp_ntz(time_ns: Column) -> Column:
    """UTC wall clock at microsecond precision."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", floor_div(time_ns, 1_000), epoch)


def clock_text(time_ns: Column, separator: str, decimals: int) -> Column:
    """``YYYY-MM-DD<separator>HH:MM:SS.<decimals>`` in UTC, whatever the session's zone."""
    seconds = floor_div(time_ns, SECOND_NS)
    days = floor_div(seconds, 86_400)
    rest = F.pmod(seconds, F.lit(86_400).cast("bigint"))
    fraction = F.lpad(F.pmod(time_ns, F.lit(SECOND_NS).cast("bigint")).cast("string"), 9, "0")

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    return F.concat(
        F.date_from_unix_date(days.cast("int")).cast("string"),
        F.lit(separator),
        two(floor_div(rest, 3_600)),
        F.lit(":"),
        two(floor_div(F.pmod(rest, F.lit(3_600).cast("bigint")), 60)),
        F.lit(":"),
        two(F.pmod(rest, F.lit(60).cast("bigint"))),
        F.lit("."),
        F.substring(fraction, 1, decimals),
    )


def nano_iso(time_ns: Column) -> Column:
    return F.concat(clock_text(time_ns, "T", 9), F.lit("Z"))


def time_literal(time_ns: Column, decimals: int = 9) -> Column:
    return clock_text(time_ns, " ", decimals)


def duration_text(seconds: Column) -> Column:
    """``168h0m0s``, ``1m30s``, ``0s``."""
    hours = floor_div(seconds, 3_600).cast("string")
    minutes = floor_div(F.pmod(seconds, F.lit(3_600)), 60).cast("string")
    rest = F.concat(F.pmod(seconds, F.lit(60)).cast("string"), F.lit("s"))
    return (
        F.when(seconds >= 3_600, F.concat(hours, F.lit("h"), minutes, F.lit("m"), rest))
        .when(seconds >= 60, F.concat(minutes, F.lit("m"), rest))
        .otherwise(rest)
    )


def now_ns(now: datetime | int | None = None) -> Column:
    """A fixed instant, or the query's start time (one value for the whole query)."""
    if now is None:
        return F.unix_micros(F.current_timestamp()) * F.lit(1_000).cast("bigint")
    if isinstance(now, datetime):
        now = NanoTime.from_datetime(now)
    return F.lit(int(now)).cast("bigint")


# -- DataFrame level -----------------------------------------------------------


def with_precision(
    df: DataFrame, precision: str, time: str = "time_ns", out: str = "time"
) -> DataFrame:
    return df.withColumn(out, to_precision(ref(time), precision))


def with_time_from_epoch(
    df: DataFrame, column: str, precision: str, out: str = "time_ns"
) -> DataFrame:
    return df.withColumn(out, from_epoch(ref(column), precision))


def with_time_from_iso(df: DataFrame, column: str, out: str = "time_ns") -> DataFrame:
    return df.withColumn(out, from_iso(ref(column)))


def with_nano_iso(df: DataFrame, time: str = "time_ns", out: str = "iso") -> DataFrame:
    return df.withColumn(out, nano_iso(ref(time)))


def with_time_literal(
    df: DataFrame, time: str = "time_ns", out: str = "literal", decimals: int = 9
) -> DataFrame:
    return df.withColumn(out, time_literal(ref(time), decimals))


def from_nano_string(df: DataFrame, column: str, out: str = "time_ns") -> DataFrame:
    """Digit strings of nanoseconds as ``time_ns`` and a millisecond ``time``."""
    ns = ref(column).cast("bigint")
    return df.withColumn(out, ns).withColumn("time", F.timestamp_millis(floor_div(ns, 1_000_000)))


def with_epoch(
    df: DataFrame, precision: str | None = None, time: str = "time_ns", out: str = "time"
) -> DataFrame:
    """Result time as an integer in the given unit; ``n`` or none keeps nanosecond text."""
    if precision in (None, "n"):
        return df.withColumn(out, nano_iso(ref(time)))
    return df.withColumn(out, to_precision(ref(time), precision))
