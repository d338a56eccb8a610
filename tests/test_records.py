"""Records over several lines, in files that are split anywhere."""

import random

import pytest
from pyspark.sql import functions as F

from pointlake.model import FieldType, MeasurementSchema
from pointlake.sinks import lines
from pointlake.sources.line_protocol import read_line_protocol
from pointlake.sources.records import read_records

LOG = MeasurementSchema("log", {"say": FieldType.STRING, "more": FieldType.STRING, "n": FieldType.INTEGER}, ("a b",))


def records_of(text):
    """What a reader that goes through the text letter by letter finds."""
    out, record, at = [], "", 0
    section, inside = "head", False
    while at < len(text):
        c = text[at]
        if c == "\\" and at + 1 < len(text) and (inside or text[at + 1] != "\n"):
            record += text[at : at + 2]
            at += 2
            continue
        if c == "\n" and not inside:
            out.append(record)
            record, section, at = "", "head", at + 1
            continue
        if record.startswith("#"):
            pass
        elif inside:
            inside = c != '"'
        elif section == "head" and c == " ":
            section = "fields"
        elif section == "fields" and c == '"' and record.endswith("="):
            inside = True
        record += c
        at += 1
    return [*out, record] if record else out


def random_files(seed, n=3):
    rng = random.Random(seed)

    def string():
        parts = ["x", " ", ",", "=", "\n", "\r\n", "\r", '\\"', "\\\\", "#", "log b=1", '=\\"', "é", "\n\n", ' v=\\"', "\n#c"]
        return '"' + "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) + '"'

    def record():
        head = rng.choice(["log", 'log,a\\ b=q"q', "log,a\\ b=1", 'l"g'])
        pairs = [f"{k}={rng.choice([string(), string(), '5i', 'T'])}" for k in rng.sample(["say", "more", "n"], rng.randrange(1, 4))]
        return rng.choice([f"{head} {','.join(pairs)} {rng.randrange(99)}", f"{head} {','.join(pairs)}", "log n=1i", '# it"s a "comment', "", "no line at all"])

    return ["\n".join(record() for _ in range(rng.randrange(5, 60))) + rng.choice(["", "\n"]) for _ in range(n)]


@pytest.mark.parametrize("seed, split", [(1, "16b"), (2, "64b"), (3, "300b"), (4, "1m"), (5, "40b")])
def test_against_letter_by_letter(spark, tmp_path, seed, split):
    texts = random_files(seed)
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.txt").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        found = sorted(r.value for r in read_records(spark, str(tmp_path)).collect())
        parts = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert split == "1m" or parts > 3
    want = [r.removesuffix("\r") for text in texts for r in records_of(text)]
    assert found == sorted(want)


def test_one_string_over_many_splits(spark, tmp_path):
    long = "\n".join(f"line {i} says nothing" for i in range(400))
    (tmp_path / "f.txt").write_text(f'log say="{long}",more="a\nb",n=1i 5\nlog n=2i 6\nlog say="{long}" 7')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256b")
    try:
        good, bad = read_line_protocol(spark, str(tmp_path), LOG, line_breaks=True)
        assert bad.count() == 0
        rows = good.orderBy("time_ns").select("say", "more", "n", "time_ns").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in rows] == [(long, "a\nb", 1, 5), (None, None, 2, 6), (long, None, None, 7)]


def test_a_string_that_is_never_closed(spark, tmp_path):
    (tmp_path / "f.txt").write_text('log n=1i 5\nlog say="open\nlog n=2i 6\n')
    good, bad = read_line_protocol(spark, str(tmp_path), LOG, line_breaks=True)
    assert good.count() == 1
    assert [r.reason for r in bad.collect()] == ["not a line"]


VALUES = ["plain", "two\nlines", "\n", "\r", "end\r\n", 'quote " and\n"', "back\\slash\n\\", "", "a,b=c d\n#x", None, "\\\n\\\\\n", "x" * 50_000 + "\n"]


def test_roundtrip(spark, folder):
    rows = [("t\\x", v, v, i, i) for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "`a b` string, say string, more string, n bigint, time_ns bigint").repartition(3)
    text = lines.to_line_protocol(df, LOG)
    lines.write_line_protocol(text, folder + "/out", line_breaks=True)
    for schema in (LOG, None):
        good, bad = read_line_protocol(spark, folder + "/out", schema, line_breaks=True)
        assert bad.count() == 0
        if schema is None:
            good = good.select(F.col("tags")["a b"].alias("a b"), F.col("fields")["say"]["s"].alias("say"),
                               F.col("fields")["more"]["s"].alias("more"), F.col("fields")["n"]["i"].alias("n"), "time_ns")
        got = good.orderBy("n").select("`a b`", "say", "more", "n", "time_ns").collect()
        assert [tuple(r) for r in got] == rows


def test_breaks_outside_of_strings_are_rejected(spark, folder):
    rows = [("t\nx", "fine", 1), ("t", "also\nfine", 2), ("t\rx", "say", 3)]
    df = spark.createDataFrame(rows, "`a b` string, say string, n bigint")
    text = lines.table_lines(df, LOG)
    lines.write_line_protocol(text, folder + "/out", folder + "/bad", line_breaks=True)
    bad = spark.read.parquet(folder + "/bad").collect()
    assert len(bad) == 2 and {r.reason for r in bad} == {"line break in value"}
    good, _ = read_line_protocol(spark, folder + "/out", LOG, line_breaks=True)
    assert [(r.say, r.n) for r in good.collect()] == [("also\nfine", 2)]


def test_plan(spark, tmp_path):
    (tmp_path / "f.txt").write_text('log say="a\nb" 5\n')
    plan = read_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
