import json
import time

import pytest
from pyspark.sql import functions as F

from pointlake.model import POINT_SCHEMA, FieldType, MeasurementSchema, SchemaSet
from pointlake.operators import validate
from pointlake.sources.points_json import read_points_json
from samples import PROBES, RAIN, RAIN_START_S, rain_points

SCHEMA = MeasurementSchema(
    "boiler",
    {
        "cycles": FieldType.INTEGER,
        "heat": FieldType.FLOAT,
        "note": FieldType.STRING,
        "open": FieldType.BOOLEAN,
    },
    ("unit",),
    database="plant",
)
LARGE = 2**62 + 1


def value(x):
    if x is None:
        return None
    if isinstance(x, bool):
        return {"f": None, "i": None, "s": None, "b": x}
    if isinstance(x, int):
        return {"f": None, "i": x, "s": None, "b": None}
    if isinstance(x, float):
        return {"f": x, "i": None, "s": None, "b": None}
    if isinstance(x, str):
        return {"f": None, "i": None, "s": x, "b": None}
    return {"f": None, "i": None, "s": None, "b": None}


def point(spark, fields, tags=None, measurement="boiler", db="plant", time_ns=None):
    row = (db, None, measurement, tags or {}, {k: value(v) for k, v in fields.items()}, time_ns)
    return spark.createDataFrame([row], POINT_SCHEMA)


def checked(spark, fields, tags=None, schemas=(SCHEMA,), **more):
    return validate.check_points(point(spark, fields, tags, **more), schemas).first()


GOOD_VALUES = {
    "cycles": [(0, "0i"), (-12, "-12i"), (LARGE, f"{LARGE}i"), (str(LARGE), f"{LARGE}i"), (" 6 ", "6i"),
               (2.9, "2i"), (-0.25, "-1i"), ("-7.01", "-8i"), ("3e2", "300i"), (float(2**62), f"{2**62}i")],
    "heat": [(81, "81"), (81.0, "81"), (-0.5, "-0.5"), ("0.500", "0.500"), ("1e3", "1e3")],
    "note": [("", '""'), ('5" pipe', '"5\\" pipe"'), (6, '"6"'), (0.75, '"0.75"'), (False, '"false"')],
    "open": [(True, "T"), (False, "F")],
}
BAD_VALUES = {
    "cycles": [False, "many", "", "1e99", float("inf"), "0b1"],
    "heat": [True, "hot", "", "0x1p3", float("nan"), float("-inf"), "1_000"],
    "note": [["list"]],
    "open": [0, 1.0, "true", ""],
}


@pytest.mark.parametrize("name, given, text", [(n, g, t) for n, cases in GOOD_VALUES.items() for g, t in cases])
def test_good_values(spark, name, given, text):
    row = checked(spark, {name: given})
    assert row.reason is None and [tuple(p) for p in row.fields_pairs] == [(name, text)]


@pytest.mark.parametrize("name, given", [(n, g) for n, cases in BAD_VALUES.items() for g in cases])
def test_bad_values(spark, name, given):
    reason = checked(spark, {name: given}).reason
    kind = {"note": "Unsupported value", "open": "Expected boolean value"}.get(name, "Expected numeric value")
    assert reason.startswith(f"{kind} for plant.boiler.{name}")
    if isinstance(given, str) and name != "open":
        assert reason.endswith(f"'{given}'")


def test_fields_come_in_name_order_without_nulls(spark):
    row = checked(spark, {"open": True, "note": None, "cycles": 5, "heat": 1.5})
    assert [p.name if hasattr(p, "name") else p[0] for p in row.fields_pairs] == ["cycles", "heat", "open"]
    assert checked(spark, {}).reason is None and checked(spark, {}).fields_pairs == []


def test_undeclared_names_are_rejected(spark):
    assert checked(spark, {"heat": 1, "wet": 2, "cold": None}).reason == (
        "Extraneous fields in plant.boiler: `cold`, `wet`"
    )
    assert checked(spark, {"heat": 1}, {"unit": "a", "floor": "2"}).reason == "Extraneous tags in plant.boiler: `floor`"


def test_the_first_fault_is_named(spark):
    """Declared fields by name, then undeclared fields, then undeclared tags."""
    faults = {"wet": 2, "open": "ajar", "heat": "hot"}
    tags = {"floor": "2"}
    found = []
    for name in ("heat", "open", "wet", None):
        found.append(checked(spark, faults, tags).reason.split(" in ")[0].split(" for ")[0])
        faults.pop(name, None)
    assert found == ["Expected numeric value", "Expected boolean value", "Extraneous fields", "Extraneous tags"]


def test_tags(spark):
    assert checked(spark, {}, {"unit": "b7"}).tags_names == ["unit"]
    assert checked(spark, {}, {}).tags_names == []
    unknown = validate.check_tags(point(spark, {}, {"roof": "1", "floor": "2", "unit": "x"}), SCHEMA)
    assert unknown.first().unknown_tags == ["floor", "roof"]


def test_undeclared(spark):
    row = checked(spark, {"on": False, "n": 9, "say": 'a "b"', "none": None, "x": 0.125}, schemas=())
    assert [tuple(p) for p in row.fields_pairs] == [
        ("n", "9"), ("on", "false"), ("say", '"a \\"b\\""'), ("x", "0.125"),
    ]
    assert row.reason is None
    assert "Unsupported" in checked(spark, {"n": [1]}, schemas=()).reason
    assert "Unsupported" in checked(spark, {"n": float("inf")}, schemas=()).reason
    other = checked(spark, {"wet": 1}, measurement="elsewhere")
    assert [tuple(p) for p in other.fields_pairs] == [("wet", "1")]


def test_missing_measurement(spark):
    assert checked(spark, {"a": 1}, schemas=(), measurement=None).reason == "Missing measurement"


@pytest.mark.parametrize("schemas", [(), (SCHEMA,)])
def test_points_without_maps(spark, schemas):
    df = spark.createDataFrame([("plant", None, "boiler", None, None, 7)], POINT_SCHEMA)
    row = validate.check_points(df, schemas).first()
    assert (row.fields_pairs, row.tags_names, row.reason) == ([], [], None)
    text = validate.check_lines(df, schemas).first()
    assert (text.line, text.reason) == ("boiler 7", None)


def test_schema_per_row(spark):
    other = MeasurementSchema("boiler", {"cycles": FieldType.STRING}, (), database="ship")
    points = point(spark, {"cycles": 4}).unionByName(point(spark, {"cycles": 4}, db="ship"))
    rows = validate.check_points(points, [SCHEMA, other]).orderBy("db").collect()
    assert [r.fields_pairs[0].text for r in rows] == ["4i", '"4"']
    named = validate.check_points(point(spark, {"cycles": 4}, db=None), [SCHEMA], database="plant")
    assert named.first().fields_pairs[0].text == "4i"


def test_a_thousand_schemas_plan_like_one(spark):
    kinds = list(FieldType)
    schemas = [
        MeasurementSchema(f"m{i}", {f"f{k}": kinds[(i + k) % 4] for k in range(8)}, ("t",), "plant") for i in range(1000)
    ]
    points = point(spark, {"f0": 4}, measurement="m998").unionByName(point(spark, {"f1": True}, measurement="m4"))
    started = time.monotonic()
    rows = validate.check_points(points, schemas).orderBy("measurement").collect()
    assert time.monotonic() - started < 20
    assert rows[0].reason.startswith("Expected numeric value for plant.m4.f1")
    assert rows[1].reason is None and rows[1].fields_pairs[0].text == '"4"'


def test_schema_set():
    later = MeasurementSchema("boiler", {"z": FieldType.FLOAT}, (), "plant")
    both = SchemaSet([SCHEMA, later])
    assert both.get("plant", "boiler") is later and len(both) == 1
    with pytest.raises(ValueError):
        SchemaSet([MeasurementSchema("m", {})])
    assert SchemaSet([MeasurementSchema("m", {})], "db").get("db", "m") is not None
    with pytest.raises(ValueError):
        MeasurementSchema("m", {"a": "float"})


def test_modes(spark):
    points = point(spark, {"cycles": 1}).unionByName(point(spark, {"cycles": "many"}))
    good, rejects = validate.parse_points(points, [SCHEMA])
    assert (good.count(), rejects.count()) == (1, 1)
    assert "reason" not in good.columns
    with pytest.raises(Exception, match="Expected numeric value"):
        validate.parse_points(points, [SCHEMA], mode="fail").collect()
    assert validate.parse_points(point(spark, {"cycles": 1}), [SCHEMA], mode="fail").count() == 1


def test_timestamps(spark):
    time_ns = 1_987_654_321_999_999_999
    df = spark.createDataFrame(
        [(time_ns, None), (None, "77"), (None, "noon"), (-1, None)], "time_ns bigint, raw_time string"
    )
    casted, reason = validate.cast_timestamp(df, "s")
    rows = df.select(casted.alias("c"), reason.alias("r")).collect()
    assert [r.c for r in rows] == [str(time_ns // 10**9), "77", "noon", "-1"]
    assert [r.r for r in rows] == [None, None, "Expected numeric value for timestamp, but got 'noon'", None]


@pytest.mark.parametrize("array_files", [True, False])
def test_json_points(spark, tmp_path, array_files):
    path = tmp_path / "points.json"
    points = rain_points()
    path.write_text(
        json.dumps(points) if array_files else "\n".join(json.dumps(p) for p in points)
    )
    read = read_points_json(spark, str(path), "s", "weather", array_files=array_files)
    assert read.count() == len(points)
    good, rejects = validate.parse_points(read, [RAIN, PROBES], "s")
    assert rejects.count() == 0
    got = {
        (r.measurement, r.tags["basin"], r.time_ns): ([tuple(p) for p in r.fields_pairs], r.casted_timestamp)
        for r in good.collect()
    }
    assert got["rain", "lower", (RAIN_START_S + 900) * 10**9] == (
        [("depth", "0.625"), ("kind of day", '"wet"')], str(RAIN_START_S + 900)
    )
    assert got["probes", "upper", (RAIN_START_S + 120) * 10**9] == ([("reads", "7i")], str(RAIN_START_S + 120))


def test_json_kinds(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(
        '{"measurement":"m","fields":{"a":1.5,"b":2,"c":"2","d":true,"e":null,"g":[1]},'
        '"timestamp":5}\n{"measurement":"m","timestamp":"soon"}\nnot json\n{"measurement":"m"}'
    )
    rows = validate.check_points(read_points_json(spark, str(path))).collect()
    by_reason = {r.reason: r for r in rows}
    assert set(by_reason) == {
        "Unsupported value for m.g",
        "Expected numeric value for timestamp, but got 'soon'",
        "Missing measurement",
        None,
    }
    first = by_reason["Unsupported value for m.g"]
    assert [tuple(p) for p in first.fields_pairs] == [
        ("a", "1.5"), ("b", "2"), ("c", '"2"'), ("d", "true"),
    ]
    assert first.time_ns == 5


def test_wide_table(spark):
    df = spark.createDataFrame(
        [
            ("b7", "4", 0.5, False, 31, None, 1_000),
            ("b7", "many", 0.5, False, 31, None, 2_000),
            (None, "4", float("nan"), False, 31, None, 3_000),
            ("b7", None, None, None, None, "extra", 4_000),
        ],
        "unit string, cycles string, heat double, open boolean, note bigint, more string, time_ns bigint",
    )
    rows = (
        validate.check_table(df, SCHEMA, "u", fields=["cycles", "heat", "open", "note", "more"], tags=["unit"])
        .orderBy("time_ns")
        .collect()
    )
    assert [tuple(p) for p in rows[0].fields_pairs] == [
        ("cycles", "4i"), ("heat", "0.5"), ("note", '"31"'), ("open", "F"),
    ]
    assert (rows[0].tags_names, rows[0].casted_timestamp) == (["unit"], "1")
    assert rows[1].reason == "Expected numeric value for plant.boiler.cycles, but got 'many'"
    assert "boiler.heat" in rows[2].reason and rows[2].tags_names == []
    assert rows[3].reason == "Extraneous fields in plant.boiler: `more`"


def test_wide_and_map_forms_agree(spark):
    from pointlake.sources.tables import to_point_form

    df = spark.createDataFrame(
        [("a", 7, 1.5, True, "q\"\\x", 1), ("b c", -3, -0.25, False, "", 2), (None, None, 1e22, None, "o\\'k", None)],
        "unit string, cycles bigint, heat double, open boolean, note string, time_ns bigint",
    )
    wide = validate.check_table(df, SCHEMA)
    mapped = validate.check_points(to_point_form(df, SCHEMA, db="plant"), [SCHEMA])
    names = ["fields_pairs", "tags_names", "casted_timestamp", "reason"]
    order = F.col("casted_timestamp").asc_nulls_last()
    assert wide.select(names).orderBy(order).collect() == mapped.select(names).orderBy(order).collect()
