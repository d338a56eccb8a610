import json

import pytest
from pyspark.sql import functions as F

from pointlake.functions import text

PLAIN = ["", "z", "Grüße", "tab\there", "semi;colon", 'say "x"', "back\\slash", "it's"]


def spelt(value, specials):
    return "".join("\\" + c if c in specials else c for c in value)


def around(specials):
    """Every special character alone, doubled, at either end and between letters."""
    out = list(PLAIN)
    for c in specials:
        out += [c, c + c, c + "w", "w" + c, f"u{c}v{c}w"]
    return [*out, "".join(specials) + "end" + "".join(reversed(specials))]


def applied(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


@pytest.mark.parametrize("function, specials", [(text.escape_tag, ",= "), (text.escape_measurement, ", ")])
def test_names(spark, function, specials):
    values = around(specials)
    assert applied(spark, function, values) == [spelt(v, specials) for v in values]


def test_strings(spark):
    values = [v for v in around('"') if "\\" not in v]
    assert applied(spark, text.quote, values) == ['"' + spelt(v, '"') + '"' for v in values]


def test_json_inside_a_string(spark):
    inner = json.dumps({"unit": "kPa", "of": ["a b", 'c"d']})
    (quoted,) = applied(spark, text.quote, [inner])
    assert quoted[0] == quoted[-1] == '"'
    assert applied(spark, text.unquote, [quoted[1:-1]]) == [inner]


def test_a_quote_behind_a_backslash(spark):
    assert applied(spark, text.escape_tag, ["o\\'k o\\'k"]) == ["o\\\\'k\\ o\\'k"]


def test_unescape_inverts_escape(spark):
    values = [*around(",= "), *around('"'), 'both\\"', "tail\\"]
    assert applied(spark, lambda c: text.unescape_name(text.escape_tag(c)), values) == values
    inner = applied(
        spark,
        lambda c: text.unquote(F.substring(text.quote(c), F.lit(2), F.length(text.quote(c)) - 2)),
        values,
    )
    assert inner == values


def test_numbers(spark):
    cases = [
        (0.0, "0"), (-0.0, "0"), (17.0, "17"), (-250.0, "-250"), (-2.75, "-2.75"), (0.3, "0.3"), (0.002, "0.002"),
        (4.56e-4, "0.000456"), (7.125e-6, "0.000007125"), (3e-7, "3e-7"), (87654321.5, "87654321.5"),
        (2e7, "20000000"), (2.0**53, "9007199254740992"), (3e20, "300000000000000000000"),
        (3e21, "3e+21"), (2.5e301, "2.5e+301"), (float("nan"), None), (float("-inf"), None),
    ]
    got = applied(spark, text.number_text, [c[0] for c in cases], "double")
    assert got == [c[1] for c in cases]


def test_numeric_text(spark):
    yes = ["17", "-2.75", "+6", ".25", "8.", "3e4", " 9 ", "0.500"]
    no = ["", "0xff", "4d", "2f", "nan", "Infinity", "seven", "3 4", "++2"]
    assert applied(spark, text.is_numeric_text, yes + no) == [True] * 8 + [False] * 9
