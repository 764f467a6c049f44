"""Raw records: what fits a schema, parsed once on reading or at landing."""

import json

import pytest
from pyspark.sql import types as T

from sparkmart.sources import land_raw, parse_raw, read_raw, with_record, write_parquet


def fits(spark, kind, texts, name="a"):
    schema = T.StructType().add(name, kind)
    raw = spark.createDataFrame([(text, n) for n, text in enumerate(texts)], "payload string, n int")
    rows = {row["n"]: row for row in parse_raw(raw, schema).collect()}
    return [rows[n][name] if rows[n]["fits"] else "no" for n in range(len(texts))]


@pytest.mark.parametrize(
    "kind, cases",
    [
        (T.DoubleType(), {"1": 1.0, "-2.5e3": -2500.0, "null": None, '"NaN"': "no", '"Infinity"': "no",
                          "1e999": "no", "-1e999": "no", '"1"': "no", "true": "no", "[1]": "no", "0.1": 0.1}),
        (T.FloatType(), {"1.5": 1.5, "1e300": "no"}),
        (T.LongType(), {"5": 5, "9223372036854775807": 2**63 - 1, "9223372036854775808": "no",
                        "1.5": "no", "1e3": "no", '"5"': "no"}),
        (T.IntegerType(), {"5": 5, "2147483648": "no"}),
        (T.DecimalType(4, 1), {"12.5": 12.5, "12345": "no", '"1"': "no"}),
        (T.BooleanType(), {"true": True, "1": "no", '"true"': "no"}),
        (T.StringType(), {'"x"': "x", "1": "no", '"NaN"': "NaN", '""': "", "{}": "no", "null": None}),
        (T.DateType(), {'"2024-02-29"': "2024-02-29", '"2024-02-30"': "no", "20240229": "no"}),
        (T.ArrayType(T.LongType()), {"[1, null]": [1, None], '[1, "2"]': "no", "{}": "no", "[]": []}),
        (T.MapType(T.StringType(), T.LongType()), {'{"x": 1}': {"x": 1}, '{"x": "1"}': "no", "[]": "no"}),
        (T.StructType().add("b", T.LongType()), {'{"b": 1, "c": "x"}': (1,), '{"B": 1}': "no", '{"b": 1.5}': "no"}),
    ],
)
def test_values(spark, kind, cases):
    found = fits(spark, kind, [f'{{"a": {text}}}' for text in cases])
    plain = [
        tuple(v) if isinstance(v, tuple) else v if isinstance(v, (str, bool, list, dict, type(None))) else
        str(v) if isinstance(kind, T.DateType) else float(v) if not isinstance(v, int) else v
        for v in found
    ]
    assert plain == list(cases.values())


def test_whole_objects_only(spark):
    good = ['{"a":1,"A":"other"}', '{"a": 1}', ' {"a": 1}\n', '{"a":1,"z":{"a":"b"}}', "{}"]
    bad = [
        '{"A": 5}', '{"a": 1} rest', '{"a": 1}{"a": 2}', '{"a": 1}, {"a": 2}', '{"a": 1}]', '{"a": 1}}',
        '{"a":1},"seal":1}', '{"a":1},"seal":0} rest', '[{"a": 1}]', "1", '"a"', "null", "", " ", None, "{", "nonsense",
        '{"a":1,"a":2}',
    ]
    found = fits(spark, T.LongType(), good + bad)
    assert found == [1, 1, 1, 1, None] + ["no"] * len(bad)


@pytest.mark.parametrize("name", ["it's", 'say "x"', "it's \"x\"", "a.b", "a b", "[0]", "é", "$"])
def test_names_are_taken_as_they_are(spark, name):
    assert fits(spark, T.LongType(), [json.dumps({name: 7}), json.dumps({name: "7"})], name) == [7, "no"]


def test_records_parsed_at_landing(spark, tmp_path, plan_of):
    df = spark.createDataFrame([(1, "x", 0.5), (2, None, None)], "id long, word string, size double")
    landed = write_parquet(with_record(land_raw(df)), str(tmp_path / "raw"))
    typed, quarantine = read_raw(landed, df.schema)
    assert "parse_json" not in plan_of(typed, "extended").lower()
    assert sorted(tuple(r) for r in typed.collect()) == [(1, "x", 0.5), (2, None, None)]
    assert quarantine.columns == landed.columns and quarantine.count() == 0
    other, refused = read_raw(landed, T.StructType().add("word", T.LongType()))
    assert (other.count(), refused.count()) == (1, 1)


def test_the_text_is_parsed_once(spark, plan_of):
    raw = spark.range(3).selectExpr("cast(id as string) as payload")
    schema = T.StructType().add("a", T.StringType()).add("b", T.DoubleType()).add("c", T.LongType())
    plan = plan_of(parse_raw(raw, schema).where("fits and a > 'x'"), "simple")
    assert plan.count("parseJson") == 1
