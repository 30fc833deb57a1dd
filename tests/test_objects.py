"""Merging JSON objects that hold undeclared members."""

import json

import pytest
from pyspark.sql import functions as F

from quillgate.functions import objects

NEW = {"b": ["x", None], "z": "é\"\n"}


def merged(spark, text, drop=None):
    df = spark.createDataFrame([(text, ["x", None], "é\"\n")], "t string, b array<string>, z string")
    return df.select(objects.merge_object(F.col("t"), {"b": F.col("b"), "z": F.col("z")}, drop)).first()[0]


@pytest.mark.parametrize("text", [
    '{"a":1,"b":2,"c":{"y":[1,null,{"q":true}],"x":-0.25},"d":"5"}', '{"z":0,"a":null,"b":{},"deep":{"z":1}}', "{}",
    '{"k\\"ey":"v\\\\","ü":[],"":1e2,"long":12345678901234567890,"f":1.10}', ' {"b" : 1 , "a" : [ ] } ',
    '{"a":1,"b":0,"a":{"last":true}}', '{"b":1,"b":2}', '{"null":null,"false":false,"s":"null"}',
])
def test_members_keep_value_and_order(spark, text):
    want = json.loads(text)
    want.update(NEW)
    got = merged(spark, text)
    assert json.loads(got) == want and list(json.loads(got)) == list(want)


@pytest.mark.parametrize("text", [None, "", "{", "5", "[1]", '{"a":1} x', '{"a":1}{"a":2}', "null", '"{}"'])
def test_other_texts_are_empty_objects(spark, text):
    assert json.loads(merged(spark, text)) == NEW


def test_dropped_members(spark):
    got = merged(spark, '{"a":1,"gone":2,"c":3}', ["gone", "none"])
    assert list(json.loads(got).items()) == [("a", 1), ("c", 3), *NEW.items()]


def test_nulls_and_nested_values(spark):
    df = spark.createDataFrame([('{"a":1,"n":5}',)], "t string")
    at = F.struct(F.lit(None).cast("string").alias("x"), F.array(F.lit(1.5)).alias("y"))
    got = df.select(objects.merge_object(F.col("t"), {"n": F.lit(None).cast("long"), "s": at})).first()[0]
    assert json.loads(got) == {"a": 1, "n": None, "s": {"x": None, "y": [1.5]}}
