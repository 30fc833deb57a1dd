import pytest
from pyspark.sql import functions as F

from quillgate.functions import validation as val
from quillgate.operators import extraction, repair


def check(spark, value):
    df = spark.createDataFrame([(value,)], "j string").select(val.parse_exact(F.col("j")).alias("v"))
    row = df.select(
        val.is_valid_output(F.col("v")).alias("ok"), val.structured_output(F.col("v")).alias("o")
    ).first()
    return bool(row["ok"]), row["o"]


@pytest.mark.parametrize("value, ok", [
    ('{"normal_statements":["a"],"schedule":"s"}', True),
    ('  {"normal_statements":[],"schedule":""}\n', True),
    ('{"normal_statements":["a"],"schedule":"s","more":{"x":[1]}}', True),
    ('{"normal_statements":[1],"schedule":"s"}', False),
    ('{"normal_statements":["a"],"schedule":5}', False),
    ('{"normal_statements":["a",null],"schedule":"s"}', False),
    ('{"normal_statements":[null],"schedule":"s"}', False),
    ('{"normal_statements":["a"],"schedule":null}', False),
    ('{"normal_statements":["a"]}', False),
    ('{"schedule":"s"}', False),
    ('{"normal_statements":"a","schedule":"s"}', False),
    ('{"normal_statements":[["a"]],"schedule":"s"}', False),
    ('{"normal_statements":["a",1],"schedule":"s"}', False),
    ('[{"normal_statements":["a"],"schedule":"s"}]', False),
    ('{"normal_statements":["a"],"schedule":"s"} done', False),
    ('{"normal_statements":["a"],"schedule":"s"}{}', False),
    ('{"normal_statements":["a"],"schedule":"s"}],[1', False),
    ('{"normal_statements":["a"],"schedule":"s"', False),
    ("not json", False), ("[]", False), ("", False), ("null", False), (None, False),
])
def test_strict_output(spark, value, ok):
    assert check(spark, value)[0] is ok
    assert (check(spark, value)[1] is not None) is ok


def test_last_of_equal_keys_wins(spark):
    _, out = check(spark, '{"schedule":"a","normal_statements":["x"],"schedule":"b"}')
    assert out["schedule"] == "b"


def test_absent_is_not_null(spark):
    df = spark.createDataFrame([('{"a":null}',)], "j string").select(val.parse_exact(F.col("j")).alias("v"))
    row = df.select(val.has_field(F.col("v"), "a"), val.has_field(F.col("v"), "b")).first()
    assert tuple(row) == (True, False)


@pytest.mark.parametrize("value, missing", [
    ("null", True), ("{}", True), ("[]", True), ('""', True), ("0", True), ("false", True),
    ('{"a":1}', False), ('"x"', False), ("1", False), ("true", False),
])
def test_missing_output(spark, value, missing):
    df = spark.createDataFrame([(value,)], "j string").select(val.parse_exact(F.col("j")).alias("v"))
    assert df.select(val.is_missing_output(F.col("v"))).first()[0] is missing


@pytest.mark.parametrize("line, issue", [
    ('{"structured_output":{}}', "missing_utterance"),
    ('{"utterance":"u"}', "missing_structured_output"),
    ('{"utterance":"u","structured_output":null}', "missing_structured_output"),
    ('{"utterance":"u","structured_output":"no json"}', "structured_output_not_json"),
    ('{"utterance":"u","structured_output":""}', "structured_output_not_json"),
    ('{"utterance":"u","structured_output":"null"}', "missing_structured_output"),
    ('{"utterance":"u","structured_output":{}}', "invalid_structured_output"),
    ('{"utterance":"u","structured_output":5}', "invalid_structured_output"),
    ('{"utterance":"u","structured_output":{"normal_statements":[],"schedule":""}}', "incomplete_status"),
    ('{"utterance":"u","structured_status":"failed","structured_output":{"normal_statements":[],"schedule":""}}',
     "incomplete_status"),
    ('{"utterance":"u","structured_status":"completed","structured_output":{"normal_statements":[],"schedule":""}}',
     None),
    ('{"utterance":null,"structured_status":"completed","structured_output":'
     '"{\\"normal_statements\\":[],\\"schedule\\":\\"\\"}"}', None),
])
def test_structured_issue(spark, line, issue):
    df = spark.createDataFrame([(line,)], "j string").select(val.parse_exact(F.col("j")).alias("_v"))
    assert repair.classify_structured(df).first()["issue"] == issue


def test_attach_structured_keeps_the_backend_error(spark):
    df = spark.createDataFrame(
        [("a", '{"normal_statements":["x"],"schedule":""}', None), ("b", None, "timeout"), ("c", "{", None)],
        "record_id string, raw string, error string",
    )
    got = {
        r["record_id"]: (r["structured_status"], r["structured_error"])
        for r in extraction.attach_structured(df, "raw", "error").collect()
    }
    assert got == {
        "a": ("completed", None), "b": ("failed", "timeout"), "c": ("failed", extraction.INVALID),
    }
