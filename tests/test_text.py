"""Text helpers against what a script would do, row by row."""

import pytest
from pyspark.sql import functions as F

from quillgate.functions import text

FENCE = "```"
SPACES = ["\t", "  ", chr(0xA0), chr(0x2028), chr(0x3000), chr(0x85), chr(0x1C), "\n", "\r\n", ""]


def evaluate(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v"))).collect())]


def padded():
    return [f"{a}one{b}two three{a}{b}" for a in SPACES for b in SPACES] + list(SPACES)


def test_strip(spark):
    values = padded()
    assert evaluate(spark, text.strip, values) == [v.strip() for v in values]


def test_word_count(spark):
    values = padded()
    assert evaluate(spark, text.word_count, values) == [len(v.split()) for v in values]


def test_has_line_end(spark):
    values = padded()
    want = [len(v.splitlines()) > 1 or bool(v.splitlines() and v != v.splitlines()[0]) for v in values]
    assert evaluate(spark, text.has_line_end, values) == want


def defence(raw):
    """The rule in script form."""
    body = raw.strip()
    if not body.startswith(FENCE):
        return body
    lines = body.splitlines()[1:]
    while lines and lines[-1].strip().startswith(FENCE):
        lines = lines[:-1]
    return "\n".join(lines).strip()


def test_fences(spark):
    obj = '{"a": 1}'
    values = [
        obj,
        f"{FENCE}json\n{obj}\n{FENCE}",
        f"{FENCE}\n{obj}\n{FENCE}",
        f"{FENCE}json\n{obj}\n{FENCE}\n{FENCE}",
        f"{FENCE}{obj}{FENCE}",
        f"{FENCE}json\n{obj}\n   {FENCE}",
        f"{FENCE}json\n{obj}",
        f"{FENCE}\n{FENCE}",
        FENCE,
        f"{obj}\n{FENCE}",
        f"{FENCE}json\n{obj}\n\n{FENCE}",
        f"{FENCE}json\n{obj}\n{FENCE}\n\n{FENCE}",
        f"{FENCE}json\r\n{obj}\r\n{FENCE}\r\n",
        f'{FENCE}json\n{{"a": "{FENCE} in text"}}\n{FENCE}',
        f"Here it is:\n{FENCE}json\n{obj}\n{FENCE}",
        f"{FENCE}json\n{obj}{chr(0x2028)}more\x0bend\x1c{FENCE}",
        "\n".join([FENCE, obj] + [FENCE] * 5000),
        "",
        "   ",
    ]
    assert evaluate(spark, text.strip_fences, values) == [defence(v) for v in values]


@pytest.mark.parametrize("answer, passes", [
    ("YES", True), (" yes.", True), ("Yesterday", True), ("**YES**", False), ("NO", False),
    ("", False), (None, False), (chr(0xA0) + "Yes", True),
])
def test_verdict(spark, answer, passes):
    assert evaluate(spark, text.is_yes, [answer]) == [passes]


@pytest.mark.parametrize("error, kind", [
    ("Timeout: 429", "timeout"), ("request timed out", "timeout"), ("401 after rate limit", "auth"),
    ("Unauthorized", "auth"), ("HTTP 429", "rate_limit"), ("Rate Limit", "rate_limit"),
    ("no such model", "fatal"), ("", "fatal"), (None, None),
])
def test_error_class(spark, error, kind):
    assert evaluate(spark, text.error_class, [error]) == [kind]


def test_record_id_is_not_cut(spark):
    got = spark.range(1).select(
        text.record_id(F.lit(0)).alias("a"), text.record_id(F.lit(1234566)).alias("b")
    ).first()
    assert tuple(got) == ("rule-000001", "rule-1234567")
