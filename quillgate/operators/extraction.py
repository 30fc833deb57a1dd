"""From raw completions to checked structured output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillgate.functions import text, validation as val

COMPLETED, FAILED = "completed", "failed"
INVALID = "response is not a valid structured output"


def parse_completion(raw: Column) -> Column:
    """Variant of a completion after fence removal, null when not JSON."""
    return val.parse_exact(text.strip_fences(raw))


def attach_structured(df: DataFrame, raw: str, error: str | None = None) -> DataFrame:
    """Add ``structured_output``, ``structured_status``, ``structured_error``."""
    parsed = df.withColumn("_v", parse_completion(F.col(raw)))
    out = parsed.withColumn("structured_output", val.structured_output(F.col("_v"))).drop("_v")
    ok = F.col("structured_output").isNotNull()
    why = F.lit(INVALID)
    if error:
        why = F.coalesce(F.col(error), why)
    return out.withColumn(
        "structured_status", F.when(ok, F.lit(COMPLETED)).otherwise(F.lit(FAILED))
    ).withColumn("structured_error", F.when(~ok, why))


def output_value(value: Column) -> Column:
    """``structured_output`` of a record, where JSON text in a string is parsed.

    Null when the field is absent or its text is not JSON.
    """
    raw = val.field(value, "structured_output")
    inner = val.text_field(value, "structured_output")
    return F.when(inner.isNotNull(), val.parse_exact(text.strip(inner))).otherwise(raw)


def output_is_bad_text(value: Column) -> Column:
    """A string in ``structured_output`` that is not JSON."""
    inner = val.text_field(value, "structured_output")
    return inner.isNotNull() & val.parse_exact(text.strip(inner)).isNull()
