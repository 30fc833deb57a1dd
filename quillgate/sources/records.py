"""Profile CSV, JSON lines in strict and tolerant form, append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from quillgate import schemas
from quillgate.functions import text, validation as val
from quillgate.sources import positions


# -- profiles ----------------------------------------------------------------


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profile CSV with header; columns are found by their header name."""
    names = schemas.PROFILE_CSV_COLUMNS
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return raw.select(*[
        F.col(csv_name).cast(f.dataType).alias(f.name)
        for csv_name, f in zip(names, schemas.PROFILES.fields)
    ])


# -- JSON lines --------------------------------------------------------------


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict reader: a broken line fails the job, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def located_errors(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file, line, index, reason, value`` of every line that ``schema`` does
    not hold for: no JSON object, or fields of another type (named).

    ``line`` counts from 1 within the file, ``index`` from 0 over all files.
    Blank lines are counted but are no errors; an absent or null field is none
    either.
    """
    lines = positions.located_lines(spark, path)
    mark = "_corrupt_record"
    while mark in schema.fieldNames():
        mark += "_"
    whole = T.StructType([*schema.fields, T.StructField(mark, T.StringType())])
    parsed = lines.withColumns({
        "_text": text.strip(F.col("value")),
        "_row": F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": mark}),
    }).withColumn("_v", val.parse_exact(F.col("_text")))
    wrong = F.array_compact(F.array(F.lit(None).cast("string"), *[
        F.when(val.has_member(F.col("_v"), f.name) & F.col("_row").getField(f.name).isNull(), F.lit(f.name))
        for f in schema.fields
    ]))
    reason = F.when(~val.is_object(F.col("_v")), F.lit(MALFORMED)).when(
        F.col("_row").getField(mark).isNotNull(), F.concat_ws(": ", F.lit(WRONG_TYPE), F.nullif(F.array_join(wrong, ", "), F.lit("")))
    )
    return parsed.withColumn("reason", reason).filter(
        (F.col("_text") != "") & F.col("reason").isNotNull()
    ).select("file", (F.col("line") + 1).alias("line"), "index", "reason", "value")


def read_jsonl_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict reader whose error names file, line, reason and text of the first
    broken line."""
    bad = located_errors(spark, path, schema).orderBy("index").limit(1).collect()
    for b in bad:
        raise ValueError(f"{b['file']}, line {b['line']}: {b['reason']}: {b['value']}")
    return read_jsonl(spark, path, schema)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their 0-based ``index`` over the files in name order."""
    return positions.located_lines(spark, path).select("index", "value")


MALFORMED = "not a JSON object"
WRONG_TYPE = "wrong type"


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Tolerant parse: ``_v`` (VARIANT), ``_malformed`` and ``_error``.

    Every line keeps its row, blank ones included: a blank line is malformed.
    """
    parsed = lines.withColumn("_v", val.parse_exact(text.strip(F.col(value))))
    bad = ~val.is_object(F.col("_v"))
    return parsed.withColumn("_malformed", bad).withColumn(
        "_error", F.when(bad, F.lit(MALFORMED))
    )


def read_jsonl_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """``index, value, _v, _malformed, _error`` for every line of the files."""
    return parse_lines(numbered_lines(spark, path))


def drop_internal(df: DataFrame) -> DataFrame:
    """Without the ``_``-prefixed tracking columns."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def json_line(df: DataFrame) -> Column:
    """One JSON text per row, nulls kept, internal columns left out."""
    return F.to_json(
        F.struct(*[c for c in df.columns if not c.startswith("_")]), {"ignoreNullFields": "false"}
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write JSON lines, nulls kept.  Never point it at a path ``df`` reads:
    write to a new one and switch readers to it through the run table."""
    drop_internal(df).write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, mode="append")


def write_split(gated: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Passed and failed records in one write, under ``verdict=passed`` and
    ``verdict=failed``.  The verdict also stays inside ``evaluation``."""
    verdict = F.when(F.col("evaluation.overall_pass"), "passed").otherwise("failed")
    writer = gated.withColumn("verdict", verdict).write.mode("overwrite").partitionBy("verdict")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)


# -- tables ------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Append-only parquet table; empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return conform(spark.range(0).drop("id"), schema)


def read_tables(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The rows of several tables that are there."""
    if not paths:
        return conform(spark.range(0).drop("id"), schema)
    return spark.read.schema(schema).parquet(*paths)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; missing ones become null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def append_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)
