"""Declared schemas of every table the engine reads or writes."""

from pyspark.sql import types as T

PROFILES = T.StructType([
    T.StructField("profile_id", T.LongType()),
    T.StructField("profile_name", T.StringType()),
    T.StructField("generated_description", T.StringType()),
])

#: header names of the profile CSV, in order (fixed values)
PROFILE_CSV_COLUMNS = ["PROFILE_ID", "PROFILE_NAME", "GENERATED_DESCRIPTION"]

PLAN = T.StructType([
    T.StructField("index", T.LongType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("complexity", T.StringType()),
])

KPI = T.StructType([
    T.StructField("profile_id", T.LongType()),
    T.StructField("profile_name", T.StringType()),
    T.StructField("description", T.StringType()),
])

REPAIR_ENTRY = T.StructType([
    T.StructField("repaired_at", T.TimestampNTZType()),
    T.StructField("reason", T.StringType()),
])

UTTERANCES = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("utterance", T.StringType()),
    T.StructField("kpis_used", T.ArrayType(KPI)),
    T.StructField("complexity", T.StringType()),
    T.StructField("tone", T.StringType()),
    T.StructField("num_kpis", T.IntegerType()),
    T.StructField("processed", T.StringType()),
    T.StructField("repair_history", T.ArrayType(REPAIR_ENTRY)),
])

STRUCTURED_OUTPUT = T.StructType([
    T.StructField("normal_statements", T.ArrayType(T.StringType())),
    T.StructField("schedule", T.StringType()),
])

STRUCTURED = T.StructType(UTTERANCES.fields + [
    T.StructField("structured_output", STRUCTURED_OUTPUT),
    T.StructField("structured_status", T.StringType()),
    T.StructField("structured_error", T.StringType()),
])

METRIC = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("reason", T.StringType()),
])


def evaluations(metrics: list[str]) -> T.StructType:
    """Evaluation table of records that are scored by these metrics."""
    return T.StructType([
        T.StructField("record_id", T.StringType()),
        T.StructField("metric_results", T.StructType([T.StructField(m, METRIC) for m in metrics])),
        T.StructField("overall_score", T.DoubleType()),
        T.StructField("overall_pass", T.BooleanType()),
        T.StructField("evaluated_at", T.TimestampNTZType()),
    ])


EVALUATIONS = evaluations(["schema", "faithfulness", "schedule"])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])

#: one row per model call; rows without an error are the completion cache
ATTEMPTS = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("endpoint", T.IntegerType()),
    T.StructField("response", T.StringType()),
    T.StructField("error", T.StringType()),
])

PLAN_STATUS = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("index", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("stage", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("thresholds", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("started_at", T.TimestampNTZType()),
    # the folder of the tables that this commit adds
    T.StructField("batch", T.StringType()),
    # earlier commits of the output no longer count; what stays of them is listed in ``carried``
    T.StructField("replaces", T.BooleanType()),
    # the commit counts once that commit of another store is there too
    T.StructField("needs", T.StructType([
        T.StructField("store", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("batch", T.StringType()),
    ])),
])

#: files of earlier commits that a replacing one carries over
CARRIED = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
])

REPAIR_AUDIT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("repaired_at", T.TimestampNTZType()),
    T.StructField("records_analyzed", T.LongType()),
    T.StructField("records_repaired", T.LongType()),
    T.StructField("records_failed", T.LongType()),
    T.StructField("issues_by_type", T.MapType(T.StringType(), T.LongType())),
])
