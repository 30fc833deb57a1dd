"""How the test tables become inputs of the operators.

Text that both engines must build alike is given once as an SQL expression
(``*_SQL``).  It uses only functions the two engines share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillgate.functions import text
from quillgate.operators import evaluation


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def quoted(x: str) -> str:
    """SQL that renders a text as a JSON string (line feed, quote, backslash)."""
    return (
        f"(chr(34) || replace(replace(replace({x}, chr(92), chr(92) || chr(92)), "
        f"chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n') || chr(34))"
    )


COMPLEXITY_SQL = "case doc_id % 3 when 0 then 'simple' when 1 then 'medium' else 'complex' end"

#: a valid structured output as JSON text; wants sj (statements) and schedule
OUTPUT_SQL = f"""('{{"normal_statements":' || sj || ',"schedule":' || {quoted('schedule')} || '}}')"""

#: raw completion: broken, wrongly typed, incomplete, decorated or fenced
COMPLETION_BODY_SQL = f"""(case
  when doc_id % 7 = 0 then substr({OUTPUT_SQL}, 1, length({OUTPUT_SQL}) - 1)
  when doc_id % 9 = 0 then '{{"normal_statements":' || sj || ',"schedule":5}}'
  when doc_id % 15 = 1 then '{{"normal_statements":["a",null],"schedule":""}}'
  when doc_id % 15 = 2 then '{{"normal_statements":[1,"a"],"schedule":""}}'
  when doc_id % 15 = 4 then '{{"schedule":' || {quoted('schedule')} || '}}'
  when doc_id % 15 = 7 then {OUTPUT_SQL} || ' Done.'
  when doc_id % 15 = 8 then '[' || {OUTPUT_SQL} || ']'
  when doc_id % 5 = 0 then '{{"note":{{"a":[1]}},"normal_statements":' || sj || ',"schedule":' || {quoted('schedule')} || '}}'
  else {OUTPUT_SQL} end)"""

FENCE_SQL = "(chr(96) || chr(96) || chr(96))"

COMPLETION_SQL = f"""(case
  when doc_id % 8 = 0 then {FENCE_SQL} || 'json' || chr(10) || {COMPLETION_BODY_SQL} || chr(10) || {FENCE_SQL}
  when doc_id % 8 = 4 then chr(10) || {FENCE_SQL} || chr(10) || {COMPLETION_BODY_SQL} || chr(10) || {FENCE_SQL} || chr(10) || '  ' || {FENCE_SQL} || ' '
  when doc_id % 8 = 6 then {COMPLETION_BODY_SQL} || chr(10) || {FENCE_SQL}
  when doc_id % 8 = 7 then '  ' || {COMPLETION_BODY_SQL} || chr(10)
  else {COMPLETION_BODY_SQL} end)"""

#: one line of an utterance file, some of them damaged
LINE_SQL = f"""(case
  when doc_id % 53 = 0 then ''
  when doc_id % 29 = 0 then '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')}
  when doc_id % 31 = 0 then '{{"record_id":' || {quoted('record_id')} || ',"kpis_used":[],"complexity":' || {quoted('complexity')} || '}}'
  when doc_id % 37 = 0 then '{{"record_id":' || {quoted('record_id')} || ',"utterance":null,"kpis_used":[]}}'
  when doc_id % 37 = 1 then '{{"record_id":' || {quoted('record_id')} || ',"utterance":"  ' || chr(92) || 'n "}}'
  when doc_id % 41 = 0 then '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')} || ',"complexity":' || {quoted('complexity')} || '}}'
  when doc_id % 41 = 1 then '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')} || ',"kpis_used":null,"complexity":null}}'
  when doc_id % 43 = 0 then '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')} || ',"kpis_used":[]}}'
  when doc_id % 47 = 0 then '{{"utterance":' || {quoted('text')} || '}}'
  else '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')} || ',"kpis_used":[],"complexity":' || {quoted('complexity')} || '}}'
  end)"""

#: the same with two fields of another type than declared
TYPED_LINE_SQL = f"""(case
  when doc_id % 7 = 3 then replace({LINE_SQL}, '"kpis_used":[]', '"kpis_used":7')
  when doc_id % 7 = 5 then replace({LINE_SQL}, '"kpis_used":[]', '"num_kpis":"many","kpis_used":{{}}')
  else {LINE_SQL} end)"""

#: one line of a structured file, some of them incomplete
STRUCTURED_LINE_SQL = f"""(case
  when doc_id % 31 = 0 then '{{"record_id":' || {quoted('record_id')} || ',"structured_output":' || {OUTPUT_SQL} || ',"structured_status":"completed"}}'
  else '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')}
    || (case
      when doc_id % 13 = 0 then ''
      when doc_id % 13 = 1 then ',"structured_output":null'
      when doc_id % 17 = 0 then ',"structured_output":' || {quoted(OUTPUT_SQL)}
      when doc_id % 17 = 1 then ',"structured_output":' || {quoted("(" + OUTPUT_SQL + " || ',')")}
      when doc_id % 19 = 0 then ',"structured_output":{{"normal_statements":' || sj || '}}'
      when doc_id % 19 = 1 then ',"structured_output":[]'
      else ',"structured_output":' || {OUTPUT_SQL} end)
    || (case when doc_id % 11 = 0 then '' when doc_id % 11 = 1 then ',"structured_status":"failed"'
      else ',"structured_status":"completed"' end) || '}}' end)"""

#: one line with members that nobody declares, some of them broken
OPEN_LINE_SQL = f"""(case
  when doc_id % 7 = 0 then '{{"extra":' || doc_id
  when doc_id % 5 = 0 then '{{"complexity":null,"zeta":{{"n":' || doc_id || ',"list":[null,true]}},"gone":1,"utterance":' || {quoted('text')} || '}}'
  when doc_id % 3 = 0 then '{{"utterance":[],"gone":[{{}}],"alpha":"' || doc_id || '"}}'
  else '{{"record_id":' || {quoted('record_id')} || ',"utterance":' || {quoted('text')} || ',"tail":[' || doc_id || ',-0.5]}}' end)"""

#: structured output text that may be missing, empty or incomplete
MAYBE_OUTPUT_SQL = f"""(case
  when doc_id % 13 = 0 then 'null'
  when doc_id % 17 = 0 then '{{}}'
  when doc_id % 19 = 0 then '{{"normal_statements":' || sj || '}}'
  else {OUTPUT_SQL} end)"""

#: judge answers of a labelled document
FAITHFUL_SQL = """(case
  when quality = 1 and doc_id % 4 = 0 then 'YES'
  when quality = 1 and doc_id % 4 = 1 then ' yes, all rules are covered. '
  when quality = 1 then 'Yes: complete'
  when doc_id % 3 = 0 then 'NO'
  when doc_id % 3 = 1 then '**YES** with gaps'
  else 'no, some rules are missing' end)"""
TIMING_SQL = "(case when toxic = 1 then 'NO: the schedule names a segment' else 'YES' end)"

#: attempt log of the events: eight events make one request
REQUEST_SQL = "(event_id - event_id % 8)"
ENDPOINT_SQL = "cast(((event_id % 8) - (event_id % 8) % (1 + user_id % 6)) / (1 + user_id % 6) as int)"
ERROR_SQL = """(case
  when event_type <> 'error' and event_type <> 'view' then null
  when value < 10 then 'ReadTimeout: no reply, status 429'
  when value < 20 then 'request Timed Out'
  when value < 30 then 'status 401: rate limit of this key unknown'
  when value < 40 then 'HTTP 429 Too Many Requests'
  when value < 50 then 'Rate limit reached'
  when value < 60 then 'Unauthorized'
  else 'model not found' end)"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, index, record_id, text, utterance, complexity, lang, source,
    statements, schedule, sj``."""
    return records_of(table(spark, sf, "documents"))


def records_of(docs: DataFrame) -> DataFrame:
    lines = F.split("text", "\n")
    return docs.select(
        "doc_id",
        F.col("doc_id").alias("index"),
        text.record_id(F.col("doc_id")).alias("record_id"),
        "text",
        F.col("text").alias("utterance"),
        F.expr(COMPLEXITY_SQL).alias("complexity"),
        "lang",
        "source",
        "n_chars",
        F.slice(lines, F.lit(1), F.size(lines) - 1).alias("statements"),
        F.element_at(lines, -1).alias("schedule"),
    ).withColumn(
        "sj",
        F.concat(
            F.lit("["),
            F.array_join(F.transform("statements", _quote), ","),
            F.lit("]"),
        ),
    )


def _quote(x):
    backslash, quote = "\\", '"'
    for old, new in ((backslash, backslash * 2), (quote, backslash + quote), ("\n", backslash + "n")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return F.concat(F.lit(quote), x, F.lit(quote))


def plan(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("index", "record_id", "complexity")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Judge answers of the labelled documents."""
    return table(spark, sf, "labels").select(
        "doc_id",
        F.col("doc_id").alias("index"),
        text.record_id(F.col("doc_id")).alias("record_id"),
        "quality",
        "toxic",
        F.expr(FAITHFUL_SQL).alias("faithful_answer"),
        F.expr(TIMING_SQL).alias("schedule_answer"),
    )


def structured(spark: SparkSession, sf: str) -> DataFrame:
    """Structured table; every 13th output is missing."""
    return documents(spark, sf).withColumn(
        "structured_output",
        F.when(
            F.col("doc_id") % 13 != 0,
            F.struct(F.col("statements").alias("normal_statements"), "schedule"),
        ),
    )


#: a judge's grade, for some records no number
GRADE_SQL = "case when doc_id % 11 = 0 then 'none' else ' ' || cast(doc_id % 5 as string) end"

ANSWERS = {"faithfulness": "faithful_answer", "schedule": "schedule_answer"}


def evaluations(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluations of the labelled records."""
    answers = labelled(spark, sf).drop("index", "record_id")
    return evaluation.evaluate(structured(spark, sf).join(answers, "doc_id"), ANSWERS)


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.expr(REQUEST_SQL).cast("string").alias("request_id"),
        F.col("event_id").alias("attempt"),
        F.expr(ENDPOINT_SQL).alias("endpoint"),
        F.expr(ERROR_SQL).alias("error"),
    )


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("profile_id"),
        F.col("p_name").alias("profile_name"),
        F.concat_ws(" ", "p_brand", "p_type", F.concat(F.lit("size "), F.col("p_size").cast("string")))
        .alias("generated_description"),
    )
