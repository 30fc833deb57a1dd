"""Metric scores, record roll-up and reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillgate import schemas
from quillgate.functions import text, validation as val
from quillgate.operators import prompts

METRICS = ["schema", "faithfulness", "schedule"]
THRESHOLD = 0.8
MISSING_REASON = "no structured output, so there is nothing to score"


@dataclass(frozen=True)
class Metric:
    """A judged metric: how to ask and how to read the answer."""

    name: str
    prompt: Callable[[Column, Column], Column]
    threshold: float = THRESHOLD
    score: Callable[[Column], Column] = text.is_yes


def judged_metrics(thresholds: dict[str, float] | None = None) -> list[Metric]:
    """The two judged metrics; prompts take (utterance, structured_output)."""
    t = thresholds or {}
    return [
        Metric(
            "faithfulness",
            lambda u, s: prompts.faithfulness_prompt(u, s["normal_statements"]),
            t.get("faithfulness", THRESHOLD),
        ),
        Metric(
            "schedule",
            lambda u, s: prompts.schedule_prompt(u, s["schedule"]),
            t.get("schedule", THRESHOLD),
        ),
    ]


def registry(metrics: list[Metric] | None = None, thresholds: dict[str, float] | None = None) -> list[Metric]:
    """The judged metrics of a run: the shipped ones or ``metrics``, with the
    run's thresholds in place of their own.  Names are unique, and ``schema``
    and ``overall`` are taken."""
    found = [replace(m, threshold=(thresholds or {}).get(m.name, m.threshold)) for m in metrics or judged_metrics()]
    names = [m.name for m in found]
    if len(set(names)) < len(names) or {"schema", "overall"} & set(names):
        raise ValueError(f"metric names must be unique and not schema or overall: {', '.join(names)}")
    return found


def table_schema(metrics: list[Metric] | None = None) -> T.StructType:
    """Schema of evaluations by the schema check and these judged metrics."""
    return schemas.evaluations(["schema", *(m.name for m in registry(metrics))])


def metric_names(evaluations: DataFrame) -> list[str]:
    """The metrics that evaluations carry."""
    return evaluations.schema["metric_results"].dataType.names


# -- scores ------------------------------------------------------------------


def metric_entry(score: Column, passed: Column, reason: Column) -> Column:
    """``{score, passed, reason}`` with the score on a scale of 100."""
    return F.struct(
        F.round(F.coalesce(score, F.lit(0.0)) * 100, 2).alias("score"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.coalesce(reason, F.lit("")).alias("reason"),
    )


def schema_metric(is_valid: Column) -> Column:
    ok = F.coalesce(is_valid, F.lit(False))
    return metric_entry(ok.cast("double"), ok, F.lit(""))


def verdict_metric(response: Column, threshold: float = THRESHOLD, score=text.is_yes) -> Column:
    """Score 1 or 0 from a judge answer, passed when it reaches the threshold."""
    value = score(response).cast("double")
    return metric_entry(value, value >= threshold, text.strip(response))


def roll_up(entries: dict[str, Column], missing: Column) -> dict[str, Column]:
    """``metric_results``, ``overall_score`` and ``overall_pass`` of a record.

    A record without output only gets a failing schema entry.  Otherwise the
    score is the plain mean and every metric must pass.
    """
    names = list(entries)
    no_output = metric_entry(F.lit(0.0), F.lit(False), F.lit(MISSING_REASON))
    results = F.struct(*[
        F.when(missing, no_output if n == "schema" else F.lit(None)).otherwise(e).alias(n)
        for n, e in entries.items()
    ])
    # entry scores are 100 x raw with two digits, so the mean is taken on them
    total = sum((entries[n]["score"] for n in names[1:]), entries[names[0]]["score"])
    passed = entries[names[0]]["passed"]
    for n in names[1:]:
        passed = passed & entries[n]["passed"]
    return {
        "metric_results": results,
        "overall_score": F.when(missing, F.lit(0.0)).otherwise(F.round(total / len(names), 2)),
        "overall_pass": ~missing & passed,
    }


def is_valid_typed(output: Column) -> Column:
    """Whether a typed ``structured_output`` has both fields and no null
    statement."""
    statements = output["normal_statements"]
    return (
        statements.isNotNull()
        & ~F.exists(statements, lambda s: s.isNull())
        & output["schedule"].isNotNull()
    )


def evaluate(
    df: DataFrame,
    responses: dict[str, str],
    missing: Column | None = None,
    valid: Column | None = None,
    thresholds: dict[str, float] | None = None,
    metrics: list[Metric] | None = None,
) -> DataFrame:
    """Score records that carry ``structured_output`` and judge answers.

    ``responses`` maps a metric to its answer column.  ``valid`` and
    ``missing`` default to what the typed ``structured_output`` says.  Other
    judged metrics than the two shipped ones go into ``metrics``.
    """
    output = F.col("structured_output")
    if missing is None:
        missing = output.isNull()
    if valid is None:
        valid = is_valid_typed(output)
    entries = {"schema": schema_metric(valid)}
    for m in registry(metrics, thresholds):
        entries[m.name] = verdict_metric(F.col(responses[m.name]), m.threshold, m.score)
    # metric entries are named first so that they are computed once
    named = df.withColumn("_missing", missing).withColumns(
        {f"_m_{n}": e for n, e in entries.items()}
    )
    rolled = roll_up({n: F.col(f"_m_{n}") for n in entries}, F.col("_missing"))
    return named.withColumns(rolled).drop("_missing", *[f"_m_{n}" for n in entries])


def evaluate_variant(df: DataFrame, value: Column, responses: dict[str, str]) -> DataFrame:
    """As ``evaluate`` for untyped output: ``{}`` and the like count as missing."""
    return evaluate(
        df.withColumn("structured_output", val.structured_output(value)),
        responses,
        missing=val.is_missing_output(value),
        valid=val.is_valid_output(value),
    )


def judge_requests(df: DataFrame, metrics: list[Metric] | None = None) -> DataFrame:
    """One ``(record_id, metric, prompt)`` row per judged metric and record
    that has output."""
    asked = F.array(*[
        F.struct(
            F.lit(m.name).alias("metric"),
            m.prompt(F.col("utterance"), F.col("structured_output")).alias("prompt"),
        )
        for m in metrics or judged_metrics()
    ])
    return df.filter(F.col("structured_output").isNotNull()).select("record_id", F.inline(asked))


def pivot_answers(answers: DataFrame, metrics: list[Metric] | None = None) -> DataFrame:
    """Back to one row per record: ``answer_<metric>``, ``answer_error``."""
    columns = [
        F.max(F.when(F.col("metric") == m.name, F.col("response"))).alias(f"answer_{m.name}")
        for m in metrics or judged_metrics()
    ]
    return answers.groupBy("record_id").agg(*columns, F.max("error").alias("answer_error"))


# -- reports -----------------------------------------------------------------


def metric_rows(evaluations: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Long form: one row per record and metric that was measured."""
    metrics = metrics or metric_names(evaluations)
    cells = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"metric_results.`{m}`").alias("entry"))
        for m in metrics
    ])
    return (
        evaluations.select("record_id", F.inline(cells))
        .filter(F.col("entry").isNotNull())
        .select("record_id", "metric", "entry.*")
    )


def pass_rates(evaluations: DataFrame) -> DataFrame:
    """Pass rate per metric and overall."""
    overall = evaluations.select(
        F.lit("overall").alias("metric"), F.col("overall_pass").alias("passed")
    )
    return (
        metric_rows(evaluations).select("metric", "passed").unionByName(overall)
        .groupBy("metric")
        .agg(F.count(F.lit(1)).alias("records"), F.count_if("passed").alias("passed"))
        .withColumn("pass_rate", F.round(F.col("passed") / F.col("records") * 100, 2))
    )


def score_histogram(evaluations: DataFrame) -> DataFrame:
    return evaluations.groupBy("overall_score").agg(F.count(F.lit(1)).alias("records"))


def top_failing(evaluations: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` lowest scores with the reasons of the metrics that failed."""
    lines = [
        F.when(
            ~F.col(f"metric_results.`{m}`.passed"),
            F.concat(F.lit(f"{m}: "), F.col(f"metric_results.`{m}`.reason")),
        )
        for m in metric_names(evaluations)
    ]
    return (
        evaluations.filter(~F.col("overall_pass"))
        .select("record_id", "overall_score", F.concat_ws(" | ", *lines).alias("reasons"))
        .orderBy("overall_score", "record_id")
        .limit(k)
    )


def quality_gate(evaluations: DataFrame, threshold: float) -> DataFrame:
    """One row: share of passing records and whether it reaches the threshold."""
    share = F.try_divide(F.count_if("overall_pass"), F.count(F.lit(1)))
    return evaluations.agg(
        F.count(F.lit(1)).alias("records"), F.round(share, 4).alias("pass_share")
    ).withColumn(
        "gate_open", F.coalesce(F.col("pass_share") >= threshold, F.lit(False))
    )


def metric_gate(evaluations: DataFrame, thresholds: dict[str, float], group: str = "lang") -> DataFrame:
    """Pass share by metric, over all records and by ``group``, against a
    threshold for each metric; the gate is open only if every row holds.

    ``metric, level`` (all or group), ``group, records, pass_share, threshold,
    holds, gate_open``.  Metrics are those that the evaluations carry, and
    ``overall``; one without a threshold, or without an entry in a record, is
    not judged there.  A metric that has a threshold but no entry at all does not hold.  A
    null group is a group of its own.  One grouping-sets aggregation, combined
    before its shuffle, whatever the number of metrics.
    """
    names = metric_names(evaluations)
    passed = {n: F.col(f"metric_results.`{n}`.passed") for n in names} | {"overall": F.col("overall_pass")}
    cells = F.array(*[
        F.struct(F.lit(n).alias("metric"), (passed[n] if n in passed else F.lit(None).cast("boolean")).alias("passed"))
        for n in thresholds
    ])
    rows = evaluations.select(F.col(group).alias("_group"), F.inline(cells))
    shares = rows.groupingSets([["metric"], ["metric", "_group"]], "metric", "_group").agg(
        F.grouping("_group").alias("_all"),
        F.count("passed").alias("records"),
        F.round(F.try_divide(F.count_if("passed"), F.count("passed")), 4).alias("pass_share"),
    ).filter((F.col("_all") == 1) | (F.col("records") > 0))
    limit = F.create_map(*[part for n, t in thresholds.items() for part in (F.lit(n), F.lit(float(t)))])[F.col("metric")]
    judged = shares.withColumn("threshold", limit).withColumn(
        "holds", F.coalesce(F.col("pass_share") >= F.col("threshold"), F.lit(False))
    )
    open_ = judged.agg(F.coalesce(F.every("holds"), F.lit(False))).scalar()
    return judged.select(
        "metric", F.when(F.col("_all") == 1, "all").otherwise("group").alias("level"), F.col("_group").alias(group),
        "records", "pass_share", "threshold", "holds", open_.alias("gate_open"),
    )


def gold_overlap(
    found: DataFrame, gold: DataFrame, items: Callable[[Column], Column], value: str = "value"
) -> DataFrame:
    """Set overlap per record with hand-made samples: precision and recall.

    ``items`` turns a value into the array to compare; it runs after the join,
    so only on records that have a sample.  A sample without a result counts as
    one of which nothing was found.
    """
    both = gold.select("record_id", F.col(value).alias("_g")).join(
        found.select("record_id", F.col(value).alias("_f")), "record_id", "left"
    )
    sets = both.select(
        "record_id",
        F.coalesce(F.array_distinct(items(F.col("_f"))), F.array().cast("array<string>")).alias("_found"),
        F.array_distinct(items(F.col("_g"))).alias("_gold"),
    )
    return sets.select(
        "record_id",
        F.size("_found").cast("bigint").alias("n_found"),
        F.size("_gold").cast("bigint").alias("n_gold"),
        F.size(F.array_intersect("_found", "_gold")).cast("bigint").alias("n_common"),
    ).withColumns({
        "precision": F.round(F.try_divide("n_common", "n_found"), 6),
        "recall": F.round(F.try_divide("n_common", "n_gold"), 6),
    })
