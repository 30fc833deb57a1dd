"""Second extraction of low-scoring records and the upsert of its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillgate.operators import evaluation, prompts
from quillgate.operators.joins import last_per_key, spread_join

MIN_SCORE = 90.0
NOT_FOUND, NO_OUTPUT = "not_found", "no_output"


def low_scores(evaluations: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    return evaluations.filter(F.col("overall_score") < min_score)


def pair_candidates(
    evaluations: DataFrame,
    structured: DataFrame,
    min_score: float = MIN_SCORE,
    order: str | None = None,
) -> DataFrame:
    """Low evaluations with their record and ``skip_reason`` (null: refine)."""
    records = last_per_key(structured, "record_id", order) if order else structured
    side = records.select(
        "record_id", "utterance", "structured_output", F.lit(True).alias("_have")
    )
    low = low_scores(evaluations, min_score).select("record_id", "overall_score", "metric_results")
    return spread_join(low, side, "record_id", "left").withColumn(
        "skip_reason",
        F.when(F.col("_have").isNull(), F.lit(NOT_FOUND)).when(
            F.col("structured_output").isNull(), F.lit(NO_OUTPUT)
        ),
    ).drop("_have")


def candidate_counts(candidates: DataFrame) -> DataFrame:
    """One row: low, to refine, and skipped by reason."""
    return candidates.agg(
        F.count(F.lit(1)).alias("low"),
        F.count_if(F.col("skip_reason").isNull()).alias("to_refine"),
        F.count_if(F.col("skip_reason") == NOT_FOUND).alias("not_found"),
        F.count_if(F.col("skip_reason") == NO_OUTPUT).alias("no_output"),
    )


def refine_requests(candidates: DataFrame) -> DataFrame:
    """Feedback prompt of every candidate that is not skipped."""
    previous = F.to_json("structured_output", {"ignoreNullFields": "false"})
    return candidates.filter(F.col("skip_reason").isNull()).withColumn(
        "prompt",
        prompts.feedback_prompt(
            F.col("utterance"), previous, F.col("metric_results"), evaluation.metric_names(candidates)
        ),
    )


def upsert(
    table: DataFrame,
    changes: DataFrame,
    columns: list[str],
    key: str = "record_id",
    order: str | None = None,
) -> DataFrame:
    """``table`` with ``columns`` taken from ``changes`` where the key matches.

    ``changes`` has at most one row per key.  A changed null stays null.  With
    ``order`` only the last row of a repeated key changes.
    """
    new = changes.select(key, F.struct(*columns).alias("_new"))
    on = [key]
    if order:
        newest = table.groupBy(key).agg(F.max(order).alias(order))
        new, on = new.join(newest, key), [key, order]
    joined = table.join(new, on, "left")
    hit = F.col("_new").isNotNull()
    return joined.select(*[
        F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in table.columns
    ])


def keep_better(changes: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Only the changes that do not lower the score (an option; by default a
    new result replaces the old one even when it is worse)."""
    old = evaluations.groupBy("record_id").agg(F.max("overall_score").alias("_old_score"))
    return (
        changes.join(old, "record_id")
        .filter(F.col("overall_score") >= F.col("_old_score"))
        .drop("_old_score")
    )


def score_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Old and new score and their difference for the records in ``after``."""
    old = before.select("record_id", F.col("overall_score").alias("old_score"))
    return after.select("record_id", F.col("overall_score").alias("new_score")).join(
        old, "record_id"
    ).withColumn("delta", F.round(F.col("new_score") - F.col("old_score"), 2))
