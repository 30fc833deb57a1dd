"""Join evaluations to records and split them by the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillgate.operators.joins import HOT_ROWS, last_per_key, spread_join

EVALUATION_FIELDS = ["metric_results", "overall_score", "overall_pass", "evaluated_at"]


def gate(
    evaluations: DataFrame, structured: DataFrame, order: str | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Records with their evaluation nested under ``evaluation``.

    Of structured rows with the same id the last by ``order`` counts;
    evaluations are all kept.  Evaluations without a record drop out here and
    show in ``unmatched``.
    """
    records = last_per_key(structured, "record_id", order) if order else structured
    nested = evaluations.select(
        "record_id",
        F.struct(*[c for c in EVALUATION_FIELDS if c in evaluations.columns]).alias("evaluation"),
    )
    joined = spread_join(nested, records, "record_id", hot_rows=hot_rows)
    return joined.select(*records.columns, "evaluation")


def unmatched(evaluations: DataFrame, structured: DataFrame) -> DataFrame:
    """Evaluations that have no structured record."""
    return spread_join(
        evaluations, structured.select("record_id").distinct(), "record_id", "left_anti"
    )


def summary(evaluations: DataFrame, structured: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts and shares.  The total includes unmatched evaluations, so the
    shares need not add up to 100; with no evaluations they are null."""
    keys = by or []
    ids = structured.select("record_id", F.lit(True).alias("_have")).distinct()
    # counting per id first leaves few rows of any id for the join
    per_id = evaluations.groupBy(*keys, "record_id", "overall_pass").agg(
        F.count(F.lit(1)).alias("_n")
    )
    marked = per_id.join(ids, "record_id", "left")
    matched, passed = F.col("_have").isNotNull(), F.col("overall_pass")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    counts = marked.groupBy(*keys).agg(
        rows(F.lit(True)).alias("total"),
        rows(matched & passed).alias("passed"),
        rows(matched & ~passed).alias("failed"),
        rows(~matched).alias("unmatched"),
    )
    return counts.withColumns({
        f"{c}_pct": F.round(F.try_divide(F.col(c) * 100, F.col("total")), 1) for c in ("passed", "failed")
    })
