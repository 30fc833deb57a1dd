"""Find and repair records: utterance level and structured-output level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillgate.functions import text, validation as val
from quillgate.operators import evaluation, extraction

# fixed values: the issue names here and in the two rules below, and the reasons
MALFORMED = "malformed_json"
MIN_WORDS = 10
UTTERANCE_REASON = "utterance_regeneration"
STRUCTURED_REASON = "structured_regeneration"


# -- utterance issues --------------------------------------------------------


def classify_records(parsed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``issue``, the first issue of a parsed line (columns ``_v`` and
    ``_malformed``) or null.

    A field that is present but null is not missing; a null utterance, or one
    that is not text, is empty.  What several rules need is computed once in
    its own column.
    """
    v = F.col("_v")
    facts = parsed.withColumn("_text", text.strip(val.text_field(v, "utterance"))).withColumns({
        "_words": F.coalesce(text.word_count(F.col("_text")), F.lit(0)),
        "_has_utterance": val.has_field(v, "utterance"),
        "_has_kpis": val.has_field(v, "kpis_used"),
        "_has_class": val.has_field(v, "complexity"),
    })
    n = F.col("_words")
    issue = (
        F.when(F.col("_malformed"), F.lit(MALFORMED))
        .when(~F.col("_has_utterance"), F.lit("missing_utterance_field"))
        .when(n == 0, F.lit("empty_utterance"))
        .when(n < min_words, F.concat(F.lit("too_short_"), n.cast("string"), F.lit("_words")))
        .when(~F.col("_has_kpis"), F.lit("missing_kpis_metadata"))
        .when(~F.col("_has_class"), F.lit("missing_complexity"))
    )
    return facts.withColumn("issue", issue).drop(
        "_text", "_words", "_has_utterance", "_has_kpis", "_has_class"
    )


def issue_counts(classified: DataFrame, issue: str = "issue") -> DataFrame:
    """Records per issue.  Fine rows drop out after the count: a filter on
    ``issue`` would move below it and evaluate all rules a second time."""
    return (
        classified.groupBy(issue)
        .agg(F.count_if(F.col(issue).isNotNull()).alias("records"))
        .filter("records > 0")
    )


def issue_summary(classified: DataFrame, issue: str = "issue") -> DataFrame:
    """One row: total, valid and invalid records."""
    return classified.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(issue).isNull()).alias("valid_records"),
        F.count_if(F.col(issue).isNotNull()).alias("invalid_records"),
    )


def issue_examples(classified: DataFrame, n: int = 3, issue: str = "issue") -> DataFrame:
    """First ``n`` records per issue and how many more there are.

    The rank limit is applied before the shuffle, so a frequent issue sends
    ``n`` rows per task.  The input is read twice; give it a written table.
    """
    label = F.coalesce(F.col("record_id"), F.concat(F.lit("index-"), F.col("index").cast("string")))
    first = W.partitionBy(issue).orderBy("index")
    shown = (
        classified.select(issue, "index", label.alias("_label"))
        .withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= n)
        .groupBy(issue)
        .agg(F.array_sort(F.collect_list(F.struct("_rn", "_label"))).alias("_shown"))
        .select(issue, F.array_join("_shown._label", ", ").alias("examples"))
    )
    return issue_counts(classified, issue).join(shown, issue).withColumn(
        "more", F.greatest(F.col("records") - n, F.lit(0))
    )


# -- repair ------------------------------------------------------------------


def add_history(history: Column, at: Column, reason: str) -> Column:
    """Append one ``{repaired_at, reason}`` entry."""
    entry = F.struct(at.cast("timestamp_ntz").alias("repaired_at"), F.lit(reason).alias("reason"))
    return F.concat(F.coalesce(history, F.array()), F.array(entry))


def repair_rows(
    df: DataFrame,
    bad: Column,
    regenerate: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Replace the bad rows by what ``regenerate`` makes of them.

    Good rows go straight through: they are neither shuffled nor joined.
    ``bad`` must not be null.
    """
    good = df.filter(~bad)
    return good.unionByName(regenerate(df.filter(bad)), allowMissingColumns=True)


def apply_utterance(
    bad_rows: DataFrame, new: dict[str, Column], error: Column, at: Column
) -> DataFrame:
    """Take over regenerated fields where the call worked; keep the old row
    and the error text where it did not."""
    ok = error.isNull()
    out = bad_rows.withColumn("repair_error", error)
    for name, value in new.items():
        out = out.withColumn(name, F.when(ok, value).otherwise(F.col(name)))
    return out.withColumn(
        "repair_history",
        F.when(ok, add_history(F.col("repair_history"), at, UTTERANCE_REASON)).otherwise(
            F.col("repair_history")
        ),
    )


def apply_structured(bad_rows: DataFrame, new_output: Column, error: Column, at: Column) -> DataFrame:
    """New output and history on success; status and error on failure."""
    ok = error.isNull() & new_output.isNotNull()
    why = F.coalesce(error, F.lit(extraction.INVALID))
    return bad_rows.withColumns({
        "structured_output": F.when(ok, new_output).otherwise(F.col("structured_output")),
        "structured_status": F.when(ok, F.lit(extraction.COMPLETED)).otherwise(F.lit(extraction.FAILED)),
        "structured_error": F.when(~ok, why),
        "repair_history": F.when(
            ok, add_history(F.col("repair_history"), at, STRUCTURED_REASON)
        ).otherwise(F.col("repair_history")),
    })


def audit_row(
    repaired: DataFrame, issue: str, failed: Column, run_id: str, stage: str, at: Column
) -> DataFrame:
    """One audit row.  Short utterances count as one issue here, so that the
    map stays small whatever ``min_words`` is."""
    kind = F.when(F.col(issue).startswith("too_short_"), F.lit("too_short")).otherwise(F.col(issue))
    per_issue = repaired.groupBy(kind.alias("_kind")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(failed).alias("_failed")
    )
    bad = F.col("_kind").isNotNull()
    return per_issue.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        at.cast("timestamp_ntz").alias("repaired_at"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records_analyzed"),
        F.coalesce(F.sum(F.when(bad, F.col("_n") - F.col("_failed"))), F.lit(0)).alias("records_repaired"),
        F.coalesce(F.sum(F.when(bad, F.col("_failed"))), F.lit(0)).alias("records_failed"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(bad, F.struct("_kind", "_n"))))
        ).alias("issues_by_type"),
    )


# -- structured-output issues ------------------------------------------------


def classify_structured(df: DataFrame, value: str = "_v") -> DataFrame:
    """Add ``issue``, the first reason to extract a parsed record again."""
    v = F.col(value)
    facts = df.withColumn("_text", val.text_field(v, "structured_output")).withColumn(
        "_parsed", val.parse_exact(text.strip(F.col("_text")))
    ).withColumn(
        "_output",
        F.when(F.col("_text").isNotNull(), F.col("_parsed")).otherwise(
            val.field(v, "structured_output")
        ),
    )
    output, status = F.col("_output"), val.text_field(v, "structured_status")
    issue = (
        F.when(~val.has_field(v, "utterance"), F.lit("missing_utterance"))
        .when(
            F.col("_text").isNotNull() & F.col("_parsed").isNull(),
            F.lit("structured_output_not_json"),
        )
        .when(output.isNull() | F.is_variant_null(output), F.lit("missing_structured_output"))
        .when(~F.coalesce(val.is_valid_output(output), F.lit(False)), F.lit("invalid_structured_output"))
        .when(~status.eqNullSafe(F.lit(extraction.COMPLETED)), F.lit("incomplete_status"))
    )
    return facts.withColumn("issue", issue).drop("_text", "_parsed", "_output")


def typed_structured_issue() -> Column:
    """The same rules on the typed table (columns of the structured schema)."""
    output = F.col("structured_output")
    return (
        F.when(F.col("utterance").isNull(), F.lit("missing_utterance"))
        .when(output.isNull(), F.lit("missing_structured_output"))
        .when(~evaluation.is_valid_typed(output), F.lit("invalid_structured_output"))
        .when(
            ~F.col("structured_status").eqNullSafe(F.lit(extraction.COMPLETED)),
            F.lit("incomplete_status"),
        )
    )


def sync_plan(plan: DataFrame, records: DataFrame, order: str) -> DataFrame:
    """Plan status and offset from the records, by id; the last record of an
    id counts, an empty status means completed, rows without id are skipped.

    ``plan`` may carry ``status`` and ``output_offset`` to fall back on.
    """
    state = records.filter(F.coalesce(F.col("record_id"), F.lit("")) != "").groupBy("record_id").agg(
        F.max_by(
            F.struct(
                F.col("offset").alias("new_offset"),
                F.when(
                    F.coalesce(F.col("structured_status"), F.lit("")) == "",
                    F.lit(extraction.COMPLETED),
                ).otherwise(F.col("structured_status")).alias("new_status"),
            ),
            F.col(order),
        ).alias("_state")
    )
    joined = plan.join(state, "record_id", "left")
    hit = F.col("_state").isNotNull()
    return joined.withColumns({
        "output_offset": F.when(hit, F.col("_state.new_offset")).otherwise(F.col("output_offset")),
        "status": F.when(hit, F.col("_state.new_status")).otherwise(F.col("status")),
        "synced": hit,
    }).drop("_state")


def sync_summary(synced: DataFrame) -> DataFrame:
    """One row: completed count and last completed id in plan order."""
    done = F.col("synced") & (F.col("status") == extraction.COMPLETED)
    return synced.agg(
        F.count_if(done).alias("completed"),
        F.max_by(F.when(done, F.col("record_id")), F.when(done, F.col("index"))).alias("last_id"),
    )
