"""Repair of utterances, repair of structured output, refinement.

They exist because an earlier answer would not do, so they ask anew: their
calls are cached for the run alone.  Each job writes its result to a new folder; the tables it read stay as they
are until the new run row is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillgate import schemas
from quillgate.functions import objects, text, validation as val
from quillgate.operators import evaluation, extraction, offsets, prompts, refine, repair, sampling
from quillgate.operators.completion import Backend, attach_completions
from quillgate.plans import stages
from quillgate.session import configure, materialise
from quillgate.sources import records as rec, state
from quillgate.sources.state import Run


NO_UTTERANCE = "record has no utterance"


def typed_utterances(parsed: DataFrame) -> DataFrame:
    """The known fields of parsed lines; the raw line stays in ``value``."""
    v = F.col("_v")
    fields = {
        f.name: F.try_variant_get(v, f"$.{f.name}", f.dataType.simpleString())
        for f in schemas.UTTERANCES.fields
    }
    return parsed.withColumns(fields)


def repair_dataset(
    spark: SparkSession,
    lines_path: str,
    plan: DataFrame,
    profiles: DataFrame,
    output: str,
    run: Run,
    backends: list[Backend],
    *,
    min_words: int = repair.MIN_WORDS,
    seed: int | str = "repair",
    dry_run: bool = False,
    reuse_profiles: bool = False,
    parallelism: int | None = None,
) -> DataFrame:
    """Repair a JSON-lines dataset; returns the audit row (dry run: the issue
    examples).

    Good lines are copied as they are.  A broken line takes its id from the
    plan by position.  A failed repair keeps the old line and its error goes
    to ``<output>/failures``.
    """
    configure(spark)
    classified = repair.classify_records(rec.read_jsonl_tolerant(spark, lines_path), min_words)
    typed = typed_utterances(classified)
    if dry_run:
        return repair.issue_examples(typed)
    typed = materialise(typed.drop("_v", "_malformed", "_error"), "repair-input")

    bad = typed.filter(F.col("issue").isNotNull())
    ids = plan.select(
        "index", F.col("record_id").alias("_plan_id"), F.col("complexity").alias("_plan_class")
    )
    todo = bad.join(ids, "index", "left").withColumns({
        "record_id": F.coalesce("record_id", "_plan_id", text.record_id(F.col("index"))),
        "complexity": F.coalesce("complexity", "_plan_class", F.lit("medium")),
    }).drop("_plan_id", "_plan_class")
    old = todo.select(
        "index", "value", "issue", "record_id", "complexity", "processed", "repair_history",
        F.col("tone").alias("_tone"), F.col("kpis_used").alias("_old_kpis"),
    )
    asked = old.withColumn("tone", sampling.assign_tone(F.col("_tone"), F.col("record_id"), seed))
    asked = sampling.sample_profiles(asked, profiles, seed)
    if reuse_profiles:
        kept = F.when(F.size("_old_kpis") > 0, F.col("_old_kpis")).otherwise(F.col("kpis_used"))
        asked = asked.withColumn("kpis_used", kept).withColumn("num_kpis", F.size("kpis_used"))
    asked = asked.withColumn(
        "prompt",
        prompts.request_text(prompts.generation_messages(
            prompts.generation_prompt(F.col("kpis_used"), F.col("complexity"), F.col("tone"))
        )),
    )
    answered = materialise(
        attach_completions(
            asked, "prompt", backends, f"{output}/attempts", backend_id=run.own_backend_id,
            run_id=run.run_id, response="utterance", parallelism=parallelism,
        ),
        "repair-answers",
    )
    ok = F.col("error").isNull()
    renewed = answered.withColumn(
        "repair_history",
        repair.add_history(F.col("repair_history"), run.now(), repair.UTTERANCE_REASON),
    )
    # a line keeps what it holds besides the declared fields
    line = objects.merge_object(F.col("value"), {name: F.col(name) for name in schemas.UTTERANCES.fieldNames()})
    new_lines = renewed.select("index", F.when(ok, line).otherwise(F.col("value")).alias("value"))
    good_lines = typed.filter(F.col("issue").isNull()).select("index", "value")
    repaired = materialise(good_lines.unionByName(new_lines), "repaired-lines")
    repaired.orderBy("index").select("value").write.text(f"{output}/lines")
    moved = offsets.record_offsets(repaired)
    offsets.update_offsets(
        plan if "offset" in plan.columns else plan.withColumn("offset", F.lit(None).cast("bigint")),
        moved,
    ).write.parquet(f"{output}/plan")
    answered.filter(~ok).select("index", "record_id", "issue", "error").write.parquet(
        f"{output}/failures"
    )
    outcome = typed.filter(F.col("issue").isNull()).select(
        "issue", F.lit(False).alias("failed")
    ).unionByName(answered.select("issue", (~ok).alias("failed")))
    audit = repair.audit_row(outcome, "issue", F.col("failed"), run.run_id, run.stage, run.now())
    rec.append_table(audit, f"{output}/repair_audit", schemas.REPAIR_AUDIT)
    return rec.read_table(spark, f"{output}/repair_audit", schemas.REPAIR_AUDIT)


def repair_structured(
    spark: SparkSession,
    store: str,
    run: Run,
    backends: list[Backend],
    *,
    dry_run: bool = False,
    parallelism: int | None = None,
) -> DataFrame:
    """Extract again where the structured output is missing, invalid or
    incomplete; returns the audit row (dry run: the counts)."""
    configure(spark)
    plan = stages.stage_plan(spark, store)
    records = stages.stage_records(spark, store, schemas.STRUCTURED, indexed=True)
    marked = records.withColumn("issue", repair.typed_structured_issue())
    if dry_run:
        return repair.issue_counts(marked)
    draft = state.draft(spark, store, run)
    marked = materialise(marked, "structured-issues")
    asked = marked.filter(F.col("issue").isNotNull()).withColumn(
        "prompt",
        prompts.request_text(prompts.extraction_messages(
            prompts.extraction_user(F.coalesce("utterance", F.lit("")))
        )),
    )
    answered = attach_completions(
        asked, "prompt", backends, f"{store}/attempts", backend_id=run.own_backend_id,
        run_id=run.run_id, parallelism=parallelism,
    )
    new = val.structured_output(extraction.parse_completion(F.col("response")))
    no_text = F.when(F.col("utterance").isNull(), F.lit(NO_UTTERANCE))
    fixed = materialise(
        repair.apply_structured(answered, new, F.coalesce(no_text, F.col("error")), run.now())
        .select(*marked.columns),
        "structured-fixed",
    )
    good = marked.filter(F.col("issue").isNull())
    stages.rewrite(draft, good.unionByName(fixed), schemas.STRUCTURED, plan)
    audit = repair.audit_row(
        good.select("issue", "structured_status").unionByName(fixed.select("issue", "structured_status")),
        "issue", F.col("structured_status") == extraction.FAILED, run.run_id, run.stage, run.now(),
    )
    rec.append_table(audit, f"{draft.batch}/repair_audit", schemas.REPAIR_AUDIT)
    draft.commit()
    return rec.read_table(spark, f"{draft.batch}/repair_audit", schemas.REPAIR_AUDIT)


def repair_structured_lines(
    spark: SparkSession,
    lines_path: str,
    plan: DataFrame,
    output: str,
    run: Run,
    backends: list[Backend],
    *,
    dry_run: bool = False,
    parallelism: int | None = None,
) -> DataFrame:
    """Extract again where a line of a structured JSON-lines file has no,
    invalid or incomplete output; returns the audit row (dry run: the counts).

    Writes ``lines``, ``plan`` (status and offset of each record), ``failures`` and
    ``repair_audit`` under the new folder ``output``.  Only the members that a
    repair sets change; all others stay, in their order.  Output that was JSON
    text in a string becomes an object.  A failed repair sets status and error;
    a line that is not an object is kept as it is and counts as failed.
    """
    configure(spark)
    v = F.col("_v")
    classified = repair.classify_structured(rec.read_jsonl_tolerant(spark, lines_path))
    marked = classified.select(
        "index", "value", val.text_field(v, "record_id").alias("record_id"),
        val.has_field(v, "utterance").alias("_has_text"),
        F.coalesce(val.text_field(v, "utterance"), F.lit("")).alias("utterance"),
        F.when(val.text_field(v, "structured_output").isNotNull(), F.to_json(extraction.output_value(v))).alias("_output"),
        F.to_json(F.try_variant_get(v, "$.repair_history", "array<variant>")).alias("_history"),
        F.when(F.col("_malformed"), F.lit(repair.MALFORMED)).otherwise(F.col("issue")).alias("issue"),
    )
    if dry_run:
        return repair.issue_counts(marked)
    opened = objects.merge_object(F.col("value"), {"structured_output": F.parse_json(F.col("_output"))})
    marked = marked.withColumn("value", F.when(F.col("_output").isNotNull(), opened).otherwise(F.col("value")))
    broken = F.col("issue") == repair.MALFORMED
    asks = F.col("issue").isNotNull() & ~broken
    # the text goes into prompts alone, and lines meet their answers by position once these are there
    marked = materialise(marked.drop("_output").withColumn("utterance", F.when(asks, F.col("utterance"))), "structured-lines")
    request = prompts.request_text(prompts.extraction_messages(prompts.extraction_user(F.col("utterance"))))
    bad = marked.filter(asks)
    answers = attach_completions(
        bad.select("index", F.when(F.col("_has_text"), request).alias("prompt")), "prompt", backends, f"{output}/attempts",
        backend_id=run.own_backend_id, run_id=run.run_id, parallelism=parallelism,
    )
    answered = bad.drop("utterance").join(answers.drop("prompt"), "index")
    answered = answered.withColumn("_new", val.structured_output(extraction.parse_completion(F.col("response"))))
    why = F.when(~F.col("_has_text"), F.lit(NO_UTTERANCE)).otherwise(
        F.coalesce("error", F.when(F.col("_new").isNull(), F.lit(extraction.INVALID)))
    )
    entry = F.struct(
        F.date_format(run.now(), "yyyy-MM-dd'T'HH:mm:ss").alias("repaired_at"), F.lit(repair.STRUCTURED_REASON).alias("reason")
    )
    earlier = F.coalesce(F.from_json("_history", "array<variant>"), F.array().cast("array<variant>"))
    fixed = objects.merge_object(F.col("value"), {
        "structured_output": F.col("_new"), "structured_status": F.lit(extraction.COMPLETED),
        "repair_history": F.concat(earlier, F.array(F.to_variant_object(entry))),
    }, drop=["structured_error"])
    marred = objects.merge_object(F.col("value"), {"structured_status": F.lit(extraction.FAILED), "structured_error": F.col("_why")})
    answered = materialise(answered.withColumn("_why", why).select(
        "index", "record_id", "issue", F.col("_why").alias("structured_error"),
        F.when(F.col("_why").isNull(), fixed).otherwise(marred).alias("value"),
    ), "structured-lines-new")
    rest = marked.filter(F.col("issue").isNull() | broken).select(
        "index", "record_id", "issue", F.when(broken, F.lit(repair.MALFORMED)).alias("structured_error"), "value"
    )
    done = rest.unionByName(answered)  # both are written by now
    done.orderBy("index").select("value").write.text(f"{output}/lines")
    failed = F.col("structured_error").isNotNull()
    states = done.join(offsets.record_offsets(done), "index").withColumn(
        "structured_status", F.when(failed, F.lit(extraction.FAILED)).otherwise(F.lit(extraction.COMPLETED))
    )
    for name, kind in (("status", "string"), ("output_offset", "bigint")):
        plan = plan if name in plan.columns else plan.withColumn(name, F.lit(None).cast(kind))
    repair.sync_plan(plan, states, "index").write.parquet(f"{output}/plan")
    done.filter(failed).select("index", "record_id", "issue", F.col("structured_error").alias("error")).write.parquet(f"{output}/failures")
    audit = repair.audit_row(done, "issue", failed, run.run_id, run.stage, run.now())
    rec.append_table(audit, f"{output}/repair_audit", schemas.REPAIR_AUDIT)
    return rec.read_table(spark, f"{output}/repair_audit", schemas.REPAIR_AUDIT)


def refine_low_scores(
    spark: SparkSession,
    evaluations: str,
    structured: str,
    run: Run,
    extract_backends: list[Backend],
    judge_backends: list[Backend],
    *,
    min_score: float = refine.MIN_SCORE,
    keep_best: bool = False,
    dry_run: bool = False,
    parallelism: int | None = None,
    metrics: list[evaluation.Metric] | None = None,
) -> DataFrame:
    """Extract low-scoring records again with feedback, score them again and
    replace both tables; returns old and new score per refined record (dry
    run: the counts)."""
    configure(spark)
    schema = evaluation.table_schema(metrics)
    evals = stages.stage_records(spark, evaluations, schema, indexed=True)
    records = stages.stage_records(spark, structured, schemas.STRUCTURED, indexed=True)
    candidates = refine.pair_candidates(evals, records, min_score)
    if dry_run:
        return refine.candidate_counts(candidates)
    new_structured, new_evals = state.revise(spark, structured, run), state.revise(spark, evaluations, run)
    asked = refine.refine_requests(candidates).withColumn(
        "prompt", prompts.request_text(prompts.extraction_messages(F.col("prompt")))
    )
    answered = attach_completions(
        asked.drop("structured_output", "metric_results", "overall_score"), "prompt",
        extract_backends, f"{structured}/attempts", backend_id=run.own_backend_id,
        run_id=run.run_id, parallelism=parallelism,
    )
    new = val.structured_output(extraction.parse_completion(F.col("response")))
    fresh = materialise(
        answered.withColumn("structured_output", new)
        .filter(F.col("structured_output").isNotNull())
        .select("record_id", "utterance", "structured_output"),
        "refined",
    )
    # an evaluation that occurs twice is refined twice; one result counts
    fresh = fresh.dropDuplicates(["record_id"])
    rated = stages.judge(fresh, f"{evaluations}/attempts", run, judge_backends, parallelism,
                         run.own_backend_id, metrics)
    changes = rated.filter(F.col("answer_error").isNull()).join(
        fresh.select("record_id", "structured_output"), "record_id"
    )
    if keep_best:
        changes = refine.keep_better(changes, evals)
    changes = materialise(changes, "refined-scored")
    delta = materialise(refine.score_delta(evals, changes), "refined-delta")

    stages.replace_columns(new_structured, changes, ["structured_output"], schemas.STRUCTURED)
    stages.replace_columns(
        new_evals, changes, ["metric_results", "overall_score", "overall_pass", "evaluated_at"], schema
    )
    # the first counts only with the second, so both change at once
    new_structured.commit(needs=new_evals)
    new_evals.commit()
    return delta


def recalculate_offsets(spark: SparkSession, lines_path: str, plan: DataFrame, output: str) -> DataFrame:
    """Plan with the byte offsets of edited JSON-lines files, written to
    ``output``; returns the positions that changed.  Several files count as one,
    in name order, as the repair jobs write them."""
    configure(spark)
    found = materialise(offsets.joint_offsets(spark, lines_path), "file-offsets")
    offsets.update_offsets(plan, found).write.parquet(output)
    return offsets.changed_offsets(plan, found)
