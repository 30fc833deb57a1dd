"""Generate, extract, evaluate and filter as resumable jobs.

A stage keeps under ``<store>`` its ``manifests``, the ``attempts`` (model
calls) and the folders of its tries with ``plan``, ``records`` and ``status``.
A job checks its upstream, works and publishes last, in one commit, so that
readers see all or nothing of it.  Work still to do is found by key; the model
calls of a job that was stopped are kept as attempts.
"""

from __future__ import annotations

from dataclasses import replace

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillgate import schemas
from quillgate.operators import evaluation, extraction, gate, planning, prompts, refine, sampling
from quillgate.operators.completion import Backend, attach_completions
from quillgate.session import configure, materialise
from quillgate.sources import records as rec, state
from quillgate.sources.state import Run


def with_index(schema: T.StructType) -> T.StructType:
    """Stage tables carry the plan position, so that no stage has to join the
    plan back to wide records."""
    return T.StructType([schemas.PLAN["index"]] + schema.fields)


def stage_records(
    spark: SparkSession, store: str, schema: T.StructType, indexed: bool = False
) -> DataFrame:
    return state.table(spark, store, "records", with_index(schema) if indexed else schema)


def stage_plan(spark: SparkSession, store: str) -> DataFrame:
    return rec.read_table(spark, f"{state.current_output(spark, store)}/plan", schemas.PLAN)


def stage_status(spark: SparkSession, store: str) -> DataFrame:
    """Newest status of every planned record."""
    log = state.table(spark, store, "status", schemas.PLAN_STATUS)
    done = planning.latest_state(log).drop("index")
    return stage_plan(spark, store).join(done, "record_id", "left").fillna({"status": "pending"})


def stage_progress(spark: SparkSession, store: str) -> DataFrame:
    return planning.progress(stage_status(spark, store))


def _begin(draft: state.Draft, plan: DataFrame) -> DataFrame:
    """The plan of a fresh try, written; that of the resumed output."""
    if not draft.shown:
        plan.write.parquet(f"{draft.output}/plan")
    return rec.read_table(draft.spark, f"{draft.output}/plan", schemas.PLAN)


def _todo(work: DataFrame, plan: DataFrame, draft: state.Draft, schema: T.StructType, max_records: int | None) -> DataFrame:
    """Rows of ``work`` (plan or indexed records) that are planned and not done."""
    if draft.shown and work is not plan:
        # upstream may have grown since
        work = work.join(plan.select("record_id"), "record_id", "left_semi")
    todo = planning.pending(work, draft.have("records", schema))
    return planning.next_batch(todo, max_records) if max_records is not None else todo


def _commit(
    results: DataFrame, draft: state.Draft, schema: T.StructType, error: str, prefix_only: bool
) -> None:
    """Good records and the status of all, then the manifest that shows them.
    The results are written once first, so nothing is computed again for the
    second table."""
    results = materialise(results, draft.run.stage)
    good = planning.committed_prefix(results, error) if prefix_only else results
    good = good.filter(F.col(error).isNull())
    rec.append_table(good, f"{draft.batch}/records", with_index(schema))
    failed = results.filter(F.col(error).isNotNull())
    marks = good.select("record_id", "index", F.lit("completed").alias("status")).unionByName(
        failed.select("record_id", "index", F.lit("failed").alias("status"), F.col(error).alias("error")),
        allowMissingColumns=True,
    )
    rec.append_table(
        marks.withColumns({"seq": F.lit(draft.seq), "updated_at": draft.run.now()}),
        f"{draft.batch}/status",
        schemas.PLAN_STATUS,
    )
    draft.commit()


def rewrite(draft: state.Draft, records: DataFrame, schema: T.StructType, plan: DataFrame) -> None:
    """Tables of a try that replaces all records of a stage; status from their
    own rows.  Not yet visible."""
    plan.write.parquet(f"{draft.output}/plan")
    rec.append_table(records, f"{draft.batch}/records", with_index(schema))
    status = F.lit("completed")
    if "structured_status" in records.columns:
        status = F.coalesce("structured_status", status)
    rec.append_table(
        records.select("record_id", "index", status.alias("status")).withColumns(
            {"seq": F.lit(draft.seq), "updated_at": draft.run.now()}
        ),
        f"{draft.batch}/status",
        schemas.PLAN_STATUS,
    )


def replace_columns(draft: state.Draft, changes: DataFrame, columns: list[str], schema: T.StructType) -> None:
    """Of a revising try: ``columns`` of the records that ``changes`` names (one
    row per ``record_id``), copy on write.  Not yet visible.

    Only the keys of the records are joined to find the files that hold one of
    them.  These files are written anew; all others are carried over by name,
    neither read in full nor shuffled.
    """
    spark, full = draft.spark, with_index(schema)
    keys = draft.have("records", full).select("record_id", F.col("_metadata.file_path").alias("file"))
    hit = changes.select("record_id", F.lit(True).alias("_hit"))
    files = keys.join(hit, "record_id", "left").groupBy("file").agg(F.count("_hit").alias("n")).collect()  # one row for each file
    touched = [unquote(r["file"]) for r in files if r["n"]]
    old = rec.read_tables(spark, touched, full)
    rec.append_table(refine.upsert(old, changes, columns), f"{draft.batch}/records", full)
    done = changes.join(old.select("record_id", "index"), "record_id").select("record_id", "index", F.lit("completed").alias("status"))
    rec.append_table(
        done.withColumns({"seq": F.lit(draft.seq), "updated_at": draft.run.now()}), f"{draft.batch}/status", schemas.PLAN_STATUS
    )
    draft.carry({
        "records": [unquote(r["file"]) for r in files if not r["n"]],
        "status": state.paths(spark, list(draft.shown), "status"),
    })


def add_generation_prompt(
    todo: DataFrame, profiles: DataFrame, seed: int | str, tone: Column | None = None
) -> DataFrame:
    """Tone, sampled profiles and the prompt of each planned record."""
    given = tone if tone is not None else F.lit(None).cast("string")
    toned = todo.withColumn("tone", sampling.assign_tone(given, F.col("record_id"), seed))
    sampled = sampling.sample_profiles(toned, profiles, seed)
    return sampled.withColumn(
        "prompt",
        prompts.request_text(
            prompts.generation_messages(
                prompts.generation_prompt(F.col("kpis_used"), F.col("complexity"), F.col("tone"))
            )
        ),
    )


def generate(
    spark: SparkSession,
    profiles: DataFrame,
    store: str,
    run: Run,
    backends: list[Backend],
    *,
    n_examples: int | None = None,
    distribution: dict[str, int] | None = None,
    seed: int | str = 0,
    resume: bool = False,
    max_records: int | None = None,
    prefix_only: bool = False,
    parallelism: int | None = None,
) -> DataFrame:
    """Plan, sample, prompt, complete; returns the utterance table."""
    configure(spark)
    draft = state.draft(spark, store, run, resume)
    fresh = None if resume else planning.build_plan(spark, planning.resolve_distribution(n_examples, distribution))
    plan = _begin(draft, fresh)
    todo = add_generation_prompt(_todo(plan, plan, draft, schemas.UTTERANCES, max_records), profiles, seed)
    answered = attach_completions(
        todo, "prompt", backends, f"{store}/attempts",
        backend_id=run.backend_id, run_id=run.run_id, response="utterance", parallelism=parallelism,
    )
    _commit(answered, draft, schemas.UTTERANCES, "error", prefix_only)
    return stage_records(spark, store, schemas.UTTERANCES)


def extract(
    spark: SparkSession,
    upstream: str,
    store: str,
    run: Run,
    backends: list[Backend],
    *,
    resume: bool = False,
    allow_partial: bool = False,
    max_records: int | None = None,
    prefix_only: bool = False,
    parallelism: int | None = None,
) -> DataFrame:
    """Structured output for every utterance; returns the structured table."""
    configure(spark)
    utterances = stage_records(spark, upstream, schemas.UTTERANCES, indexed=True)
    draft = state.draft(spark, store, run, resume)
    plan = _begin(draft, None if resume else planning.next_stage_plan(stage_plan(spark, upstream), utterances, allow_partial))
    work = _todo(utterances, plan, draft, schemas.STRUCTURED, max_records).withColumn(
        "prompt",
        prompts.request_text(prompts.extraction_messages(prompts.extraction_user(F.col("utterance")))),
    )
    turn = None
    if resume:
        # a cached answer that did not pass the check is not used again
        log = draft.have("status", schemas.PLAN_STATUS)
        failed = log.filter("status = 'failed'").groupBy("record_id").agg(
            F.count(F.lit(1)).alias("_failed")
        )
        work = work.join(failed, "record_id", "left")
        turn = F.coalesce("_failed", F.lit(0))
    answered = attach_completions(
        work, "prompt", backends, f"{store}/attempts",
        backend_id=run.backend_id, run_id=run.run_id, parallelism=parallelism, turn=turn,
    )
    structured = extraction.attach_structured(answered, "response", "error")
    _commit(structured, draft, schemas.STRUCTURED, "structured_error", prefix_only)
    return stage_records(spark, store, schemas.STRUCTURED)


def judge(
    records: DataFrame,
    attempts: str,
    run: Run,
    backends: list[Backend],
    parallelism: int | None = None,
    backend_id: str | None = None,
    metrics: list[evaluation.Metric] | None = None,
) -> DataFrame:
    """Evaluation of records with ``utterance, structured_output``: adds the
    scores to the narrow columns (all but those two)."""
    metrics = evaluation.registry(metrics, run.thresholds)
    asked = evaluation.judge_requests(records, metrics)
    answers = attach_completions(
        asked, "prompt", backends, attempts,
        backend_id=backend_id or run.backend_id, run_id=run.run_id, parallelism=parallelism,
    )
    # what the scores need of the output is one flag each, taken before the join
    output = F.col("structured_output")
    flags = records.withColumns({
        "_no_output": output.isNull(), "_valid": evaluation.is_valid_typed(output)
    })
    keep = [c for c in ("index", "record_id") if c in records.columns]
    scored = evaluation.evaluate(
        flags.select(*keep, "_no_output", "_valid").join(
            evaluation.pivot_answers(answers, metrics), "record_id", "left"
        ),
        {m.name: f"answer_{m.name}" for m in metrics},
        missing=F.col("_no_output"),
        valid=F.col("_valid"),
        metrics=metrics,
    )
    return scored.drop("_no_output", "_valid").withColumn("evaluated_at", run.now())


def evaluate(
    spark: SparkSession,
    upstream: str,
    store: str,
    run: Run,
    backends: list[Backend],
    *,
    resume: bool = False,
    allow_partial: bool = False,
    max_records: int | None = None,
    parallelism: int | None = None,
    metrics: list[evaluation.Metric] | None = None,
) -> DataFrame:
    """Schema and judge scores for every structured record; ``metrics`` take the
    place of the shipped judged metrics.  A run that is resumed with others, or
    with other thresholds, is refused."""
    configure(spark)
    if metrics:
        metrics = evaluation.registry(metrics, run.thresholds)
        run = replace(run, thresholds={m.name: m.threshold for m in metrics})
    schema = evaluation.table_schema(metrics)
    structured = stage_records(spark, upstream, schemas.STRUCTURED, indexed=True)
    draft = state.draft(spark, store, run, resume)
    plan = _begin(draft, None if resume else planning.next_stage_plan(stage_plan(spark, upstream), structured, allow_partial))
    work = _todo(structured, plan, draft, schema, max_records)
    scored = judge(work, f"{store}/attempts", run, backends, parallelism, metrics=metrics)
    _commit(scored, draft, schema, "answer_error", False)
    return stage_records(spark, store, schema)


def filter_by_verdict(
    spark: SparkSession, evaluations: str, structured: str, output: str, fmt: str = "parquet",
    metrics: list[evaluation.Metric] | None = None,
) -> DataFrame:
    """Write passed and failed records; returns the one-row summary."""
    configure(spark)
    evals = stage_records(spark, evaluations, evaluation.table_schema(metrics))
    records = stage_records(spark, structured, schemas.STRUCTURED)
    rec.write_split(gate.gate(evals, records), output, fmt)
    return gate.summary(evals, records)
