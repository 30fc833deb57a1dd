"""Registered queries: operator name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quillgate import schemas
from quillgate.functions import objects, text, validation as val
from quillgate.operators import (
    completion, evaluation, extraction, gate, offsets, planning, prompts, refine, repair, sampling,
)
from quillgate.operators.joins import last_per_key, spread_join
from quillgate.plans import side_jobs, stages
from quillgate.queries import bindings as b
from quillgate.session import configure, materialise, scratch_path
from quillgate.sources import records as rec, state
from quillgate.sources.state import Run
from quillgate.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SEED = "seed-1"
BATCH = 100
TOP = 20


def query(fn):
    """Register ``fn`` under its name."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(configure(spark), sf)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def digest(c: Column) -> Column:
    return F.md5(c)


# -- evaluation --------------------------------------------------------------


@query
def verdict_scores(spark, sf):
    labels = b.labelled(spark, sf)
    cells = F.array(*[
        F.struct(F.lit(m).alias("metric"), evaluation.verdict_metric(F.col(c)).alias("entry"))
        for m, c in b.ANSWERS.items()
    ])
    return labels.select("record_id", F.inline(cells)).select("record_id", "metric", "entry.*")


def flat_scores(df, *more):
    m = "metric_results"
    return df.select(
        "record_id",
        F.col(f"{m}.schema.score").alias("schema_score"),
        F.col(f"{m}.faithfulness.score").alias("faithfulness_score"),
        F.col(f"{m}.schedule.score").alias("schedule_score"),
        "overall_score",
        "overall_pass",
        *more,
    )


@query
def record_rollup(spark, sf):
    return flat_scores(b.evaluations(spark, sf))


@query
def missing_output_eval(spark, sf):
    docs = b.documents(spark, sf).join(
        b.labelled(spark, sf).drop("index", "record_id"), "doc_id"
    ).withColumn("_v", val.parse_exact(F.expr(b.MAYBE_OUTPUT_SQL)))
    scored = evaluation.evaluate_variant(docs, F.col("_v"), b.ANSWERS)
    return flat_scores(scored, F.col("metric_results.schema.reason").alias("schema_reason"))


@query
def judge_prompts(spark, sf):
    asked = evaluation.judge_requests(b.structured(spark, sf))
    return asked.select("record_id", "metric", digest(F.col("prompt")).alias("prompt_md5"),
                        F.length("prompt").cast("bigint").alias("n_chars"))


@query
def pass_rates(spark, sf):
    return evaluation.pass_rates(b.evaluations(spark, sf))


#: a metric of a graded answer: 0 to 4, two are enough
GRADE = evaluation.Metric(
    "grade", lambda u, s: F.concat(F.lit("Grade from 0 to 4: "), u), 0.5,
    lambda answer: F.try_divide(text.strip(answer).try_cast("double"), F.lit(4)),
)


@query
def custom_metric_eval(spark, sf):
    """Pass rates, and the worst records' scores, with a fourth metric."""
    answers = b.labelled(spark, sf).drop("index", "record_id").withColumn("grade_answer", F.expr(b.GRADE_SQL))
    scored = evaluation.evaluate(
        b.structured(spark, sf).join(answers, "doc_id"), b.ANSWERS | {"grade": "grade_answer"},
        metrics=[*evaluation.judged_metrics(), GRADE],
    )
    scores = scored.groupBy().agg(F.count_if("overall_pass").alias("n"), F.round(F.avg("overall_score"), 6).alias("score"),
                                  F.count(F.lit(1)).alias("records"))
    rows = evaluation.pass_rates(scored).select("metric", "records", "passed", "pass_rate")
    return rows.unionByName(scores.select(
        F.lit("score").alias("metric"), "records", F.col("n").alias("passed"), F.col("score").alias("pass_rate")
    ))


@query
def score_histogram(spark, sf):
    return evaluation.score_histogram(b.evaluations(spark, sf))


@query
def top_failing(spark, sf):
    return evaluation.top_failing(b.evaluations(spark, sf), TOP)


@query
def quality_gate(spark, sf):
    return evaluation.quality_gate(b.evaluations(spark, sf), 0.7)


@query
def metric_gate(spark, sf):
    """A threshold for each metric, held overall and in every language."""
    return evaluation.metric_gate(
        b.evaluations(spark, sf), {"schema": 0.9, "faithfulness": 0.3, "schedule": 0.5, "overall": 0.2}
    )


@query
def gold_overlap(spark, sf):
    gold = b.table(spark, sf, "benchmark").select(
        text.record_id(F.col("item_id")).alias("record_id"), F.col("text").alias("value")
    )
    found = b.documents(spark, sf).select("record_id", F.col("text").alias("value"))
    return evaluation.gold_overlap(found, gold, lambda c: text.words(F.lower(c)))


# -- gate --------------------------------------------------------------------


def keyed_by_text(spark, sf):
    """Records under the hash of their text, so that copies share an id."""
    return b.structured(spark, sf).withColumn("record_id", F.md5("text"))


@query
def dedup_last_wins(spark, sf):
    records = keyed_by_text(spark, sf).select("record_id", "index", "source")
    return last_per_key(records, "record_id", "index")


@query
def gate_join(spark, sf):
    evals = b.evaluations(spark, sf).withColumn("record_id", F.md5("text")).select(
        "record_id", "metric_results", "overall_score", "overall_pass"
    )
    records = keyed_by_text(spark, sf).select("record_id", "index", "structured_output")
    return gate.gate(evals, records, order="index").select(
        "record_id",
        "index",
        F.size("structured_output.normal_statements").cast("bigint").alias("n_statements"),
        "evaluation.overall_score",
        "evaluation.overall_pass",
    )


def many_line_records(spark, sf):
    return b.structured(spark, sf).filter(F.contains("text", F.lit("\n")))


@query
def gate_unmatched(spark, sf):
    evals = b.evaluations(spark, sf).select("record_id", "overall_score", "overall_pass")
    return gate.unmatched(evals, many_line_records(spark, sf))


@query
def gate_summary(spark, sf):
    return gate.summary(b.evaluations(spark, sf), many_line_records(spark, sf))


@query
def gate_summary_by_lang(spark, sf):
    return gate.summary(b.evaluations(spark, sf), many_line_records(spark, sf), ["lang"])


@query
def split_write(spark, sf):
    path = scratch_path(spark, "split")
    evals = b.evaluations(spark, sf).select(
        "record_id", "metric_results", "overall_score", "overall_pass"
    )
    records = b.structured(spark, sf).select("record_id", "utterance", "structured_output")
    rec.write_split(gate.gate(evals, records), path)
    return spark.read.parquet(path).select(
        "record_id", "verdict", "evaluation.overall_score", digest(F.col("utterance")).alias("text_md5")
    )


# -- planning ----------------------------------------------------------------


@query
def complexity_distribution(spark, sf):
    per_lang = b.table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return planning.distribution_rows(per_lang, "n").select("lang", "ord", "complexity", "n_class")


@query
def plan_expand(spark, sf):
    n = F.col("n_chars")
    counts = b.table(spark, sf, "documents").agg(
        F.count_if(n < 500).alias("simple"),
        F.count_if((n >= 500) & (n < 2000)).alias("medium"),
        F.count_if(n >= 2000).alias("complex"),
    ).first().asDict()
    return planning.build_plan(spark, planning.resolve_distribution(custom=counts))


@query
def pending_records(spark, sf):
    return planning.pending(b.plan(spark, sf), b.labelled(spark, sf))


@query
def next_batch(spark, sf):
    return planning.next_batch(planning.pending(b.plan(spark, sf), b.labelled(spark, sf)), BATCH)


@query
def next_batch_large(spark, sf):
    todo = planning.pending(b.plan(spark, sf), b.labelled(spark, sf))
    return planning.next_batch(todo, todo.count() // 2, bucket=64)


@query
def prefix_commit(spark, sf):
    failed = b.labelled(spark, sf).filter("quality = 0 and toxic = 1").select(
        "index", F.lit("refused").alias("error")
    )
    return planning.committed_prefix(b.plan(spark, sf).join(failed, "index", "left")).select(
        "index", "record_id"
    )


@query
def id_mismatch(spark, sf):
    found = F.when(F.rlike("text", F.lit('[!"]')), text.record_id(F.col("doc_id") + 2)).when(
        F.col("n_chars") >= 60, F.col("record_id")
    )
    records = b.documents(spark, sf).select("index", found.alias("record_id"))
    return planning.id_mismatches(b.plan(spark, sf), records)


@query
def stage_handoff(spark, sf):
    return planning.handoff_report(b.plan(spark, sf), b.labelled(spark, sf))


@query
def missing_upstream(spark, sf):
    return planning.missing_upstream(b.plan(spark, sf), b.labelled(spark, sf))


@query
def record_lookup(spark, sf):
    records = b.labelled(spark, sf).select("record_id", "quality")
    return planning.lookup_records(b.plan(spark, sf), records)


def status_log(spark, sf):
    return b.table(spark, sf, "events").select(
        text.record_id(F.col("user_id")).alias("record_id"),
        F.col("user_id").alias("index"),
        F.when(F.col("event_type").isin("purchase", "signup"), "completed")
        .when(F.col("event_type") == "error", "failed").otherwise("pending").alias("status"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp_ntz").alias("updated_at"),
    )


@query
def latest_state(spark, sf):
    return planning.latest_state(status_log(spark, sf)).select("record_id", "status", "seq")


@query
def progress(spark, sf):
    return planning.progress(planning.latest_state(status_log(spark, sf))).withColumn(
        "last_at", F.date_format("last_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@query
def completion_counts(spark, sf):
    return planning.completion_by_complexity(b.plan(spark, sf), b.labelled(spark, sf))


@query
def resume_guard(spark, sf):
    docs = b.table(spark, sf, "documents")

    def runs(df, output):
        return df.groupBy("source").agg(
            F.max("lang").alias("model"), F.count(F.lit(1)).alias("_n")
        ).select(
            F.col("source").alias("run_id"),
            F.col("source").alias("input"),
            F.lit(output).alias("output"),
            "model",
            (F.col("_n") / 1000).alias("temperature"),
        )

    labelled = docs.join(b.table(spark, sf, "labels"), "doc_id")
    return planning.resume_conflicts(runs(labelled, "out/a"), runs(docs, "out/a")).select(
        "run_id", "setting"
    )


# -- sampling and prompts ----------------------------------------------------


def sampled(spark, sf):
    records = b.plan(spark, sf).withColumn(
        "tone", sampling.assign_tone(F.lit(None).cast("string"), F.col("record_id"), SEED)
    )
    return sampling.sample_profiles(records, b.profiles(spark, sf), SEED)


@query
def tone_assign(spark, sf):
    return b.plan(spark, sf).select(
        "record_id",
        sampling.assign_tone(F.lit(None).cast("string"), F.col("record_id"), SEED).alias("tone"),
    )


@query
def kpi_sample(spark, sf):
    return sampled(spark, sf).select(
        "record_id", F.posexplode("kpis_used").alias("draw", "kpi")
    ).select("record_id", F.col("draw").cast("bigint").alias("draw"), "kpi.profile_id", "kpi.profile_name")


@query
def kpis_used(spark, sf):
    ids = F.array_join(F.transform("kpis_used", lambda k: k["profile_id"].cast("string")), ",")
    return sampled(spark, sf).select(
        "record_id", F.col("num_kpis").cast("bigint").alias("num_kpis"), ids.alias("profile_ids")
    )


@query
def kpi_section(spark, sf):
    return sampled(spark, sf).select("record_id", prompts.kpi_section(F.col("kpis_used")).alias("section"))


@query
def generation_prompt(spark, sf):
    prompt = prompts.generation_prompt(F.col("kpis_used"), F.col("complexity"), F.col("tone"))
    return sampled(spark, sf).select("record_id", prompt.alias("prompt"))


@query
def extraction_request(spark, sf):
    messages = prompts.extraction_messages(prompts.extraction_user(F.col("utterance")))
    asked = b.documents(spark, sf).select("record_id", messages.alias("messages"))
    return asked.select("record_id", F.inline("messages")).select(
        "record_id", "role", digest(F.col("content")).alias("content_md5")
    )


@query
def messages(spark, sf):
    turns = b.table(spark, sf, "conversations").filter("role = 'user'")
    request = prompts.request_text(
        prompts.extraction_messages(prompts.extraction_user(F.col("text")))
    )
    return turns.select("conv_id", "turn", request.alias("request"))


@query
def feedback_prompt(spark, sf):
    previous = F.to_json("structured_output", {"ignoreNullFields": "false"})
    prompt = prompts.feedback_prompt(
        F.col("utterance"), previous, F.col("metric_results"), evaluation.METRICS
    )
    return b.evaluations(spark, sf).filter("structured_output is not null").select(
        "record_id", prompt.alias("prompt")
    )


@query
def contract_audit(spark, sf):
    audited = prompts.audit_contract(b.documents(spark, sf))
    return audited.select(
        "record_id", F.col("n_words").cast("bigint").alias("n_words"),
        "bad_length", "has_marks", "many_lines", "in_contract",
    )


@query
def contract_summary(spark, sf):
    return prompts.contract_summary(prompts.audit_contract(b.documents(spark, sf)))


# -- completions -------------------------------------------------------------


def hashing_backend(refused: str | None = None) -> completion.Backend:
    """Deterministic backend of the queries.  The nested function travels to
    the workers by value, so they need not have this package."""

    def answer(prompt: str) -> str:
        if refused and refused in prompt:
            raise ValueError("refused")
        return f" answer {hashlib.md5(prompt.encode()).hexdigest()} of {len(prompt)}\n"

    return completion.backend_from_function("only", answer)


@query
def completion_attach(spark, sf):
    """Labelled prompts come from the cache, the others from the backend."""
    store, backend_id = scratch_path(spark, "attempts"), "model-a@0.0"
    asked = b.documents(spark, sf).select(
        "record_id", "doc_id", prompts.extraction_user(F.col("utterance")).alias("prompt")
    )
    known = asked.join(b.labelled(spark, sf).select("doc_id", "faithful_answer"), "doc_id")
    cached = known.groupBy(
        completion.request_id(F.col("prompt"), backend_id).alias("request_id")
    ).agg(F.min("faithful_answer").alias("response"))
    completion.append_attempts(
        cached.withColumns({"run_id": F.lit("earlier"), "attempt": F.lit(1), "endpoint": F.lit(0)}), store
    )
    backend = hashing_backend("!")
    out = completion.attach_completions(
        asked, "prompt", [backend], store, backend_id=backend_id, run_id="now"
    )
    return out.select("record_id", "response", "error")


@query
def completion_resume(spark, sf):
    """Four waves of prompts: a job ends after two, the next one answers only
    what is open.  ``answered_by`` tells the job."""
    store, backend_id = scratch_path(spark, "waves"), "model-a@0.0"
    asked = b.documents(spark, sf).select(
        "record_id", prompts.extraction_user(F.col("utterance")).alias("prompt")
    ).withColumn("request_id", completion.request_id(F.col("prompt"), backend_id))  # so that no prompt is joined later
    n = asked.select("request_id").distinct().count()
    kw = dict(backend_id=backend_id, wave_rows=-(-n // 4))
    for run_id, more in (("first", {"max_waves": 2}), ("second", {})):
        out = completion.attach_completions(asked, "prompt", [hashing_backend()], store, run_id=run_id, **kw, **more)
    calls = completion.attempts_table(spark, store).groupBy("request_id").agg(
        F.max("run_id").alias("answered_by"), F.count(F.lit(1)).alias("calls")
    )
    return spread_join(out.drop("prompt"), calls, "request_id", "inner", spread_by=["record_id"]).select(
        "record_id", "response", "answered_by", "calls"
    )


@query
def error_classes(spark, sf):
    return completion.classify_errors(b.attempts(spark, sf))


@query
def retry_frontier(spark, sf):
    return completion.retry_frontier(b.attempts(spark, sf), 8).select(
        "request_id", "action", F.col("next_endpoint").cast("bigint").alias("next_endpoint")
    )


@query
def generate_stage(spark, sf):
    """The whole generate stage: plan, sample, prompt, complete, commit."""
    total = b.table(spark, sf, "documents").count()
    store = scratch_path(spark, "generate")
    run = Run("run-1", "generate", "part", "model-a", 0.85)
    backend = hashing_backend()
    out = stages.generate(
        spark, b.profiles(spark, sf), store, run, [backend], n_examples=total, seed=SEED
    )
    return out.select(
        "record_id", "complexity", "tone", F.col("num_kpis").cast("bigint").alias("num_kpis"), "utterance"
    )


@query
def stage_resume(spark, sf):
    """The generate stage in three jobs, with a refused start, a job that is
    lost before its commit and a second writer in between: each record with the
    commit that shows it."""
    total = b.table(spark, sf, "documents").count()
    store, after = scratch_path(spark, "resume"), scratch_path(spark, "resume-extract")
    profiles, backend = b.profiles(spark, sf), hashing_backend()

    def job(run_id, **more):
        run = Run(run_id, "generate", "part", "model-a", 0.85)
        return stages.generate(spark, profiles, store, run, [backend], seed=SEED, **more)

    job("run-1", n_examples=total, max_records=total // 3)
    with contextlib.suppress(ValueError):  # upstream is incomplete, so nothing may come of it
        stages.extract(spark, store, after, Run("run-1", "extract", store, "model-a"), [structuring_backend("!")])
    lost = state.draft(spark, store, Run("run-2", "generate", "part", "model-a", 0.85), resume=True)
    rec.append_table(
        stages.stage_records(spark, store, schemas.UTTERANCES, indexed=True), f"{lost.batch}/records",
        stages.with_index(schemas.UTTERANCES),
    )
    job("run-3", resume=True, max_records=total // 3)
    with contextlib.suppress(state.Conflict):  # that number is taken by now
        lost.commit()
    job("run-4", resume=True)
    shown = stages.stage_status(spark, store)
    have = stages.stage_records(spark, store, schemas.UTTERANCES).groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("complexity").alias("complexity")
    )
    return shown.drop("complexity").join(have, "record_id").select(
        "record_id", "index", "complexity", "status", F.col("seq").alias("commit"), "n_rows",
        F.lit(len(state.manifests(spark, after).take(1))).cast("bigint").alias("refused_commits"),
    )


def stage_input(spark, records, schema, name):
    """A finished stage over the documents, for the stage after it."""
    store = scratch_path(spark, name)
    output = f"{store}/data"
    rec.append_table(records, f"{output}/records", stages.with_index(schema))
    records.select("index", "record_id", "complexity").write.parquet(f"{output}/plan")
    state.publish(spark, store, Run("run-0", name, "documents", "model-a"), output)
    return store


def structuring_backend(refused: str) -> completion.Backend:
    def structure(prompt: str) -> str:
        if refused in prompt:
            raise ValueError("refused")
        statement = hashlib.md5(prompt.encode()).hexdigest()
        return f'```json\n{{"normal_statements": ["{statement}"], "schedule": "{len(prompt)}"}}\n```'

    return completion.backend_from_function("structure", structure)


@query
def extract_stage(spark, sf):
    """The whole extract stage; documents with a ``!`` are refused."""
    upstream = stage_input(spark, b.documents(spark, sf), schemas.UTTERANCES, "utterances")
    store = scratch_path(spark, "extract")
    out = stages.extract(
        spark, upstream, store, Run("run-1", "extract", upstream, "model-a"), [structuring_backend("!")]
    )
    return out.select(
        "record_id",
        "structured_status",
        F.col("structured_output.normal_statements")[0].alias("statement"),
        F.col("structured_output.schedule").alias("schedule"),
    )


def coin_backend() -> completion.Backend:
    def judge(prompt: str) -> str:
        return "Yes" if hashlib.md5(prompt.encode()).hexdigest() < "9" else "No: gap"

    return completion.backend_from_function("judge", judge)


@query
def evaluate_stage(spark, sf):
    """The whole evaluate stage over the structured documents."""
    upstream = stage_input(spark, b.structured(spark, sf), schemas.STRUCTURED, "structured")
    store = scratch_path(spark, "evaluate")
    out = stages.evaluate(
        spark, upstream, store, Run("run-1", "evaluate", upstream, "model-a"), [coin_backend()]
    )
    return flat_scores(out)


# -- extraction --------------------------------------------------------------


def completions(spark, sf):
    return b.documents(spark, sf).withColumn("raw", F.expr(b.COMPLETION_SQL))


@query
def fence_strip(spark, sf):
    return completions(spark, sf).select("record_id", text.strip_fences(F.col("raw")).alias("payload"))


@query
def extract_validate(spark, sf):
    parsed = completions(spark, sf).select(
        "record_id", extraction.parse_completion(F.col("raw")).alias("v")
    )
    checked = parsed.select("record_id", val.structured_output(F.col("v")).alias("o"))
    return checked.select(
        "record_id",
        F.col("o").isNotNull().alias("is_valid"),
        F.array_size("o.normal_statements").cast("bigint").alias("n_statements"),
        F.array_join("o.normal_statements", "\n").alias("statements"),
        F.col("o.schedule").alias("schedule"),
    )


@query
def structured_attach(spark, sf):
    return extraction.attach_structured(completions(spark, sf), "raw").select(
        "record_id", "structured_status", "structured_error",
        digest(F.to_json("structured_output")).alias("output_md5"),
    )


def structured_lines(spark, sf):
    return b.documents(spark, sf).select(
        "index", "record_id", val.parse_exact(F.expr(b.STRUCTURED_LINE_SQL)).alias("v")
    )


@query
def output_from_string(spark, sf):
    value = extraction.output_value(F.col("v"))
    return structured_lines(spark, sf).select(
        "record_id",
        val.text_field(value, "schedule").alias("schedule"),
        extraction.output_is_bad_text(F.col("v")).alias("bad_text"),
    )


@query
def structured_issues(spark, sf):
    return repair.classify_structured(structured_lines(spark, sf), "v").select("record_id", "issue")


@query
def structured_issue_counts(spark, sf):
    return repair.issue_counts(structured_issues(spark, sf))


# -- repair ------------------------------------------------------------------


def classified(spark, sf):
    lines = b.documents(spark, sf).select(
        "index", "record_id", F.expr(b.LINE_SQL).alias("value")
    )
    marked = repair.classify_records(rec.parse_lines(lines))
    # the id is what the line says, which may be none
    return marked.withColumn("record_id", val.text_field(F.col("_v"), "record_id"))


@query
def issue_classify(spark, sf):
    return classified(spark, sf).select("index", "record_id", "issue")


@query
def issue_counts(spark, sf):
    return repair.issue_counts(classified(spark, sf))


@query
def issue_summary(spark, sf):
    return repair.issue_summary(classified(spark, sf))


@query
def issue_examples(spark, sf):
    marked = materialise(classified(spark, sf).select("index", "record_id", "issue"), "issues")
    return repair.issue_examples(marked)


def repair_input(spark, sf):
    """Short or marked utterances are to be regenerated; labels are what the
    backend answered (toxic: it failed)."""
    history = F.when(
        F.col("lang") == "en",
        F.array(F.struct(
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("repaired_at"),
            F.lit("earlier").alias("reason"),
        )),
    )
    docs = b.documents(spark, sf).withColumn("repair_history", history).withColumn(
        "issue",
        F.when(text.word_count(F.col("utterance")) < 30, "short")
        .when(F.rlike("utterance", F.lit("[!=]")), "marks"),
    )
    return docs.select("doc_id", "record_id", "utterance", "complexity", "issue", "repair_history")


def repaired(spark, sf):
    at = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    answers = b.labelled(spark, sf).select("doc_id", "toxic", "faithful_answer")

    def regenerate(bad):
        error = F.when(F.col("toxic").isNull(), "no answer").when(F.col("toxic") == 1, "refused")
        new = repair.apply_utterance(
            bad.join(answers, "doc_id", "left"),
            {"utterance": text.strip(F.col("faithful_answer"))}, error, at,
        )
        return new.drop("toxic", "faithful_answer")

    # both branches read the input: it is classified once and written
    marked = materialise(repair_input(spark, sf), "classified")
    return repair.repair_rows(marked, F.col("issue").isNotNull(), regenerate)


@query
def repair_merge(spark, sf):
    return repaired(spark, sf).select(
        "record_id",
        digest(F.col("utterance")).alias("utterance_md5"),
        "repair_error",
        F.coalesce(F.array_size("repair_history"), F.lit(0)).cast("bigint").alias("n_repairs"),
        F.array_join("repair_history.reason", ",").alias("reasons"),
    )


@query
def repair_open_fields(spark, sf):
    """New utterance and complexity merged into lines with undeclared members,
    some of them broken."""
    lines = b.documents(spark, sf).select("record_id", "utterance", F.expr(b.OPEN_LINE_SQL).alias("value"))
    new = {"utterance": F.concat(F.lit("new "), F.md5(F.col("utterance").cast("binary"))), "complexity": F.lit("simple")}
    return lines.select("record_id", objects.merge_object(F.col("value"), new, drop=["gone"]).alias("line"))


@query
def structured_repair_jsonl(spark, sf):
    """The repair job over a structured JSON-lines file; texts with a ``!`` are
    refused.  What the new lines say, and their members in order."""
    path, output = scratch_path(spark, "structured-lines"), scratch_path(spark, "structured-repaired")
    # the texts are put in order, not the longer lines made of them
    docs = b.table(spark, sf, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    b.records_of(docs).select(F.expr(b.STRUCTURED_LINE_SQL).alias("value")).write.text(path)
    side_jobs.repair_structured_lines(
        spark, path, b.plan(spark, sf), output,
        Run("run-1", "repair", "documents", "model-a"), [structuring_backend("!")],
    )
    plan = spark.read.parquet(f"{output}/plan").select("index", F.col("status").alias("plan_status"))
    found = rec.read_jsonl_tolerant(spark, f"{output}/lines").join(plan, "index")
    v = F.col("_v")
    history = F.try_variant_get(v, "$.repair_history", "array<variant>")
    return found.select(
        val.text_field(v, "record_id").alias("record_id"), val.text_field(v, "structured_status").alias("structured_status"),
        val.text_field(v, "structured_error").alias("structured_error"),
        F.try_variant_get(v, "$.structured_output.schedule", "string").alias("schedule"),
        F.coalesce(F.array_size(history), F.lit(0)).cast("bigint").alias("n_repairs"),
        F.array_join(F.transform(objects.members(F.col("value")), lambda m: m["key"]), ",").alias("members"), "plan_status",
    )


@query
def repair_audit(spark, sf):
    at = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    audit = repair.audit_row(
        repaired(spark, sf), "issue", F.col("repair_error").isNotNull(), "run-1", "repair", at
    )
    issues = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("issues_by_type")),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
        ), ",",
    )
    return audit.select(
        "run_id", "records_analyzed", "records_repaired", "records_failed", issues.alias("issues")
    )


@query
def structured_repair_merge(spark, sf):
    """Records without output take over the last line as a new schedule; toxic
    ones fail again."""
    at = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    records = b.structured(spark, sf).select(
        "doc_id", "record_id", "utterance", "structured_output",
        F.when(F.col("doc_id") % 11 != 0, "completed").alias("structured_status"),
        F.lit(None).cast("string").alias("structured_error"),
        F.lit(None).cast(schemas.UTTERANCES["repair_history"].dataType).alias("repair_history"),
    ).withColumn("issue", repair.typed_structured_issue())
    answers = b.labelled(spark, sf).select("doc_id", "toxic")

    def regenerate(bad):
        new = F.struct(
            F.array().cast("array<string>").alias("normal_statements"),
            F.substring_index("utterance", "\n", -1).alias("schedule"),
        )
        error = F.when(F.col("toxic") == 1, "refused")
        return repair.apply_structured(bad.join(answers, "doc_id", "left"), new, error, at).drop("toxic")

    done = repair.repair_rows(records, F.col("issue").isNotNull(), regenerate)
    return done.select(
        "record_id", "issue", "structured_status", "structured_error",
        F.col("structured_output.schedule").alias("schedule"),
        F.array_join("repair_history.reason", ",").alias("reasons"),
    )


def record_states(spark, sf):
    """Rewritten records; copies of a text share an id, some have none."""
    docs = b.documents(spark, sf)
    return docs.select(
        F.when(F.col("doc_id") % 23 != 0, F.md5("text")).alias("record_id"),
        F.col("doc_id").alias("seq"),
        (F.col("n_chars") * 2).alias("offset"),
        F.when(F.col("doc_id") % 11 == 0, F.lit("")).when(F.col("n_chars") < 100, F.lit("failed"))
        .otherwise(F.lit("completed")).alias("structured_status"),
    )


def synced(spark, sf):
    plan = b.documents(spark, sf).select(
        "index", F.md5("text").alias("record_id"),
        F.lit(None).cast("bigint").alias("output_offset"), F.lit(None).cast("string").alias("status"),
    )
    return repair.sync_plan(plan, record_states(spark, sf), "seq")


@query
def plan_sync(spark, sf):
    return synced(spark, sf).select("index", "record_id", "output_offset", "status")


@query
def plan_sync_summary(spark, sf):
    return repair.sync_summary(synced(spark, sf))


# -- offsets -----------------------------------------------------------------


def utterance_lines(spark, sf):
    return b.documents(spark, sf).select("index", F.expr(b.LINE_SQL).alias("value"))


def write_lines(lines, path):
    """``value`` as eight text files in index order."""
    ordered = lines.repartitionByRange(8, "index").sortWithinPartitions("index")
    ordered.select("value").write.text(path)


@query
def record_offsets(spark, sf):
    return offsets.record_offsets(utterance_lines(spark, sf))


@query
def file_offsets(spark, sf):
    """Offsets of written files, strung together in file order."""
    path = scratch_path(spark, "offset-lines")
    utterance_lines(spark, sf).repartitionByRange(8, "index").sortWithinPartitions("index").select(
        "value"
    ).write.text(path)
    found = materialise(offsets.file_offsets(spark, path), "found-offsets")
    sizes = spark.read.option("lineSep", "\n").text(path).groupBy(
        F.col("_metadata.file_path").alias("file")
    ).agg(F.count(F.lit(1)).alias("_lines"), F.sum(F.octet_length("value") + 1).alias("_bytes"))
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(
        "file",
        F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_lines"),
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes"),
    )
    return found.join(before, "file").select(
        (F.col("index") + F.col("_lines")).alias("index"), (F.col("offset") + F.col("_bytes")).alias("offset")
    )


def stale_plan(spark, sf):
    """Offsets that count characters; they go wrong after the first
    multi-byte character.  The plan lacks the single-line documents."""
    docs = b.documents(spark, sf)
    ascii_lines = docs.select("index", F.expr(b.LINE_SQL).alias("value")).withColumn(
        "value", F.regexp_replace("value", r"[^\x00-\x7f]", "?")
    )
    plan = docs.filter(F.contains("text", F.lit("\n"))).select("index", "record_id")
    return plan.join(offsets.record_offsets(ascii_lines), "index")


@query
def offset_diff(spark, sf):
    return offsets.changed_offsets(
        stale_plan(spark, sf), offsets.record_offsets(utterance_lines(spark, sf))
    )


@query
def offset_update(spark, sf):
    """Positions beyond the rewritten file keep their offset."""
    kept = utterance_lines(spark, sf).join(
        b.labelled(spark, sf).select("index"), "index", "left_semi"
    )
    return offsets.update_offsets(stale_plan(spark, sf), offsets.record_offsets(kept))


@query
def offset_update_files(spark, sf):
    """The plan's offsets after an edit of a data set of several files."""
    path, plan = scratch_path(spark, "edited-lines"), scratch_path(spark, "edited-plan")
    write_lines(utterance_lines(spark, sf), path)
    side_jobs.recalculate_offsets(spark, path, stale_plan(spark, sf), plan)
    return spark.read.parquet(plan)


# -- refinement --------------------------------------------------------------


def refine_structured(spark, sf):
    """Structured side of the refinement: single-line documents are missing."""
    return many_line_records(spark, sf)


@query
def refine_candidates(spark, sf):
    return refine.pair_candidates(b.evaluations(spark, sf), refine_structured(spark, sf)).select(
        "record_id", "overall_score", "skip_reason"
    )


@query
def refine_counts(spark, sf):
    return refine.candidate_counts(
        refine.pair_candidates(b.evaluations(spark, sf), refine_structured(spark, sf))
    )


@query
def refine_prompts(spark, sf):
    pairs = refine.pair_candidates(b.evaluations(spark, sf), refine_structured(spark, sf))
    return refine.refine_requests(pairs).select("record_id", digest(F.col("prompt")).alias("prompt_md5"))


def refined(spark, sf):
    """New scores: the judge now accepts what it called incomplete."""
    pairs = refine.pair_candidates(b.evaluations(spark, sf), refine_structured(spark, sf)).filter(
        "skip_reason is null"
    )
    labels = b.labelled(spark, sf).select("record_id", "faithful_answer", "schedule_answer")
    again = pairs.select("record_id", "structured_output").join(labels, "record_id").withColumn(
        "faithful_answer",
        F.when(F.startswith("faithful_answer", F.lit("**")), "YES").otherwise(F.col("faithful_answer")),
    )
    return evaluation.evaluate(again, b.ANSWERS)


@query
def refine_upsert(spark, sf):
    columns = ["metric_results", "overall_score", "overall_pass"]
    evals = b.evaluations(spark, sf).select("record_id", *columns)
    return flat_scores(refine.upsert(evals, refined(spark, sf), columns))


@query
def refine_by_file(spark, sf):
    """New scores for records of the first quarter, copy on write over a store
    of four commits.  ``carried`` tells for the other quarters that their files
    are the old ones."""
    total = b.table(spark, sf, "documents").count()
    store, quarter = scratch_path(spark, "refine"), max(1, total // 4)
    columns = ["metric_results", "overall_score", "overall_pass"]
    evals = materialise(b.evaluations(spark, sf).select("index", "record_id", *columns), "refine-evals")
    run = Run("run-1", "evaluate", "documents", "model-a")
    for n in range(4):
        draft = state.draft(spark, store, run, resume=n > 0)
        if not n:
            evals.select("index", "record_id").withColumn("complexity", F.lit("simple")).write.parquet(f"{draft.output}/plan")
        mine = evals.filter(F.least(F.expr(f"index div {quarter}"), F.lit(3)) == n)
        rec.append_table(mine, f"{draft.batch}/records", stages.with_index(schemas.EVALUATIONS))
        rec.append_table(mine.selectExpr("record_id", "index", "'completed' as status", f"{draft.seq}L as seq"), f"{draft.batch}/status", schemas.PLAN_STATUS)
        draft.commit()
    first = evals.filter(F.col("index") < quarter).select("record_id")
    changes = materialise(refined(spark, sf).join(first, "record_id", "left_semi").select("record_id", *columns), "refine-changes")
    draft = state.revise(spark, store, Run("run-2", "refine", "documents", "model-a"))
    stages.replace_columns(draft, changes, columns, schemas.EVALUATIONS)
    draft.commit()
    new_file = F.col("_metadata.file_path").contains(draft.batch.rpartition("/")[2])
    out = stages.stage_records(spark, store, schemas.EVALUATIONS, indexed=True).withColumn("_new", new_file)
    return flat_scores(out, F.when(F.col("index") >= quarter, ~F.col("_new")).alias("carried"))


@query
def score_delta(spark, sf):
    return refine.score_delta(b.evaluations(spark, sf), refined(spark, sf))


# -- sources and sinks -------------------------------------------------------


@query
def csv_scan(spark, sf):
    path = scratch_path(spark, "profiles")
    named = b.profiles(spark, sf).toDF(*schemas.PROFILE_CSV_COLUMNS)
    named.write.option("header", True).option("escape", '"').csv(path)
    return rec.read_profiles(spark, path)


def written_utterances(spark, sf):
    path = scratch_path(spark, "utterances")
    docs = b.documents(spark, sf).select(
        "record_id", "utterance", "complexity",
        F.lit(None).cast("string").alias("processed"),
        F.lit(1).alias("_line_number"),
    )
    rec.write_jsonl(rec.conform(docs, schemas.UTTERANCES).withColumn("_internal", F.lit(1)), path)
    return path


@query
def jsonl_strict(spark, sf):
    """Write JSON lines (nulls kept, internal fields dropped), read them back."""
    lines = rec.read_jsonl_checked(spark, written_utterances(spark, sf), schemas.UTTERANCES)
    return lines.select("record_id", digest(F.col("utterance")).alias("text_md5"), "complexity", "processed")


@query
def jsonl_append(spark, sf):
    """Two appends of JSON lines to the same folder."""
    path = scratch_path(spark, "appended")
    docs = b.documents(spark, sf).select("record_id", "source", "lang")
    rec.append_jsonl(docs.filter("lang = 'en'"), path)
    rec.append_jsonl(docs.filter("not (lang <=> 'en')"), path)
    return rec.read_jsonl(spark, path, docs.schema)


@query
def jsonl_tolerant(spark, sf):
    """Damaged lines keep their place; single file order is the plan order."""
    path = scratch_path(spark, "lines")
    utterance_lines(spark, sf).repartitionByRange(8, "index").sortWithinPartitions("index").select(
        "value"
    ).write.text(path)
    found = rec.read_jsonl_tolerant(spark, path)
    return repair.classify_records(found).select(
        "index", F.col("_malformed").alias("malformed"), "issue"
    )


@query
def jsonl_located_errors(spark, sf):
    """Line number and reason of every broken or wrongly typed line of several files."""
    path = scratch_path(spark, "broken-lines")
    lines = b.documents(spark, sf).select("index", F.expr(b.TYPED_LINE_SQL).alias("value"))
    write_lines(lines, path)
    return rec.located_errors(spark, path, schemas.UTTERANCES).select("index", "reason", digest(F.col("value")).alias("line_md5"))


@query
def incremental_stream(spark, sf):
    """Stream the documents through the utterance check into a table."""
    # a stream source wants a folder or a pattern, not the name of one file
    source = spark.readStream.schema(b.table(spark, sf, "documents").schema).parquet(
        f"{sf}/documents[.]parquet"
    )

    def check(batch):
        words = text.word_count(F.col("text"))
        return batch.select(
            text.record_id(F.col("doc_id")).alias("record_id"), words.cast("bigint").alias("n_words"),
            (words >= repair.MIN_WORDS).alias("long_enough"),
        )

    sink, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    schema = check(b.table(spark, sf, "documents")).schema
    # the second stream has a checkpoint of its own and finds every record written
    for state in (checkpoint, f"{checkpoint}-2"):
        incremental.stream_stage(source, check, sink, state, schema).awaitTermination()
    return incremental.sink_table(spark, sink, schema).drop(*incremental.FOLDERS)
