"""Stage jobs end to end with deterministic backends."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillgate import schemas
from quillgate.operators import prompts
from quillgate.operators.completion import backend_from_function
from quillgate.plans import side_jobs, stages
from quillgate.sources import records as rec, state
from quillgate.sources.state import Run


# the workers cannot import this module, so its functions travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_text(prompt):
    import hashlib
    return "Target users " + " ".join(hashlib.md5(prompt.encode()).hexdigest())


def structure(prompt):
    import hashlib
    import json
    body = json.dumps({"normal_statements": ["Target users"], "schedule": hashlib.md5(prompt.encode()).hexdigest()})
    return f"```json\n{body}\n```"


def judge_by_hash(prompt):
    import hashlib
    return "YES fine" if int(hashlib.md5(prompt.encode()).hexdigest(), 16) % 3 else "NO gap"


WRITE = [backend_from_function("write", write_text)]
STRUCTURE = [backend_from_function("structure", structure)]
JUDGE = [backend_from_function("judge", judge_by_hash)]


def refusing(fn, word):
    def answer(prompt):
        if word in prompt:
            raise ValueError("refused")
        return fn(prompt)

    return [backend_from_function("refusing", answer)]


def run(stage, n=1, **kw):
    return Run(f"{stage}-{n}", stage, "in", "m", **kw)


@pytest.fixture(scope="module")
def profiles(spark):
    return spark.createDataFrame([(i, f"n{i}", f"d{i}") for i in range(30)], schemas.PROFILES)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_resumed_run_equals_one_run(spark, profiles, tmp_path):
    one, two = f"{tmp_path}/one", f"{tmp_path}/two"
    whole = stages.generate(spark, profiles, one, run("generate"), WRITE, n_examples=17, seed=3)
    stages.generate(spark, profiles, two, run("generate"), WRITE, n_examples=17, seed=3, max_records=6)
    assert stages.stage_progress(spark, two).first()["completed"] == 6
    rest = stages.generate(spark, profiles, two, run("generate", 2), WRITE, seed=3, resume=True)
    key = ("record_id", "utterance", "kpis_used", "complexity", "tone", "num_kpis")
    assert whole.count() == 17
    assert rows(whole, *key) == rows(rest, *key)
    last = stages.stage_progress(spark, two).first()
    assert (last["planned"], last["completed"], last["last_id"]) == (17, 17, "rule-000017")
    again = stages.generate(spark, profiles, two, run("generate", 3), WRITE, seed=3, resume=True)
    assert again.count() == 17


def test_resume_checks_settings(spark, profiles, tmp_path):
    store = f"{tmp_path}/g"
    with pytest.raises(FileNotFoundError):
        stages.generate(spark, profiles, store, run("generate"), WRITE, resume=True)
    stages.generate(spark, profiles, store, run("generate", temperature=0.5), WRITE, n_examples=2)
    with pytest.raises(ValueError, match="temperature"):
        stages.generate(spark, profiles, store, run("generate", 2, temperature=0.6), WRITE, resume=True)


def test_failures_are_kept_apart_and_done_on_resume(spark, profiles, tmp_path):
    all_good, prefix = f"{tmp_path}/a", f"{tmp_path}/b"
    bad = refusing(write_text, "Complexity: MEDIUM")
    got = stages.generate(spark, profiles, all_good, run("generate"), bad, n_examples=9)
    assert rows(got, "complexity") == [("complex",)] * 3 + [("simple",)] * 3
    status = stages.stage_status(spark, all_good)
    assert rows(status.filter("status = 'failed'"), "index", "error") == [
        (i, "ValueError: refused") for i in (3, 4, 5)
    ]
    cut = stages.generate(spark, profiles, prefix, run("generate"), bad, n_examples=9, prefix_only=True)
    assert rows(cut, "record_id") == [(f"rule-00000{i}",) for i in (1, 2, 3)]
    done = stages.generate(spark, profiles, all_good, run("generate", 2), WRITE, resume=True)
    assert done.count() == 9


@pytest.fixture(scope="module")
def stores(spark, profiles, tmp_path_factory):
    base = tmp_path_factory.mktemp("chain")
    g, x, e = f"{base}/generate", f"{base}/extract", f"{base}/evaluate"
    stages.generate(spark, profiles, g, run("generate"), WRITE, n_examples=30)
    stages.extract(spark, g, x, run("extract"), STRUCTURE, max_records=11)
    stages.extract(spark, g, x, run("extract", 2), STRUCTURE, resume=True)
    stages.evaluate(spark, x, e, run("evaluate"), JUDGE)
    return base, g, x, e


def test_chain(spark, stores):
    base, g, x, e = stores
    structured = stages.stage_records(spark, x, schemas.STRUCTURED)
    assert structured.count() == structured.select("record_id").distinct().count() == 30
    assert structured.filter("structured_status = 'completed' and structured_error is null").count() == 30
    for r in structured.collect():
        request = "\n\n".join(["system:\n" + prompts.EXTRACT_SYSTEM, "user:\n" + prompts.EXTRACT_USER + r["utterance"]])
        want = json.loads(structure(request).split("\n")[1])
        assert r["structured_output"]["schedule"] == want["schedule"]
    evals = stages.stage_records(spark, e, schemas.EVALUATIONS)
    assert evals.count() == 30
    assert {r["overall_score"] for r in evals.collect()} <= {33.33, 66.67, 100.0}
    summary = stages.filter_by_verdict(spark, e, x, f"{base}/split", "json").first()
    assert summary["total"] == 30 and summary["passed"] + summary["failed"] == 30
    for verdict in ("passed", "failed"):
        part = spark.read.json(f"{base}/split/verdict={verdict}")
        assert part.count() == summary[verdict]
        assert {r[0] for r in part.select("evaluation.overall_pass").collect()} <= {verdict == "passed"}


def test_incomplete_upstream_is_refused(spark, profiles, tmp_path):
    g, x = f"{tmp_path}/g", f"{tmp_path}/x"
    stages.generate(spark, profiles, g, run("generate"), WRITE, n_examples=4, max_records=3)
    with pytest.raises(ValueError, match="incomplete"):
        stages.extract(spark, g, x, run("extract"), STRUCTURE)
    part = stages.extract(spark, g, f"{tmp_path}/y", run("extract"), STRUCTURE, allow_partial=True)
    assert part.count() == 3


def test_rejected_answer_is_asked_again(spark, profiles, tmp_path):
    g, x = f"{tmp_path}/g", f"{tmp_path}/x"
    stages.generate(spark, profiles, g, run("generate"), WRITE, n_examples=4)
    prose = [backend_from_function("prose", lambda p: "sorry, no JSON")]
    assert stages.extract(spark, g, x, run("extract"), prose).count() == 0
    failed = stages.stage_status(spark, x).filter("status = 'failed'")
    assert failed.count() == 4
    assert stages.extract(spark, g, x, run("extract", 2), STRUCTURE, resume=True).count() == 4
    assert stages.stage_progress(spark, x).first()["completed"] == 4


def test_refine(spark, profiles, tmp_path):
    g, x, e = f"{tmp_path}/g", f"{tmp_path}/x", f"{tmp_path}/e"
    stages.generate(spark, profiles, g, run("generate"), WRITE, n_examples=12)
    stages.extract(spark, g, x, run("extract"), STRUCTURE)
    before = {r["record_id"]: r for r in stages.evaluate(spark, x, e, run("evaluate"), JUDGE).collect()}
    low = {i for i, r in before.items() if r["overall_score"] < 90}
    assert low and len(low) < 12
    counts = side_jobs.refine_low_scores(
        spark, e, x, run("refine"), STRUCTURE, JUDGE, dry_run=True
    ).first()
    assert counts["low"] == counts["to_refine"] == len(low)
    yes = [backend_from_function("yes", lambda p: "yes")]
    delta = side_jobs.refine_low_scores(spark, e, x, run("refine"), STRUCTURE, yes)
    assert {r["record_id"] for r in delta.collect()} == low
    after = {r["record_id"]: r for r in stages.stage_records(spark, e, schemas.EVALUATIONS).collect()}
    assert set(after) == set(before)
    for i in before:
        assert after[i]["overall_score"] == (100.0 if i in low else before[i]["overall_score"])
    assert stages.stage_records(spark, x, schemas.STRUCTURED).count() == 12
    no = [backend_from_function("no", lambda p: "no")]
    none = side_jobs.refine_low_scores(spark, e, x, run("refine", 2), STRUCTURE, no)
    assert none.count() == 0


def test_repair_structured(spark, profiles, tmp_path):
    g, x = f"{tmp_path}/g", f"{tmp_path}/x"
    stages.generate(spark, profiles, g, run("generate"), WRITE, n_examples=6)
    stages.extract(spark, g, x, run("extract"), STRUCTURE)
    whole = stages.stage_records(spark, x, schemas.STRUCTURED, indexed=True)
    hurt = whole.withColumn(
        "structured_output", F.when(F.col("index") != 1, F.col("structured_output"))
    ).withColumn("structured_status", F.when(F.col("index") != 2, F.col("structured_status"))).withColumn(
        "utterance", F.when(F.col("index") != 3, F.col("utterance"))
    )
    output = f"{x}/data-hurt"
    rec.append_table(hurt, f"{output}/records", stages.with_index(schemas.STRUCTURED))
    stages.stage_plan(spark, x).write.parquet(f"{output}/plan")
    state.publish(spark, x, Run("hurt", "extract", "in", "m"), output)
    counts = dict(rows(side_jobs.repair_structured(spark, x, run("repair"), STRUCTURE, dry_run=True), "issue", "records"))
    assert counts == {"missing_structured_output": 1, "incomplete_status": 1, "missing_utterance": 1}
    audit = side_jobs.repair_structured(spark, x, run("repair"), STRUCTURE).first()
    assert (audit["records_analyzed"], audit["records_repaired"], audit["records_failed"]) == (6, 2, 1)
    assert audit["issues_by_type"] == counts
    after = {r["index"]: r for r in stages.stage_records(spark, x, schemas.STRUCTURED, indexed=True).collect()}
    assert len(after) == 6
    assert after[1]["structured_output"] and after[1]["repair_history"][0]["reason"] == "structured_regeneration"
    assert after[2]["structured_status"] == "completed"
    assert after[3]["structured_status"] == "failed" and after[3]["structured_error"]
    assert after[0]["repair_history"] is None
    status = dict(rows(stages.stage_status(spark, x).groupBy("status").count(), "status", "count"))
    assert status == {"completed": 5, "failed": 1}


def test_repair_dataset(spark, profiles, tmp_path):
    good = {"record_id": "rule-000001", "utterance": "w " * 12, "kpis_used": [], "complexity": "simple", "extra": [1, None]}
    lines = [
        json.dumps(good), "{broken", json.dumps({**good, "record_id": "rule-000003", "utterance": "too short", "tone": "formal"}),
        "", json.dumps({**good, "record_id": "rule-000005", "utterance": None, "complexity": "complex"}),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.jsonl").write_text("\n".join(lines) + "\n")
    from quillgate.operators import planning
    plan = planning.build_plan(spark, {"simple": 2, "medium": 2, "complex": 2})
    kw = dict(min_words=10)
    shown = side_jobs.repair_dataset(
        spark, f"{tmp_path}/in", plan, profiles, f"{tmp_path}/dry", run("repair"), WRITE, dry_run=True, **kw
    )
    assert dict(rows(shown, "issue", "examples")) == {
        "malformed_json": "index-1, index-3", "too_short_2_words": "rule-000003", "empty_utterance": "rule-000005",
    }
    out = f"{tmp_path}/out"
    backend = refusing(write_text, "Complexity: COMPLEX")
    audit = side_jobs.repair_dataset(spark, f"{tmp_path}/in", plan, profiles, out, run("repair"), backend, **kw).first()
    assert (audit["records_analyzed"], audit["records_repaired"], audit["records_failed"]) == (5, 3, 1)
    assert audit["issues_by_type"] == {"malformed_json": 2, "too_short": 1, "empty_utterance": 1}
    new = [r["value"] for r in rec.numbered_lines(spark, f"{out}/lines").orderBy("index").collect()]
    assert new[0] == lines[0] and new[4] == lines[4]
    fixed = [json.loads(new[i]) for i in (1, 2, 3)]
    assert [r["record_id"] for r in fixed] == ["rule-000002", "rule-000003", "rule-000004"]
    assert [r["complexity"] for r in fixed] == ["simple", "simple", "medium"]
    assert fixed[1]["tone"] == "formal"
    assert fixed[1]["extra"] == [1, None] and list(fixed[1])[:5] == list(good)
    assert all(r["num_kpis"] == len(r["kpis_used"]) >= 1 and r["processed"] is None for r in fixed)
    at, want = 0, []
    for line in new:
        want.append(at)
        at += len(line.encode()) + 1
    got = spark.read.parquet(f"{out}/plan").orderBy("index").collect()
    assert [r["offset"] for r in got] == want + [None]
    assert rows(spark.read.parquet(f"{out}/failures"), "record_id", "error") == [("rule-000005", "ValueError: refused")]


def test_repair_structured_lines(spark, tmp_path):
    whole = {"normal_statements": ["a"], "schedule": "now", "more": [1]}
    lines = [
        {"x": 1, "record_id": "a", "utterance": "u", "structured_output": whole, "structured_status": "completed"},
        {"record_id": "b", "structured_output": json.dumps(whole), "utterance": "u", "structured_status": "completed", "y": None},
        {"structured_error": "old", "record_id": "c", "utterance": "v", "structured_status": "failed", "z": {"k": "5"},
         "repair_history": [{"reason": "first", "by": 3}]},
        {"record_id": "d", "structured_output": whole}, {"record_id": "e", "utterance": "stop", "structured_output": "{"},
    ]
    (tmp_path / "in.jsonl").write_text("\n".join([*map(json.dumps, lines), "{broken", "[1]"]) + "\n")
    plan = spark.createDataFrame([(i, c, "simple") for i, c in enumerate("abcdef")], "index long, record_id string, complexity string")
    args = (spark, f"{tmp_path}/in.jsonl", plan)
    backend = refusing(structure, "stop")
    counts = dict(rows(side_jobs.repair_structured_lines(*args, f"{tmp_path}/dry", run("fix"), backend, dry_run=True), "issue", "records"))
    assert counts == {"missing_structured_output": 1, "missing_utterance": 1, "structured_output_not_json": 1, "malformed_json": 2}
    audit = side_jobs.repair_structured_lines(*args, f"{tmp_path}/out", run("fix"), backend).first()
    assert (audit["records_analyzed"], audit["records_repaired"], audit["records_failed"]) == (7, 1, 4)
    text = [r["value"] for r in rec.numbered_lines(spark, f"{tmp_path}/out/lines").orderBy("index").collect()]
    assert text[0] == json.dumps(lines[0]) and text[5:] == ["{broken", "[1]"]
    new = [json.loads(t) for t in text[:5]]
    assert new[1] == {**lines[1], "structured_output": whole} and list(new[1]) == list(lines[1])
    assert list(new[2]) == ["record_id", "utterance", "structured_status", "z", "repair_history", "structured_output"]
    assert new[2]["z"] == {"k": "5"} and new[2]["structured_status"] == "completed"
    assert new[2]["repair_history"][0] == {"by": 3, "reason": "first"}
    assert new[2]["repair_history"][1] == {"repaired_at": "1970-01-01T00:00:00", "reason": "structured_regeneration"}
    assert new[3] == {**lines[3], "structured_status": "failed", "structured_error": "record has no utterance"}
    assert new[4] == {**lines[4], "structured_status": "failed", "structured_error": "ValueError: refused"}
    at = [sum(len(t.encode()) + 1 for t in text[:i]) for i in range(5)]
    got = spark.read.parquet(f"{tmp_path}/out/plan").orderBy("index").collect()
    assert [(r["status"], r["output_offset"]) for r in got] == [*zip(["completed"] * 3 + ["failed"] * 2, at), (None, None)]
    assert rows(spark.read.parquet(f"{tmp_path}/out/failures"), "index", "error")[0] == (3, "record has no utterance")


def test_recalculate_offsets(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a":1}\n{"a":"' + chr(0xE9) + '"}\n{}\n')
    plan = spark.createDataFrame([(0, 0), (1, 8), (2, 17), (3, 99)], "index long, offset long")
    changed = side_jobs.recalculate_offsets(spark, str(path), plan, f"{tmp_path}/plan")
    assert rows(changed, "index", "new_offset") == [(2, 19)]
    assert rows(spark.read.parquet(f"{tmp_path}/plan"), "index", "offset") == [(0, 0), (1, 8), (2, 19), (3, 99)]


def test_own_metric(spark):
    from quillgate.operators import evaluation
    short = evaluation.Metric(
        "brief", lambda u, s: F.concat(F.lit("Brief? "), u), 1.0, lambda r: F.length(r) < 4
    )
    df = spark.createDataFrame(
        [("a", "u", ([], "")), ("b", "v", ([], "x"))],
        "record_id string, utterance string, structured_output struct<normal_statements:array<string>,schedule:string>",
    )
    asked = evaluation.judge_requests(df, [short])
    assert rows(asked, "record_id", "metric", "prompt") == [("a", "brief", "Brief? u"), ("b", "brief", "Brief? v")]
    answers = asked.withColumns({"response": F.col("record_id"), "error": F.lit(None).cast("string")}).withColumn(
        "response", F.when(F.col("record_id") == "a", "ok").otherwise("too long")
    )
    got = evaluation.evaluate(
        df.join(evaluation.pivot_answers(answers, [short]), "record_id"), {"brief": "answer_brief"}, metrics=[short]
    )
    assert rows(got, "record_id", "overall_score", "metric_results.brief.passed") == [("a", 100.0, True), ("b", 50.0, False)]


def test_own_metrics_through_the_stage(spark, stores, tmp_path):
    """A fourth metric goes through judge, store, reports, gate and filter."""
    from quillgate.operators import evaluation, refine
    base, _, x, _ = stores
    brief = evaluation.Metric("brief one", lambda u, s: F.concat(F.lit("Brief? "), u), 0.5, lambda r: F.length(r) / 100)
    mine = [*evaluation.judged_metrics(), brief]
    e = f"{tmp_path}/evaluate"
    got = stages.evaluate(spark, x, e, run("evaluate"), JUDGE, max_records=10, metrics=mine)
    assert evaluation.metric_names(got) == ["schema", "faithfulness", "schedule", "brief one"]
    with pytest.raises(ValueError):  # other metrics cannot go on with this run
        stages.evaluate(spark, x, e, run("evaluate", 2), JUDGE, resume=True)
    got = stages.evaluate(spark, x, e, run("evaluate", 2), JUDGE, resume=True, metrics=mine)
    assert got.count() == 30 and got.filter("metric_results.`brief one` is null").count() == 0
    rates = {r.metric: r.records for r in evaluation.pass_rates(got).collect()}
    assert rates == {"schema": 30, "faithfulness": 30, "schedule": 30, "brief one": 30, "overall": 30}
    assert all("brief one: " in r.reasons for r in evaluation.top_failing(got.withColumn("overall_pass", F.lit(False)), 3).collect()
               if "brief one" in r.reasons)
    gate = evaluation.metric_gate(got.withColumn("lang", F.lit("en")), {"brief one": 0.0}).collect()
    assert {r.metric for r in gate} == {"brief one"} and all(r.gate_open for r in gate)
    assert stages.filter_by_verdict(spark, e, x, f"{tmp_path}/split", metrics=mine).first()["total"] == 30
    prompts_ = refine.refine_requests(refine.pair_candidates(got, stages.stage_records(spark, x, schemas.STRUCTURED), 101.0))
    assert prompts_.filter(F.col("prompt").contains("Brief One")).count() == prompts_.filter("metric_results.`brief one`.reason <> ''").count()
    with pytest.raises(ValueError, match="unique"):
        evaluation.registry([brief, brief])
