import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillgate import schemas
from quillgate.functions import text
from quillgate.operators import (
    completion, evaluation, gate, offsets, planning, prompts, refine, repair, sampling,
)
from quillgate.operators.joins import last_per_key, spread_join
from quillgate.session import scratch_root
from quillgate.sources import records as rec


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# -- joins -------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_spread_join_equals_join(spark, how):
    rng = random.Random(1)
    keys = ["hot"] * 700 + [f"k{rng.randrange(40)}" for _ in range(300)] + [None] * 20 + ["none"] * 300
    left = spark.createDataFrame(list(enumerate(keys)), "i int, key string").repartition(7)
    left = left.unionByName(left)
    right = spark.createDataFrame(
        [("hot", 1)] + [(f"k{i}", i) for i in range(20)] + [(None, 5)], "key string, v int"
    )
    got = spread_join(left, right, "key", how, hot_rows=100)
    want = left.join(right, "key", how)
    assert got.columns == want.columns
    key = lambda r: repr(r)
    assert sorted(map(key, map(tuple, got.collect()))) == sorted(map(key, map(tuple, want.collect())))


def test_hot_key_is_split(spark):
    left = spark.range(0, 4000, numPartitions=8).select("id", F.lit("hot").alias("key"))
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = spread_join(left, right, "key", hot_rows=100).groupBy(F.spark_partition_id()).count()
        assert parts.count() > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, n int, v string")
    assert rows(last_per_key(df, "k", "n"), "k", "v") == [("a", "y"), ("b", "w")]


# -- planning ----------------------------------------------------------------


@pytest.mark.parametrize("n, want", [(1, (1, 0, 0)), (2, (1, 1, 0)), (3, (1, 1, 1)), (5, (2, 2, 1))])
def test_even_distribution(n, want):
    assert tuple(planning.resolve_distribution(n).values()) == want


def test_custom_distribution():
    got = planning.resolve_distribution(custom={"simple": 2, "unknown": 9})
    assert got == {"simple": 2, "medium": 0, "complex": 0}
    with pytest.raises(ValueError):
        planning.resolve_distribution(custom={"simple": 0})
    with pytest.raises(ValueError):
        planning.resolve_distribution(0)


def test_plan_skips_an_empty_class(spark):
    got = rows(planning.build_plan(spark, {"simple": 1, "medium": 0, "complex": 2}), "index", "record_id", "complexity")
    assert got == [(0, "rule-000001", "simple"), (1, "rule-000002", "complex"), (2, "rule-000003", "complex")]


def test_next_batch_by_cut(spark):
    rng = random.Random(2)
    index = sorted(rng.sample(range(1000), 300))
    todo = spark.createDataFrame([(i, f"r{i}") for i in index], "index long, record_id string")
    for n in (1, 63, 64, 150, 299, 300, 500):
        cut = planning.next_batch(todo, n, bucket=16)
        assert rows(cut, "index") == [(i,) for i in index[:n]]
        assert rows(planning.next_batch(todo, n), "index") == [(i,) for i in index[:n]]


def test_handoff_needs_a_complete_upstream(spark):
    plan = planning.build_plan(spark, {"simple": 3})
    have = plan.filter("index < 2")
    with pytest.raises(ValueError, match="1 of 3"):
        planning.next_stage_plan(plan, have)
    assert planning.next_stage_plan(plan, have, allow_partial=True).count() == 2
    assert planning.next_stage_plan(plan, plan).count() == 3


def test_prefix_without_error_keeps_all(spark):
    df = spark.createDataFrame([(0, None), (1, None)], "index long, error string")
    assert planning.committed_prefix(df).count() == 2
    bad = spark.createDataFrame([(0, None), (1, "x"), (2, None)], "index long, error string")
    assert rows(planning.committed_prefix(bad), "index") == [(0,)]


def test_id_mismatch_accepts_a_missing_id(spark):
    plan = planning.build_plan(spark, {"simple": 4})
    records = spark.createDataFrame(
        [(0, "rule-000001"), (1, None), (2, ""), (3, "rule-000009")], "index long, record_id string"
    )
    assert rows(planning.id_mismatches(plan, records), "index", "found_id") == [(3, "rule-000009")]


def test_resume_conflicts(spark):
    schema = "run_id string, input string, output string, model string, temperature double, thresholds map<string,double>"
    old = spark.createDataFrame([("r", "i", "o", "m", 0.5, {"a": 0.8})], schema)
    same = spark.createDataFrame([("r", "i", "o", "m", 0.5 + 1e-12, {"a": 0.8})], schema)
    assert planning.resume_conflicts(same, old).count() == 0
    new = spark.createDataFrame([("r", "j", "o", None, 0.6, {"a": 0.9})], schema)
    assert rows(planning.resume_conflicts(new, old), "setting") == [
        ("input",), ("model",), ("temperature",), ("thresholds",)
    ]


# -- sampling ----------------------------------------------------------------


def profiles(spark, n):
    return spark.createDataFrame(
        [(1000 + 3 * i, f"p{i}", f"d{i}") for i in range(n)], schemas.PROFILES
    )


@pytest.mark.parametrize("n", [1, 2, 4, 64, 65, 700])
def test_sample_is_whole_and_without_repeats(spark, n):
    plan = planning.build_plan(spark, planning.resolve_distribution(60))
    table = profiles(spark, n)
    near = sampling.sample_profiles(plan, table, "s")
    for r in near.collect():
        low, high = sampling.DRAWS[r["complexity"]]
        ids = [k["profile_id"] for k in r["kpis_used"]]
        assert len(set(ids)) == len(ids) == r["num_kpis"]
        assert min(low, n) <= len(ids) <= min(high, n)
    far = sampling.sample_profiles(plan, table, "s", broadcast_bytes=0)
    key = ("record_id", "kpis_used", "num_kpis")
    assert rows(near, *key) == rows(far, *key)


def test_sample_is_the_same_for_any_limit(spark):
    ids = ["a", "a", None, None, "b", "c"]
    records = spark.createDataFrame([(i, x, "complex") for i, x in enumerate(ids)], "index long, record_id string, complexity string")
    table = profiles(spark, 30).union(profiles(spark, 3).withColumn("profile_name", F.lit("again")))
    near, far = (rows(sampling.sample_profiles(records, table, "s", broadcast_bytes=b), "index", "kpis_used", "num_kpis") for b in (1 << 20, 0))
    assert near == far and len(near) == len(ids)
    assert near[0][1:] == near[1][1:] and near[2][1:] == near[3][1:]
    assert all(4 <= r[2] <= 5 for r in near)


def test_next_batch_takes_the_rows_of_an_index_together(spark):
    todo = spark.createDataFrame([(i // 3, f"r{i}") for i in range(30)], "index long, record_id string")
    for n, want in ((0, 0), (1, 3), (3, 3), (4, 6), (29, 30), (99, 30)):
        for bucket in (1, 4, 1 << 20):
            assert planning.next_batch(todo, n, bucket=bucket).count() == want


def test_sample_does_not_depend_on_partitions(spark):
    plan = planning.build_plan(spark, planning.resolve_distribution(90))
    table = profiles(spark, 50)
    key = ("record_id", F.col("kpis_used.profile_id"))
    assert rows(sampling.sample_profiles(plan.repartition(13), table.repartition(5), 7), *key) == rows(
        sampling.sample_profiles(plan.coalesce(1), table, 7), *key
    )
    assert rows(sampling.sample_profiles(plan, table, 7), *key) != rows(
        sampling.sample_profiles(plan, table, 8), *key
    )


def test_sample_is_even(spark):
    plan = planning.build_plan(spark, {"complex": 6000})
    got = sampling.sample_profiles(plan, profiles(spark, 6), 1)
    first = [r["n"] for r in got.groupBy(F.col("kpis_used")[0]["profile_id"]).agg(F.count("*").alias("n")).collect()]
    last = [r["n"] for r in got.groupBy(F.col("kpis_used")[3]["profile_id"]).agg(F.count("*").alias("n")).collect()]
    for counts in (first, last):
        assert len(counts) == 6 and min(counts) > 850 and max(counts) < 1150


def test_positions_in_two_phases(spark):
    table = profiles(spark, 500).repartition(9)
    one = rows(sampling.with_positions(table), "profile_id", "position")
    two = rows(sampling.with_positions(table, buckets=17), "profile_id", "position")
    assert one == two == [(1000 + 3 * i, i) for i in range(500)]


def test_given_tone_is_kept(spark):
    df = spark.createDataFrame([("a", "direct"), ("b", None)], "record_id string, tone string")
    got = dict(rows(df.withColumn("t", sampling.assign_tone(F.col("tone"), F.col("record_id"), 1)), "record_id", "t"))
    assert got["a"] == "direct" and got["b"] in sampling.TONES


# -- prompts -----------------------------------------------------------------


def test_generation_prompt(spark):
    df = spark.createDataFrame(
        [("odd", "formal", [(1, "n1", "first"), (2, "n2", "second")])],
        "complexity string, tone string, kpis array<struct<profile_id:long,profile_name:string,description:string>>",
    )
    got = df.select(
        prompts.generation_prompt(F.col("kpis"), F.col("complexity"), F.col("tone"))
    ).first()[0]
    assert "KPI 1: first\n\nKPI 2: second" in got
    assert "Complexity: ODD" in got and prompts.COMPLEXITY_GUIDES["complex"] in got
    assert prompts.TONE_GUIDES["formal"] in got


def test_feedback_lines(spark):
    entry = "struct<score:double,passed:boolean,reason:string>"
    df = spark.createDataFrame(
        [(((0.0, False, ""), (0.0, False, "gap"), (100.0, True, "YES")),), (((0.0, False, ""), None, None),)],
        f"m struct<schema:{entry},faithfulness:{entry},schedule:{entry}>",
    )
    got = [r[0] for r in df.select(prompts.feedback_lines(F.col("m"), evaluation.METRICS)).collect()]
    assert got == ["- Faithfulness: gap\n- Schedule: YES", prompts.NO_FEEDBACK]


def test_contract(spark):
    df = spark.createDataFrame(
        [("a", "simple", "w " * 30), ("b", "simple", "w " * 24), ("c", "medium", "w " * 50 + "AND"),
         ("d", "simple", "w " * 30 + "AND x"), ("e", "complex", "w " * 80 + "\nx"), ("f", "complex", "w " * 80 + "!")],
        "record_id string, complexity string, utterance string",
    )
    got = {r["record_id"]: (r["bad_length"], r["has_marks"], r["many_lines"]) for r in prompts.audit_contract(df).collect()}
    no = False
    assert got == {"a": (no, no, no), "b": (True, no, no), "c": (no, no, no), "d": (no, True, no),
                   "e": (no, no, True), "f": (no, True, no)}


# -- evaluation and gate -----------------------------------------------------


@pytest.mark.parametrize("answers, score, passed", [
    (("YES", "YES"), 100.0, True), (("YES", "no"), 66.67, False), (("no", None), 33.33, False),
])
def test_roll_up(spark, answers, score, passed):
    df = spark.createDataFrame([("a", ([], ""), *answers)], "record_id string, structured_output "
                               "struct<normal_statements:array<string>,schedule:string>, f string, s string")
    got = evaluation.evaluate(df, {"faithfulness": "f", "schedule": "s"}).first()
    assert (got["overall_score"], got["overall_pass"]) == (score, passed)


def test_thresholds(spark):
    df = spark.createDataFrame([("a", ([], ""), "no", "no")], "record_id string, structured_output "
                               "struct<normal_statements:array<string>,schedule:string>, f string, s string")
    got = evaluation.evaluate(
        df, {"faithfulness": "f", "schedule": "s"}, thresholds={"faithfulness": 0.0, "schedule": 0.0}
    ).first()
    assert got["overall_pass"] and got["overall_score"] == 33.33


def evals(spark, *given):
    return spark.createDataFrame(
        [(i, r, None, s, p, None) for i, (r, s, p) in enumerate(given)],
        schemas.T.StructType([schemas.PLAN["index"]] + schemas.EVALUATIONS.fields),
    )


def test_gate_last_record_wins_and_evaluations_stay(spark):
    e = evals(spark, ("a", 100.0, True), ("a", 0.0, False), ("x", 0.0, False))
    s = spark.createDataFrame([("a", 0, "old"), ("a", 1, "new"), ("b", 2, "other")], "record_id string, n int, v string")
    got = gate.gate(e, s, order="n")
    assert rows(got, "record_id", "v", "evaluation.overall_score") == [("a", "new", 0.0), ("a", "new", 100.0)]
    assert rows(gate.unmatched(e, s), "record_id") == [("x",)]
    one = gate.summary(e, s).first().asDict()
    assert one == {"total": 3, "passed": 1, "failed": 1, "unmatched": 1, "passed_pct": 33.3, "failed_pct": 33.3}


def test_gate_with_a_hot_record(spark):
    e = evals(spark, *[("a", 100.0, True)] * 400, *[(f"r{i}", 0.0, False) for i in range(50)])
    s = spark.createDataFrame([("a", "x")] + [(f"r{i}", "y") for i in range(50)], "record_id string, v string")
    assert gate.gate(e.drop("index"), s, hot_rows=10).count() == 450


def test_empty_evaluations(spark):
    e, s = evals(spark), spark.createDataFrame([("a",)], "record_id string")
    one = gate.summary(e, s).first()
    assert one["total"] == 0 and one["passed_pct"] is None
    assert evaluation.quality_gate(e, 0.5).first()["gate_open"] is False


# -- completions -------------------------------------------------------------


def attempt_log(spark, *given):
    return spark.createDataFrame(list(given), "request_id string, attempt long, endpoint int, error string")


@pytest.mark.parametrize("log, action, endpoint", [
    ([(0, None)], "done", None),
    ([(0, "timeout")] * 4, "retry_same", 0),
    ([(0, "timeout")] * 5, "rotate", 1),
    ([(0, "timeout"), (0, "401")], "rotate", 1),
    ([(2, "429")], "rotate", 0),
    ([(0, "429"), (1, "429"), (2, "429")], "exhausted", None),
    ([(0, "429"), (1, "429"), (2, "timeout")], "retry_same", 2),
    ([(0, "429"), (1, "no model")], "fatal", None),
    ([(0, "timeout"), (0, None)], "done", None),
])
def test_frontier(spark, log, action, endpoint):
    df = attempt_log(spark, *[("r", i, e, err) for i, (e, err) in enumerate(log)])
    got = completion.retry_frontier(df, 3).first()
    assert (got["action"], got["next_endpoint"]) == (action, endpoint)


def test_completions_are_cached_and_deduplicated(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def answer(prompt):
        import uuid
        (calls / uuid.uuid4().hex).write_text(prompt)
        if prompt == "bad":
            raise ValueError("refused")
        return f"  {prompt.upper()}\n"

    backend = completion.backend_from_function("b", answer)
    df = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "a", "b", "bad", None])], "i int, p string")
    kw = dict(backend_id="m", response="r", error="e")
    got = completion.attach_completions(df, "p", [backend], f"{tmp_path}/store", run_id="1", **kw)
    want = [(0, "A", None), (1, "A", None), (2, "B", None), (3, None, "ValueError: refused"), (4, None, None)]
    assert sorted(map(tuple, got.select("i", "r", "e").collect())) == want
    assert sorted(f.read_text() for f in calls.iterdir()) == ["a", "b", "bad"]
    again = completion.attach_completions(df, "p", [backend], f"{tmp_path}/store", run_id="2", **kw)
    assert sorted(map(tuple, again.select("i", "r", "e").collect())) == want
    assert sorted(f.read_text() for f in calls.iterdir()) == ["a", "b", "bad", "bad"]
    other = completion.attach_completions(df, "p", [backend], f"{tmp_path}/store", run_id="3",
                                          backend_id="other", response="r", error="e")
    assert other.filter("r is not null").count() == 3
    assert len(list(calls.iterdir())) == 7


def test_rounds_follow_the_retry_rules(spark, tmp_path):
    def slow(prompt):
        raise TimeoutError("no reply")

    def picky(prompt):
        if prompt.startswith("x"):
            raise RuntimeError("HTTP 429")
        return prompt

    ends = [completion.backend_from_function("slow", slow), completion.backend_from_function("picky", picky)]
    df = spark.createDataFrame([(f"{c}{i}",) for c in "xy" for i in range(20)], "p string")
    store = f"{tmp_path}/store"
    got = completion.attach_completions(df, "p", ends, store, backend_id="m", run_id="1", parallelism=4)
    for r in got.collect():
        if r["p"].startswith("y"):
            assert r["response"] == r["p"] and r["error"] is None
        else:
            assert r["response"] is None and r["error"]
    log = completion.attempts_table(spark, store)
    left = completion.retry_frontier(log, 2).groupBy("action").count()
    assert dict(rows(left, "action", "count")) == {"done": 20, "exhausted": 20}
    tries = log.groupBy("request_id", "endpoint").count().filter("endpoint = 0")
    assert {r["count"] for r in tries.collect()} == {5}


def test_gate_by_metric_and_group(spark):
    """Any metrics, null groups, missing entries; one bad group closes it."""
    entry = "struct<score:double,passed:boolean,reason:string>"
    schema = f"lang string, metric_results struct<schema:{entry},brief:{entry}>, overall_pass boolean"

    def e(p):
        return None if p is None else (1.0, p, "")

    data = [("en", (e(True), e(True)), True), ("en", (e(True), e(False)), False), ("de", (e(False), None), False), (None, (e(True), e(True)), True)]
    df = spark.createDataFrame(data, schema)

    def gate(thresholds, frame=df):
        return {(r["metric"], r["level"], r["lang"]): (r["records"], r["pass_share"], r["holds"], r["gate_open"])
                for r in evaluation.metric_gate(frame, thresholds).collect()}

    got = gate({"schema": 0.7, "brief": 0.5})
    assert got == {
        ("schema", "all", None): (4, 0.75, True, False), ("schema", "group", "en"): (2, 1.0, True, False),
        ("schema", "group", "de"): (1, 0.0, False, False), ("schema", "group", None): (1, 1.0, True, False),
        ("brief", "all", None): (3, 0.6667, True, False), ("brief", "group", "en"): (2, 0.5, True, False),
        ("brief", "group", None): (1, 1.0, True, False),
    }
    assert {v[3] for v in gate({"brief": 0.5, "overall": 0.0}).values()} == {True}
    assert gate({"unknown": 0.0}) == {("unknown", "all", None): (0, None, False, False)}
    assert gate({"schema": 0.1}, df.limit(0)) == {}


def counting(folder, word=None, stop=None):
    """Answers prompts and leaves a file for each call; a prompt that begins
    with ``stop`` ends the task."""
    import uuid
    from pathlib import Path

    def batches(frames):
        for frame in frames:
            for prompt in frame["prompt"]:
                if stop and prompt.startswith(stop):
                    raise RuntimeError("the executor is gone")
                (Path(folder) / uuid.uuid4().hex).write_text(prompt)
            yield frame[["request_id"]].assign(response=frame["prompt"] + (word or ""), error=None)

    return completion.Backend("counting", batches)


def test_waves_cover_all_buckets():
    for n, rows_, count in ((0, 10, 1), (9, 10, 1), (25, 10, 3), (10**9, 10, 256)):
        waves = completion.wave_buckets(n, rows_)
        assert len(waves) == count and [b for w in waves for b in w] == completion.bucket_names()


def test_a_lost_job_keeps_its_waves(spark, tmp_path):
    calls, store = tmp_path / "calls", f"{tmp_path}/store"
    calls.mkdir()
    prompts = [f"p{i}" for i in range(200)]
    df = spark.createDataFrame([(p,) for p in prompts + prompts[:30] + [None]], "p string")
    ids = {r["p"]: r["id"] for r in df.select("p", completion.request_id(F.col("p"), "m").alias("id")).collect() if r["p"]}
    # the request with the largest id is of the last wave
    last = max(ids, key=ids.get)
    kw = dict(backend_id="m", run_id="1", wave_rows=60)
    with pytest.raises(Exception, match="the executor is gone"):
        completion.attach_completions(df, "p", [counting(calls, stop=last)], store, **kw)
    kept = {r["request_id"] for r in completion.attempts_table(spark, store).collect()}
    whole = {i for i in ids.values() if i[:2] in set(sum(completion.wave_buckets(200, 60)[:3], []))}
    assert kept == whole and len(kept) > 100
    for f in calls.iterdir():
        f.unlink()
    got = completion.attach_completions(df, "p", [counting(calls)], store, **kw).collect()
    assert len(got) == 231 and all(r["response"] == r["p"] and r["error"] is None for r in got)
    asked = [f.read_text() for f in calls.iterdir()]
    assert sorted(asked) == sorted(p for p, i in ids.items() if i not in kept)


def test_a_wave_reads_only_its_partitions(spark, tmp_path):
    calls, store = tmp_path / "calls", f"{tmp_path}/store"
    calls.mkdir()
    df = spark.createDataFrame([(f"p{i}",) for i in range(300)], "p string")
    completion.attach_completions(df, "p", [counting(calls)], store, backend_id="m", run_id="1")
    part = completion.attempts_table(spark, store, ["00", "0a", "ff"])
    assert {r["request_id"][:2] for r in part.collect()} <= {"00", "0a", "ff"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert len(part.inputFiles()) == 300 or part.rdd.getNumPartitions() <= 3


def test_open_requests_are_not_failures(spark, tmp_path):
    calls, store = tmp_path / "calls", f"{tmp_path}/store"
    calls.mkdir()
    df = spark.createDataFrame([(f"p{i}",) for i in range(80)], "p string")
    kw = dict(backend_id="m", wave_rows=20)
    part = completion.attach_completions(df, "p", [counting(calls)], store, run_id="1", max_waves=2, **kw).collect()
    errors = {r["error"] for r in part}
    assert errors == {None, completion.UNFINISHED} and 20 < sum(r["error"] is None for r in part) < 60
    rest = completion.attach_completions(df, "p", [counting(calls)], store, run_id="2", **kw).collect()
    assert all(r["response"] == r["p"] for r in rest) and len(list(calls.iterdir())) == 80

    def slow(prompt):
        raise TimeoutError("no reply")

    late = completion.attach_completions(
        df.limit(3), "p", [completion.backend_from_function("slow", slow)], f"{store}-2", backend_id="m", run_id="1", max_rounds=2
    ).collect()
    assert [r["error"] for r in late] == [completion.UNFINISHED] * 3


# -- repair ------------------------------------------------------------------


@pytest.mark.parametrize("line, issue", [
    ('{"utterance":"a b c d e f g h i j","kpis_used":null,"complexity":"simple"}', None),
    ('{"utterance":"a b","kpis_used":[],"complexity":"simple"}', "too_short_2_words"),
    ('{"utterance":"a b c d e f g h i j"}', "missing_kpis_metadata"),
    ('{"utterance":"a b c d e f g h i j","kpis_used":[]}', "missing_complexity"),
    ('{"utterance":null}', "empty_utterance"), ('{"utterance":" \\n"}', "empty_utterance"),
    ('{"utterance":5}', "empty_utterance"), ('{"complexity":"simple"}', "missing_utterance_field"),
    ("", "malformed_json"), ("   ", "malformed_json"), ("{", "malformed_json"), ("5", "malformed_json"),
])
def test_utterance_issue(spark, line, issue):
    df = rec.parse_lines(spark.createDataFrame([(line,)], "value string"))
    assert repair.classify_records(df).first()["issue"] == issue


def test_history_is_appended(spark):
    df = spark.createDataFrame([(None,), ([(dt.datetime(2024, 1, 1), "old")],)], schemas.T.StructType(
        [schemas.T.StructField("h", schemas.UTTERANCES["repair_history"].dataType)]))
    got = [[e["reason"] for e in r[0]] for r in df.select(repair.add_history(F.col("h"), F.lit("2025-01-01").cast("timestamp_ntz"), "new")).collect()]
    assert got == [["new"], ["old", "new"]]


# -- offsets -----------------------------------------------------------------

LINES = ["", "abc", "", chr(0xE9) * 3, chr(0x4E2D) + "x", "end"] * 7


def starts(lines, size=lambda s: len(s.encode()) + 1):
    out, at = [], 0
    for i, line in enumerate(lines):
        out.append((i, at))
        at += size(line)
    return out


@pytest.mark.parametrize("bucket", [1, 5, 1 << 20])
def test_record_offsets(spark, bucket):
    df = spark.createDataFrame(list(enumerate(LINES)), "index long, value string").repartition(5)
    assert rows(offsets.record_offsets(df, bucket=bucket), "index", "offset") == starts(LINES)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_file_offsets_and_numbers(spark, tmp_path, end):
    path = tmp_path / "lines.txt"
    path.write_bytes(end.join(LINES).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = rows(offsets.file_offsets(spark, str(path)), "index", "offset")
        numbered = rows(rec.numbered_lines(spark, str(path)), "index", "value")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == starts(LINES, lambda s: len(s.encode()) + len(end))
    assert numbered == list(enumerate(LINES))


def test_offsets_pair_by_position(spark):
    plan = spark.createDataFrame([(0, 0), (1, None), (2, 9), (5, 7)], "index long, offset long")
    new = spark.createDataFrame([(0, 0), (1, 4), (2, 8), (3, 12)], "index long, offset long")
    assert rows(offsets.changed_offsets(plan, new), "index", "new_offset") == [(1, 4), (2, 8)]
    assert rows(offsets.update_offsets(plan, new), "index", "offset") == [(0, 0), (1, 4), (2, 8), (5, 7)]


# -- refinement --------------------------------------------------------------


def test_candidates_and_upsert(spark):
    e = evals(spark, ("a", 66.67, False), ("b", 90.0, True), ("c", 0.0, False), ("d", 0.0, False), ("a", 33.33, False))
    s = spark.createDataFrame(
        [("a", "u", ([], "")), ("b", "u", ([], "")), ("c", "u", None)],
        "record_id string, utterance string, structured_output struct<normal_statements:array<string>,schedule:string>",
    )
    pairs = refine.pair_candidates(e, s)
    assert sorted(((r["record_id"], r["skip_reason"]) for r in pairs.collect()), key=repr) == sorted(
        [("a", None), ("a", None), ("c", "no_output"), ("d", "not_found")], key=repr)
    assert refine.candidate_counts(pairs).first().asDict() == {"low": 4, "to_refine": 2, "not_found": 1, "no_output": 1}
    change = spark.createDataFrame([("a", 100.0, True)], "record_id string, overall_score double, overall_pass boolean")
    cols = ["overall_score", "overall_pass"]
    assert rows(refine.upsert(e, change, cols).filter("record_id = 'a'"), "index", "overall_score") == [(0, 100.0), (4, 100.0)]
    last = refine.upsert(e, change, cols, order="index").filter("record_id = 'a'")
    assert rows(last, "index", "overall_score") == [(0, 66.67), (4, 100.0)]
    worse = spark.createDataFrame([("b", 10.0, False)], change.schema)
    assert refine.keep_better(worse, e).count() == 0
    assert rows(refine.upsert(e, worse, cols).filter("record_id = 'b'"), "overall_score") == [(10.0,)]


def test_gold_overlap(spark):
    found = spark.createDataFrame([("a", "x y y"), ("b", "")], "record_id string, value string")
    gold = spark.createDataFrame([("a", "y z"), ("b", "q")], "record_id string, value string")
    got = rows(evaluation.gold_overlap(found, gold, text.words), "record_id", "n_common", "precision", "recall")
    assert got == [("a", 1, 0.5, 0.5), ("b", 0, None, 0.0)]


def test_larger_profile_table_is_joined_and_its_lacking_draws_are_spread(spark):
    """Beyond the limit no table is broadcast, also not while the query runs, and
    records without a draw do not meet in one task."""
    plan = spark.range(4000).select(
        F.col("id").alias("index"), text.record_id(F.col("id")).alias("record_id"), F.lit("simple").alias("complexity")
    )
    got = sampling.sample_profiles(plan, profiles(spark, 500), "s", broadcast_bytes=0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = got.withColumn("part", F.spark_partition_id())
        sizes = sorted(r["count"] for r in spread.groupBy("part").count().collect())
        joins = got.select("record_id", "kpis_used")
        joins.collect()
        shape = joins._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 4000 and sizes[-1] < 1000, sizes
    assert shape.count("SortMergeJoin") == sampling.MAX_DRAWS


def scratch_folders(spark, name):
    return set(Path(scratch_root(spark).removeprefix("file:"), "quillgate").glob(f"{name}-*"))


def test_waves_are_written_by_many_tasks_and_open_ones_not_copied(spark, tmp_path):
    """No task writes a whole wave, and a wave of which all or nothing is open
    writes its prompts once; of a wave that is partly open the rest is written."""
    df = spark.createDataFrame([(i, f"prompt {i}") for i in range(400)], "id int, p string")
    store, calls = str(tmp_path / "attempts"), tmp_path / "calls"
    calls.mkdir()
    kw = dict(backend_id="m", wave_rows=200)
    before = {n: scratch_folders(spark, n) for n in ("asked", "wanted")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for run_id in ("1", "2"):
            got = completion.attach_completions(df, "p", [counting(calls)], store, run_id=run_id, **kw).collect()
            assert len(got) == 400 and all(r.error is None and r.response for r in got)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for folder in scratch_folders(spark, "asked") - before["asked"]:
        sizes = [spark.read.parquet(str(f)).count() for f in folder.rglob("*.parquet")]
        assert sum(sizes) == 400 and max(sizes) < 100, sizes
    assert scratch_folders(spark, "wanted") == before["wanted"]
    more = df.unionByName(spark.createDataFrame([(i, f"prompt {i}") for i in range(400, 440)], df.schema))
    got = completion.attach_completions(more, "p", [counting(calls)], store, run_id="3", **kw).collect()
    assert len(got) == 440 and all(r.response for r in got)
    new = [spark.read.parquet(str(f)).count() for f in scratch_folders(spark, "wanted") - before["wanted"]]
    assert sum(new) == 40
