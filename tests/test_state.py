"""Commits by manifest: all or nothing, one winner, two stores at once."""

import pytest

from quillgate import schemas
from quillgate.plans import stages
from quillgate.sources import records as rec, state
from quillgate.sources.state import Run


def run(n, **more):
    return Run(f"run-{n}", "generate", "in", "m", **more)


def rows(spark, ids):
    return spark.createDataFrame([(i, f"rule-{i:06d}", f"text {i}", "simple") for i in ids], "index long, record_id string, utterance string, complexity string")


def write(spark, draft, ids, plan=None):
    if plan is not None:
        rows(spark, plan).select("index", "record_id", "complexity").write.parquet(f"{draft.output}/plan")
    rec.append_table(rows(spark, ids).coalesce(1), f"{draft.batch}/records", stages.with_index(schemas.UTTERANCES))


def shown(spark, store):
    return sorted(r["index"] for r in stages.stage_records(spark, store, schemas.UTTERANCES, indexed=True).collect())


def test_nothing_shows_before_the_commit(spark, tmp_path):
    store = f"{tmp_path}/s"
    first = state.draft(spark, store, run(1))
    write(spark, first, [0, 1], plan=range(5))
    with pytest.raises(FileNotFoundError):
        shown(spark, store)
    first.commit()
    assert shown(spark, store) == [0, 1]
    again = state.draft(spark, store, run(1))  # the same job once more, lost on the way
    write(spark, again, [0, 1], plan=range(5))
    assert shown(spark, store) == [0, 1] and again.output != first.output
    redone = state.draft(spark, store, run(1))
    write(spark, redone, [0, 1], plan=range(5))
    redone.commit()
    assert shown(spark, store) == [0, 1]
    assert state.current_output(spark, store) == redone.output


def test_of_two_writers_one_wins(spark, tmp_path):
    store = f"{tmp_path}/s"
    base = state.draft(spark, store, run(1))
    write(spark, base, [0], plan=range(4))
    base.commit()
    one, two = (state.draft(spark, store, run(n), resume=True) for n in (2, 3))
    write(spark, one, [1, 2])
    write(spark, two, [1, 2, 3])
    two.commit()
    with pytest.raises(state.Conflict):
        one.commit()
    assert shown(spark, store) == [0, 1, 2, 3]
    assert [r["run_id"] for r in state.commits(spark, store)] == ["run-1", "run-3"]
    late = state.draft(spark, store, run(4), resume=True)
    assert late.seq == 3 and late.have("records", with_index()).count() == 4


def with_index():
    return stages.with_index(schemas.UTTERANCES)


def test_two_stores_change_at_once(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    for store in (a, b):
        d = state.draft(spark, store, run(1))
        write(spark, d, [0], plan=[0])
        d.commit()
    lost_a, lost_b = state.draft(spark, a, run(2)), state.draft(spark, b, run(2))
    for d in (lost_a, lost_b):
        write(spark, d, [7], plan=[7])
    lost_a.commit(needs=lost_b)  # and the job ends here
    assert shown(spark, a) == shown(spark, b) == [0]
    new_a, new_b = state.draft(spark, a, run(3)), state.draft(spark, b, run(3))
    for d in (new_a, new_b):
        write(spark, d, [8], plan=[8])
    new_a.commit(needs=new_b)
    assert shown(spark, a) == [0]
    new_b.commit()
    assert shown(spark, a) == shown(spark, b) == [8]
    with pytest.raises(state.Conflict):
        lost_b.commit()


def test_refused_start_leaves_the_store_as_it_was(spark, tmp_path):
    up, down = f"{tmp_path}/up", f"{tmp_path}/down"
    d = state.draft(spark, up, run(1))
    write(spark, d, [0, 1], plan=range(3))
    d.commit()
    before = state.draft(spark, down, Run("x-1", "extract", "in", "m"))
    rows(spark, [0]).select("index", "record_id", "complexity").write.parquet(f"{before.output}/plan")
    rec.append_table(rows(spark, [0]), f"{before.batch}/records", stages.with_index(schemas.STRUCTURED))
    before.commit()
    with pytest.raises(ValueError, match="incomplete"):
        stages.extract(spark, up, down, Run("x-2", "extract", "in", "m"), [])
    assert len(state.commits(spark, down)) == 1
    assert stages.stage_records(spark, down, schemas.STRUCTURED).count() == 1
    with pytest.raises(ValueError, match="temperature"):
        state.draft(spark, down, Run("x-3", "extract", "in", "m", 0.5), resume=True)


def test_null_and_empty_tables(spark, tmp_path):
    store = f"{tmp_path}/s"
    d = state.draft(spark, store, run(1, thresholds={"schema": 1.0}))
    write(spark, d, [], plan=[])
    d.commit()
    assert shown(spark, store) == [] and stages.stage_plan(spark, store).count() == 0
    assert state.draft(spark, store, run(2, thresholds={"schema": 1.0}), resume=True).seq == 2
    with pytest.raises(ValueError, match="thresholds"):
        state.draft(spark, store, run(2), resume=True)


def test_only_files_with_changed_keys_are_written(spark, tmp_path):
    """Copy on write: other files stay the very same, twice in a row."""
    store = f"{tmp_path}/a store"  # names are quoted in file metadata
    for n, ids in enumerate(([0, 1, 2], [3, 4, 5], [6, 7])):
        d = state.draft(spark, store, run(1), resume=n > 0)
        write(spark, d, ids, plan=range(8) if n == 0 else None)
        rec.append_table(rows(spark, ids).selectExpr("record_id", "index", "'completed' as status", f"{d.seq}L as seq"), f"{d.batch}/status", schemas.PLAN_STATUS)
        d.commit()

    def table():
        return stages.stage_records(spark, store, schemas.UTTERANCES, indexed=True)

    def files():
        return {r["index"]: r["f"] for r in table().selectExpr("index", "_metadata.file_path as f").collect()}

    def change(ids, word):
        new = rows(spark, ids).selectExpr("record_id", f"concat('{word} ', index) as utterance")
        d = state.revise(spark, store, run(2))
        stages.replace_columns(d, new, ["utterance"], schemas.UTTERANCES)
        return d

    before = files()
    lost = change([4], "lost")
    assert files() == before
    change([4], "new").commit()
    after = files()
    assert {i for i in range(8) if before[i] != after[i]} == {3, 4, 5}
    with pytest.raises(state.Conflict):
        lost.commit()
    change([5, 7], "newer").commit()
    change([99], "none").commit()
    last = files()
    assert {i for i in range(8) if after[i] != last[i]} == {3, 4, 5, 6, 7}
    got = {r["index"]: r["utterance"] for r in table().collect()}
    assert got == {**{i: f"text {i}" for i in range(8)}, 4: "new 4", 5: "newer 5", 7: "newer 7"}
    assert {(r["index"], r["status"]) for r in stages.stage_status(spark, store).collect()} == {(i, "completed") for i in range(8)}
    rest = state.draft(spark, store, run(2), resume=True)
    assert rest.have("records", with_index()).count() == 8
