"""Line numbers, offsets and located errors of several files."""

import gzip

import pytest
from pyspark.sql import functions as F, types as T

from quillgate.functions import validation as val
from quillgate.plans import side_jobs
from quillgate.sources import positions, records as rec

LINES = ["", "abc", "", chr(0xE9) * 3, chr(0x4E2D) + "x", "end"] * 7


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def folder(tmp_path):
    """Several files, one empty, one that cannot be split."""
    want, at, n = [], 0, 0
    for name, lines in (("a.txt", LINES[:9]), ("b.txt", []), ("c.txt.gz", LINES), ("d.txt", LINES[3:])):
        data = "".join(x + "\n" for x in lines).encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
        inside = 0
        for i, x in enumerate(lines):
            want.append((name, i, inside, n, at, x))
            size = len(x.encode()) + 1
            inside, at, n = inside + size, at + size, n + 1
    return want


@pytest.mark.parametrize("run", [1, 4, positions.RUN])
@pytest.mark.parametrize("most", [0, positions.MAX_BROADCAST_RUNS])
def test_positions_in_several_files(spark, tmp_path, small_blocks, monkeypatch, run, most):
    monkeypatch.setattr(positions, "MAX_BROADCAST_RUNS", most)
    want = folder(tmp_path)
    name = F.substring_index("file", "/", -1)
    lines = positions.located_lines(spark, str(tmp_path), run=run).select(name, "line", "index", "value").collect()
    assert sorted(map(tuple, lines)) == sorted((f, i, n, x) for f, i, _, n, _, x in want)
    got = positions.line_offsets(spark, str(tmp_path), run=run).select(name, "line", "offset", "index", "position").collect()
    assert sorted(map(tuple, got)) == sorted(w[:5] for w in want)


def test_changed_blocks_are_refused(spark, tmp_path):
    """Lines of files that are cut otherwise the second time get no wrong number."""
    (tmp_path / "a.txt").write_text("one\ntwo\nthree\n" * 20)
    lines = positions.located_lines(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        with pytest.raises(Exception, match="settings changed between two scans"):
            lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_the_text_is_neither_written_nor_shuffled(spark, tmp_path):
    folder(tmp_path)
    lines = positions.located_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "value" in x]
    assert not exchanges


SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("it's", T.ArrayType(T.LongType())), T.StructField("_corrupt_record", T.StringType()),
])


def test_located_errors(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join([
        '{"record_id":"a","n":1}', "", "   ", '{"record_id":"b","n":"x"}', '{"record_id":', '{"n":null,"more":{}}', "[1]",
        '{"n":1.5,"it\'s":{"a":1}}', '{"n":2} trailing', '{"it\'s":[1,"x"]}',
    ]))
    (tmp_path / "b.jsonl").write_text('{"n":3}\n"text"\n')
    (tmp_path / "c.jsonl").write_text("")
    got = rec.located_errors(spark, str(tmp_path), SCHEMA).orderBy("index").collect()
    assert [(r.file[-7:], r.line, r["index"], r.reason) for r in got] == [
        ("a.jsonl", 4, 3, "wrong type: n"), ("a.jsonl", 5, 4, "not a JSON object"), ("a.jsonl", 7, 6, "not a JSON object"),
        ("a.jsonl", 8, 7, "wrong type: n, it's"), ("a.jsonl", 9, 8, "not a JSON object"), ("a.jsonl", 10, 9, "wrong type: it's"),
        ("b.jsonl", 2, 11, "not a JSON object"),
    ]
    with pytest.raises(ValueError, match="a.jsonl, line 4: wrong type: n: .*\"x\""):
        rec.read_jsonl_checked(spark, str(tmp_path), SCHEMA)


def test_no_lines_no_errors(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("")
    assert rec.located_errors(spark, str(tmp_path), SCHEMA).count() == 0
    assert rec.read_jsonl_checked(spark, str(tmp_path), SCHEMA).count() == 0


def test_offsets_of_a_plan_over_several_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    want = folder(tmp_path / "in")
    plan = spark.createDataFrame([(0, 0), (3, 1), (12, None), (500, 9)], "index long, offset long")
    changed = side_jobs.recalculate_offsets(spark, f"{tmp_path}/in", plan, f"{tmp_path}/plan")
    at = {w[3]: w[4] for w in want}
    assert sorted(map(tuple, changed.select("index", "new_offset").collect())) == [(3, at[3]), (12, at[12])]
    got = spark.read.parquet(f"{tmp_path}/plan").select("index", "offset")
    assert sorted(map(tuple, got.collect())) == [(0, 0), (3, at[3]), (12, at[12]), (500, 9)]


def test_members_by_any_name(spark):
    df = spark.createDataFrame([('{"a.b":1,"c\'d":2,"e":null}',)], "j string").select(F.parse_json("j").alias("v"))
    got = df.select(*[val.has_member(F.col("v"), n).alias(str(i)) for i, n in enumerate(["a.b", "c'd", "e", "a"])]).first()
    assert list(got) == [True, True, False, False]
