import json

import pytest
from pyspark.sql import functions as F, types as T

from quillgate import schemas
from quillgate.operators import repair
from quillgate.sources import records as rec
from quillgate.streaming import incremental

FLAT = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("n", T.LongType())])


def test_profiles_by_header_name(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('MORE,GENERATED_DESCRIPTION,PROFILE_ID,PROFILE_NAME\nx,"a, ""b""\nc",7,name\n')
    got = rec.read_profiles(spark, str(path))
    assert got.schema == schemas.PROFILES
    assert [tuple(r) for r in got.collect()] == [(7, "name", 'a, "b"\nc')]


def test_missing_profiles_raise(spark, tmp_path):
    with pytest.raises(Exception):
        rec.read_profiles(spark, f"{tmp_path}/none.csv").count()


def test_strict_reader(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"record_id":"a","n":1}\n\n   \n{"record_id":"b"}\n')
    got = sorted(map(tuple, rec.read_jsonl_checked(spark, str(path), FLAT).collect()))
    assert got == [("a", 1), ("b", None)]
    path.write_text('{"record_id":"a","n":1}\n{"record_id":\n')
    with pytest.raises(ValueError, match="record_id"):
        rec.read_jsonl_checked(spark, str(path), FLAT)
    with pytest.raises(Exception):
        rec.read_jsonl(spark, str(path), FLAT).collect()


def test_tolerant_reader_keeps_every_line(spark, tmp_path):
    lines = ['{"a":1}', "", "   ", "{", "[1]", '{"a":null}']
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(lines))
    got = rec.read_jsonl_tolerant(spark, str(path)).orderBy("index").collect()
    assert [r["value"] for r in got] == lines
    assert [r["_malformed"] for r in got] == [False, True, True, True, True, False]


def test_write_keeps_nulls_and_drops_internal_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1)], "record_id string, n long, _line_number int")
    rec.write_jsonl(df, f"{tmp_path}/out")
    rec.append_jsonl(df, f"{tmp_path}/out")
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert [json.loads(x) for x in lines] == [{"record_id": "a", "n": None}] * 2


def test_table_before_its_first_write_is_empty(spark, tmp_path):
    assert rec.read_table(spark, f"{tmp_path}/none", FLAT).count() == 0


def stage(batch):
    return batch.withColumn("n", F.col("n") * 2)


def arrive(spark, path, ids):
    df = spark.createDataFrame([(f"r{i}", i) for i in ids], FLAT)
    df.coalesce(1).write.mode("append").json(path)


def test_stream_writes_each_record_once(spark, tmp_path):
    src, sink, state = (f"{tmp_path}/{n}" for n in ("src", "sink", "state"))

    def go():
        source = incremental.jsonl_stream(spark, src, FLAT, max_files=1)
        incremental.stream_stage(source, stage, sink, state, FLAT).awaitTermination()
        return incremental.sink_table(spark, sink, FLAT)

    arrive(spark, src, list(range(60)) + list(range(5)))
    assert go().count() == 60
    arrive(spark, src, range(40, 100))
    got = go()
    assert sorted((r["record_id"], r["n"]) for r in got.collect()) == sorted((f"r{i}", 2 * i) for i in range(100))
    assert go().count() == 100


def test_repeated_batch_leaves_no_second_copy(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    first = spark.createDataFrame([("a", 1), ("b", 2)], FLAT)
    incremental.append_new(first, 0, sink, FLAT, "record_id", "s")
    second = spark.createDataFrame([("b", 2), ("c", 3)], FLAT)
    for _ in range(2):
        incremental.append_new(second, 1, sink, FLAT, "record_id", "s")
    got = incremental.sink_table(spark, sink, FLAT)
    assert sorted(r["record_id"] for r in got.collect()) == ["a", "b", "c"]


def test_a_second_stream_leaves_the_first_one_alone(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    for name, ids in (("one", range(10)), ("two", range(5, 15))):
        arrive(spark, f"{tmp_path}/{name}", ids)
        source = incremental.jsonl_stream(spark, f"{tmp_path}/{name}", FLAT)
        incremental.stream_stage(source, stage, sink, f"{tmp_path}/state-{name}", FLAT).awaitTermination()
    got = incremental.sink_table(spark, sink, FLAT)
    assert sorted(r["record_id"] for r in got.collect()) == sorted(f"r{i}" for i in range(15))
    assert got.select("stream").distinct().count() == 2 and got.filter("stream = 'None'").isEmpty()


def test_a_batch_reads_and_writes_its_own_buckets(spark, tmp_path):
    """Files read by a batch: those of its buckets, whatever the sink holds."""
    sink = f"{tmp_path}/sink"
    for n in range(4):
        rows = spark.createDataFrame([(f"r{i}", i) for i in range(200 * n, 200 * n + 200)], FLAT)
        incremental.append_new(rows, n, sink, FLAT, "record_id", "s", 16)
    whole = len(incremental.sink_table(spark, sink, FLAT).inputFiles())
    assert whole == 4 * 16  # one file for each bucket and batch
    small = spark.createDataFrame([("r5", 5), ("r6", 6), ("new", 7)], FLAT)
    seen = incremental.seen_keys(small, sink, FLAT, "record_id")
    plan = seen._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(bucket" in plan.toString() or "PartitionFilters: [bucket" in plan.toString()
    assert {r["record_id"] for r in seen.collect()} >= {"r5", "r6"}
    assert seen.count() < 3 * 800 / 16 * 2 and seen.rdd.getNumPartitions() <= 3 * 4
    # a stream may go on with more buckets; older ones are still looked into
    incremental.append_new(small, 0, sink, FLAT, "record_id", "t", 64)
    assert incremental.numbers_of_buckets(spark, sink) == [16, 64]
    for b, stream in ((4, "s"), (1, "t")):
        incremental.append_new(small, b, sink, FLAT, "record_id", stream, 32)
    got = [r["record_id"] for r in incremental.sink_table(spark, sink, FLAT).collect()]
    assert len(got) == len(set(got)) == 801


def test_empty_batches_and_first_batches(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    none = spark.createDataFrame([], FLAT)
    incremental.append_new(none, 0, sink, FLAT, "record_id", "s")
    assert incremental.sink_table(spark, sink, FLAT).count() == 0
    incremental.append_new(spark.createDataFrame([("a", 1)], FLAT), 1, sink, FLAT, "record_id", "s")
    incremental.append_new(none, 2, sink, FLAT, "record_id", "s")
    assert incremental.sink_table(spark, sink, FLAT).count() == 1


def test_records_without_a_key_are_all_kept(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 3)], FLAT)
    incremental.append_new(rows, 0, sink, FLAT, "record_id", "s")
    assert sorted(r["n"] for r in incremental.sink_table(spark, sink, FLAT).collect()) == [1, 2, 3]


def test_examples_are_the_first_in_order(spark):
    df = spark.createDataFrame(
        [(i, f"r{i}" if i % 2 else None, "x" if i < 8 else None) for i in range(10)],
        "index long, record_id string, issue string",
    ).repartition(4)
    got = repair.issue_examples(df).collect()
    assert [tuple(r) for r in got] == [("x", 8, "index-0, r1, index-2", 5)]
