"""Keep appending new records to a table, each record once.

The sink is filed by a hash of the key: ``bucket=<buckets>-<number>`` and below
it the stream and its batch.  A micro-batch looks for its keys in the buckets
that they fall into and reads nothing else, so its cost follows its own size as
long as it has fewer keys than there are buckets, and is the key column of the
sink at most.  The number of buckets is part of the name: a stream may choose a
larger one when the sink has grown, and look-ups cover all that are in use.

Every micro-batch of every stream owns its folders and overwrites them when it
runs again, so a batch that was repeated after a failure leaves no second copy,
and a stream with a fresh checkpoint leaves the batches of an older one alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from quillgate.session import materialise
from quillgate.sources import records as rec


#: folder columns of the sink
FOLDERS = ("bucket", "stream", "batch")
#: buckets of a new batch; each holds a file for every batch that touches it
BUCKETS = 32
_NO_KEY = "none"


def sink_table(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """All rows of the sink; ``bucket``, ``stream`` and ``batch`` come from the folders."""
    folders = [T.StructField(n, T.LongType() if n == "batch" else T.StringType()) for n in FOLDERS]
    return rec.read_table(spark, sink, T.StructType(schema.fields + folders))


def bucket(key: Column, buckets: int) -> Column:
    number = F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("string")
    return F.when(key.isNull(), F.lit(_NO_KEY)).otherwise(F.concat(F.lit(f"{buckets}-"), number))


def numbers_of_buckets(spark: SparkSession, sink: str) -> list[int]:
    """The numbers of buckets in use, from the names of the upper folders."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [f.getPath().getName().partition("=")[2] for f in files.listStatus(path)]
    return sorted({int(n.partition("-")[0]) for n in names if "-" in n})


def seen_keys(rows: DataFrame, sink: str, schema: T.StructType, key: str) -> DataFrame:
    """Key, stream and batch of the sink's rows in the buckets that the keys of
    ``rows`` fall into."""
    spark = rows.sparkSession
    used = numbers_of_buckets(spark, sink)
    named = rows.filter(F.col(key).isNotNull())
    touched = set()
    for n in used:  # at most n rows each
        touched.update(r[0] for r in named.select(bucket(F.col(key), n)).distinct().collect())
    table = sink_table(spark, sink, schema).filter(F.col("bucket").isin(sorted(touched)) if touched else F.lit(False))
    return table.select(key, "stream", "batch")


def append_new(
    batch: DataFrame, batch_id: int, sink: str, schema: T.StructType, key: str, stream: str, buckets: int = BUCKETS
) -> None:
    """Write the records of one micro-batch that the sink does not have.

    A record without a key can't be told from others, so all of them are kept.
    """
    rows = materialise(batch, "stream-batch")  # looked at twice, computed once
    other = (F.col("stream") != stream) | (F.col("batch") != batch_id)
    seen = seen_keys(rows, sink, schema, key).filter(other).select(key)
    named = rows.filter(F.col(key).isNotNull()).dropDuplicates([key]).join(seen, key, "left_anti")
    fresh = rec.conform(named.unionByName(rows.filter(F.col(key).isNull())), schema)
    place = {"bucket": bucket(F.col(key), buckets), "stream": F.lit(stream), "batch": F.lit(batch_id)}
    # keyed rows of a bucket in one file; rows without a key stay where they are spread
    spread = F.when(F.col(key).isNull(), F.spark_partition_id())
    (
        fresh.withColumns(place).repartition("bucket", spread).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS).parquet(sink)
    )


def jsonl_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """JSON lines that keep arriving as files; a broken line fails the batch."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_stage(
    source: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    schema: T.StructType,
    key: str = "record_id",
    once: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Run a stateless stage over a streaming source into the sink.

    ``once`` works off what has arrived and stops; otherwise the query runs on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # the id that the checkpoint keeps: the same after a restart
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_new(stage(batch), batch_id, sink, schema, key, stream, buckets)

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
