"""Line numbers and byte offsets of text files, without a copy of the text.

A first scan counts lines and bytes by runs: the lines of one file block that
share a range of row numbers, so a run is bounded even where a file cannot be
split.  Prefix sums over the runs, a table of a row for each million lines, tell
where each run begins; a second scan adds a line's place in its run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quillgate.session import materialise

#: most lines of a run
RUN = 1 << 20
#: most runs that are broadcast
MAX_BROADCAST_RUNS = 500_000
_KEYS = ["file", "_block", "_length", "_run"]


def _scan(spark: SparkSession, path: str, line_sep: str | None, run: int) -> DataFrame:
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    lines = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_block_length").alias("_length"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return lines.withColumn("_run", F.expr(f"_row div {run}"))


def _runs(lines: DataFrame) -> DataFrame:
    """For each run its first row, lines, and the lines and bytes before it, in
    its file (``_line``, ``_byte``) and in all files (``_index``, ``_at``).

    Counts combine in the scan's tasks.  Files follow each other by name."""
    counted = lines.groupBy(*_KEYS).agg(
        F.min("_row").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.octet_length("value").cast("bigint") + 1).alias("_bytes"),
    )
    runs = materialise(counted, "line-runs")
    files = runs.groupBy("file").agg(F.sum("_n").alias("_fn"), F.sum("_bytes").alias("_fbytes"))
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("file", _before("_fn", earlier).alias("_flines"), _before("_fbytes", earlier).alias("_fstart"))
    inside = W.partitionBy("file").orderBy("_block", "_run").rowsBetween(W.unboundedPreceding, -1)
    placed = runs.withColumns({"_line": _before("_n", inside), "_byte": _before("_bytes", inside)}).join(files, "file")
    placed = placed.select(
        *_KEYS, "_first", "_n", "_line", "_byte",
        (F.col("_line") + F.col("_flines")).alias("_index"), (F.col("_byte") + F.col("_fstart")).alias("_at"),
    )
    return F.broadcast(placed) if runs.count() <= MAX_BROADCAST_RUNS else placed


def _before(column: str, window: W) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0)).cast("bigint")


def _placed(spark: SparkSession, path: str, line_sep: str | None, run: int) -> DataFrame:
    """Lines joined with their run, and ``_off``, the place in it.

    Both scans cut and pack the files alike, as long as the settings stay as they
    are.  A line outside its run's rows shows that they did not, and fails the
    job instead of getting a wrong number.  The files must not change meanwhile."""
    lines = _scan(spark, path, line_sep, run)
    both = lines.join(_runs(lines), _KEYS, "left")
    off = F.col("_row") - F.col("_first")
    same = off.between(F.lit(0), F.col("_n") - 1)
    return both.withColumn("_off", F.when(same, off).otherwise(
        F.raise_error(F.concat(F.lit("settings changed between two scans of "), F.col("file"))).cast("bigint")
    ))


def located_lines(spark: SparkSession, path: str, line_sep: str | None = None, run: int = RUN) -> DataFrame:
    """``file, line, index, value``: every line with its 0-based number in its
    file and over the files in name order.  Lines are neither written nor
    shuffled (beyond MAX_BROADCAST_RUNS runs they are joined by run)."""
    return _placed(spark, path, line_sep, run).select(
        "file", (F.col("_line") + F.col("_off")).alias("line"), (F.col("_index") + F.col("_off")).alias("index"), "value"
    )


def line_offsets(spark: SparkSession, path: str, run: int = RUN) -> DataFrame:
    """``file, line, offset, index, position``: a line's number and first byte in
    its file, and the same with the files strung together in name order (each
    ended by a line feed).

    Lines end at a line feed; a carriage return stays in the line.  Only
    lengths are shuffled, by runs."""
    sized = _placed(spark, path, "\n", run).withColumn("_bytes", F.octet_length("value").cast("bigint") + 1).drop("value")
    inside = W.partitionBy(*_KEYS).orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    return sized.withColumn("_in", _before("_bytes", inside)).select(
        "file", (F.col("_line") + F.col("_off")).alias("line"), (F.col("_byte") + F.col("_in")).alias("offset"),
        (F.col("_index") + F.col("_off")).alias("index"), (F.col("_at") + F.col("_in")).alias("position"),
    )
