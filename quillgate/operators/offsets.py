"""Byte positions of records in a JSON-lines file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quillgate.operators.planning import BUCKET
from quillgate.sources import positions


def record_offsets(lines: DataFrame, line: str = "value", bucket: int = BUCKET) -> DataFrame:
    """``index, offset``: where each line starts when written in index order.

    Bytes are summed per bucket of positions first, then inside each bucket;
    ``index`` is unique, so a bucket has at most ``bucket`` rows and no window
    runs over the whole data.
    """
    sized = lines.select(
        "index",
        F.expr(f"index div {bucket}").alias("_bucket"),
        (F.octet_length(line) + 1).cast("bigint").alias("_bytes"),
    )
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sized.groupBy("_bucket").agg(F.sum("_bytes").alias("_total")).select(
        "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start")
    )
    inside = F.sum("_bytes").over(
        W.partitionBy("_bucket").orderBy("index").rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        sized.withColumn("_inside", F.coalesce(inside, F.lit(0)))
        .join(starts, "_bucket")
        .select("index", (F.col("_start") + F.col("_inside")).alias("offset"))
    )


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``file, index, offset`` of every line of the files under ``path``.

    Lines end at a line feed; a carriage return stays in the line, so the
    positions are exact for both kinds of file.
    """
    return positions.line_offsets(spark, path).select("file", F.col("line").alias("index"), "offset")


def joint_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``index, offset`` over all files under ``path`` as if they were one, in
    name order."""
    return positions.line_offsets(spark, path).select("index", F.col("position").alias("offset"))


def changed_offsets(plan: DataFrame, offsets: DataFrame, field: str = "offset") -> DataFrame:
    """Plan positions whose offset changes; positions that only one side has
    are left alone."""
    new = offsets.select("index", F.col("offset").alias("new_offset"))
    return (
        plan.select("index", F.col(field).alias("old_offset"))
        .join(new, "index")
        .filter(~F.col("old_offset").eqNullSafe(F.col("new_offset")))
    )


def update_offsets(plan: DataFrame, offsets: DataFrame, field: str = "offset") -> DataFrame:
    """Plan with ``field`` replaced by position; others keep what they had."""
    new = offsets.select("index", F.col("offset").alias("_new"))
    return (
        plan.join(new, "index", "left")
        .withColumn(field, F.coalesce("_new", field))
        .drop("_new")
    )
