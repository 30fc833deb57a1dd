"""Keyed look-ups that stay even when one key owns much of the left side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

#: rows of one key that one task may hold
HOT_ROWS = 1_000_000


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` to ``right`` (at most one row per key) on ``key``.

    Keys with ``hot_rows`` or more rows on the left are split over as many
    salts as they have multiples of ``hot_rows``; only the few right rows of
    those keys are copied.  At most ``rows / hot_rows`` keys can be hot, which
    bounds what is broadcast.  Counting reads the key column alone and
    combines before its shuffle.  ``spread_by`` names left columns that tell
    the rows of one key apart (default: all but maps); the task number is
    added, so even exact copies spread.  Both stay the same when a task runs
    again, unlike random salts.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"spread_join does not do '{how}' joins")
    if spread_by is None:
        spread_by = [c for c, t in left.dtypes if c != key and "map<" not in t and "variant" not in t]
    spread = F.xxhash64(*spread_by, F.spark_partition_id())
    hot = F.broadcast(
        left.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") >= hot_rows) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    salted_left = (
        left.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(spread, F.lit(1024)).cast("int"))
            .when(
                F.col("_salts").isNotNull(),
                F.pmod(spread, F.col("_salts")).cast("int"),
            )
            .otherwise(F.lit(0)),
        )
        .drop("_salts")
    )
    salted_right = (
        right.join(hot, key, "left")
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
        )
        .drop("_salts")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the row with the highest ``order`` of each key.

    The row-number limit is applied before the shuffle as well, so a key with
    many copies sends one row per task.
    """
    w = W.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
