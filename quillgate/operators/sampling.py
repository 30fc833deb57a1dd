"""Reproducible per-record draws from the profile table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillgate.functions import text

#: fewest and most profiles per complexity (fixed values); the last entry also
#: serves unknown classes
DRAWS = {"simple": (1, 2), "medium": (3, 4), "complex": (4, 5)}
MAX_DRAWS = 5

TONES = ["formal", "direct", "casual"]

#: largest profile table, in bytes of text, that is broadcast
BROADCAST_BYTES = 64 << 20

def assign_tone(tone: Column, record_id: Column, seed: int | str) -> Column:
    """The given tone, else one drawn per record."""
    pick = F.pmod(text.hash_number(F.lit(str(seed)), record_id, F.lit("tone")), F.lit(len(TONES)))
    choices = F.array(*[F.lit(t) for t in TONES])
    return F.coalesce(tone, F.element_at(choices, (pick + 1).cast("int")))


def draw_count(complexity: Column, record_id: Column, seed: int | str, table_rows: int) -> Column:
    """How many profiles a record gets, never more than there are."""
    coin = F.pmod(text.hash_number(F.lit(str(seed)), record_id, F.lit("n")), F.lit(2))
    low = F.lit(DRAWS["complex"][0])
    for name in ("medium", "simple"):
        low = F.when(complexity == name, F.lit(DRAWS[name][0])).otherwise(low)
    return F.least(low + coin, F.lit(table_rows)).cast("int")


def draw_positions(record_id: Column, n: Column, seed: int | str, table_rows: int) -> Column:
    """``n`` different positions in ``[0, table_rows)`` in draw order.

    Draw ``j`` picks one of the positions still free: a number below
    ``table_rows - j + 1`` that is moved up past every earlier pick.  Exactly
    uniform, no rejection, and the cost does not depend on the table size.
    """

    def add_draw(picked: Column, j: Column) -> Column:
        free = F.pmod(
            text.hash_number(F.lit(str(seed)), record_id, j.cast("string")), F.lit(table_rows) - j + 1
        )
        moved = F.aggregate(
            F.array_sort(picked), free, lambda pos, p: pos + (pos >= p).cast("bigint")
        )
        return F.array_append(picked, moved)

    return F.aggregate(F.sequence(F.lit(1), n), F.array().cast("array<bigint>"), add_draw)


def with_positions(profiles: DataFrame, buckets: int = 256) -> DataFrame:
    """Dense 0-based ``position`` by ``profile_id``, then name and description.

    Approximate quantiles give bucket bounds, bucket counts give each bucket
    its start, and rows are ranked inside their bucket; the result does not
    depend on where the bounds fall.
    """
    grid = [i / buckets for i in range(1, buckets)]
    bounds = profiles.agg(F.percentile_approx("profile_id", grid, 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<bigint>")
    keyed = profiles.withColumn(
        "_bucket", F.size(F.filter(cuts, lambda b: b < F.col("profile_id")))
    )
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy("profile_id", "profile_name", "generated_description"))
    return (
        keyed.withColumn("_rn", inside)
        .join(F.broadcast(starts), "_bucket")
        .withColumn("position", F.col("_start") + F.col("_rn") - 1)
        .drop("_bucket", "_rn", "_start")
    )


def sample_profiles(
    records: DataFrame,
    profiles: DataFrame,
    seed: int | str = 0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``kpis_used`` (profiles in draw order) and ``num_kpis``.

    ``records`` needs ``record_id`` and ``complexity``; rows that repeat an id,
    or have none, each get the draws of that id.  Every draw is looked up by
    its position.  A profile table of at most ``broadcast_bytes`` is broadcast
    once for all look-ups, so records are not shuffled; that limit changes how
    the joins run and nothing else.  Most records have fewer draws than there
    are look-ups; a draw that a record has not gets a number below 0, drawn as
    well, so that these records spread over the tasks like all others.
    """
    size = profiles.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(
            F.coalesce(F.octet_length("profile_name"), F.lit(0))
            + F.coalesce(F.octet_length("generated_description"), F.lit(0))
            + 64
        ).alias("bytes"),
    ).first()
    rows = size["rows"]
    if rows == 0:
        raise ValueError("the profile table is empty")

    n = draw_count(F.col("complexity"), F.col("record_id"), seed, rows)
    drawn = records.withColumn("_n", n).withColumn(
        "_picks", draw_positions(F.col("record_id"), F.col("_n"), seed, rows)
    )
    dim = with_positions(profiles).select(
        "position",
        F.struct(
            "profile_id",
            "profile_name",
            F.col("generated_description").alias("description"),
        ).alias("kpi"),
    )
    # without the hint a larger table may still be broadcast while the query runs, and a task then holds it for each look-up
    dim = F.broadcast(dim) if size["bytes"] <= broadcast_bytes else dim.hint("merge")
    none = -1 - F.pmod(F.xxhash64("record_id", F.spark_partition_id()), F.lit(1 << 40))
    out = drawn.withColumn("_none", none)
    for j in range(MAX_DRAWS):
        out = out.withColumn("_at", F.coalesce(F.get("_picks", F.lit(j)), F.col("_none"))).join(
            dim, F.col("_at") == F.col("position"), "left"
        ).withColumnRenamed("kpi", f"_kpi{j}").drop("position", "_at")
    kpis = F.array_compact(F.array(*[F.col(f"_kpi{j}") for j in range(MAX_DRAWS)]))
    out = out.withColumn("kpis_used", kpis).drop(*[f"_kpi{j}" for j in range(MAX_DRAWS)])
    return out.drop("_n", "_picks", "_none").withColumn("num_kpis", F.size("kpis_used"))
