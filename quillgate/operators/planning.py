"""Plans, resume, batching and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quillgate.functions import text

#: plan order of the complexity classes (fixed values)
COMPLEXITIES = ["simple", "medium", "complex"]

#: rows per bucket wherever positions are cut in two phases
BUCKET = 1 << 20


# -- distribution and plan ---------------------------------------------------


def resolve_distribution(n_examples: int | None = None, custom: dict | None = None) -> dict[str, int]:
    """Counts per complexity: an even split whose remainder goes to the first
    classes, or the given counts restricted to the known classes."""
    if custom:
        counts = {c: int(custom.get(c, 0)) for c in COMPLEXITIES}
        if sum(counts.values()) <= 0:
            raise ValueError("the distribution must ask for at least one example")
    else:
        if n_examples is None or n_examples < 1:
            raise ValueError("n_examples must be at least 1")
        share, extra = divmod(n_examples, len(COMPLEXITIES))
        counts = {c: share + (pos < extra) for pos, c in enumerate(COMPLEXITIES)}
    if min(counts.values()) < 0:
        raise ValueError("counts must not be negative")
    return counts


def distribution_rows(df: DataFrame, n: str) -> DataFrame:
    """The even split for every row of ``df``: adds ``ord, complexity, n_class``."""
    share, extra = F.expr(f"{n} div {len(COMPLEXITIES)}"), F.col(n) % len(COMPLEXITIES)
    classes = F.array(*[
        F.struct(
            F.lit(pos).alias("ord"),
            F.lit(c).alias("complexity"),
            (share + (extra > pos).cast("bigint")).alias("n_class"),
        )
        for pos, c in enumerate(COMPLEXITIES)
    ])
    return df.select("*", F.inline(classes))


def build_plan(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """One row per planned record, ordered by complexity class.

    ``range`` splits evenly over tasks and the class follows from the index,
    so no row is exploded or ranked.
    """
    total = sum(counts.get(c, 0) for c in COMPLEXITIES)
    bound, complexity = 0, None
    for c in COMPLEXITIES:
        bound += counts.get(c, 0)
        hit = F.col("id") < bound
        complexity = F.when(hit, c) if complexity is None else complexity.when(hit, c)
    return spark.range(total).select(
        F.col("id").alias("index"),
        text.record_id(F.col("id")).alias("record_id"),
        complexity.alias("complexity"),
    )


# -- stage hand-over and resume ----------------------------------------------


def missing_upstream(plan: DataFrame, upstream: DataFrame) -> DataFrame:
    """Plan rows whose record the previous stage has not written."""
    return plan.join(upstream.select("record_id").distinct(), "record_id", "left_anti")


def handoff_report(plan: DataFrame, upstream: DataFrame) -> DataFrame:
    """One row: planned, available, missing, complete."""
    done = upstream.select("record_id", F.lit(True).alias("_have")).distinct()
    return plan.join(done, "record_id", "left").agg(
        F.count(F.lit(1)).alias("planned"),
        F.count("_have").alias("available"),
        F.count_if(F.col("_have").isNull()).alias("missing"),
        ((F.count(F.lit(1)) > 0) & (F.count_if(F.col("_have").isNull()) == 0)).alias("complete"),
    )


def next_stage_plan(plan: DataFrame, upstream: DataFrame, allow_partial: bool = False) -> DataFrame:
    """Plan of the next stage.  A stage starts on a complete upstream unless
    ``allow_partial`` asks for the finished part."""
    if not allow_partial:
        report = handoff_report(plan, upstream).first()
        if not report["complete"]:
            raise ValueError(
                f"upstream is incomplete: {report['missing']} of {report['planned']} records missing"
            )
    return plan.join(upstream.select("record_id").distinct(), "record_id", "left_semi")


def pending(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Plan rows still to do; keyed, so gaps left by failures are found too."""
    return plan.join(done.select("record_id"), "record_id", "left_anti")


def next_batch(todo: DataFrame, n: int, bucket: int = BUCKET) -> DataFrame:
    """The first ``n`` rows by plan order, with every row that shares the
    index of the last one.

    The cut is found from counts by bucket and then by index in one bucket, so
    neither the batch nor the rows of a repeated index are gathered in a task.
    """
    if n < 1:
        return todo.limit(0)
    keyed = todo.select("index", F.expr(f"index div {bucket}").alias("_bucket"))
    edge = (
        keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(_running("_bucket")))
        .filter((F.col("_upto") >= n) & (F.col("_upto") - F.col("_n") < n))
        .select("_bucket", (F.lit(n) - F.col("_upto") + F.col("_n")).alias("_rank"))
    )
    cut = (
        keyed.join(F.broadcast(edge), "_bucket")
        .groupBy("index", "_rank").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(_running("index")))
        .filter("_upto >= _rank")
        .agg(F.min("index"))
        .scalar()
    )
    return todo.filter(F.col("index") <= F.coalesce(cut, F.lit((1 << 63) - 1)))


def _running(column: str):
    return W.orderBy(column).rowsBetween(W.unboundedPreceding, W.currentRow)


def committed_prefix(results: DataFrame, error: str = "error") -> DataFrame:
    """Rows before the first failing plan position (stop-at-first-failure)."""
    first_bad = results.filter(F.col(error).isNotNull()).agg(F.min("index")).scalar()
    return results.filter(F.col("index") < F.coalesce(first_bad, F.lit((1 << 63) - 1)))


def lookup_records(plan: DataFrame, records: DataFrame) -> DataFrame:
    """Each plan row with its record; ``record_found`` tells the gaps."""
    found = records.withColumn("record_found", F.lit(True))
    return plan.join(found, "record_id", "left").fillna({"record_found": False})


def id_mismatches(plan: DataFrame, records: DataFrame) -> DataFrame:
    """Positions where the record carries another id than the plan.  A record
    without an id is accepted."""
    other = records.select("index", F.col("record_id").alias("found_id"))
    return plan.join(other, "index").filter(
        F.col("found_id").isNotNull()
        & (F.col("found_id") != "")
        & (F.col("found_id") != F.col("record_id"))
    ).select("index", F.col("record_id").alias("planned_id"), "found_id")


# -- resume guard and progress -----------------------------------------------

#: settings a resumed run must share with the run it continues
GUARDED = ["input", "output", "model"]


def resume_conflicts(current: DataFrame, recorded: DataFrame, key: str = "run_id") -> DataFrame:
    """One row per setting that differs between a run and its recorded state.

    Temperatures may differ by 1e-9; thresholds are compared when both sides
    have the column.
    """
    old = recorded.select(key, *[F.col(c).alias(f"_old_{c}") for c in recorded.columns if c != key])
    both = current.join(old, key)
    fields: list[Column] = []

    def conflict(name: str, bad: Column) -> Column:
        return F.when(
            bad,
            F.struct(
                F.lit(name).alias("setting"),
                F.col(f"_old_{name}").cast("string").alias("recorded"),
                F.col(name).cast("string").alias("given"),
            ),
        )

    for name in GUARDED:
        if name in current.columns and name in recorded.columns:
            fields.append(conflict(name, ~F.col(name).eqNullSafe(F.col(f"_old_{name}"))))
    fields.append(
        conflict(
            "temperature",
            F.abs(
                F.coalesce(F.col("_old_temperature"), F.col("temperature")) - F.col("temperature")
            ) > 1e-9,
        )
    )
    if "thresholds" in current.columns and "thresholds" in recorded.columns:
        entries = lambda c: F.array_sort(F.map_entries(F.col(c)))
        fields.append(
            conflict("thresholds", ~entries("thresholds").eqNullSafe(entries("_old_thresholds")))
        )
    found = F.array_compact(F.array(*fields))
    return both.select(key, F.inline(found))


def latest_state(log: DataFrame, key: str = "record_id", order: str = "seq") -> DataFrame:
    """Newest row per key of an append-only log (combines before the shuffle)."""
    rest = [c for c in log.columns if c != key]
    return (
        log.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
        .select(key, "_last.*")
    )


def progress(status: DataFrame) -> DataFrame:
    """One row: completed, last completed id in plan order, last update."""
    done = F.col("status") == "completed"
    return status.agg(
        F.count(F.lit(1)).alias("planned"),
        F.count_if(done).alias("completed"),
        F.max_by(F.when(done, F.col("record_id")), F.when(done, F.col("index"))).alias("last_id"),
        F.max(F.when(done, F.col("updated_at"))).alias("last_at"),
    )


def completion_by_complexity(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Planned and completed counts per complexity with a total row."""
    flag = done.select("record_id").distinct().withColumn("_done", F.lit(True))
    return (
        plan.join(flag, "record_id", "left")
        .rollup("complexity")
        .agg(F.count(F.lit(1)).alias("planned"), F.count("_done").alias("completed"))
        .withColumn("complexity", F.coalesce("complexity", F.lit("all")))
    )
