"""Model completions as a table: cached, deduplicated, retried in rounds.

The model call is a backend the user supplies: a function over batches of
``(request_id, prompt)`` that yields ``(request_id, response, error)``.  No
network client ships.  Every call is one row of the attempt store; its rows
without an error are the cache, so nothing is ever called twice and a lost
executor or a stopped run repeats only what was not committed.

The store is partitioned by the first digits of the request id.  Requests are
worked off in waves of bounded size, each a range of these digits: a wave reads
only its partitions and commits its answers itself, so that a job that is
stopped keeps the waves and rounds before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillgate import schemas
from quillgate.functions import text
from quillgate.operators import planning
from quillgate.operators.joins import spread_join
from quillgate.session import materialise, scratch_path
from quillgate.sources import records as rec

#: timeouts tolerated on one endpoint before moving on (fixed value)
MAX_TRIES = 5

BatchFn = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

#: digits of the request id that name a partition of the store: 256 of them
BUCKET_DIGITS = 2
#: requests of a wave, about
WAVE_ROWS = 1_000_000
#: requests that a task asks for; more tasks than the bound share the rest
TASK_ROWS = 64
#: requests that a task asks for at most, unless ``parallelism`` wants fewer tasks
MAX_TASK_ROWS = 16_384

_ANSWER = "request_id string, endpoint int, response string, error string"
NO_ANSWER = "no answer from the backend"
#: of requests that this job has not come to, or not to an end with
UNFINISHED = "not finished"


@dataclass(frozen=True)
class Backend:
    """One endpoint: a name for logs and a batch function."""

    name: str
    batches: BatchFn


def backend_from_function(name: str, answer: Callable[[str], str]) -> Backend:
    """Backend from a plain prompt-to-text function.  An exception becomes the
    error text of its row (type name first) and never fails the task."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            responses, errors = [], []
            for prompt in frame["prompt"]:
                try:
                    responses.append(answer(prompt))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001
                    responses.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
            yield pd.DataFrame(
                {"request_id": frame["request_id"], "response": responses, "error": errors}
            )

    return Backend(name, batches)


def _dispatch(endpoints: list[BatchFn]) -> BatchFn:
    """Batch function that sends each row to the endpoint it names."""

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if len(endpoints) == 1:
            rows = (frame[["request_id", "prompt"]] for frame in frames)
            for got in endpoints[0](rows):
                yield got.assign(endpoint=0)
            return
        for frame in frames:
            for e, part in frame.groupby("endpoint", sort=True):
                for got in endpoints[e](iter([part[["request_id", "prompt"]]])):
                    yield got.assign(endpoint=e)

    return call


def request_id(prompt: Column, backend_id: str, turn: Column | None = None) -> Column:
    """Cache key: same prompt to the same model and settings, same id.

    ``turn`` counts how often a used-up answer has to be asked for anew; turn 0
    is the plain id.
    """
    parts = [F.lit(backend_id)]
    if turn is not None:
        parts.append(F.when(turn > 0, F.concat(F.lit("#"), turn.cast("string"))).otherwise(F.lit("")))
    return F.sha2(F.concat(*parts, F.lit("\x1f"), prompt), 256)


def classify_errors(attempts: DataFrame) -> DataFrame:
    """Attempt counts per error class."""
    return (
        attempts.filter(F.col("error").isNotNull())
        .groupBy(text.error_class(F.col("error")).alias("error_class"))
        .agg(F.count(F.lit(1)).alias("attempts"))
    )


def retry_frontier(attempts: DataFrame, n_endpoints: int, max_tries: int = MAX_TRIES) -> DataFrame:
    """What to do next with each request, from its attempt log.

    A timeout is retried on the same endpoint up to ``max_tries`` times and
    then rotates; auth and rate-limit errors rotate at once; other errors are
    fatal; when every endpoint has been visited the request is exhausted.  A
    request visits an endpoint once, so counting per request and endpoint
    first (combined before the shuffle) leaves at most ``n_endpoints`` rows
    per request, however long its log is.
    """
    visits = attempts.groupBy("request_id", "endpoint").agg(
        F.count(F.lit(1)).alias("tries"),
        F.max("attempt").alias("last_attempt"),
        F.max_by(text.error_class(F.col("error")), "attempt").alias("error_class"),
    )
    last = visits.groupBy("request_id").agg(
        F.max_by(F.struct("endpoint", "tries", "error_class"), F.col("last_attempt")).alias("_last"),
        F.max("last_attempt").alias("last_attempt"),
        F.count(F.lit(1)).alias("visited"),
    ).select("request_id", "last_attempt", "visited", "_last.*")
    error = F.col("error_class")
    rotate = F.when(F.col("visited") >= n_endpoints, F.lit("exhausted")).otherwise(F.lit("rotate"))
    action = (
        F.when(error.isNull(), F.lit("done"))
        .when(error == text.FATAL, F.lit("fatal"))
        .when((error == "timeout") & (F.col("tries") < max_tries), F.lit("retry_same"))
        .otherwise(rotate)
    )
    return last.withColumn("action", action).withColumn(
        "next_endpoint",
        F.when(F.col("action") == "retry_same", F.col("endpoint"))
        .when(F.col("action") == "rotate", F.pmod(F.col("endpoint") + 1, F.lit(n_endpoints)))
        .cast("int"),
    )


def bucket(request: Column) -> Column:
    return F.substring(request, 1, BUCKET_DIGITS)


def bucket_names() -> list[str]:
    return [f"{i:0{BUCKET_DIGITS}x}" for i in range(16**BUCKET_DIGITS)]


def attempts_table(spark: SparkSession, store: str, buckets: list[str] | None = None) -> DataFrame:
    """The attempt store, or only the partitions of these buckets."""
    schema = T.StructType([*schemas.ATTEMPTS.fields, T.StructField("bucket", T.StringType())])
    calls = rec.read_table(spark, store, schema)
    if buckets is not None:
        calls = calls.filter(F.col("bucket").isin(buckets))
    return calls.drop("bucket")


def append_attempts(calls: DataFrame, store: str) -> None:
    """Add calls, the rows of a partition in one file where they are few."""
    rows = rec.conform(calls, schemas.ATTEMPTS).withColumn("bucket", bucket(F.col("request_id")))
    rows.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(store)


def wave_buckets(n: int, wave_rows: int) -> list[list[str]]:
    """Ranges of buckets that hold about ``wave_rows`` of ``n`` requests each;
    ids are hashes, so they spread evenly."""
    names = bucket_names()
    waves = max(1, min(len(names), -(-n // wave_rows)))
    return [names[i * len(names) // waves : (i + 1) * len(names) // waves] for i in range(waves)]


def _ask(todo: DataFrame, n: int, call: BatchFn, parallelism: int | None) -> DataFrame:
    """Answers of the open requests, spread over tasks by their number.  Without
    a bound a task asks for at most MAX_TASK_ROWS."""
    most = parallelism or max(todo.sparkSession.sparkContext.defaultParallelism, -(-n // MAX_TASK_ROWS))
    todo = todo.repartition(max(1, min(most, -(-n // TASK_ROWS))), "request_id")
    silent = F.col("response").isNull() & F.col("error").isNull()
    return todo.mapInPandas(call, _ANSWER).withColumn("error", F.when(silent, F.lit(NO_ANSWER)).otherwise(F.col("error")))


def _answer_wave(
    asked: DataFrame, backends: list[Backend], store: str, buckets: list[str], run_id: str,
    max_tries: int, parallelism: int | None, max_rounds: int | None, written: bool = False,
) -> None:
    """Call for the requests of a wave that have no answer yet, in rounds, each
    of which is added to the store.  Of ``written`` requests the open ones are
    counted by id first: all or none need no copy of their prompts."""
    spark, n = asked.sparkSession, len(backends)
    calls = attempts_table(spark, store, buckets)
    good = calls.filter(F.col("error").isNull() & F.col("response").isNotNull()).select("request_id")
    if written:
        total = asked.count()
        left = asked.select("request_id").join(good, "request_id", "left_anti").count()
    if written and left in (0, total):
        wanted = asked
    else:
        wanted = materialise(asked.join(good, "request_id", "left_anti"), "wanted")
        left = wanted.count()
    start = F.pmod(F.xxhash64("request_id"), F.lit(n)).cast("int")
    todo = wanted.select("request_id", "prompt", start.alias("endpoint"))
    call = _dispatch([b.batches for b in backends])
    # attempts go on counting where a stopped run of the same id has ended
    before = calls.filter(F.col("run_id") == run_id).agg(F.max("attempt")).first()[0] or 0 if left else 0
    for tried in range(max_rounds or n * max_tries):
        if not left:
            break
        # every open request is tried once per round, so the round numbers the attempt
        append_attempts(
            _ask(todo, left, call, parallelism).withColumns(
                {"run_id": F.lit(run_id), "attempt": F.lit(before + tried + 1)}
            ),
            store,
        )
        log = attempts_table(spark, store, buckets).filter(F.col("run_id") == run_id)
        again = retry_frontier(log, n, max_tries).filter(F.col("action").isin("retry_same", "rotate"))
        again = materialise(again.select("request_id", F.col("next_endpoint").alias("endpoint")), "again")
        left = again.count()
        todo = wanted.join(again, "request_id").select("request_id", "prompt", "endpoint")


def attach_completions(
    df: DataFrame,
    prompt: str,
    backends: list[Backend],
    store: str,
    *,
    backend_id: str,
    run_id: str,
    response: str = "response",
    error: str = "error",
    max_tries: int = MAX_TRIES,
    parallelism: int | None = None,
    max_rounds: int | None = None,
    turn: Column | None = None,
    wave_rows: int = WAVE_ROWS,
    max_waves: int | None = None,
) -> DataFrame:
    """Add the (stripped) response to each prompt, and the error where it failed.

    Distinct prompts without a cached response are called in rounds until none
    is left to retry, wave by wave, and the store is joined back.
    ``parallelism`` bounds how many calls run at the same time.  What
    ``max_waves`` or ``max_rounds`` leave open has the error ``not finished`` and
    is asked for by the next job.
    """
    spark = df.sparkSession
    keyed = materialise(df.withColumn("_request", request_id(F.col(prompt), backend_id, turn)), "keyed")
    asked = (
        keyed.filter(F.col(prompt).isNotNull())
        .select(F.col("_request").alias("request_id"), F.col(prompt).alias("prompt"))
        .dropDuplicates(["request_id"])
    )
    used = sorted(r[0] for r in keyed.select(bucket(F.col("_request"))).distinct().collect() if r[0])  # at most one row a bucket
    waves = wave_buckets(asked.select("request_id").count(), wave_rows)
    whole = asked
    if len(waves) > 1:
        # by wave, each task of the shuffle before writes its part of every wave
        path = scratch_path(spark, "asked")
        starts = F.array(*[F.lit(names[0]) for names in waves])
        wave = F.size(F.filter(starts, lambda x: x <= bucket(F.col("request_id")))) - 1
        asked.withColumn("_wave", wave).write.partitionBy("_wave").parquet(path)
        whole = spark.read.schema(T.StructType([*asked.schema, T.StructField("_wave", T.IntegerType())])).parquet(path)
    for i, names in enumerate(waves[:max_waves]):
        mine = whole.filter(F.col("_wave") == i).drop("_wave") if len(waves) > 1 else asked
        _answer_wave(mine, backends, store, names if len(waves) > 1 else used, run_id, max_tries, parallelism, max_rounds, len(waves) > 1)

    calls = attempts_table(spark, store, used)
    good = F.col("error").isNull() & F.col("response").isNotNull()
    # a success of any run wins; else the newest error of this run
    rank = F.when(good, F.lit(1 << 62)).when(F.col("run_id") == run_id, F.col("attempt"))
    outcome = planning.latest_state(
        calls.select(
            F.col("request_id").alias("_request"),
            text.strip(F.col("response")).alias(response),
            F.col("error").alias(error),
            rank.alias("_rank"),
        ).filter(F.col("_rank").isNotNull()),
        key="_request",
        order="_rank",
    ).drop("_rank")
    if max_rounds:
        mine = attempts_table(spark, store, used).filter(F.col("run_id") == run_id)
        again = retry_frontier(mine, len(backends), max_tries).filter(F.col("action").isin("retry_same", "rotate"))
        again = again.select(F.col("request_id").alias("_request"), F.lit(True).alias("_again"))
        outcome = outcome.join(again, "_request", "left").withColumn(
            error, F.when(F.col(error).isNotNull() & F.col("_again"), F.lit(UNFINISHED)).otherwise(F.col(error))
        ).drop("_again")
    # the flag lets the prompt text drop out before the shuffle when unused
    flagged = keyed.withColumn("_asked", F.col(prompt).isNotNull())
    joined = spread_join(flagged, outcome, "_request", "left", spread_by=["_asked"])
    unanswered = F.col("_asked") & F.col(response).isNull() & F.col(error).isNull()
    return joined.withColumn(
        error, F.when(unanswered, F.lit(UNFINISHED if max_waves else NO_ANSWER)).otherwise(F.col(error))
    ).drop("_request", "_asked")
