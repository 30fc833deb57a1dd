"""Manifests of a store: which try of which run is the one that counts.

Every try writes its tables into a fresh folder that nobody reads.  Its last
step is one manifest, a row in a folder named by the next number of the store.
The folder is written under a hidden name and renamed, which fails if the number
is taken: of two writers that began at the same state one wins, and the other's
tables stay unseen.  A try that fails or is refused leaves no trace, and a
repeated one no second copy of a row.

The rename is atomic on HDFS; on a local file system it is as good as that for
jobs that do not commit in the same instant.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from quillgate import schemas
from quillgate.operators import planning
from quillgate.sources import records as rec


class Conflict(RuntimeError):
    """Another writer has published since this try began."""


@dataclass(frozen=True)
class Run:
    """Settings of one run.  ``at`` is passed in so that results do not depend
    on the clock."""

    run_id: str
    stage: str
    input: str
    model: str
    temperature: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    at: dt.datetime = dt.datetime(1970, 1, 1)

    @property
    def backend_id(self) -> str:
        return f"{self.model}@{self.temperature}"

    @property
    def own_backend_id(self) -> str:
        """As ``backend_id`` for calls that no other run may answer."""
        return f"{self.backend_id}/{self.run_id}"

    def now(self):
        return F.lit(self.at).cast("timestamp_ntz")


def run_row(
    spark: SparkSession, run: Run, output: str, seq: int, batch: str | None = None,
    needs: tuple[str, int, str] | None = None, replaces: bool = False,
) -> DataFrame:
    limits = [F.lit(part) for item in run.thresholds.items() for part in item]
    other = F.struct(*[F.lit(v).alias(k) for k, v in zip(("store", "seq", "batch"), needs)]) if needs else F.lit(None)
    row = spark.range(1).select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(seq).alias("seq"),
        F.lit(run.stage).alias("stage"),
        F.lit(run.input).alias("input"),
        F.lit(output).alias("output"),
        F.lit(run.model).alias("model"),
        F.lit(run.temperature).alias("temperature"),
        F.create_map(*limits).alias("thresholds"),
        run.now().alias("started_at"),
        F.lit(batch).alias("batch"),
        F.lit(replaces).alias("replaces"),
        other.alias("needs"),
    )
    return rec.conform(row, schemas.RUNS)


def manifests(spark: SparkSession, store: str) -> DataFrame:
    """All commits of a store, those that do not count included."""
    try:
        return spark.read.schema(schemas.RUNS).option("recursiveFileLookup", True).json(f"{store}/manifests")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return rec.conform(spark.range(0).drop("id"), schemas.RUNS)


def commits(spark: SparkSession, store: str) -> list[Row]:
    """The commits that make up what a store shows now, oldest first: those of
    the newest output.  One row for every finished job, so this is short."""
    known: dict[str, list[Row]] = {}

    def rows(where: str) -> list[Row]:
        if where not in known:
            known[where] = sorted(manifests(spark, where).collect(), key=lambda r: r["seq"])
        return known[where]

    def counts(row: Row) -> bool:
        needs = row["needs"]
        return needs is None or any((r["seq"], r["batch"]) == (needs["seq"], needs["batch"]) for r in rows(needs["store"]))

    shown = [r for r in rows(store) if counts(r)]
    shown = [r for r in shown if r["output"] == shown[-1]["output"]]
    first = max((i for i, r in enumerate(shown) if r["replaces"]), default=0)
    return shown[first:]


def paths(spark: SparkSession, shown: list[Row], name: str) -> list[str]:
    """Folders and files of a table in these commits, of which only the first
    may carry files over."""
    out = [f"{r['batch']}/{name}" for r in shown]
    if shown and shown[0]["replaces"]:
        carried = rec.read_table(spark, f"{shown[0]['batch']}/carried", schemas.CARRIED)
        out += [r["path"] for r in carried.filter(F.col("name") == name).collect()]  # one row for each file
    return out


def current_output(spark: SparkSession, store: str) -> str:
    """The folder of the plan that a store shows now."""
    shown = commits(spark, store)
    if not shown:
        raise FileNotFoundError(f"no run recorded under {store}; start a fresh one")
    return shown[-1]["output"]


def table(spark: SparkSession, store: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows of a table that a store shows now."""
    shown = commits(spark, store)
    if not shown:
        raise FileNotFoundError(f"no run recorded under {store}; start a fresh one")
    return rec.read_tables(spark, paths(spark, shown, name), schema)


@dataclass(frozen=True)
class Draft:
    """One try of a run.  ``output`` holds the plan, ``batch`` the tables that
    this try adds, ``shown`` what was committed when it began."""

    spark: SparkSession
    store: str
    run: Run
    seq: int
    output: str
    batch: str
    shown: tuple = ()
    replaces: bool = False

    def have(self, name: str, schema: T.StructType) -> DataFrame:
        """Rows that earlier commits of this output have written."""
        return rec.read_tables(self.spark, paths(self.spark, list(self.shown), name), schema)

    def carry(self, files: dict[str, list[str]]) -> None:
        """Of a replacing try: the files of earlier commits that stay."""
        rows = [(name, path) for name, every in files.items() for path in every]
        self.spark.createDataFrame(rows, schemas.CARRIED).coalesce(1).write.parquet(f"{self.batch}/carried")

    def commit(self, needs: Draft | None = None) -> None:
        """Make the tables of this try visible; ``needs``: only together with
        those of a try in another store, which is committed after this one."""
        other = (needs.store, needs.seq, needs.batch) if needs else None
        _add(self.spark, self.store, self.seq, run_row(self.spark, self.run, self.output, self.seq, self.batch, other, self.replaces))


def _next(spark: SparkSession, store: str) -> int:
    return (manifests(spark, store).agg(F.max("seq")).first()[0] or 0) + 1


def draft(spark: SparkSession, store: str, run: Run, resume: bool = False) -> Draft:
    """A fresh try: of a new output, or of the shown one on resume after
    checking that the settings agree."""
    seq, new = _next(spark, store), uuid.uuid4().hex
    if not resume:
        output = f"{store}/data-{run.run_id}-{new}"
        return Draft(spark, store, run, seq, output, f"{output}/batch-{new}")
    shown = commits(spark, store)
    if not shown:
        raise FileNotFoundError(f"no run recorded under {store}; start a fresh one")
    last = shown[-1]
    given = run_row(spark, run, last["output"], 0).withColumn("run_id", F.lit("run"))
    recorded = spark.createDataFrame([last], schemas.RUNS).withColumn("run_id", F.lit("run"))
    conflicts = planning.resume_conflicts(given, recorded).collect()  # one row per setting
    if conflicts:
        told = ", ".join(f"{c['setting']}: {c['recorded']} -> {c['given']}" for c in conflicts)
        raise ValueError(f"settings differ from the run to resume ({told})")
    return Draft(spark, store, run, seq, last["output"], f"{last['output']}/batch-{new}", tuple(shown))


def revise(spark: SparkSession, store: str, run: Run) -> Draft:
    """A fresh try that changes some rows of what a store shows: its commit
    takes the place of the earlier ones and carries their other files over."""
    seq, shown = _next(spark, store), commits(spark, store)
    if not shown:
        raise FileNotFoundError(f"no run recorded under {store}; start a fresh one")
    output = shown[-1]["output"]
    return Draft(spark, store, run, seq, output, f"{output}/batch-{uuid.uuid4().hex}", tuple(shown), True)


def publish(spark: SparkSession, store: str, run: Run, output: str) -> None:
    """Show the tables of ``output``, which somebody has written, from now on."""
    Draft(spark, store, run, _next(spark, store), output, output).commit()


def _add(spark: SparkSession, store: str, seq: int, row: DataFrame) -> None:
    """One manifest under the number ``seq``, or ``Conflict``."""
    jvm = spark.sparkContext._jvm
    hidden, name = f"{store}/manifests/_{uuid.uuid4().hex}", f"{store}/manifests/{seq:012d}"
    row.coalesce(1).write.json(hidden)
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (hidden, name))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.getFileSystem(conf).getUri(), conf)
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(source, target, no_overwrite)
    except Py4JJavaError as exc:
        if files.util().exists(target):
            raise Conflict(f"commit {seq} of {store} was made by another writer") from exc
        raise
