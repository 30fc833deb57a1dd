"""A training corpus from raw documents, in stages that are written and reread.

Every stage takes (spark, docs, sf_dir) and keeps the columns of ``docs``; the
last one adds ``pass`` and ``place``, the order of the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillgate.llm import decontaminate, language_id, mixing, near_dedup, pii
from quillgate.llm.common import materialise

#: a text whose best language is less likely than this has none that stands out
LEAST_SHARE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which a language can be told."""
    got = language_id.predict(docs, language_id.train(docs), keep=[F.struct("*").alias("row")])
    return got.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates."""
    return near_dedup.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = decontaminate.matches(docs, items, keep=[F.struct("*").alias("row")])
    return got.filter(F.size("matches") == 0).select("row.*")


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind."""
    got = pii.find(docs, pii.train(docs), keep=[F.struct("*").alias("row")])
    changed = F.size("spans") > 0
    columns = {
        "text": F.when(changed, F.col("redacted")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.length("redacted")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType),
    }
    return got.select(*[columns[x].alias(x) if x in columns else F.col(f"row.`{x}`") for x in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in the mixture's proportions, with pass and place."""
    return mixing.mix(docs).withColumnsRenamed({"_pass": "pass", "_place": "place"})


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each),
    ("benchmark", no_benchmark),
    ("personal data", no_personal_data),
    ("mixture", mixed),
]

#: the stages learn models, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
