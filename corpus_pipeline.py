"""The corpus pipeline: clean documents in, packed training sequences out.

Every stage takes what its predecessor kept, written as Parquet, and takes effect on it: rejected
languages go, one document of each near-duplicate component stays, contaminated documents go,
secrets are masked in the text, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registry.scratch import local_scratch
from stockweave.llm.common import prepare
from stockweave.llm.decontaminate import drop_contaminated
from stockweave.llm.language import keep_identified
from stockweave.llm.packing import pack_documents
from stockweave.llm.secrets import redact_secrets
from stockweave.llm.simhash import keep_one_of_each
from stockweave.session import materialize, tune


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


def ready(spark: SparkSession) -> SparkSession:
    return prepare(local_scratch(tune(spark)))


def staged(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ready(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", staged(language_id)),
    ("simhash_dedup", staged(simhash_dedup)),
    ("decontamination", staged(decontamination)),
    ("secret_scan", staged(secret_scan)),
    ("packing", staged(packing)),
]

#: Compression sizes, fingerprints, token ids and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing of what the stages keep, each stage written and read back."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
