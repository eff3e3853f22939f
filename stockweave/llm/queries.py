"""One query per operator over its whole table, and the SQL twins of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import (
    decontaminate,
    importance,
    language,
    licenses,
    neighbours,
    packing,
    secrets,
    sentences,
    sharding,
    simhash,
    spelling,
    sql,
    substrings,
    toxicity,
)
from stockweave.llm.common import prepare

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def keep(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        REGISTRY[name] = run
        if twin:
            ORACLE[name] = twin
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_licenses", sql.license_sql())
def _(spark, d):
    return licenses.scan_licenses(table(spark, d, "documents"))


@query("op2_neighbours")
def _(spark, d):
    return neighbours.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_decontamination", sql.contamination_sql())
def _(spark, d):
    return decontaminate.find_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op4_sentences", sql.sentence_sql())
def _(spark, d):
    return sentences.dedup_sentences(table(spark, d, "documents"))


@query("op5_language")
def _(spark, d):
    return language.identify_languages(table(spark, d, "documents"))


@query("op6_simhash")
def _(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query("op7_sharding")
def _(spark, d):
    return sharding.assign_shards(table(spark, d, "documents"))


@query("op8_packing")
def _(spark, d):
    return packing.pack_documents(table(spark, d, "documents"))


@query("op9_secrets", sql.secret_sql())
def _(spark, d):
    return secrets.scan_secrets(table(spark, d, "documents"))


@query("op10_substrings")
def _(spark, d):
    return substrings.dedup_substrings(table(spark, d, "documents"))


@query("op11_toxicity")
def _(spark, d):
    return toxicity.score_toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op12_importance", sql.importance_sql())
def _(spark, d):
    ranks = importance.importance_ranks(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return ranks.drop("n_words")


@query("op13_spelling", sql.spelling_sql())
def _(spark, d):
    return spelling.spelling_variants(table(spark, d, "documents"), change=spelling.dropped_letter)
