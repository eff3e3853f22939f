"""Fuzzy matching of product names to an external catalogue by edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _deletions(text: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
        lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
    )


def deletion_keys(text: Column, max_distance: int) -> Column:
    """Hashes of ``text`` with up to ``max_distance`` characters left out.

    Two texts within that edit distance share at least one of these keys, so an equi-join on them
    finds every match and needs no shared word: a word that a third of the catalogue uses costs
    nothing extra.
    """
    found = level = F.array(text)
    for _ in range(max_distance):
        level = F.array_distinct(F.flatten(F.transform(level, _deletions)))
        found = F.concat(found, level)
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def fuzzy_product_match(products: DataFrame, catalogue: DataFrame, max_distance: int = 2) -> DataFrame:
    """Nearest catalogue ``name`` per distinct product name, ties by name; null without a match.

    ``catalogue``: name plus further columns, one row per name. Columns: product_name, match_name,
    the further columns, distance.
    """
    rest = [c for c in catalogue.columns if c != "name"]
    names = products.select("product_name").distinct()
    left = names.select("product_name", F.explode(deletion_keys(F.col("product_name"), max_distance)).alias("_key"))
    right = catalogue.select("name", F.explode(deletion_keys(F.col("name"), max_distance)).alias("_key"))
    distance = F.levenshtein("product_name", "name", max_distance)
    best = (
        left.join(right, "_key")
        .select("product_name", "name")
        .distinct()
        .withColumn("distance", distance)
        .filter("distance >= 0")
        .groupBy("product_name")
        .agg(F.min(F.struct("distance", "name")).alias("m"))
        .select("product_name", F.col("m.name").alias("name"), F.col("m.distance").alias("distance"))
    )
    matched = best.join(catalogue, "name").withColumnRenamed("name", "match_name")
    return names.join(matched, "product_name", "left").select("product_name", "match_name", *rest, "distance")
