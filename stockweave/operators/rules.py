"""Association rules from frequent itemsets, and reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.operators.baskets import (
    SliceBaskets,
    frequent_itemsets,
    item_names,
    named,
    slice_baskets,
)
from stockweave.params import MiningParams


def rules_from(start: SliceBaskets, p: MiningParams) -> DataFrame:
    """Every split of a frequent itemset into antecedent and consequent that passes the limits.

    Both sides may hold several items. Numbers come from counts: confidence = n_AC / n_A,
    lift = n_AC * n / (n_A * n_C).
    """
    keys = list(p.slice_cols)
    sets = frequent_itemsets(start, p)
    splits = F.transform(
        F.expr("sequence(1, shiftleft(1, size(itemset)) - 2)"),
        lambda m: F.struct(
            F.filter("itemset", lambda x, i: F.getbit(m, i) == 1).alias("a"),
            F.filter("itemset", lambda x, i: F.getbit(m, i) == 0).alias("c"),
        ),
    )
    sides = (
        sets.filter(F.size("itemset") >= 2)
        .select(*keys, "cnt", "n_orders", F.inline(splits))
    )
    counts = sets.select(*keys, "itemset", F.col("cnt").alias("n"))
    joined = (
        sides.join(counts.withColumnsRenamed({"itemset": "a", "n": "n_a"}), [*keys, "a"])
        .join(counts.withColumnsRenamed({"itemset": "c", "n": "n_c"}), [*keys, "c"])
        .withColumn("confidence", F.col("cnt") / F.col("n_a"))
        .withColumn(
            "lift",
            (F.col("cnt").cast("double") * F.col("n_orders"))
            / (F.col("n_a").cast("double") * F.col("n_c")),
        )
        .filter((F.col("lift") >= p.min_lift) & (F.col("confidence") >= p.min_confidence))
    )
    rules = joined.join(item_names(start, p), keys)
    return rules.select(
        named("a").alias("antecedents"),
        named("c").alias("consequents"),
        (F.col("cnt") / F.col("n_orders")).alias("support"),
        "confidence",
        "lift",
        *keys,
    ).select(
        F.array_join("antecedents", ", ").alias("antecedent"),
        F.array_join("consequents", ", ").alias("consequent"),
        "support",
        "confidence",
        "lift",
        *keys,
        "antecedents",
        "consequents",
    )


def context_rules(enriched: DataFrame, p: MiningParams = MiningParams(), item: str = "product_name") -> DataFrame:
    """Rules of every context slice in one job."""
    return rules_from(slice_baskets(enriched, p, item), p)


def global_rules(enriched: DataFrame, p: MiningParams, item: str = "product_name") -> DataFrame:
    """The same without slices: one slice named 'all'."""
    from dataclasses import replace

    everything = enriched.withColumn("scope", F.lit("all"))
    return context_rules(everything, replace(p, slice_cols=("scope",)), item)


def rules_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count(F.lit(1)).alias("n_rules"), F.avg("lift").alias("avg_lift"), F.max("lift").alias("max_lift")
    )


def rule_order(p: MiningParams):
    return [F.desc("lift"), "antecedent", "consequent", *p.slice_cols]


def top_rules(rules: DataFrame, p: MiningParams, n: int = 5) -> DataFrame:
    return rules.orderBy(*rule_order(p)).limit(n)


def top_rules_per_segment(rules: DataFrame, p: MiningParams, n: int = 10, by: str = "segment") -> DataFrame:
    w = Window.partitionBy(by).orderBy(*rule_order(p))
    return rules.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def best_rule_per_item(rules: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Strongest rule per single-item antecedent over all slices; ties by consequent.

    An aggregate, not a sorted window: the pick is combined per map task.
    """
    single = rules.filter(F.size("antecedents") == 1)
    best = F.min_by(F.struct("consequent", "lift"), F.struct(-F.col("lift"), F.col("consequent")))
    return (
        single.groupBy(*by, "antecedent")
        .agg(best.alias("b"))
        .select(*by, F.col("antecedent"), F.col("b.consequent").alias("consequent"), F.col("b.lift").alias("lift"))
    )


def rule_coverage(start: SliceBaskets, rules: DataFrame, p: MiningParams) -> DataFrame:
    """Per slice: mined orders that contain the antecedent of some rule, and their share.

    Works on distinct baskets; an antecedent is looked up by its first item and then checked.
    """
    keys = list(p.slice_cols)
    named_baskets = start.baskets.join(item_names(start, p), keys).select(
        *keys, named("items").alias("items"), "weight"
    )
    sides = rules.select(*keys, "antecedents").distinct().withColumn("first", F.col("antecedents")[0])
    covered = (
        named_baskets.select(*keys, "items", "weight", F.explode("items").alias("first"))
        .join(sides, [*keys, "first"])
        .filter(F.size(F.array_except("antecedents", "items")) == 0)
        .select(*keys, "items", "weight")
        .distinct()
        .groupBy(*keys)
        .agg(F.sum("weight").alias("covered"))
    )
    return start.sizes.join(covered, keys, "left").select(
        *keys,
        "n_orders",
        F.coalesce("covered", F.lit(0)).alias("covered_orders"),
        (F.coalesce("covered", F.lit(0)) / F.col("n_orders")).alias("coverage"),
    )


def lift_gain(rules: DataFrame, overall: DataFrame, p: MiningParams) -> DataFrame:
    """Slice rules that also hold overall, with the relative gain in lift."""
    base = overall.select("antecedent", "consequent", F.col("lift").alias("global_lift"))
    return rules.join(base, ["antecedent", "consequent"]).select(
        *p.slice_cols,
        "antecedent",
        "consequent",
        "lift",
        "global_lift",
        (F.col("lift") / F.col("global_lift") - 1).alias("lift_gain"),
    )


def segment_top_products(enriched: DataFrame, n: int = 20) -> DataFrame:
    counts = enriched.groupBy("segment", "product_name").agg(F.count(F.lit(1)).alias("lines"))
    w = Window.partitionBy("segment").orderBy(F.desc("lines"), "product_name")
    return counts.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def segment_affinity(enriched: DataFrame) -> DataFrame:
    """Share of an item within a segment, divided by its share overall."""
    counts = enriched.groupBy("segment", "product_name").agg(F.count(F.lit(1)).alias("lines"))
    by_segment = counts.groupBy("segment").agg(F.sum("lines").alias("segment_lines"))
    by_item = counts.groupBy("product_name").agg(F.sum("lines").alias("item_lines"))
    total = counts.agg(F.sum("lines").alias("t")).scalar()
    return (
        counts.join(by_segment, "segment")
        .join(by_item, "product_name")
        .select(
            "segment",
            "product_name",
            "lines",
            (
                (F.col("lines") / F.col("segment_lines")) / (F.col("item_lines") / total)
            ).alias("affinity"),
        )
    )
