"""Context slices, baskets and frequent itemsets: all slices in one job, the slice is a key.

Shape of the work: distinct (slice, order, item) rows spread evenly over the cluster; the frequent
items of a slice, whose number the support bounds (mean basket size / least support), get small
integer ranks; every order shrinks to its set of ranks and equal sets are counted once. Itemsets are
counted on these distinct weighted baskets, so a group of copies, however large, costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.ordering import capped_by_hash
from stockweave.functions.scalars import time_slot
from stockweave.params import MiningParams
from stockweave.session import materialize

NO_BIN = "nan"  # a missing rain bin is a slice of its own


def enrich_baskets(lines: DataFrame, context: DataFrame, segments: DataFrame) -> DataFrame:
    """(order_id, user_id, product_name, segment, time_slot, weather_bin) per order line.

    Orders meet their user's segment first, at order grain, so the lines are joined once and a
    user with very many lines is only as heavy as their orders.
    """
    who = segments.select("user_id", F.col("cluster_name").alias("segment"))
    orders = context.select(
        "order_id", "user_id", F.coalesce("rain_bin", F.lit(NO_BIN)).alias("weather_bin")
    ).join(who, "user_id")
    return (
        lines.select("order_id", "order_hour_of_day", "product_name")
        .join(orders, "order_id")
        .select(
            "order_id",
            "user_id",
            "product_name",
            "segment",
            time_slot(F.col("order_hour_of_day")).alias("time_slot"),
            "weather_bin",
        )
    )


def presence(rows: DataFrame) -> DataFrame:
    """Distinct rows; hashed over all columns, so neither a hot slice nor a hot item skews it."""
    return rows.distinct()


def slice_orders(enriched: DataFrame, p: MiningParams) -> DataFrame:
    """Distinct (slice, order_id)."""
    return enriched.select(*p.slice_cols, "order_id").distinct()


def slice_order_counts(enriched: DataFrame, p: MiningParams) -> DataFrame:
    """Orders per slice, slices below the minimum left out."""
    return (
        slice_orders(enriched, p)
        .groupBy(*p.slice_cols)
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .filter(F.col("n_orders") >= p.min_orders)
    )


def slice_order_cap(enriched: DataFrame, p: MiningParams) -> DataFrame:
    """Orders that take part in mining, ``max_orders`` of a slice, with ``n_orders`` after the cap."""
    capped = capped_by_hash(slice_orders(enriched, p), p.slice_cols, "order_id", p.max_orders)
    return capped.filter(F.col("group_size") >= p.min_orders).select(
        *p.slice_cols, "order_id", F.least("group_size", F.lit(p.max_orders)).alias("n_orders")
    )


def slice_item_counts(present: DataFrame, p: MiningParams) -> DataFrame:
    """(slice, item, cnt, n_orders). ``present``: distinct (slice, n_orders, order_id, item)."""
    return present.groupBy(*p.slice_cols, "item").agg(
        F.count(F.lit(1)).alias("cnt"), F.first("n_orders").alias("n_orders")
    )


def slice_top_items(counts: DataFrame, p: MiningParams) -> DataFrame:
    """The ``top_items`` items per slice by order count, ties by name, with their rank from 0.

    Spark prunes to the top rows per slice before the shuffle of the window (group limit).
    """
    order = Window.partitionBy(*p.slice_cols).orderBy(F.desc("cnt"), "item")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.top_items)
    return top.withColumn("rank", F.col("rank") - 1)


def frequent_items(counts: DataFrame, p: MiningParams) -> DataFrame:
    """Items of a slice within its support, ranked from 0; all of them unless ``top_items`` cuts."""
    enough = counts.filter(F.col("cnt") / F.col("n_orders") >= p.min_support)
    if p.top_items is not None:
        return slice_top_items(enough, p)
    order = Window.partitionBy(*p.slice_cols).orderBy(F.desc("cnt"), "item")
    return enough.withColumn("rank", F.row_number().over(order) - 1)


def rank_baskets(ranked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., items, weight): distinct sorted baskets and the number of orders that share them.

    ``ranked``: distinct (keys, order_id, rank).
    """
    per_order = ranked.groupBy(*keys, "order_id").agg(F.sort_array(F.collect_set("rank")).alias("items"))
    return per_order.groupBy(*keys, "items").agg(F.count(F.lit(1)).alias("weight"))


def pair_counts(baskets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., itemset, cnt) of all item pairs, summed per map task before the shuffle."""
    pairs = F.flatten(
        F.transform(
            "items",
            lambda x, i: F.transform(
                F.slice("items", i + 2, F.size("items")), lambda y: F.array(x, y)
            ),
        )
    )
    return (
        baskets.filter(F.size("items") >= 2)
        .select(*keys, F.explode(pairs).alias("itemset"), "weight")
        .groupBy(*keys, "itemset")
        .agg(F.sum("weight").alias("cnt"))
    )


@dataclass(frozen=True)
class SliceBaskets:
    """Materialized start of the mining: ``sizes`` (slice, n_orders mined), ``items`` (slice, item,
    rank, cnt, n_orders) of the frequent single items and ``baskets`` (slice, items, weight) of them."""

    sizes: DataFrame
    items: DataFrame
    baskets: DataFrame


def slice_baskets(enriched: DataFrame, p: MiningParams, item: str = "product_name") -> SliceBaskets:
    """The joins behind ``enriched`` run once: its distinct rows are written, all else reads them."""
    keys = list(p.slice_cols)
    present = materialize(presence(enriched.select(*keys, "order_id", F.col(item).alias("item"))), "presence")
    if p.max_orders is None:
        sizes = materialize(slice_order_counts(present, p), "slice_sizes")  # one row per slice
        used = present.join(sizes, keys)
    else:
        capped = slice_order_cap(present, p)
        sizes = materialize(capped.select(*keys, "n_orders").distinct(), "slice_sizes")
        used = present.join(capped, [*keys, "order_id"])
    tops = materialize(frequent_items(slice_item_counts(used, p), p), "slice_items")
    # The written size of ``tops`` is known to Spark, which broadcasts it below its threshold.
    ranked = used.drop("n_orders").join(tops.select(*keys, "item", "rank"), [*keys, "item"])
    return SliceBaskets(sizes, tops, materialize(rank_baskets(ranked, keys), "slice_baskets"))


def frequent_itemsets(start: SliceBaskets, p: MiningParams) -> DataFrame:
    """(slice, itemset of ranks, cnt, n_orders) with cnt / n_orders >= min_support.

    Level by level; a level's candidates are joins of frequent sets one item smaller that share
    their prefix, and a basket is only extended along candidates. Ends with the first empty level
    or at ``max_len``.
    """
    keys = list(p.slice_cols)
    sizes = start.items.select(*keys, "n_orders").distinct()
    enough = F.col("cnt") / F.col("n_orders") >= p.min_support
    cols = [*keys, "itemset", "cnt", "n_orders"]
    level = start.items.select(*keys, F.array("rank").alias("itemset"), "cnt", "n_orders")
    found = level.select(cols)
    if p.max_len == 1:
        return found
    level = materialize(
        pair_counts(start.baskets, keys).join(sizes, keys).filter(enough).select(cols), "level_2"
    )
    found = found.unionByName(level)
    held = None  # baskets with the frequent sets of the previous level they contain
    size = 2
    while (p.max_len is None or size < p.max_len) and not level.isEmpty():
        size += 1
        prefix = F.slice("itemset", 1, size - 2)
        last = F.element_at("itemset", -1)
        small = level.select(*keys, prefix.alias("prefix"), last.alias("x"))
        candidates = (
            small.join(small.withColumnRenamed("x", "y"), [*keys, "prefix"])
            .filter("x < y")
            .select(*keys, F.concat("prefix", F.array("x")).alias("itemset"), "y")
        )
        if held is None:
            pairs = level.select(*keys, F.col("itemset")[0].alias("x"), F.col("itemset")[1].alias("y"))
            held = (
                start.baskets.filter(F.size("items") >= 3)
                .select(*keys, "items", "weight", F.explode("items").alias("x"))
                .join(pairs, [*keys, "x"])
                .filter(F.array_contains("items", F.col("y")))
                .select(*keys, "items", "weight", F.array("x", "y").alias("itemset"))
            )
        extended = (
            held.join(candidates, [*keys, "itemset"])
            .filter(F.array_contains("items", F.col("y")))
            .select(*keys, "items", "weight", F.concat("itemset", F.array("y")).alias("itemset"))
        )
        counts = extended.groupBy(*keys, "itemset").agg(F.sum("weight").alias("cnt"))
        level = materialize(counts.join(sizes, keys).filter(enough).select(cols), f"level_{size}")
        found = found.unionByName(level)
        held = extended.join(level.select(*keys, "itemset"), [*keys, "itemset"], "left_semi")
        if p.max_len is None or size + 1 < p.max_len:
            held = materialize(held, f"held_{size}")
    return found


def item_names(start: SliceBaskets, p: MiningParams) -> DataFrame:
    """(slice, names): rank -> item name; the support bounds the frequent items of a slice."""
    return start.items.groupBy(*p.slice_cols).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "item"))).alias("names")
    )


def named(ranks, names="names"):
    return F.array_sort(F.transform(ranks, lambda r: F.col(names)[r]))


def context_itemsets(enriched: DataFrame, p: MiningParams, item: str = "product_name") -> DataFrame:
    """(slice, items array, itemset text, n_items, cnt, support)."""
    start = slice_baskets(enriched, p, item)
    sets = frequent_itemsets(start, p).join(item_names(start, p), list(p.slice_cols))
    return sets.select(
        *p.slice_cols,
        named("itemset").alias("items"),
        F.array_join(named("itemset"), ", ").alias("itemset"),
        F.size("itemset").alias("n_items"),
        "cnt",
        (F.col("cnt") / F.col("n_orders")).alias("support"),
    )
