"""Profiling aggregates of the transaction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.quantiles import exact_quantiles
from stockweave.operators.baskets import pair_counts, presence, rank_baskets
from stockweave.session import materialize

HOURS = tuple(range(24))
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows (column, n_distinct). Exact counts deduplicate (column, value) before the shuffle,
    so no task holds all values of a column; ``approximate`` uses sketches in one pass."""
    if approximate:
        sketches = [F.approx_count_distinct(c).alias(c) for c in columns]
        return df.agg(*sketches).unpivot([], list(columns), "column", "n_distinct")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(cells)).filter("value IS NOT NULL").distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for columns that hold any null."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column", "nulls").filter("nulls > 0")


def orders_by(orders: DataFrame, column: str, names: Sequence[str] | None = None) -> DataFrame:
    """Order counts per value of ``column``, the busiest one flagged."""
    counts = orders.groupBy(column).agg(F.count("order_id").alias("orders"))
    peak = counts.agg(F.max_by(column, F.struct("orders", -F.col(column))).alias("p")).scalar()
    out = counts.withColumn("is_peak", (F.col(column) == peak).cast("int"))
    if names:
        out = out.withColumn("label", F.get(F.array(*[F.lit(n) for n in names]), F.col(column)))
    return out


def top_products(lines: DataFrame, n: int = 50) -> DataFrame:
    """Most frequent products; ties by name."""
    return value_counts(lines, "product_name").orderBy(F.desc("n"), "product_name").limit(n)


def basket_sizes(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.count("product_id").alias("basket_size"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, std, min, quartiles, max (exact, linear interpolation)."""
    df = materialize(df.select(column), "described")  # read by the sketch, the count and the moments
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75])
    at = {p: F.max(F.when(F.col("probability") == p, F.col("value"))) for p in (0.25, 0.5, 0.75)}
    q = quartiles.agg(F.struct(at[0.25].alias("q25"), at[0.5].alias("q50"), at[0.75].alias("q75")).alias("q")).scalar()
    x = F.col(column).cast("double")
    basics = df.agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    return basics.withColumn("_q", q).select(
        "n", "mean", "std", "min",
        F.col("_q.q25").alias("p25"), F.col("_q.q50").alias("p50"), F.col("_q.q75").alias("p75"),
        "max",
    )


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, count) for equal bins; the last bin is closed on the right, values outside drop out.

    Without a range the column's own minimum and maximum are used.
    """
    x = F.col(column).cast("double")
    if low is None or high is None:
        ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("r")).scalar()
        rows = df.select(x.alias("x"), ends.alias("r")).select("x", "r.lo", "r.hi")
    else:
        rows = df.select(x.alias("x"), F.lit(float(low)).alias("lo"), F.lit(float(high)).alias("hi"))
    inside = rows.filter("x BETWEEN lo AND hi")
    index = F.coalesce(
        F.try_divide((F.col("x") - F.col("lo")) * F.lit(bins), F.col("hi") - F.col("lo")), F.lit(0.0)
    )
    return inside.groupBy(
        (F.least(F.floor(index), F.lit(bins - 1)) + 1).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def gap_peaks(orders: DataFrame, gaps: Sequence[int] = (7, 30)) -> DataFrame:
    gap = F.col("days_since_prior_order")
    return orders.agg(*[F.count_if(gap == g).alias(f"gap_{g}") for g in gaps])


def dept_hour_heatmap(lines: DataFrame) -> DataFrame:
    """Department x hour line counts, 0-filled, each row divided by its largest value."""
    counts = lines.groupBy("department", "order_hour_of_day").agg(F.count(F.lit(1)).alias("n"))
    wide = counts.groupBy("department").pivot("order_hour_of_day", list(HOURS)).agg(F.sum("n")).na.fill(0)
    cols = [F.col(f"`{h}`") for h in HOURS]
    top = F.greatest(*cols)
    return wide.select("department", *[F.try_divide(c, top).alias(f"h{h:02d}") for h, c in zip(HOURS, cols)])


def user_reorder_rates(lines: DataFrame) -> DataFrame:
    return lines.groupBy("user_id").agg(F.avg("reordered").alias("reorder_rate"))


def copurchase_corr(lines: DataFrame, n: int = 30) -> DataFrame:
    """Pearson correlation of product presence over orders, top ``n`` products, a < b.

    On 0/1 data Pearson equals phi, which needs only counts; pairs come from distinct baskets of
    at most ``n`` products, each with the number of orders that share it.
    """
    top = materialize(top_products(lines, n).select(F.col("product_name").alias("item")), "top_products")
    present = presence(lines.select("order_id", F.col("product_name").alias("item"))).join(
        F.broadcast(top), "item", "left_semi"
    )
    baskets = materialize(rank_baskets(present.withColumnRenamed("item", "rank")), "top_baskets")
    singles = baskets.select(F.explode("items").alias("a"), "weight").groupBy("a").agg(F.sum("weight").alias("n_a"))
    pairs = pair_counts(baskets).select(F.col("itemset")[0].alias("a"), F.col("itemset")[1].alias("b"), F.col("cnt").alias("n_ab"))
    total = baskets.agg(F.sum("weight").alias("t")).scalar()
    # Every pair of top products, also those never bought together: at most n x n cells.
    everyone = singles.agg(
        F.collect_list(F.struct(F.col("a").alias("b"), F.col("n_a").alias("n_b"))).alias("x")
    ).scalar()
    others = F.filter("_all", lambda s: s["b"] > F.col("a"))
    grid = singles.withColumn("_all", everyone).select("a", "n_a", F.inline(others))
    cell = grid.join(pairs, ["a", "b"], "left").withColumn("n_ab", F.coalesce("n_ab", F.lit(0)))
    d = {c: F.col(c).cast("double") for c in ("n_a", "n_b", "n_ab")}
    t = total.cast("double")
    spread = d["n_a"] * (t - d["n_a"]) * d["n_b"] * (t - d["n_b"])
    return cell.select(
        F.col("a").alias("product_a"),
        F.col("b").alias("product_b"),
        "n_ab",
        F.try_divide(t * d["n_ab"] - d["n_a"] * d["n_b"], F.sqrt(spread)).alias("correlation"),
    )
