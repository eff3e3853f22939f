"""Exact quantiles without holding a column's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import materialize


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value double) without nulls and NaN."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(*keep, F.inline(cells))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Rows (feature, probability, value): exact quantiles, linear interpolation.

    Equal values are counted together before the shuffle; the counts are range-partitioned by value,
    in as many partitions as they fill, and written. One sum per partition and feature tells in which
    partitions the wanted ranks lie, and only the values of those are ranked, one partition a task.
    """
    counts = long_values(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"))
    written = materialize(
        counts.repartitionByRange("feature", "value").withColumn("_part", F.spark_partition_id()), "value_counts"
    )
    by_part = Window.partitionBy("feature").orderBy("_part")
    upto = by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        written.groupBy("feature", "_part")
        .agg(F.sum("_n").alias("_own"))
        .withColumn("_end", F.sum("_own").over(upto))
        .withColumn("_total", F.sum("_own").over(Window.partitionBy("feature")))
        .select("feature", "_part", "_end", (F.col("_end") - F.col("_own")).alias("_before"), "_total",
                F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"))
        .withColumn("_rank", (F.col("_total") - 1) * F.col("probability"))
    )
    low, high = F.floor("_rank"), F.ceil("_rank")
    holds = [(F.col("_before") <= r) & (r < F.col("_end")) for r in (low, high)]
    # At most two partitions per feature and probability.
    wanted = placed.filter(holds[0] | holds[1]).select("feature", "_part", "_before", "probability", "_rank")
    inside = (
        Window.partitionBy("feature", "probability", "_part")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        written.join(F.broadcast(wanted), ["feature", "_part"])
        .withColumn("_stop", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_stop") - F.col("_n"))
    )

    def at(position):
        return F.max(F.when((F.col("_start") <= position) & (position < F.col("_stop")), F.col("value")))

    return (
        ranked.groupBy("feature", "probability", "_rank")
        .agg(at(low).alias("_a"), at(high).alias("_b"))
        .select(
            "feature", "probability",
            (F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_rank") - low)).alias("value"),
        )
    )


def quantile_map(quantiles: DataFrame, probability: float):
    """feature -> value of one probability, as a scalar map (bounded by the column count)."""
    return (
        quantiles.filter(F.col("probability") == F.lit(float(probability)))
        .agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("m"))
        .scalar()
    )
