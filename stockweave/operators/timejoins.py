"""Joins of two large tables by time: the nearest row before or after, and points in windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import materialize


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, out: str, forward: bool = True
) -> DataFrame:
    """``left`` with ``out``: the row of ``right`` (a struct) of the same keys that is next in time.

    ``forward``: the first at or after the left row, else the last at or before it; null where there
    is none, where a key is null, or the left time is. Of several right rows at one time the smallest
    (forward) or largest (backward) struct counts.

    Both sides are put in one order of (keys, time), cut into range partitions, so a key that holds a
    third of the rows spreads over as many tasks as it fills. Inside a partition a window carries the
    right rows along; over the borders goes one right row per partition and key.
    """
    keys = list(keys)
    mine = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    theirs = F.struct(*[F.col(f"`{c}`") for c in right.columns])
    lefts = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), mine.alias("_l"))
    known = [F.col(c).isNotNull() for c in (*keys, right_time)]
    rights = (
        right.filter(_all(known))
        .select(*keys, F.col(right_time).alias("_t"), theirs.alias("_r"))
        .groupBy(*keys, "_t")  # of one time only one row can be met; hot times shrink here
        .agg((F.min("_r") if forward else F.max("_r")).alias("_r"))
        .withColumn("_side", F.lit(0))
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)
    # Rows that carry come first in the way of the walk: at equal times they are met.
    rank = F.col("_side") if not forward else -F.col("_side")
    placed = materialize(
        both.withColumn("_rank", rank)
        .repartitionByRange(*[F.col(k) for k in keys], F.col("_t"), F.col("_rank"), F.xxhash64("_l"))
        .withColumn("_part", F.spark_partition_id()),
        "asof_rows",
    )
    when = F.when(F.col("_side") == 0, F.col("_t"))
    if forward:
        walk = [F.col("_t").desc_nulls_first(), F.col("_rank").desc()]
        parts, nearest = F.col("_part").desc(), F.min_by("_r", when)
    else:
        walk = [F.col("_t").asc_nulls_first(), F.col("_rank").asc()]
        parts, nearest = F.col("_part").asc(), F.max_by("_r", when)
    inside = Window.partitionBy("_part", *keys).orderBy(*walk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(parts).rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        placed.groupBy(*keys, "_part")
        .agg(nearest.alias("_own"))
        .withColumn("_carried", F.last("_own", ignorenulls=True).over(before))
        .filter("_carried IS NOT NULL")
        .select(*keys, "_part", "_carried")
    )
    met = placed.withColumn("_r", F.last("_r", ignorenulls=True).over(inside)).filter("_side = 1")
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_r", "_carried"))
    return met.join(borders, [*keys, "_part"], "left").select("_l.*", found.alias(out))


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def interval_join(
    points: DataFrame, windows: DataFrame, keys: Sequence[str], point: str, start: str, end: str
) -> DataFrame:
    """Every point with every window of the same keys that holds it, both ends included.

    Time columns are whole numbers or timestamps. A window goes to the bins of the smallest width that
    is not shorter than itself, so it lies in two bins at most, however long it is; widths are powers
    of two times a tenth of the windows' lengths. A point goes to one bin per width that occurs. Since
    a window has one width and a point one bin of it, a pair meets once. Pairs are rechecked; windows
    that end before they begin, and nulls, meet nothing. Columns of both sides must have different
    names but for the keys.
    """
    keys = list(keys)
    def ticks(column: str, df: DataFrame) -> Column:
        kind = dict(df.dtypes)[column]
        return F.unix_micros(F.col(column).cast("timestamp")) if kind in ("timestamp", "date", "timestamp_ntz") else F.col(column).cast("long")

    length = ticks(end, windows) - ticks(start, windows)
    # Number of doublings of the base width until a window fits.
    base = windows.filter(length >= 0).agg(F.greatest(F.percentile_approx(length, 0.1), F.lit(1))).first()[0] or 1
    level = F.when(length <= base, 0).otherwise(F.ceil(F.log2(length / F.lit(float(base)))).cast("int"))
    width = F.lit(base).cast("long") * F.expr("shiftleft(1L, _level)")

    def bin_of(t: Column) -> Column:
        return ((t - F.pmod(t, width)) / width).cast("long")

    first, last = (bin_of(ticks(c, windows)) for c in (start, end))
    binned = (
        windows.filter(length >= 0)
        .withColumn("_level", level)
        .withColumn("_bin", F.explode(F.sequence(first, last)))
    )
    levels = sorted(r[0] for r in binned.select("_level").distinct().collect())  # at most 63
    if not levels:
        levels = [0]
    placed = points.filter(F.col(point).isNotNull()).withColumn(
        "_level", F.explode(F.array(*[F.lit(i) for i in levels]))
    ).withColumn("_bin", bin_of(ticks(point, points)))
    inside = ticks(point, points).between(ticks(start, windows), ticks(end, windows))
    return placed.join(binned, [*keys, "_level", "_bin"]).filter(inside).drop("_level", "_bin")
