"""Order-dependent work that must not put a whole group, or all rows, into one task.

A plain window over a hot key sorts that key's rows in a single task. These operators cut the
key's order into value-based blocks, aggregate per block (partial aggregation before the
shuffle), run the window over the few blocks, and look at single rows only inside a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.scalars import mixed_hash
from stockweave.session import materialize


def running_sum(
    df: DataFrame, keys: Sequence[str], position: str, value: Column, out: str, block: int = 4096
) -> DataFrame:
    """Running sum of ``value`` per key in order of the integer column ``position``.

    Two levels: block totals and their prefix, then the rows inside one block. A key that holds
    a third of all rows is spread over as many tasks as it has blocks.
    """
    keys = list(keys)
    rows = df.withColumn("_v", value).withColumn(
        "_block", F.floor(F.col(position) / F.lit(block)).cast("long")
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_block")
        .agg(F.sum("_v").alias("_t"))
        .select(*keys, "_block", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.join(offsets, [*keys, "_block"])
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
        .drop("_v", "_block", "_offset")
    )


def daily_positions(
    df: DataFrame, keys: Sequence[str], day: str, tie: Sequence[str], block: str | None = None
) -> DataFrame:
    """Add ``position`` (1-based, by day then ``tie``) and ``prior_day`` per key.

    ``prior_day`` is the day of the preceding row, null for the first. The outer window runs
    over distinct days, which the calendar bounds; ranks are taken inside one day, or with
    ``block``, the first column of ``tie``, inside one of its values: a hot day is not one task.
    """
    keys = list(keys)
    cells = [*keys, day, *([block] if block else [])]
    by_day = Window.partitionBy(*keys).orderBy(day)
    counts = df.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n"))
    days = (
        counts.groupBy(*keys, day)
        .agg(F.sum("_n").alias("_n"))
        .select(
            *keys,
            day,
            F.coalesce(
                F.sum("_n").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.lag(day).over(by_day).alias("_last_day"),
        )
    )
    if block:
        in_day = Window.partitionBy(*keys, day).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
        inner = counts.withColumn("_inner", F.coalesce(F.sum("_n").over(in_day), F.lit(0))).drop("_n")
        days = inner.join(days, [*keys, day]).withColumn("_before", F.col("_before") + F.col("_inner"))
        days = days.withColumn("_first", F.col("_inner") == 0).drop("_inner")
    else:
        days = days.withColumn("_first", F.lit(True))
    rank = F.row_number().over(Window.partitionBy(*cells).orderBy(*tie))
    return (
        df.withColumn("_rank", rank)
        .join(days, cells)
        .withColumn("position", F.col("_before") + F.col("_rank"))
        .withColumn(
            "prior_day", F.when((F.col("_rank") == 1) & F.col("_first"), F.col("_last_day")).otherwise(F.col(day))
        )
        .drop("_rank", "_before", "_last_day", "_first")
    )


def capped_by_hash(
    df: DataFrame, group: Sequence[str], key: str, cap: int, salt: int = 42, blocks: int = 4096
) -> DataFrame:
    """Keep ``cap`` rows per group, the ones with the smallest (hash(key), key).

    A reproducible sample that does not depend on partitioning. ``key`` must be unique within a
    group. Groups are not sorted whole: a histogram of the hash finds the block that holds the
    cap-th row, earlier blocks are kept as they are, and only that block is ranked. Adds
    ``group_size``.
    """
    group = list(group)
    width = 2_147_483_647 // blocks + 1
    rows = df.withColumn("_h", mixed_hash(F.col(key), salt)).withColumn(
        "_block", F.floor(F.col("_h") / F.lit(width)).cast("int")
    )
    upto = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    fill = (
        rows.groupBy(*group, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_cum", F.sum("_n").over(upto))
        .withColumn("group_size", F.sum("_n").over(Window.partitionBy(*group)))
        .withColumn("_room", F.lit(cap) - (F.col("_cum") - F.col("_n")))
        .filter("_room > 0")
        .select(*group, "_block", "group_size", "_room", (F.col("_n") > F.col("_room")).alias("_cut"))
    )
    kept = rows.join(fill, [*group, "_block"])
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_h", key))
    whole = kept.filter(~F.col("_cut"))
    cut = kept.filter("_cut").withColumn("_r", rank).filter("_r <= _room").drop("_r")
    return whole.unionByName(cut).drop("_h", "_block", "_room", "_cut")


def ranked(rows: DataFrame, keys: Sequence[str], out: str, after: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based place in the order of ``keys``; with ``after``, a prefix of the keys, the place
    among rows that are equal in it.

    Range partitions, as many as the rows fill, are sorted and numbered inside; the offsets are sums
    over one row per partition (and per value of ``after`` that begins in it).
    """
    written = materialize(
        rows.repartitionByRange(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .withColumn("_number", F.monotonically_increasing_id()),
        "ordered",
    )
    # A partition's numbers start at its index times 2^33.
    part, inner = F.shiftright("_number", 33), F.col("_number").bitwiseAND((1 << 33) - 1)
    placed = written.withColumn("_part", part).withColumn("_inner", inner)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    whole = placed.join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + F.col("_inner"))
    if after:
        first = whole.groupBy(*after).agg(F.min(out).alias("_first"))
        whole = whole.join(first, list(after)).withColumn(out, F.col(out) - F.col("_first")).drop("_first")
    return whole.drop("_number", "_part", "_inner", "_start")


def value_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the distinct values of several string columns, null included, with
    their 0-based place in sorted order. One scan of ``df`` and one sort for all columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    values = df.select(F.inline(cells)).distinct()
    placed = ranked(values, ["column", "value"], "code", ["column"])
    return placed.select("column", "value", F.col("code").cast("int").alias("code"))


def ordered_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values of ``column`` with their 0-based position in sorted order."""
    return value_codes(df, [column]).select(F.col("value").alias(column), F.col("code").alias(code))
