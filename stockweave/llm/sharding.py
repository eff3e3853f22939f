"""Sharding along a Hilbert curve through the metadata.

Each metadata dimension is quantised at its own quantiles; the cell of a row is a point whose index
on the Hilbert curve orders the rows, and shards are runs of that order. Rows that are close in
several dimensions share shards, so minima and maxima per file prune on each of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, free_name, map_batches, numbered
from stockweave.session import materialize

by_value(__name__)


@dataclass(frozen=True)
class ShardParams:
    """``bits`` per dimension; ``accuracy`` of the quantiles; ``dimensions`` are columns."""

    shards: int = 40
    dimensions: tuple[str, ...] = ("source", "lang", "size")
    bits: int = 5
    accuracy: int = 10_000


def ordinal(column: str, kind: str) -> Column:
    """Any value as a number in the same order: strings by their first seven bytes, nulls first."""
    c = F.col(f"`{column}`")
    if kind == "string":
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0")
        number = F.conv(head, 16, 10).cast("double")
    elif kind in ("date", "timestamp"):
        number = F.unix_micros(c.cast("timestamp")).cast("double")
    else:
        number = c.cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(float("-inf")))


def hilbert_index(cells, bits: int):
    """Index on the Hilbert curve of every row of ``cells`` (n x dimensions, ints of ``bits`` bits).

    The axes are turned into the curve's transposed index by undoing excess work from the highest bit
    down, then Gray-encoding; interleaving the bits gives the index.
    """
    import numpy as np

    x = cells.astype(np.int64).T.copy()
    d = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def with_curve(rows: DataFrame, params: ShardParams, name: str) -> DataFrame:
    """``rows`` with their curve index as column ``name``."""
    kinds = dict(rows.dtypes)
    numbers = [ordinal(c, kinds[c]) for c in params.dimensions]
    steps = [i / (1 << params.bits) for i in range(1, 1 << params.bits)]
    # One row of at most dimensions x 2^bits cut points.
    cuts = rows.agg(*[F.percentile_approx(x, steps, params.accuracy).alias(f"c{i}") for i, x in enumerate(numbers)]).first()
    cells = [
        sum([(x > cut).cast("int") for cut in dict.fromkeys(cuts[i] or [])], F.lit(0)) for i, x in enumerate(numbers)
    ]
    columns = rows.columns
    placed = rows.select(*[F.col(f"`{c}`") for c in columns], F.array(*cells).alias(name))

    def run(batch):
        import pyarrow as pa

        at = batch.schema.get_field_index(name)
        flat = batch.column(at).flatten().to_numpy(zero_copy_only=False)
        index = hilbert_index(flat.reshape(batch.num_rows, -1), params.bits)
        return batch.set_column(at, name, pa.array(index, pa.int64()))

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"`{name}` long"])
    return map_batches(placed, run, schema)


def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in the order of ``keys``, which must tell all rows apart.

    Range partitions are numbered inside, and the counts of the partitions, one row each, summed.
    """
    inner = free_name(rows, "inner_number")
    ordered = rows.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    placed = materialize(ordered.withColumn(inner, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(inner, 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One entry per partition of the range exchange.
    starts, total = {}, 0
    for row in counts.orderBy("part").collect():
        starts[row.part], total = total, total + row.n
    if not starts:
        return placed.withColumn(name, F.lit(0).cast("long")).drop(inner)
    lookup = F.create_map(*[F.lit(v).cast("long") for pair in starts.items() for v in pair])
    return placed.withColumn(name, lookup[part] + F.col(inner).bitwiseAND((1 << 33) - 1)).drop(inner)


def assign_shards(docs: DataFrame, params: ShardParams = ShardParams()) -> DataFrame:
    """Shard and slot of every document, shard sizes in rows at most one apart (law ``rows``).

    Returns doc_id, size (UTF-8 bytes of the text, none for null, plus 16), text_crc32 (null counts
    as empty), law, shard, slot (gapless from 0 in curve order), grown_shard (null: the law has
    none) and curve. Ties on the curve go by text hash, doc_id and a row number, so equal documents
    lie side by side and a hot value or repeated rows spread over as many shards as they fill. Nulls
    are the smallest value of a dimension. With fewer rows than shards, some shards stay empty.
    """
    raw = utf8_or_empty("text")
    rest = [c for c in params.dimensions if c != "size"]
    base = docs.select(
        "doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"), *[F.col(f"`{c}`") for c in rest],
    )
    rows = numbered(base, "sizes", "row")
    n = rows.count()
    curved = with_curve(rows, params, "curve").drop(*rest)
    placed = ranked(curved, ["curve", "text_hash", "doc_id", "row"], "place")
    shard = F.expr(f"cast(place * {params.shards} div {max(n, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {max(n, 1)} + {params.shards - 1}) div {params.shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def utf8_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def write_shards(docs: DataFrame, path: str, params: ShardParams = ShardParams(), max_rows: int = 1_000_000) -> None:
    """All columns of ``docs``, cut along the curve into files below ``path``/shard=..., in curve order.

    A shard of more than ``max_rows`` rows is written by several tasks, each a run of the curve.
    """
    number, shard, place = (free_name(docs, c) for c in ("shard_row", "shard", "place"))
    sized = docs if "size" in docs.columns else docs.withColumn("size", F.octet_length(utf8_or_empty("text")) + 16)
    rows = numbered(sized, "shard_rows", number)
    curve = free_name(rows, "curve")
    keys = with_curve(rows.select(number, *params.dimensions), params, curve).select(number, curve)
    n = max(rows.count(), 1)
    places = ranked(keys, [curve, number], place).select(
        number, place, F.expr(f"cast(`{place}` * {params.shards} div {n} as int)").alias(shard)
    )
    tasks = params.shards * max(1, -(-n // (params.shards * max_rows)))
    joined = rows.join(places, number).repartitionByRange(tasks, place).sortWithinPartitions(place)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined.select(*columns, F.col(shard)).write.partitionBy(shard).option("maxRecordsPerFile", max_rows).parquet(path)
