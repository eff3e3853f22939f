"""SimHash near-duplicates by exact comparison, tile by tile.

Distinct fingerprints are ordered by the bit counts of their quarters and cut into tiles. Two
fingerprints differ in at least as many bits as the bit counts of their quarters differ in sum, so
tile pairs whose count ranges lie further apart than the radius are never made. Inside a pair, numpy
compares blocks the same way: count ranges first, then exclusive-or and bit counts. A task returns a
spanning forest of the links it saw, never all pairs of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, free_name, map_batches, numbered, record_batch, utf8
from stockweave.llm.components import connected_components, local_roots
from stockweave.session import materialize

by_value(__name__)


@dataclass(frozen=True)
class SimHashParams:
    """``tiles``: into so many tiles the fingerprints are cut, more where a tile would have over
    ``tile_rows``; ``block`` fingerprints are compared at once in a task."""

    shingle: int = 4
    radius: int = 4
    tiles: int = 64
    tile_rows: int = 1 << 18
    block: int = 512


LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
QUARTERS = 4
HASHES_AT_ONCE = 1 << 16


def fingerprint(data: bytes | None, shingle: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included; 0 without words."""
    from itertools import accumulate

    import numpy as np
    import xxhash

    # bytes.split() parts at exactly U+0009 to U+000D and the space.
    words = data.translate(LOWER).split() if data else []
    if not words:
        return 0
    k = min(shingle, len(words))
    text = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - k]]
    ends = ends[k - 1 :]
    total = len(starts)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE])
        hashes = np.array([digest(text[s : e - 1], 42) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(rows: DataFrame, params: SimHashParams, *keep: str) -> DataFrame:
    """``keep`` columns and the fingerprint (as a signed long) of every row's text."""
    kept = rows.select(*[F.col(f"`{c}`") for c in keep], utf8("text").alias("print"))

    def run(batch):
        import pyarrow as pa

        made = [fingerprint(d, params.shingle) for d in batch.column(len(keep)).to_pylist()]
        return batch.set_column(len(keep), "print", pa.array(made, pa.int64()))

    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])
    return map_batches(kept, run, f"{schema}, print long")


def quarter_counts(values):
    """Bit counts of the four quarters, one row per fingerprint."""
    import numpy as np

    return np.bitwise_count(values.view("<u2").reshape(-1, QUARTERS)).astype(np.int16)


def ranges(counts, edges):
    """Least and largest counts, the total included, of every block of ordered rows."""
    import numpy as np

    full = np.concatenate([counts, counts.sum(1, keepdims=True)], 1)
    return np.minimum.reduceat(full, edges, axis=0), np.maximum.reduceat(full, edges, axis=0)


def gap(low_a, high_a, low_b, high_b):
    """Least number of bits in which members of two blocks differ, by their count ranges."""
    import numpy as np

    apart = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return np.maximum(apart[..., :QUARTERS].sum(-1), apart[..., QUARTERS])


def make_tiles(prints: DataFrame, params: SimHashParams) -> DataFrame:
    """Tiles (tile, body, low, high) of distinct fingerprints (print), nearly ordered by counts."""
    n = prints.count()
    size = max(params.block, min(params.tile_rows, -(-n // params.tiles)))
    mask = [f"bit_count(shiftrightunsigned(print, {16 * q}) & 65535)" for q in range(QUARTERS)]
    keys = [F.expr("bit_count(print)"), *map(F.expr, mask), F.col("print")]
    ordered = prints.repartitionByRange(-(-n // size) or 1, *keys).sortWithinPartitions(*keys)

    def cut(batches):
        import numpy as np
        from pyspark import TaskContext

        held, count, number = [], 0, TaskContext.get().partitionId() << 32

        def flush():
            values = np.concatenate(held)
            low, high = ranges(quarter_counts(values), [0])
            return record_batch(
                tile=([number], "int64"), body=([values.tobytes()], "binary"),
                low=([low[0].tolist()], None), high=([high[0].tolist()], None),
            )

        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
            while len(values):
                part = values[: size - count]
                values = values[len(part) :]
                held.append(part)
                count += len(part)
                if count == size:
                    yield flush()
                    held, count, number = [], 0, number + 1
        if held:
            yield flush()

    return materialize(
        ordered.select("print").mapInArrow(cut, "tile long, body binary, low array<long>, high array<long>"), "tiles"
    )


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b), a <= b, of tiles whose count ranges come within the radius."""
    span = tiles.select(
        "tile", "low", "high", F.explode(F.sequence(F.col("low")[QUARTERS], F.col("high")[QUARTERS])).alias("total")
    )
    reach = tiles.select(
        "tile", "low", "high",
        F.explode(F.sequence(F.col("low")[QUARTERS] - radius, F.col("high")[QUARTERS] + radius)).alias("total"),
    )
    apart = [
        F.greatest(F.lit(0), F.col("x.low")[q] - F.col("y.high")[q], F.col("y.low")[q] - F.col("x.high")[q])
        for q in range(QUARTERS)
    ]
    return (
        span.alias("x")
        .join(reach.alias("y"), "total")
        .filter((F.col("x.tile") <= F.col("y.tile")) & (sum(apart, F.lit(0)) <= radius))
        .select(F.col("x.tile").alias("a"), F.col("y.tile").alias("b"))
        .distinct()
    )


def linked(first: bytes, second: bytes | None, radius: int, block: int):
    """Spanning forest (point, root) of the links between two tiles, or within one."""
    import numpy as np

    def parts(raw):
        values = np.frombuffer(raw, "<u8")
        edges = np.arange(0, len(values), block)
        return values, edges, *ranges(quarter_counts(values), edges)

    one, edges, low, high = parts(first)
    two, edges2, low2, high2 = parts(second) if second is not None else (one, edges, low, high)
    offset = len(one) if second is not None else 0
    points = np.concatenate([one, two]) if second is not None else one
    roots, left, right, waiting = None, [], [], 0
    for i, start in enumerate(edges):
        near = np.flatnonzero(gap(low[i], high[i], low2, high2) <= radius)
        x = one[start : start + block, None]
        for j in near if second is not None else near[near >= i]:
            y = two[edges2[j] : edges2[j] + block]
            a, b = np.nonzero(np.bitwise_count(x ^ y) <= radius)
            if second is None and j == i:
                a, b = a[a < b], b[a < b]
            if len(a):
                left.append(a + start)
                right.append(b + edges2[j] + offset)
                waiting += len(a)
            if waiting > 1 << 18:
                roots = local_roots(len(points), np.concatenate(left), np.concatenate(right), roots)
                left, right, waiting = [], [], 0
    if left:
        roots = local_roots(len(points), np.concatenate(left), np.concatenate(right), roots)
    if roots is None:
        return points[:0], points[:0]
    moved = np.flatnonzero(roots != np.arange(len(points)))
    return points[moved], points[roots[moved]]


def links(prints: DataFrame, params: SimHashParams) -> DataFrame:
    """Links (a, b) that connect just what links of at most ``radius`` bits connect."""
    tiles = make_tiles(prints, params)
    bodies = tiles.select("tile", "body")
    # A stated number of tasks: a pair is few bytes and much work, so sizes would merge too many.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (
        tile_pairs(tiles, params.radius)
        .join(bodies.select(F.col("tile").alias("a"), F.col("body").alias("first")), "a")
        .join(bodies.select(F.col("tile").alias("b"), F.col("body").alias("second")), "b")
        .select("a", "b", "first", "second")
        .repartition(tasks, "a", "b")
    )

    def compare(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(0)[k].as_py() == batch.column(1)[k].as_py()
                first, second = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
                a, b = linked(first, None if same else second, params.radius, params.block)
                if len(a):
                    yield record_batch(a=(a.view("<i8"), "int64"), b=(b.view("<i8"), "int64"))

    return pairs.mapInArrow(compare, "a long, b long")


def classes(prints: DataFrame, params: SimHashParams) -> DataFrame:
    """(print, component) of every distinct fingerprint; component is one fingerprint of it."""
    distinct = materialize(prints.select("print").distinct(), "distinct_prints")
    found = connected_components(links(distinct, params))
    return distinct.join(found.withColumnRenamed("node", "print"), "print", "left").select(
        "print", F.coalesce("root", "print").alias("component")
    )


def near_duplicates(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """Fingerprint and near-duplicate component of every document.

    One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id
    of the component; null only if all its ids are null). Null and empty texts, and texts of white
    space, have fingerprint 0, which links like any other. Repeated rows stay, with equal results.
    """
    prints = materialize(fingerprints(docs, params, "doc_id"), "prints")
    component = classes(prints, params)
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    known = materialize(least.join(component, "print"), "print_components")
    ids = known.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = known.join(ids, "component").select("print", "component_id")
    return prints.join(by_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """``docs`` with one row of every component: the smallest doc_id, null ids last; columns stay."""
    row = free_name(docs, "row_number")
    rows = numbered(docs, "numbered_docs", row)
    prints = materialize(
        fingerprints(rows, params, "doc_id", row).withColumnRenamed(row, "row"), "prints"
    )
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    best = prints.groupBy("print").agg(F.min(order).alias("best")).join(classes(prints, params), "print")
    kept = best.groupBy("component").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
