"""Nearest neighbours by inner product through collision counting.

Blocks of bounded size hold vectors of nearly equal norm. There vectors get one more component that
makes all norms equal, so the largest inner product is the shortest distance; each vector is projected
on each of a set of directions and each projection kept as a sorted array. A query opens a window around its own
projection in every array; a vector collides where it falls inside. Windows grow round by round
(virtual rehashing) and only what they newly cover is counted; vectors that collide in more arrays
than a threshold are verified by their true inner product, until enough of the block has been.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, numbered, record_batch
from stockweave.session import materialize

by_value(__name__)


@dataclass(frozen=True)
class SearchParams:
    """``projections`` directions, orthogonal in sets of the dimension. The first window reaches
    ``width`` standard deviations of a projection to each side, later ones ``growth`` times as far.
    Vectors inside at least ``threshold`` of the windows are verified; a query is done with a block
    once ``k`` and ``verified`` of the block's vectors are. All of it is relative, so the share of
    work and the recall are alike at every size. The norms of a block lie within a ratio of
    ``norm_ratio``: longer vectors would make its windows too wide to tell the others apart."""

    k: int = 20
    projections: int = 64
    width: float = 1.75
    growth: float = 1.12
    threshold: float = 0.85
    verified: float = 0.1
    norm_ratio: float = 1.05
    block_rows: int = 4096
    query_rows: int = 1024
    seed: int = 7


def valid(column: str) -> Column:
    """Vectors that take part: not null or empty, all components finite, not all zero."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def directions(dim: int, params: SearchParams):
    """Unit directions, orthogonal in sets of ``dim``."""
    import numpy as np

    random = np.random.default_rng(params.seed)
    sets = [np.linalg.qr(random.standard_normal((dim, dim)))[0] for _ in range(-(-params.projections // dim))]
    return np.concatenate(sets, axis=1)[:, : params.projections]


class Block:
    """Sorted projection arrays of one block of vectors."""

    def __init__(self, vectors, rows, ids, params: SearchParams):
        import numpy as np

        self.vectors, self.rows, self.ids, self.params = vectors, rows, ids, params
        n, dim = vectors.shape
        squares = (vectors * vectors).sum(1)
        reach = np.sqrt(squares.max()) * (1 + 1e-9)
        lift = np.sqrt(np.maximum(0.0, reach * reach - squares))
        self.axes = directions(dim + 1, params)
        projected = np.concatenate([vectors, lift[:, None]], axis=1) @ self.axes
        order = np.argsort(projected, axis=0, kind="stable")
        self.values = np.ascontiguousarray(np.take_along_axis(projected, order, 0).T)
        # The place of every vector in every sorted array; a block has at most 65,535 rows.
        self.places = np.empty((order.shape[1], n), np.uint16)
        np.put_along_axis(self.places, order.T, np.arange(n, dtype=np.uint16)[None, :], 1)
        self.reach, self.sigma = reach, reach / np.sqrt(dim + 1)

    def search(self, queries, own):
        """For every query (its own row number left out): members of its ``k`` best and their scores."""
        import numpy as np

        p, n, m = self.params, len(self.rows), len(self.places)
        # A query's length does not change the order of its inner products.
        scaled = queries * (self.reach / np.sqrt((queries * queries).sum(1)))[:, None]
        centres = scaled @ self.axes[:-1]
        need = int(np.ceil(p.threshold * m))
        enough = min(n, p.k + 1 + int(p.verified * n))
        buffer = np.empty(self.vectors.shape)
        count = np.uint8 if m < 256 else np.uint16
        reached: list = []

        def windows(k):
            """First place and length of round k's windows in every array, for all queries."""
            if k == len(reached):
                half = p.width * p.growth**k * self.sigma
                first = np.stack([v.searchsorted(c - half) for v, c in zip(self.values, centres.T)], 1)
                last = np.stack([v.searchsorted(c + half, "right") for v, c in zip(self.values, centres.T)], 1)
                reached.append((first.astype(np.uint16)[:, :, None], (last - first).astype(np.uint16)[:, :, None]))
            return reached[k]

        for q, (query, row) in enumerate(zip(queries, own)):
            k, collided = 0, None
            while collided is None or np.count_nonzero(collided) < enough:
                first, length = (x[q] for x in windows(k))
                # Unsigned: places before the window wrap around to large numbers.
                inside = (self.places - first) < length
                collided = np.add.reduce(inside.view(np.uint8), axis=0, dtype=count) >= need
                k += 1
            chosen = np.flatnonzero(collided & (self.rows != row))
            # Into one buffer: fresh arrays of this size cost more than the arithmetic.
            picked = buffer[: len(chosen)]
            np.take(self.vectors, chosen, axis=0, out=picked, mode="clip")
            picked *= query
            scores = picked.sum(1)
            if len(chosen) > p.k:
                top = scores >= np.partition(scores, len(scores) - p.k)[len(scores) - p.k]
                chosen, scores = chosen[top], scores[top]
            best = np.lexsort((self.ids[chosen], -scores))[: p.k]
            yield chosen[best], scores[best]


def matrix_of(column, dim: int):
    import numpy as np

    return np.frombuffer(column, "<f8").reshape(-1, dim)


def gathered(rows: DataFrame, keys: list[str], spread: Column, prefix: str) -> DataFrame:
    """Rows (row, id, vector, dim) of equal ``keys`` and ``spread`` as one row of packed columns."""
    names = [*keys, f"{prefix}_part"]

    def pack(group):
        import numpy as np
        import pyarrow as pa

        first = [group.column(c)[0].as_py() for c in names]
        order = np.argsort(group.column("row").to_numpy(), kind="stable")
        ids = group.column("id").to_numpy(zero_copy_only=False)
        vectors = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        packed = {
            f"{prefix}_rows": group.column("row").to_numpy()[order].astype("<i8").tobytes(),
            f"{prefix}_ids": ids[order].astype("<i8").tobytes(),
            f"{prefix}_vectors": np.ascontiguousarray(
                vectors.reshape(len(order), -1)[order].astype("<f8")
            ).tobytes(),
        }
        columns = {c: ([v], "int64") for c, v in zip(names, first)}
        return pa.Table.from_batches([record_batch(**columns, **{k: ([v], "binary") for k, v in packed.items()})])

    schema = ", ".join([*(f"{c} long" for c in names), *(f"{prefix}_{c} binary" for c in ("rows", "ids", "vectors"))])
    return rows.withColumn(f"{prefix}_part", spread.cast("long")).groupBy(*names).applyInArrow(pack, schema)


def nearest(
    vectors: DataFrame, queries: Column, params: SearchParams = SearchParams(), vector: str = "embedding"
) -> DataFrame:
    """For every row of ``vectors`` (vec_id, ``vector``) where ``queries`` holds: its nearest others.

    Returns query_id, rank (from 1), vec_id, score: the ``k`` largest inner products found among all
    other rows of the same dimension, ties to the smaller vec_id. Vectors null, empty, all zero, or
    with null or non-finite components take no part, nor do rows with a null vec_id; a repeated row
    is a candidate of its own and, if a query, answered once per row. All rows are indexed; queries
    meet blocks of bounded size and nearly equal norms, and only each block's ``k`` best leave it.
    """
    base = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & valid("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    # Squares beyond the range of doubles, on either side, have a band of their own.
    band = (
        F.when(squares == 0, -(1 << 62)).when(squares == float("inf"), 1 << 62)
        .otherwise(F.round(F.log(squares) / (2 * math.log(params.norm_ratio))).cast("long"))
    )
    rows = numbered(
        base.withColumn("dim", F.size("vector").cast("long")).withColumn("band", band), "vectors", "row"
    )
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    parts, asked = max(1, -(-n // params.block_rows)), max(1, -(-asking // params.query_rows))
    spread = lambda k: F.pmod(F.xxhash64("row"), k)
    # One row per dimension and band of norms, whose number the range of doubles bounds.
    blocks = rows.groupBy("dim", "band").agg(F.ceil(F.count("*") / params.block_rows).alias("blocks"))
    banded = rows.join(F.broadcast(blocks), ["dim", "band"])
    index = materialize(gathered(banded, ["dim", "band"], spread(F.col("blocks")), "index"), "index")
    asks = materialize(
        gathered(rows.filter("asks"), ["dim"], spread(F.lit(asked)), "query"), "queries"
    )
    # The stated query set meets the blocks of its dimension, a group of queries at a time.
    pairs = asks.join(index, "dim").repartition(parts * asked, "band", "index_part", "query_part", "dim")

    def run(batches):
        import numpy as np

        for batch in batches:
            for pair in batch.to_pylist():
                dim = pair["dim"]
                block = Block(
                    matrix_of(pair["index_vectors"], dim), np.frombuffer(pair["index_rows"], "<i8"),
                    np.frombuffer(pair["index_ids"], "<i8"), params,
                )
                own, ids = (np.frombuffer(pair[c], "<i8") for c in ("query_rows", "query_ids"))
                found = list(block.search(matrix_of(pair["query_vectors"], dim), own))
                times = [len(f) for f, _ in found]
                if sum(times):
                    members = np.concatenate([f for f, _ in found])
                    yield record_batch(
                        query_row=(np.repeat(own, times), "int64"), query_id=(np.repeat(ids, times), "int64"),
                        row=(block.rows[members], "int64"), vec_id=(block.ids[members], "int64"),
                        score=(np.concatenate([s for _, s in found]), "float64"),
                    )

    found = pairs.mapInArrow(run, "query_row long, query_id long, row long, vec_id long, score double")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= params.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact_nearest(vectors: DataFrame, queries: Column, k: int, vector: str = "embedding") -> DataFrame:
    """The same by comparing everything, block by block: the measure of recall, for tests."""
    return nearest(vectors, queries, SearchParams(k=k, verified=1.0, threshold=0.0), vector)
