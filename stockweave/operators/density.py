"""Density outliers: rows with no dense row within ``eps``.

Only the noise flag of density clustering is wanted, so no cluster ids are built:
core = at least ``min_samples`` rows within ``eps``, itself included; noise = not core and no core
within ``eps``.

Exact, and a crowd is never compared with itself:

* equal rows collapse to one weighted point, however many there are;
* space is cut into leaves of bounded size. A point is first counted in its own leaf, nearest tiles
  first, and only until it has ``min_samples`` rows: most points are settled there as core;
* only a point that is still open travels, once to every other leaf whose box is within ``eps`` of it;
  the points of a leaf stay together;
* a point that is not core has fewer than ``min_samples`` neighbours, which are kept by number. So the
  cores that were found last reach it by a join of numbers, with no further distance.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.tiles import Leaves, cut_space, lists, matrix, reached
from stockweave.session import materialize

#: Rows that show where to cut, at least, and per leaf.
SAMPLE_ROWS, SAMPLE_PER_LEAF = 20_000, 256


def distinct_points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """id, x, w (rows), finite: the different points. One with a null, NaN or infinite coordinate has
    no distance to any other."""
    xs = [F.col(f).cast("double") for f in features]
    points = df.select(F.array(*xs).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("w"))
    unknown = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    return materialize(
        points.withColumn("finite", ~unknown).withColumn("id", F.monotonically_increasing_id()), "density_points"
    )


def point_leaves(points: DataFrame, n: int, dims: int, block_dims: int | None, leaf_rows: int) -> Leaves:
    """Leaves of about ``leaf_rows`` of the ``n`` points; a sample of them tells where to cut."""
    import numpy as np

    leaves = n / leaf_rows
    share = min(1.0, max(SAMPLE_ROWS, SAMPLE_PER_LEAF * leaves) / max(n, 1))
    picked = points.filter(F.pmod(F.xxhash64("x"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("x").toArrow()
    return cut_space(matrix(picked, "x") if len(picked) else np.zeros((0, dims)), leaves, block_dims)


def settle_at_home(points: DataFrame, leaves: Leaves, eps: float, min_samples: int, tile_rows: int) -> DataFrame:
    """leaf, id, x, w, core, hits, saved, near: what a point's own leaf tells.

    core: settled as such. Else ``hits`` rows were found within ``eps``, ``saved`` says whether one of
    them is core, and if not, ``near`` has the numbers of the other points.
    """

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if len(table):
                leaf = pa.array(leaves.place(matrix(table, "x")), pa.int32())
                yield from table.add_column(0, "leaf", leaf).to_batches()

    def settle(table):
        import numpy as np
        import pyarrow as pa

        x, w, ids = matrix(table, "x"), table.column("w").to_numpy(), table.column("id").to_numpy()
        need = np.where(w >= min_samples, 0, min_samples)
        hits, i, j = reached(x, x, w, need, eps, leaves.directions, tile_rows)
        core = hits >= need
        saved = np.zeros(len(x), dtype=bool)
        saved[i[core[j]]] = True
        kept = ~saved[i] & (i != j)
        out = {
            "core": pa.array(core), "hits": pa.array(hits), "saved": pa.array(saved),
            "near": lists(i[kept], ids[j[kept]], len(x)),
        }
        for name, column in out.items():
            table = table.append_column(name, column)
        return table

    point = "leaf int, id long, x array<double>, w long"
    return (
        points.select("id", "x", "w").mapInArrow(place, point).groupBy("leaf")
        .applyInArrow(settle, f"{point}, core boolean, hits long, saved boolean, near array<long>")
    )


def meet_elsewhere(
    home: DataFrame, leaves: Leaves, eps: float, min_samples: int, tile_rows: int, leaf_rows: int
) -> DataFrame:
    """id, found, reached, others: what all other leaves tell of the points still open, as at home.

    A leaf that many open points visit gets them in chunks, each with the leaf's points beside it.
    """

    def visits(batches):
        import pyarrow as pa

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if len(table):
                near = leaves.near(matrix(table, "x"), eps)
                near[table.column("leaf").to_numpy(), range(len(table))] = False
                yield table, near

    def count(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(len(leaves), dtype=np.int64)
        for _, near in visits(batches):
            total += near.sum(1)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], ["leaf", "n"])

    visitors = home.filter("NOT core").select("leaf", "x").mapInArrow(count, "leaf int, n long")
    chunks = {  # one row per leaf
        r["leaf"]: math.ceil(r["n"] / leaf_rows) for r in visitors.groupBy("leaf").agg(F.sum("n").alias("n")).collect()
    }

    def deal(batches):
        import numpy as np
        import pyarrow as pa

        def rows(table, leaf, chunk, side, w):
            n = len(table)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.broadcast_to(v, n), pa.int32()) for v in (leaf, chunk, side)]
                + [table.column(c).combine_chunks() for c in ("id", "x")]
                + [pa.array(w), table.column("core").combine_chunks()],
                ["leaf", "chunk", "side", "id", "x", "w", "core"],
            )

        for table, near in visits(batches):
            own, w = table.column("leaf").to_numpy(), table.column("w").to_numpy()
            for leaf in np.unique(own):
                some = np.flatnonzero(own == leaf)
                for chunk in range(chunks.get(int(leaf), 0)):
                    yield rows(table.take(some), leaf, chunk, 1, w[some])
            near[:, table.column("core").to_numpy()] = False
            ids, lacks = table.column("id").to_numpy(), min_samples - table.column("hits").to_numpy()
            for leaf in np.flatnonzero(near.any(1)):
                some = np.flatnonzero(near[leaf])
                yield rows(table.take(some), leaf, (ids[some] ^ (ids[some] >> 33)) % chunks[int(leaf)], 0, lacks[some])

    def meet(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        mine, theirs = (table.filter(pc.equal(table.column("side"), side)) for side in (0, 1))
        if not len(mine) or not len(theirs):
            return empty
        core, ids = theirs.column("core").to_numpy(), theirs.column("id").to_numpy()
        hits, i, j = reached(
            matrix(mine, "x"), matrix(theirs, "x"), theirs.column("w").to_numpy(), mine.column("w").to_numpy(),
            eps, leaves.directions, tile_rows,
        )
        saved = np.zeros(len(mine), dtype=bool)
        saved[i[core[j]]] = True
        kept = ~saved[i]
        some = np.flatnonzero(hits)
        return pa.table(
            {"id": mine.column("id"), "hits": pa.array(hits), "saved": pa.array(saved),
             "near": lists(i[kept], ids[j[kept]], len(mine))}
        ).take(some)

    import pyarrow as pa

    found = {"id": pa.int64(), "hits": pa.int64(), "saved": pa.bool_(), "near": pa.list_(pa.int64())}
    empty = pa.table({c: pa.array([], t) for c, t in found.items()})
    met = (
        home.select("leaf", "id", "x", "w", "core", "hits")
        .mapInArrow(deal, "leaf int, chunk int, side int, id long, x array<double>, w long, core boolean")
        .groupBy("leaf", "chunk")
        .applyInArrow(meet, "id long, hits long, saved boolean, near array<long>")
    )
    return met.groupBy("id").agg(  # under min_samples numbers from each leaf
        F.sum("hits").alias("found"), F.bool_or("saved").alias("reached"),
        F.flatten(F.collect_list("near")).alias("others"),
    )


def unknown_noise(points: DataFrame, side: float, min_samples: int) -> DataFrame:
    """The points with an unknown coordinate that do not share their cell, by null, with ``min_samples`` rows."""
    cells = points.withColumn("cell", F.transform("x", lambda v: F.floor(v / F.lit(side))))
    unknown = cells.filter("NOT finite")
    crowded = (
        cells.join(unknown.select("cell").distinct(), "cell", "left_semi")
        .groupBy("cell").agg(F.sum("w").alias("n")).filter(F.col("n") >= min_samples)
    )
    return unknown.join(crowded, "cell", "left_anti").select("x")


def density_noise(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    eps: float = 1.2,
    min_samples: int = 10,
    tile_rows: int = 1_000,
    block_dims: int | None = None,
    leaf_rows: int = 131_072,
) -> DataFrame:
    """(key, is_noise) for every row.

    ``leaf_rows`` points of a leaf, about, are in one task, which compares them ``tile_rows`` at a time;
    leaves are cut along ``block_dims`` directions at most, by default along any.
    """
    points = distinct_points(df, features)
    known = points.filter("finite")
    n, total = points.agg(F.count_if("finite"), F.count(F.lit(1))).first()
    leaves = point_leaves(known, n, len(features), block_dims, leaf_rows)
    home = materialize(settle_at_home(known, leaves, eps, min_samples, tile_rows), "density_home")
    left = home.filter("NOT core").select("id", "x", "hits", "saved", "near")
    if len(leaves) > 1:
        found = meet_elsewhere(home, leaves, eps, min_samples, tile_rows, leaf_rows)
        left = left.join(found, "id", "left").select(
            "id", "x", (F.col("hits") + F.coalesce("found", F.lit(0))).alias("hits"),
            (F.col("saved") | F.coalesce("reached", F.lit(False))).alias("saved"),
            F.concat("near", F.coalesce("others", F.array().cast("array<bigint>"))).alias("near"),
        )
    left = materialize(left.withColumn("core", F.col("hits") >= min_samples), "density_open")
    bare = left.filter("NOT core AND NOT saved")
    late = left.filter("core").select(F.col("id").alias("other"))
    saved = bare.select("id", F.explode("near").alias("other")).join(late, "other", "left_semi").select("id")
    noise = bare.join(saved, "id", "left_anti").select("x")
    if total > n:
        noise = noise.unionByName(unknown_noise(points, eps / math.sqrt(len(features)) * (1 - 1e-9), min_samples))
    rows = df.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    return rows.join(noise.withColumn("is_noise", F.lit(1)), "x", "left").select(
        key, F.coalesce("is_noise", F.lit(0)).alias("is_noise")
    )
