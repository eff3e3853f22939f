"""K-Means with all restarts and all numbers of clusters in the same scans.

A run is one start with one number of clusters. Every scan reads the rows once for all runs that still
move: tasks add up rows and coordinates per (run, cluster), Spark merges these few sums, and the
driver holds nothing but centres. Seeding goes the same way: a seed is drawn with the chance of its
squared distance to the nearest seed so far, by a race that each task runs over its own rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.session import materialize

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Clustering:
    """Centres (clusters x features) of the best start, and its cost: summed squared distances."""

    k: int
    centers: tuple[tuple[float, ...], ...]
    cost: float

    def label(self, features: Sequence[str]) -> Column:
        """Number of the nearest centre, of equally near ones the first."""
        x = F.array(*[F.col(f).cast("double") for f in features])
        centers = F.array(*[F.array(*[F.lit(v) for v in c]) for c in self.centers])
        far = F.transform(
            centers,
            lambda c: F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v),
        )
        return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def point_blocks(rows: DataFrame, features: Sequence[str], key: str, block_rows: int = 16_384) -> DataFrame:
    """(h, x): blocks of rows as raw arrays, a hash of the key and the coordinates."""

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        def out(table):
            x = np.stack([table.column(i).to_numpy() for i in range(1, table.num_columns)], 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([a.tobytes()], pa.binary()) for a in (table.column(0).to_numpy(), x)], ["h", "x"]
            )

        waiting, held = [], 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= block_rows:
                yield out(pa.Table.from_batches(waiting))
                waiting, held = [], 0
        if held:
            yield out(pa.Table.from_batches(waiting))

    return rows.select(
        F.xxhash64(key).alias("h"), *[F.col(f).cast("double").alias(f) for f in features]
    ).mapInArrow(pack, "h binary, x binary")


def _blocks(batch, n_features: int):
    import numpy as np

    for h, x in zip(batch.column(0), batch.column(1)):
        yield np.frombuffer(h.as_buffer(), np.uint64), np.frombuffer(x.as_buffer()).reshape(-1, n_features)


def _shares(h, salt: int):
    """Numbers in (0, 1) from hashes, another row of them for every salt."""
    import numpy as np

    z = h ^ np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54


def squared_gaps(x, centers):
    """Squared distances of rows to centres, never below 0."""
    import numpy as np

    return np.maximum((x * x).sum(1)[:, None] - 2.0 * (x @ centers.T) + (centers * centers).sum(1)[None, :], 0.0)


def seed_centers(blocks: DataFrame, n_features: int, runs: Sequence[int], seed: int) -> list:
    """Seeds of every run, ``runs`` giving the numbers of clusters: k-means++ without a sample.

    In round t the row of least -ln(u) / d wins, d its squared distance to the nearest seed (1 in the
    first round), u a hash of row, run and round. A run with fewer different rows than clusters keeps
    fewer seeds.
    """
    import numpy as np

    seeds: list = [np.zeros((0, n_features)) for _ in runs]
    for t in range(max(runs)):
        open_runs = [r for r, k in enumerate(runs) if k > t and len(seeds[r]) == t]

        def race(batches, seeds=seeds, t=t, open_runs=open_runs):
            import numpy as np
            import pyarrow as pa

            best: dict = {}
            for batch in batches:
                for h, x in _blocks(batch, n_features):
                    for r in open_runs:
                        weight = squared_gaps(x, seeds[r]).min(1) if t else np.ones(len(x))
                        # What rounding leaves of a seed's distance to itself is no distance.
                        weight = np.where(weight > 1e-12 * (1.0 + (x * x).sum(1)), weight, 0.0)
                        with np.errstate(divide="ignore"):
                            time = -np.log(_shares(h, seed + r * 1_000_003 + t * 97)) / weight
                        i = int(np.argmin(time))
                        if np.isfinite(time[i]) and (r not in best or (time[i], tuple(x[i])) < best[r]):
                            best[r] = (float(time[i]), tuple(x[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.int32()), pa.array([b[0] for b in best.values()], pa.float64()),
                 pa.array([list(b[1]) for b in best.values()], pa.list_(pa.float64()))],
                ["run", "time", "x"],
            )

        drawn = blocks.mapInArrow(race, "run int, time double, x array<double>")
        winners = drawn.groupBy("run").agg(F.min(F.struct("time", "x")).alias("w")).select("run", "w.x").collect()
        for row in winners:  # one per run
            seeds[row["run"]] = np.vstack([seeds[row["run"]], row["x"]])
    return seeds


def lloyd_step(blocks: DataFrame, n_features: int, centers: dict) -> dict:
    """(run, cluster) -> rows, cost, sums of coordinates by nearest centre; one scan for all runs."""
    names = [f"s{i}" for i in range(n_features)]

    def sums(batches):
        import numpy as np
        import pyarrow as pa

        totals = {r: np.zeros((len(c), n_features + 2)) for r, c in centers.items()}
        for batch in batches:
            for _, x in _blocks(batch, n_features):
                rows = np.hstack([np.ones((len(x), 1)), np.zeros((len(x), 1)), x])
                for r, c in centers.items():
                    gaps = squared_gaps(x, c)
                    near = gaps.argmin(1)
                    rows[:, 1] = gaps[np.arange(len(x)), near]
                    totals[r] += np.stack([np.bincount(near, column, len(c)) for column in rows.T], 1)
        keys = [(r, k) for r, c in centers.items() for k in range(len(c))]
        table = np.vstack([totals[r] for r in centers]) if keys else np.zeros((0, n_features + 2))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)]
            + [pa.array(table[:, i], pa.float64()) for i in range(n_features + 2)],
            ["run", "cluster", "n", "cost", *names],
        )

    columns = ["n", "cost", *names]
    parts = blocks.mapInArrow(sums, "run int, cluster int, " + ", ".join(f"{c} double" for c in columns))
    merged = parts.groupBy("run", "cluster").agg(*[F.sum(c).alias(c) for c in columns])
    return {(r["run"], r["cluster"]): tuple(r)[2:] for r in merged.collect()}  # one row per cluster


def fit_runs(
    rows: DataFrame, features: Sequence[str], key: str, runs: Sequence[int], seed: int, max_iter: int, tol: float = 1e-4
) -> list[Clustering]:
    """A clustering per run; it ends after ``max_iter`` rounds, or when the squared moves of its centres
    sum to at most ``tol`` times the features' mean variance.

    A cluster that loses all its rows keeps its centre.
    """
    import numpy as np

    blocks = materialize(point_blocks(rows, features, key), "point_blocks")
    centers = seed_centers(blocks, len(features), runs, seed)
    if any(not len(c) for c in centers):
        raise ValueError("no rows to cluster")
    spread = rows.agg(*[F.coalesce(F.var_pop(f), F.lit(0.0)) for f in features]).first()
    still = tol * sum(spread) / len(features)
    moving, costs = set(range(len(runs))), [0.0] * len(runs)
    for _ in range(max_iter):
        found = lloyd_step(blocks, len(features), {r: centers[r] for r in sorted(moving)})
        for r in sorted(moving):
            after = centers[r].copy()
            for k in range(len(after)):
                n, _, *total = found[r, k]
                if n:
                    after[k] = np.array(total) / n
            if ((after - centers[r]) ** 2).sum() <= still:
                moving.discard(r)
            centers[r] = after
        if not moving:
            break
    found = lloyd_step(blocks, len(features), dict(enumerate(centers)))
    for (r, _), sums in sorted(found.items()):
        costs[r] += sums[1]
    return [Clustering(k, tuple(map(tuple, c.tolist())), cost) for k, c, cost in zip(runs, centers, costs)]


def fit_kmeans(
    rows: DataFrame, features: Sequence[str], key: str, restarts: dict[int, int], seed: int, max_iter: int
) -> dict[int, Clustering]:
    """The clustering of least cost for every number of clusters, ``restarts`` starts of each, all at once."""
    runs = [k for k, n in restarts.items() for _ in range(n)]
    best: dict[int, Clustering] = {}
    for c in fit_runs(rows, features, key, runs, seed, max_iter):
        if c.k not in best or c.cost < best[c.k].cost:
            best[c.k] = c
    return best
