"""Distances between two sets of points, a bounded tile of each at a time.

Points are Spark rows with a tile name; a table of tile pairs says which tiles meet. Spark brings
the two tiles of a pair into one task, at most two tiles of rows, where Arrow hands the coordinates
to numpy. Only per-point sums come back: point pairs never become rows.

Neighbours within a radius: ``cut_space`` cuts space into leaves of about equally many points, along
directions of large variance; ``reached`` counts within one leaf, tile by tile, nearest tiles first.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The helpers below travel with the task: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix(table, column: str):
    """Array column of equal lengths as a 2-d numpy array."""
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def squared_distances(a, b, near: float | None = None):
    """All squared distances between the rows of ``a`` and ``b``.

    The product form is fast but loses digits; values close to ``near`` are computed again from
    the differences, so a comparison with ``near`` is exact.
    """
    import numpy as np

    out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    size = max(float((a * a).sum(1).max()), float((b * b).sum(1).max()), 1.0)
    doubt = np.abs(out - near) <= 1e-9 * size if near is not None else out <= 1e-6 * size
    if doubt.any():
        i, j = np.nonzero(doubt)
        out[i, j] = ((a[i] - b[j]) ** 2).sum(1)
    return np.maximum(out, 0.0)


def _halves(values):
    """The value at which sorted ``values`` fall into two parts as equal as they can be, both with rows."""
    import numpy as np

    below = values[: max(1, int(np.searchsorted(values, values[-1])))]  # what is under the largest
    return below[min(len(below) - 1, (len(values) - 1) // 2)]


@dataclass(frozen=True)
class Leaves:
    """Pieces of space: cuts between rotated coordinates, and the box of every leaf (unbounded outside)."""

    directions: object  # columns: orthogonal, by falling variance
    axis: object  # per node, -1 in a leaf
    at: object
    child: object  # first child, the one at or below the cut; in a leaf its number
    lo: object
    hi: object

    def __len__(self) -> int:
        return len(self.lo)

    def place(self, x):
        """Number of the leaf of every row."""
        import numpy as np

        z, node = x @ self.directions, np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.nonzero(self.axis[node] >= 0)[0]
            if not len(inner):
                return self.child[node].astype(np.int32)
            own = node[inner]
            node[inner] = self.child[own] + (z[inner, self.axis[own]] > self.at[own])

    def near(self, x, eps: float):
        """(leaves x rows) whether a leaf may hold points within ``eps`` of a row."""
        z = x @ self.directions
        return box_gaps(z, self.lo, self.hi) <= slack(eps, x, z)


def cut_space(sample, leaves: float, dims: int | None = None) -> Leaves:
    """About ``leaves`` leaves by median cuts of a sample along its widest directions, ``dims`` at most.

    The sample only decides where the cuts are; any point falls into exactly one leaf.
    """
    import numpy as np

    n = sample.shape[1]
    unit = sample / max(float(np.abs(sample).max()), 1.0) if len(sample) else sample  # squares stay finite
    _, vectors = np.linalg.eigh(np.cov(unit.T).reshape(n, n) if len(unit) > 1 else np.eye(n))
    directions = np.ascontiguousarray(vectors[:, ::-1])
    axes = n if dims is None else max(1, min(dims, n))
    z, most = sample @ directions, len(sample) / max(leaves, 1)
    axis, at, child, boxes = [-1], [0.0], [0], []
    todo = [(0, np.arange(len(z)), np.full(n, -np.inf), np.full(n, np.inf))]
    while todo:
        node, rows, lo, hi = todo.pop()
        wide = int(z[rows][:, :axes].var(0).argmax()) if len(rows) > 1 else 0
        values = np.sort(z[rows, wide])
        if len(rows) <= 1.5 * most or values[0] == values[-1]:
            child[node] = len(boxes)
            boxes.append((lo, hi))
            continue
        cut = float(_halves(values))
        axis[node], at[node], child[node] = wide, cut, len(axis)
        for above in (False, True):
            low, high = lo.copy(), hi.copy()
            (low if above else high)[wide] = cut
            todo.append((len(axis), rows[(z[rows, wide] > cut) == above], low, high))
            axis.append(-1), at.append(0.0), child.append(0)
    lo, hi = (np.array(b) for b in zip(*boxes))
    return Leaves(directions, np.array(axis), np.array(at), np.array(child), lo, hi)


def box_gaps(z, lo, hi):
    """(boxes x rows) squared distances of rows to boxes."""
    import numpy as np

    out = np.zeros((len(lo), len(z)))
    for i in range(z.shape[1]):
        v = z[:, i][None, :]
        gap = np.maximum(lo[:, i][:, None] - v, v - hi[:, i][:, None])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        out += gap
    return out


def slack(eps: float, *points) -> float:
    """Square of a radius just above ``eps``: what rounding may add to a bound that was computed after a rotation."""
    import numpy as np

    size = max([1.0, *(float(np.abs(p).max()) for p in points if p.size)])
    return (eps * (1 + 1e-9) + 1e-12 * size) ** 2


def tiled(z, tile_rows: int):
    """(order, starts): rows in tiles of at most ``tile_rows``, halved along their widest axis."""
    import numpy as np

    order, starts, todo = np.arange(len(z)), [], [(0, len(z))]
    while todo:
        a, b = todo.pop()
        if b - a <= tile_rows:
            starts.append(a)
            continue
        part = z[order[a:b]]
        middle = (b - a) // 2
        split = np.argpartition(part[:, int(np.ptp(part, axis=0).argmax())], middle)
        order[a:b] = order[a:b][split]
        todo += [(a + middle, b), (a, a + middle)]
    return order, np.array(starts, dtype=np.int64)


def reached(probes, targets, weights, need, eps: float, directions, tile_rows: int, probe_rows: int = 4_096):
    """(hits, rows, columns): summed weights of the targets within ``eps`` of each probe.

    A probe whose hits come to its ``need`` is looked at no further. Of every other one all targets
    within ``eps`` are counted, and (rows, columns) holds its pairs.
    """
    import numpy as np

    square, hits = eps * eps, np.zeros(len(probes), dtype=np.int64)
    nothing = np.zeros(0, dtype=np.int64)
    if not len(probes) or not len(targets):
        return hits, nothing, nothing
    order, starts = tiled(zt := targets @ directions, tile_rows)
    ends = np.append(starts[1:], len(targets))
    lo, hi = np.minimum.reduceat(zt[order], starts), np.maximum.reduceat(zt[order], starts)
    sizes = [(a * a).sum(1) for a in (probes, targets)]
    # One product gives the squared distances: |p|^2 - 2 p.t + |t|^2.
    left = np.hstack([-2.0 * probes, sizes[0][:, None], np.ones((len(probes), 1))])
    right = np.hstack([targets, np.ones((len(targets), 1)), sizes[1][:, None]])[order]
    doubt = 1e-9 * max(float(sizes[0].max()), float(sizes[1].max()), 1.0)
    zp = probes @ directions
    far = slack(eps, zp, zt)
    pairs = []

    def compare(rows, tile):
        a, b = starts[tile], ends[tile]
        out = (left[rows] @ right[a:b].T).ravel()
        flat = np.flatnonzero(out <= square + doubt)
        i, j = rows[flat // (b - a)], order[a + flat % (b - a)]
        close = np.flatnonzero(out[flat] >= square - doubt)
        if len(close):  # the product loses digits: again, from the differences
            exact = ((probes[i[close]] - targets[j[close]]) ** 2).sum(1) <= square
            keep = np.ones(len(flat), dtype=bool)
            keep[close] = exact
            i, j = i[keep], j[keep]
        np.add.at(hits, i, weights[j])
        still = hits[i] < need[i]
        if still.any():
            pairs.append((i[still], j[still]))

    wanted = np.flatnonzero(need > 0)
    by_place, begins = tiled(zp[wanted], probe_rows)
    for rows in np.split(wanted[by_place], begins[1:]):
        gaps = box_gaps(zp[rows], lo, hi)
        first = gaps.argmin(0)
        for tile in np.unique(first):
            compare(rows[first == tile], tile)
        gaps[first, np.arange(len(rows))] = np.inf
        left_over = hits[rows] < need[rows]
        rows, gaps = rows[left_over], gaps[:, left_over]
        for tile in np.argsort(np.minimum(gaps, 4 * far).sum(1), kind="stable"):
            some = rows[(gaps[tile] <= far) & (hits[rows] < need[rows])]
            if len(some):
                compare(some, tile)
    if not pairs:
        return hits, nothing, nothing
    i, j = (np.concatenate(p) for p in zip(*pairs))
    still = hits[i] < need[i]
    return hits, i[still], j[still]


def lists(owner, values, n: int):
    """Arrow lists: of each of ``n`` rows the values whose owner it is."""
    import numpy as np
    import pyarrow as pa

    by_owner = np.argsort(owner, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[by_owner], pa.int64()))


def per_tile_pair(
    pairs: DataFrame, probes: DataFrame, targets: DataFrame, combine: Callable, schema: str
) -> DataFrame:
    """``combine(probe table, target table) -> arrow table`` for every row of ``pairs``.

    ``pairs``: p_tile, t_tile. ``probes`` and ``targets``: tile plus the same further columns.
    """
    rest = [c for c in probes.columns if c != "tile"]
    left = pairs.join(probes.withColumnRenamed("tile", "p_tile"), "p_tile").select(
        "p_tile", "t_tile", F.lit(0).alias("side"), *rest
    )
    right = pairs.join(targets.withColumnRenamed("tile", "t_tile"), "t_tile").select(
        "p_tile", "t_tile", F.lit(1).alias("side"), *rest
    )

    def both(table):
        import pyarrow.compute as pc

        mine = table.filter(pc.equal(table.column("side"), 0))
        theirs = table.filter(pc.equal(table.column("side"), 1))
        return combine(mine, theirs)

    return left.unionByName(right).groupBy("p_tile", "t_tile").applyInArrow(both, schema)
