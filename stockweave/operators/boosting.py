"""Boosted regression trees, grown leaf by leaf, several runs (folds) at once.

Every run keeps a score per row; a tree is grown on what is left of the label. Rows travel as blocks
of binned columns, so a scan hands numpy a few large arrays. One job serves all runs: tasks add up
histograms of gradients and counts for the open leaves, histograms are merged per (run, leaf) on the
executors, and one row per leaf, its best split, reaches the driver, which keeps the queue of leaves.
An open leaf of bounded size sends its rows instead, and its whole subtree comes back from one task.
Gradients are whole numbers of a fixed unit, so sums do not depend on the order in which tasks
finish, and a task that is run again yields the same tree.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.session import remove_path, scratch_path

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class BoostParams:
    """``rounds`` trees of ``leaves`` leaves at most, each leaf of ``min_leaf_rows`` rows at least, scaled
    by ``step``; a run ends after ``patience`` rounds without a smaller validation error. Features are
    cut into ``bins`` quantile bins. Scores are written anew every ``kept_rounds`` rounds; in between,
    the few newest trees are added on the fly. A leaf of at most ``local_rows`` rows, some 30 bytes each
    at twenty features, is finished inside one task; larger ones are split by merged histograms."""

    leaves: int = 63
    rounds: int = 300
    step: float = 0.05
    min_leaf_rows: int = 20
    patience: int = 30
    bins: int = 64
    kept_rounds: int = 5
    block_rows: int = 16_384
    rows_per_task: int = 500_000
    local_rows: int = 1 << 19


@dataclass(frozen=True)
class Run:
    """Trains on rows with a place up to ``train_to``, validates on those up to ``valid_to``."""

    train_to: int
    valid_to: int


@dataclass
class Tree:
    """Nodes in order of creation; ``feature`` -1 is a leaf; bins up to ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], (self.left[node], self.right[node]) = feature, cut, children
        for _ in children:
            for column, blank in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0),
                                  (self.rows, 0), (self.gain, 0.0)):
                column.append(blank)
        return children


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted run: ``edges`` per feature, starting score and trees."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    base: float
    trees: tuple[Tree, ...]
    errors: tuple[float, ...]

    def gains(self) -> list[float]:
        """Share of every feature in the gain of all splits."""
        total = [0.0] * len(self.features)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        whole = sum(total) or 1.0
        return [g / whole for g in total]

    def predict(self, columns: Sequence[Column] | None = None) -> Column:
        """The prediction from the features' columns, null as 0."""
        import pandas as pd
        from pyspark.sql.functions import pandas_udf

        edges, base, trees = self.edges, self.base, self.trees

        def predicted(*values):
            x = binned([v.to_numpy() for v in values], edges)
            return pd.Series(scores_of(x, trees, base))

        predicted.__annotations__ = {"values": pd.Series, "return": pd.Series}
        columns = [F.col(f) for f in self.features] if columns is None else columns
        return pandas_udf(predicted, "double")(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])


def binned(columns: list, edges):
    """(features, rows) bin numbers: how many edges lie below a value."""
    import numpy as np

    return np.stack([np.searchsorted(np.array(e), c, "left").astype(np.uint8) for c, e in zip(columns, edges)])


def nodes_of(x, tree: Tree):
    """The leaf of ``tree`` that every row of the binned matrix ``x`` ends in."""
    import numpy as np

    feature, cut, down = np.array(tree.feature), np.array(tree.cut), np.array([tree.left, tree.right])
    node = np.zeros(x.shape[1], np.int64)
    place = np.arange(x.shape[1] if feature[0] >= 0 else 0)
    while len(place):
        at = node[place]
        moved = down[(x[feature[at], place] > cut[at]).astype(np.int8), at]
        node[place] = moved
        place = place[feature[moved] >= 0]
    return node


def scores_of(x, trees: Sequence[Tree], start=0.0):
    """``start`` and the trees' values, added in order."""
    import numpy as np

    total = np.zeros(x.shape[1]) + start
    for t in trees:
        total += np.array(t.value)[nodes_of(x, t)]
    return total


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int) -> tuple[tuple[float, ...], ...]:
    """Inner edges of at most ``bins`` bins per feature, at its quantiles."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in features]).first()
    return tuple(tuple(sorted(set(found[c] or ()))) for c in features)


def row_blocks(
    rows: DataFrame, features: Sequence[str], label: str, place: str, edges, base: Sequence[float], p: BoostParams
) -> DataFrame:
    """(x, y, place, score): blocks of rows in order of ``place`` within a task, as raw arrays."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // p.rows_per_task))
    ordered = (
        rows.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
                    F.col(label).cast("double").alias("_y"), F.col(place).cast("long").alias("_place"))
        .repartition(tasks, F.xxhash64("_place"))
        .sortWithinPartitions("_place")
    )

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        waiting, held = [], 0

        def out(table):
            columns = [table.column(i).to_numpy() for i in range(table.num_columns)]
            y, at = columns[-2], columns[-1]
            score = np.repeat(np.array(base)[:, None], len(y), 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([a.tobytes()], pa.binary()) for a in (binned(columns[:-2], edges), y, at, score)],
                ["x", "y", "place", "score"],
            )

        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= p.block_rows:
                table = pa.Table.from_batches(waiting)
                for i in range(0, held - held % p.block_rows, p.block_rows):
                    yield out(table.slice(i, p.block_rows))
                waiting = table.slice(held - held % p.block_rows).to_batches()
                held %= p.block_rows
        if held:
            yield out(pa.Table.from_batches(waiting))

    return ordered.mapInArrow(pack, "x binary, y binary, place binary, score binary")


def _unpacked(batch, n_features: int):
    """Arrays (x, y, place, score) of every block of a batch."""
    import numpy as np

    for x, y, place, score in zip(*[batch.column(i) for i in range(4)]):
        y, place = np.frombuffer(y.as_buffer()), np.frombuffer(place.as_buffer(), np.int64)
        yield (
            np.frombuffer(x.as_buffer(), np.uint8).reshape(n_features, -1), y, place,
            np.frombuffer(score.as_buffer()).reshape(-1, len(y)),
        )


def leaf_histograms(
    blocks: DataFrame, n_features: int, n_bins: int, runs: Sequence[Run], newest: dict[int, list[Tree]],
    growing: dict[int, Tree], wanted: dict[int, list[int]], local: set[tuple[int, int]], slot_of: dict[tuple[int, int], int],
    unit: float, square: float | None,
) -> DataFrame:
    """(slot, run, node, local, sums, counts) per task: gradients and rows of the wanted leaves by
    feature and bin; for ``local`` leaves the binned rows and their gradients instead. ``slot_of``
    names the exchange's key of a leaf.

    With ``square``, the unit of squared errors, node -1 holds those of a run's validation rows.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        totals: dict = {}
        members: dict = {}

        def add(r, node, sums, counts):
            known = totals.get((r, node))
            if known is None:
                totals[r, node] = [sums, counts]
            else:
                known[0] += sums
                known[1] += counts

        for batch in batches:
            for x, y, place, score in _unpacked(batch, n_features):
                for r, tree in growing.items():
                    n = int(np.searchsorted(place, runs[r].train_to, "right"))
                    until = int(np.searchsorted(place, runs[r].valid_to, "right")) if square else n
                    if not until:
                        continue
                    now = scores_of(x[:, :until], newest[r], score[r, :until])
                    if square and until > n:
                        off = np.rint((now[n:] - y[n:until]) ** 2 / square).astype(np.int64)
                        add(r, -1, np.array([off.sum()]), np.array([until - n]))
                    if not n or not wanted[r]:
                        continue
                    gradient = np.rint((now[:n] - y[:n]) / unit)
                    at = nodes_of(x[:, :n], tree)
                    for node in wanted[r]:
                        if (r, node) in local:
                            own = slice(0, n) if len(tree.feature) == 1 else np.flatnonzero(at == node)
                            members.setdefault((r, node), []).append((x[:, :n][:, own], gradient[own]))
                    merged = [node for node in wanted[r] if (r, node) not in local]
                    if not merged:
                        continue
                    slots = np.full(len(tree.feature), -1)
                    slots[merged] = np.arange(len(merged))
                    slot = slots[at]
                    some = np.flatnonzero(slot >= 0)
                    if not len(some):
                        continue
                    part, weights, first = x[:, some], gradient[some], slot[some] * n_bins
                    size = len(merged) * n_bins
                    cells = [first + part[f] for f in range(n_features)]
                    sums = np.stack([np.bincount(c, weights, size) for c in cells]).astype(np.int64)
                    counts = np.stack([np.bincount(c, minlength=size) for c in cells])
                    add(r, tuple(merged), sums, counts)
        keys, parts = [], []
        for (r, nodes), both in totals.items():
            if nodes == -1:
                keys.append((r, -1))
                parts.append([a.tobytes() for a in both])
                continue
            # (feature, leaf, bin) to one (feature, bin) array per leaf that has rows.
            split = [a.reshape(n_features, len(nodes), n_bins) for a in both]
            for k in np.flatnonzero(split[1][0].sum(1)):
                keys.append((r, nodes[k]))
                parts.append([np.ascontiguousarray(a[:, k]).tobytes() for a in split])
        for key, pieces in members.items():
            keys.append(key)
            parts.append([np.concatenate([v[0] for v in pieces], 1).tobytes(), np.concatenate([v[1] for v in pieces]).tobytes()])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([slot_of[k] for k in keys], pa.int32()),
                pa.array([r for r, _ in keys], pa.int32()), pa.array([n for _, n in keys], pa.int32()),
                pa.array([k in local for k in keys], pa.bool_()),
                *[pa.array([v[i] for v in parts], pa.binary()) for i in (0, 1)],
            ],
            ["slot", "run", "node", "local", "sums", "counts"],
        )

    return blocks.mapInArrow(run, "slot int, run int, node int, local boolean, sums binary, counts binary")


def best_cuts(sums, counts, min_leaf_rows: int) -> dict:
    """Best split of every histogram (leaf, feature, bin): arrays by column.

    ``feature`` is -1 where no split leaves enough rows on both sides and gains anything. Ties go to
    the first feature, then the lowest cut.
    """
    import numpy as np

    n_leaves, _, n_bins = sums.shape
    left_g, left_n = np.cumsum(sums, 2), np.cumsum(counts, 2)
    g, n = left_g[:, 0, -1], left_n[:, 0, -1]
    a, rows = left_g.astype(float), left_n.astype(float)
    b, others = g[:, None, None] - a, n[:, None, None] - rows
    whole = (g.astype(float) ** 2 / np.maximum(n, 1))[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = a * a / rows + b * b / others - whole
    fits = (rows >= min_leaf_rows) & (others >= min_leaf_rows) & (gain > 1e-9 * np.maximum(1.0, whole))
    gain = np.where(fits, gain, -1.0).reshape(n_leaves, -1)
    every, best = np.arange(n_leaves), gain.argmax(1)
    return {
        "g": g, "n": n, "feature": np.where(gain[every, best] > 0, best // n_bins, -1), "cut": best % n_bins,
        "gain": gain[every, best], "left_g": left_g.reshape(n_leaves, -1)[every, best],
        "left_n": left_n.reshape(n_leaves, -1)[every, best],
    }


def local_subtree(x, gradient, leaves: int, n_bins: int, min_leaf_rows: int) -> list[dict]:
    """Splits of all nodes below a leaf, grown best first from its rows; a node's ``parent`` is its
    place in the list, -1 for the leaf itself, and a split node's children come left before right."""
    import numpy as np

    n_features = len(x)
    offset = (np.arange(n_features) * n_bins)[:, None]

    def histogram(part, own):
        if part.shape[1] <= 4_096:  # one call instead of one per feature
            cells = (part + offset).ravel()
            size = n_features * n_bins
            return np.stack([np.bincount(cells, np.tile(own, n_features), size), np.bincount(cells, minlength=size)]).reshape(
                2, n_features, n_bins
            )
        return np.stack([
            np.stack([np.bincount(row, own, n_bins) for row in part]), np.stack([np.bincount(row, minlength=n_bins) for row in part])
        ])

    out: list[dict] = []
    held: dict = {}

    def found(parent, parts, histograms):
        stacked = np.rint(np.stack(histograms)).astype(np.int64)
        best = best_cuts(stacked[:, 0], stacked[:, 1], min_leaf_rows)
        for k, (part, h) in enumerate(zip(parts, histograms)):
            row = {c: v[k].item() for c, v in best.items()} | {"parent": parent}
            if row["feature"] >= 0:
                held[len(out)] = (*part, h)
                heapq.heappush(queue, (-row["gain"], len(out)))
            out.append(row)

    queue: list = []
    found(-1, [(x, gradient)], [histogram(x, gradient)])
    count = 1
    while queue and count < leaves:
        at = heapq.heappop(queue)[1]
        part, own, whole = held.pop(at)
        left = part[out[at]["feature"]] <= out[at]["cut"]
        sides = [(part[:, m], own[m]) for m in (left, ~left)]
        few = 0 if len(sides[0][1]) <= len(sides[1][1]) else 1
        known = histogram(*sides[few])
        found(at, sides, [known, whole - known] if few == 0 else [whole - known, known])
        count += 1
    return out


SPLIT_SCHEMA = (
    "run int, node int, place int, parent int, g long, n long, feature int, cut int, gain double, left_g long, left_n long"
)


def best_splits(
    histograms: DataFrame, n_features: int, n_bins: int, min_leaf_rows: int, leaves: int, tasks: int
) -> DataFrame:
    """Best split of every leaf from its merged histograms, and whole subtrees of local leaves.

    ``place`` numbers the nodes of a subtree, 0 the leaf itself; ``parent`` is -1 there. A task holds
    one histogram per leaf that falls to it, and the rows of one local leaf at a time.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        totals: dict = {}
        members: dict = {}
        for batch in batches:
            for r, node, local, sums, counts in zip(*[batch.column(i) for i in range(1, 6)]):
                key = r.as_py(), node.as_py()
                if local.as_py():
                    rows = np.frombuffer(sums.as_buffer(), np.uint8).reshape(n_features, -1)
                    members.setdefault(key, []).append((rows, np.frombuffer(counts.as_buffer())))
                    continue
                parts = [np.frombuffer(v.as_buffer(), np.int64) for v in (sums, counts)]
                known = totals.setdefault(key, [0, 0])
                known[0], known[1] = known[0] + parts[0], known[1] + parts[1]
        rows = []
        blank = {"place": 0, "parent": -1, "feature": -1, "cut": 0, "gain": 0.0, "left_g": 0, "left_n": 0}
        for (r, node), both in totals.items():
            if node < 0:
                rows.append(blank | {"run": r, "node": node, "g": int(both[0][0]), "n": int(both[1][0])})
        merged = [k for k in totals if k[1] >= 0]
        if merged:
            sums, counts = (np.stack([totals[k][i] for k in merged]).reshape(len(merged), n_features, n_bins) for i in (0, 1))
            best = {c: v.tolist() for c, v in best_cuts(sums, counts, min_leaf_rows).items()}
            for i, (r, node) in enumerate(merged):
                rows.append(blank | {"run": r, "node": node} | {c: v[i] for c, v in best.items()})
        for r, node in list(members):
            pieces = members.pop((r, node))
            x, gradient = np.concatenate([v[0] for v in pieces], 1), np.concatenate([v[1] for v in pieces])
            for place, row in enumerate(local_subtree(x, gradient, leaves, n_bins, min_leaf_rows)):
                rows.append(row | {"run": r, "node": node, "place": place})
        kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
        fields = [f.split() for f in SPLIT_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))

    return histograms.repartition(tasks, "slot").mapInArrow(run, SPLIT_SCHEMA)


def slot_keys(spark, tasks: int) -> list[int]:
    """For every partition of an exchange of ``tasks`` partitions a key that goes to it."""
    rows = spark.range(64 * tasks).select(F.col("id").cast("int").alias("k"))
    keys = rows.groupBy(F.pmod(F.hash("k"), F.lit(tasks)).alias("p")).agg(F.min("k").alias("k")).collect()
    return [r["k"] for r in sorted(keys, key=lambda r: r["p"])]


class Growth:
    """One tree on its way: which leaves were looked at, which splits the queue takes.

    The queue takes the leaf of largest gain, of equals the older one. A child's gain is known only
    after the next scan, so leaves that the queue would take by what is known so far are opened ahead;
    the tree itself is cut out in the right order at the end.
    """

    def __init__(self, leaves: int) -> None:
        self.leaves, self.tree, self.found = leaves, Tree(), {}
        self.names: dict[int, dict[int, int]] = {}

    def rows_of(self, node: int, everything: int) -> int:
        """Rows of a leaf that is open; ``everything`` those of the root."""
        if node == 0:
            return everything
        parent = next(i for i in range(len(self.tree.feature)) if node in (self.tree.left[i], self.tree.right[i]) and i != node)
        best = self.found[parent]
        return best["left_n"] if self.tree.left[parent] == node else best["n"] - best["left_n"]

    def learn(self, row: dict) -> None:
        """Take in the split of a leaf, or of a node of a leaf's subtree (parents come first)."""
        if row["place"] == 0:
            self.found[row["node"]] = row
            self.names[row["node"]] = {0: row["node"]}
            return
        names = self.names[row["node"]]
        parent = names[row["parent"]]
        if self.tree.feature[parent] < 0:
            self.tree.split(parent, self.found[parent]["feature"], self.found[parent]["cut"])
        left = self.tree.left[parent]
        names[row["place"]] = self.tree.right[parent] if left in self.found else left
        self.found[names[row["place"]]] = row

    def wanted(self) -> list[int]:
        """Leaves whose histogram the next scan must bring; none once the tree is settled."""
        if self._taken() is not None:
            return []
        if not self.found:
            return [0]
        queue, count, unknown = [(0.0, 0)], 1, []
        while queue and count < self.leaves:
            node = heapq.heappop(queue)[1]
            best = self.found[node]
            if best["feature"] < 0:
                continue
            count += 1
            if self.tree.feature[node] < 0:
                self.tree.split(node, best["feature"], best["cut"])
            for child in (self.tree.left[node], self.tree.right[node]):
                if child in self.found:
                    heapq.heappush(queue, (-self.found[child]["gain"], child))
                else:
                    unknown.append(child)
        return sorted(unknown)

    def _taken(self) -> list[int] | None:
        """Nodes split in order of the queue; None where a leaf not looked at yet could come first."""
        if 0 not in self.found:
            return None
        taken, queue = [], []

        def offer(node: int) -> None:
            if self.found[node]["feature"] >= 0:
                heapq.heappush(queue, (-self.found[node]["gain"], node))

        offer(0)
        while queue and len(taken) + 1 < self.leaves:
            node = heapq.heappop(queue)[1]
            taken.append(node)
            if len(taken) + 1 == self.leaves and self.tree.feature[node] >= 0:
                break
            for child in (self.tree.left[node], self.tree.right[node]):
                if child not in self.found or self.tree.feature[node] < 0:
                    return None
                offer(child)
        return taken

    def finished(self, step: float, unit: float) -> Tree:
        """The tree of the splits taken, with leaf values."""
        taken = set(self._taken() or ())
        out = Tree()
        root = self.found[0]
        todo = [(0, 0, root["g"], root["n"])]
        while todo:
            node, at, g, n = todo.pop()
            out.rows[at] = n
            out.value[at] = -step * unit * g / n
            if node in taken:
                best = self.found[node]
                out.gain[at] = best["gain"] * unit * unit
                left, right = out.split(at, best["feature"], best["cut"])
                todo.append((self.tree.right[node], right, g - best["left_g"], n - best["left_n"]))
                todo.append((self.tree.left[node], left, best["left_g"], best["left_n"]))
        return out


def best_round(errors: Sequence[float], patience: int) -> int:
    """1-based round of the least error before ``patience`` rounds without a smaller one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boost(
    rows: DataFrame, features: Sequence[str], label: str, place: str, runs: Sequence[Run], p: BoostParams = BoostParams()
) -> list[BoostedTrees]:
    """Boosted trees of every run; ``place`` is a long, larger for later rows.

    Rows with a null label are left out. A run without validation rows has all rounds; one ends early
    where no leaf can be split. Runs that have ended take no part in later scans.
    """
    spark = rows.sparkSession
    rows = rows.filter(F.col(label).isNotNull())
    y = F.col(label).cast("double")
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), (F.max(y) - F.min(y)).alias("span"),
        *[F.avg(F.when(F.col(place) <= r.train_to, y)).alias(f"b{i}") for i, r in enumerate(runs)],
        *[F.count(F.when(F.col(place) <= r.train_to, 1)).alias(f"n{i}") for i, r in enumerate(runs)],
        *[F.count(F.when((F.col(place) > r.train_to) & (F.col(place) <= r.valid_to), 1)).alias(f"v{i}")
          for i, r in enumerate(runs)],
    ).first()
    if any(facts[f"b{i}"] is None for i in range(len(runs))):
        raise ValueError("a run has no rows to train on")
    # Without the last digits, which hang on the order in which tasks finish.
    base = [float(f"{facts[f'b{i}']:.9g}") for i in range(len(runs))]
    # Sums of all gradients and squared errors stay below 2^53 units, exact in doubles.
    reach = max(facts["span"], 1e-12) * 2
    unit, square = (2.0 ** max(-30, math.ceil(math.log2(facts["n"] * most)) - 52) for most in (reach, reach * reach))
    edges = bin_edges(rows, features, p.bins)
    n_bins = max(len(e) for e in edges) + 1
    # Few keys, each a histogram or a leaf: dealt out evenly, as hashing would put some side by side.
    tasks = max(1, min(spark.sparkContext.defaultParallelism, p.leaves * len(runs)))
    slots = slot_keys(spark, tasks)

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "boosting_blocks")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    blocks, path = written(row_blocks(rows, features, label, place, edges, base, p))
    trees: dict[int, list[Tree]] = {i: [] for i in range(len(runs))}
    newest: dict[int, list[Tree]] = {i: [] for i in range(len(runs))}
    errors: dict[int, list[float]] = {i: [] for i in range(len(runs))}
    active = list(trees)
    while active:
        growths = {r: Growth(p.leaves) for r in active}
        first = True
        while growths:
            wanted = {r: g.wanted() if len(trees[r]) < p.rounds else [] for r, g in growths.items()}
            open_runs = [r for r in growths if wanted[r] or first]
            if not open_runs:
                break
            sizes = {
                (r, node): growths[r].rows_of(node, facts[f"n{r}"]) for r in open_runs for node in wanted[r]
            } | {(r, -1): 0 for r in open_runs}
            local = {k for k, n in sizes.items() if k[1] >= 0 and n <= p.local_rows}
            order = sorted(sizes, key=lambda k: (k not in local, -sizes[k], k))
            histograms = leaf_histograms(
                blocks, len(features), n_bins, runs, newest, {r: growths[r].tree for r in open_runs}, wanted,
                local, {k: slots[i % tasks] for i, k in enumerate(order)}, unit, square if first else None,
            )
            best = best_splits(histograms, len(features), n_bins, p.min_leaf_rows, p.leaves, tasks)
            for row in sorted(best.toArrow().to_pylist(), key=lambda row: (row["run"], row["node"], row["place"])):
                if row["node"] >= 0:
                    growths[row["run"]].learn(row)
                elif trees[row["run"]]:
                    errors[row["run"]].append(row["g"] * square / row["n"])
            if first:
                for r in list(growths):
                    known = errors[r]
                    late = facts[f"v{r}"] and known and len(known) - best_round(known, p.patience) >= p.patience
                    if late or len(trees[r]) >= p.rounds or growths[r].found[0]["feature"] < 0:
                        del growths[r]
                first = False
        active = list(growths)
        for r, growth in growths.items():
            tree = growth.finished(p.step, unit)
            trees[r].append(tree)
            newest[r].append(tree)
        if active and len(trees[active[0]]) % p.kept_rounds == 0:
            older = path
            blocks, path = written(_scored(blocks, len(features), newest))
            remove_path(spark, older)
            newest = {r: [] for r in trees}
    remove_path(spark, path)
    out = []
    for r in trees:
        kept = best_round(errors[r], p.patience) if errors[r] else len(trees[r])
        out.append(BoostedTrees(tuple(features), edges, base[r], tuple(trees[r][:kept]), tuple(errors[r])))
    return out


def _scored(blocks: DataFrame, n_features: int, newest: dict[int, list[Tree]]) -> DataFrame:
    """The blocks with the newest trees added to their scores."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = []
            for x, _, _, score in _unpacked(batch, n_features):
                score = score.copy()
                for r, added in newest.items():
                    if added:
                        score[r] = scores_of(x, added, score[r])
                scores.append(score.tobytes())
            yield batch.set_column(3, "score", pa.array(scores, pa.binary()))

    return blocks.mapInArrow(run, "x binary, y binary, place binary, score binary")
