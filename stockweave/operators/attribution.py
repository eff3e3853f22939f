"""What every input adds to a row's prediction of boosted trees: Shapley values along the trees' paths.

A path to a leaf asks for an interval of bins of each feature on it. A feature that is known lets the
row through or not; one that is not known lets the share of training rows through that went this way.
A leaf's value times these factors, averaged over all orders in which features become known, gives the
feature's contribution. Rows that meet the same conditions of a leaf share its numbers.
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.operators.boosting import BoostedTrees, Tree, binned

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def leaf_paths(tree: Tree) -> list[tuple[float, dict[int, tuple[int, int, float]]]]:
    """(value, {feature: (above, up to, share of rows)}) of every leaf; bins from above + 1 to up to."""
    out, todo = [], [(0, {})]
    while todo:
        node, path = todo.pop()
        f = tree.feature[node]
        if f < 0:
            out.append((tree.value[node], path))
            continue
        low, high, share = path.get(f, (-1, 1 << 30, 1.0))
        for child, bounds in (
            (tree.left[node], (low, min(high, tree.cut[node]))), (tree.right[node], (max(low, tree.cut[node]), high))
        ):
            todo.append((child, path | {f: (*bounds, share * tree.rows[child] / tree.rows[node])}))
    return out


def path_weights(met, shares):
    """Contribution of each of m features, for a leaf of value 1, to rows of conditions ``met`` (rows x m).

    The polynomial product of (share + met t) holds at t^k the factor of all choices of k known
    features; leaving one feature out is a division.
    """
    import numpy as np

    n, m = met.shape
    whole = np.zeros((n, m + 1))
    whole[:, 0] = 1.0
    for j in range(m):
        whole[:, 1:] = whole[:, 1:] * shares[j] + whole[:, :-1] * met[:, j : j + 1]
        whole[:, 0] *= shares[j]
    weight = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
    out = np.empty((n, m))
    for i in range(m):
        known = np.zeros((n, m))
        known[:, m - 1] = whole[:, m]
        for k in range(m - 1, 0, -1):
            known[:, k - 1] = whole[:, k] - shares[i] * known[:, k]
        rest = np.where(met[:, i : i + 1] > 0, known, whole[:, :m] / shares[i])
        out[:, i] = (met[:, i] - shares[i]) * (rest @ weight)
    return out


def contributions(x, trees, n_features: int, base: float):
    """(rows x (features + 1)): contributions and, last, the prediction expected without any feature."""
    import numpy as np

    out = np.zeros((x.shape[1], n_features + 1))
    out[:, -1] = base
    for tree in trees:
        for value, path in leaf_paths(tree):
            out[:, -1] += value * math.prod(share for *_, share in path.values())
            features = list(path)
            if not features:
                continue
            met = np.stack([(x[f] > low) & (x[f] <= high) for f, (low, high, _) in path.items()], 1)
            codes, place = np.unique(met @ (1 << np.arange(len(features))), return_inverse=True)
            patterns = (codes[:, None] >> np.arange(len(features)) & 1).astype(float)
            parts = value * path_weights(patterns, [share for *_, share in path.values()])
            out[:, features] += parts[place]
    return out


def attributed(model: BoostedTrees) -> Column:
    """Contributions of the model's features, in their order, and the expected prediction at the end;
    together they sum to the prediction."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    edges, base, trees, size = model.edges, model.base, model.trees, len(model.features)

    def parts(*values):
        return pd.Series(list(contributions(binned([v.to_numpy() for v in values], edges), trees, size, base)))

    parts.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return pandas_udf(parts, "array<double>")(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in model.features])
