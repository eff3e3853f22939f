"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value
from stockweave.session import materialize

by_value(__name__)


def local_roots(n: int, a, b, roots=None):
    """Smallest member of the component of each of ``n`` numbered points, edges given as arrays.

    ``roots`` continues from the result of earlier edges.
    """
    import numpy as np

    roots = np.arange(n) if roots is None else roots
    while len(a):
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        least = np.minimum(ra, rb)
        np.minimum.at(roots, np.maximum(ra, rb), least)
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots = up
    return roots


def _hooked(edges: DataFrame, small: bool) -> DataFrame:
    """One star step on edges (a, b), a > b: every point's neighbours hang on the smallest one."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    joined = both.join(least, "a")
    out = joined.filter(F.col("b") > F.col("root")) if not small else joined.filter(F.col("b") != F.col("root"))
    out = out.select(F.col("b").alias("a"), F.col("root").alias("b"))
    # The point itself hangs on the smallest neighbour too.
    return out.unionByName(least.filter(F.col("a") != F.col("root")).select("a", F.col("root").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternating large-star and small-star steps: the number of rows never grows beyond the edges and
    their nodes, no component is gathered, and the number of rounds grows with the logarithm of the
    longest path. Every round is written, so a lost executor costs one step. Nodes with a null end
    or linked to themselves only are left out.
    """
    now = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    while True:
        now = materialize(_hooked(_hooked(now, False), True), "stars")
        # A sum of hashes that wraps nowhere: decimals.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
