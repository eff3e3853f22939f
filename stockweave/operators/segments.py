"""Customer segmentation: scaling, K-Means, cluster quality, personas, projection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.quantiles import exact_quantiles, quantile_map
from stockweave.functions.scalars import mixed_hash
from stockweave.functions.tiles import matrix, per_tile_pair, squared_distances
from stockweave.operators.density import density_noise
from stockweave.operators.lloyd import fit_kmeans
from stockweave.params import SegmentParams
from stockweave.session import materialize


def feature_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return exact_quantiles(df, features, [0.5]).select("feature", F.col("value").alias("median"))


def scaled_features(df: DataFrame, p: SegmentParams = SegmentParams(), key: str = "user_id") -> DataFrame:
    """Median-imputed z-scores with the population deviation; a constant column becomes 0.

    Medians and moments are one row each and enter as scalars, so the rows are never joined.
    """
    medians = quantile_map(exact_quantiles(df, p.features, [0.5]), 0.5)
    filled = (
        df.select(key, *[F.col(c).cast("double").alias(c) for c in p.features])
        .withColumn("_m", medians)
        .select(key, *[F.coalesce(F.nanvl(c, F.lit(None)), F.col("_m")[c]).alias(c) for c in p.features])
    )
    moments = filled.agg(
        F.struct(
            *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in p.features]
        ).alias("s")
    ).scalar()

    def z(c: str) -> Column:
        std = F.col(f"_s.{c}.std")
        return ((F.col(c) - F.col(f"_s.{c}.mean")) / F.when(std > 0, std).otherwise(1.0)).alias(c)

    return filled.withColumn("_s", moments).select(key, *[z(c) for c in p.features])


def with_vector(scaled: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(scaled)


def kmeans_segments(scaled: DataFrame, k: int, p: SegmentParams = SegmentParams()) -> DataFrame:
    """The scaled rows with ``cluster_id``: the best of ``restarts`` starts, all in the same scans."""
    best = fit_kmeans(scaled, p.features, "user_id", {k: p.restarts}, p.seed, p.max_iter)[k]
    return scaled.withColumn("cluster_id", best.label(p.features))


def k_selection(scaled: DataFrame, p: SegmentParams = SegmentParams()) -> DataFrame:
    """(k, inertia, silhouette, best): the smallest k among those with the top silhouette.

    All starts of all k share their scans, and all labelings are then judged together, on all rows.
    """
    fits = fit_kmeans(scaled, p.features, "user_id", {k: p.sweep_restarts for k in p.k_values}, p.seed, p.max_iter)
    labels = {f"k_{k}": fits[k].label(p.features) for k in p.k_values}
    labelled = materialize(scaled.select(*p.features, *[c.alias(n) for n, c in labels.items()]), "k_labels")
    scores = silhouettes(labelled, p.features, list(labels)).withColumn("k", F.substring("label", 3, 9).cast("int"))
    costs = scaled.sparkSession.createDataFrame([(k, fits[k].cost) for k in p.k_values], "k int, inertia double")
    out = materialize(costs.join(scores, "k"), "k_sweep")
    best = out.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("b")).scalar()
    return out.select("k", "inertia", "silhouette", (F.col("k") == best).cast("int").alias("best"))


def _distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(reduce(add, [(x - y) * (x - y) for x, y in zip(a, b)]))


def silhouette(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean silhouette by squared distance over all rows, one row."""
    return silhouettes(df, features, [label]).select("silhouette")


def silhouettes(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """(label, silhouette) of several labelings by squared Euclidean distance, over all rows.

    The squared distances of a point to all members of a cluster sum to n |x|^2 - 2 x.S + Q with the
    cluster's size n, sum S and sum of squares Q, so every row meets one entry per cluster and never
    another row. A point alone in its cluster scores 0.
    """
    x = [F.col(f).cast("double") for f in features]
    square = reduce(add, [v * v for v in x])
    rows, scores = df, []
    for i, label in enumerate(labels):
        sums = df.groupBy(F.col(label).alias("c")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"), F.array(*[F.sum(v) for v in x]).alias("s")
        )
        clusters = sums.agg(F.collect_list(F.struct("c", "n", "q", "s")).alias("all")).scalar()
        rows = rows.withColumn(f"_clusters{i}", clusters)
        scores.append(F.avg(_silhouette_of(x, square, F.col(label), F.col(f"_clusters{i}"))).alias(label))
    wide = rows.agg(*scores)
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("silhouette")) for c in labels])
    return wide.select(F.inline(pairs))


def _silhouette_of(x: Sequence[Column], square: Column, label: Column, clusters: Column) -> Column:
    def total(o: Column) -> Column:
        dot = reduce(add, [v * o["s"][i] for i, v in enumerate(x)])
        return F.greatest(F.lit(0.0), o["n"] * square - dot * 2 + o["q"])

    own = F.filter(clusters, lambda o: (o["c"] == label) & (o["n"] > 1))
    a = F.get(F.transform(own, lambda o: total(o) / (o["n"] - 1)), F.lit(0))
    b = F.array_min(F.transform(F.filter(clusters, lambda o: o["c"] != label), lambda o: total(o) / o["n"]))
    return F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))


def sampled_silhouette(
    df: DataFrame, features: Sequence[str], label: str, key: str, sample: int = 20_000, seed: int = 42
) -> DataFrame:
    """Mean Euclidean silhouette of a reproducible sample of at most ``sample`` rows, one row."""
    return sampled_silhouettes(df, features, [label], key, sample, seed).select("silhouette")


def sampled_silhouettes(
    df: DataFrame,
    features: Sequence[str],
    labels: Sequence[str],
    key: str,
    sample: int = 20_000,
    seed: int = 42,
    block: int = 1_000,
) -> DataFrame:
    """(label, silhouette) of several labelings, Euclidean, on a reproducible sample.

    The measure compares every pair of the sample, which the parameter bounds. The sample is cut
    into tiles of about ``block`` rows; one task handles two tiles and returns only distance sums
    per point and cluster.
    """
    picked = materialize(
        df.select(
            F.col(key).alias("id"),
            F.array(*[F.col(c).cast("int") for c in labels]).alias("c"),
            F.array(*features).alias("x"),
        )
        .orderBy(mixed_hash(F.col("id"), seed), "id")
        .limit(sample),
        "silhouette_sample",
    )
    tiles = picked.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(block))).cast("int").alias("n"))
    points = picked.withColumn("tile", (mixed_hash(F.col("id"), seed + 1) % tiles.scalar()).cast("int"))
    pairs = (
        tiles.select("n", F.explode(F.expr("sequence(0, n - 1)")).alias("p_tile"))
        .select("p_tile", F.explode(F.expr("sequence(0, n - 1)")).alias("t_tile"))
    )

    def distance_sums(mine, theirs):
        import numpy as np
        import pyarrow as pa

        if not len(mine) or not len(theirs):
            return pa.table({c: pa.array([], t) for c, t in arrow.items()})
        dist = np.sqrt(squared_distances(matrix(mine, "x"), matrix(theirs, "x")))
        own, others = matrix(mine, "c"), matrix(theirs, "c")
        parts = []
        for which in range(own.shape[1]):
            found, place = np.unique(others[:, which], return_inverse=True)
            member = np.zeros((len(place), len(found)))
            member[np.arange(len(place)), place] = 1.0
            n = len(mine) * len(found)
            parts.append(
                pa.table(
                    {
                        "id": np.repeat(mine.column("id").to_numpy(), len(found)),
                        "l": np.full(n, which, np.int32),
                        "c": np.repeat(own[:, which], len(found)).astype(np.int32),
                        "other": np.tile(found, len(mine)).astype(np.int32),
                        "d": (dist @ member).ravel(),
                        "n": np.tile(member.sum(0).astype(np.int64), len(mine)),
                    }
                )
            )
        return pa.concat_tables(parts)

    import pyarrow as pa

    arrow = {"id": pa.int64(), "l": pa.int32(), "c": pa.int32(), "other": pa.int32(), "d": pa.float64(), "n": pa.int64()}
    found = per_tile_pair(
        pairs, points, points, distance_sums, "id long, l int, c int, other int, d double, n long"
    )
    sums = found.groupBy("l", "id", "c", "other").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    own = F.col("c") == F.col("other")
    point = sums.groupBy("l", "id").agg(
        F.max(F.when(own & (F.col("n") > 1), F.col("d") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("d") / F.col("n"))).alias("b"),
    )
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    names = F.array(*[F.lit(c) for c in labels])
    return point.groupBy(F.get(names, F.col("l")).alias("label")).agg(F.avg(score).alias("silhouette"))


def davies_bouldin(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean over clusters of the worst (S_i + S_j) / M_ij; only centroids are paired."""
    centers = df.groupBy(F.col(label).alias("c")).agg(*[F.avg(f).alias(f"m_{f}") for f in features])
    spread = (
        df.select(F.col(label).alias("c"), *features)
        .join(F.broadcast(centers), "c")  # one row per cluster
        .groupBy("c")
        .agg(F.avg(_distance([F.col(f) for f in features], [F.col(f"m_{f}") for f in features])).alias("s"))
    )
    points = centers.join(spread, "c").select("c", "s", F.array(*[f"m_{f}" for f in features]).alias("m"))
    everyone = points.agg(F.collect_list(F.struct("c", "s", "m")).alias("all")).scalar()

    def ratio(o: Column) -> Column:
        gaps = F.transform(F.arrays_zip(F.col("m").alias("p"), o["m"].alias("q")), lambda z: (z["p"] - z["q"]) * (z["p"] - z["q"]))
        return F.try_divide(F.col("s") + o["s"], F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda t, v: t + v)))

    worst = points.withColumn("_all", everyone).select(
        F.array_max(F.transform(F.filter("_all", lambda o: o["c"] != F.col("c")), ratio)).alias("r")
    )
    return worst.agg(F.avg("r").alias("davies_bouldin"))


def cluster_profile(df: DataFrame, features: Sequence[str], label: str = "cluster_id") -> DataFrame:
    """Mean of every feature per cluster, unscaled."""
    return df.groupBy(label).agg(*[F.avg(f).alias(f) for f in features])


def persona_names(profile: DataFrame, power_label: Column | None = None) -> DataFrame:
    """(cluster_id, cluster_name). Quantiles run over the profile rows, one per cluster; the
    power-user row takes part in them. Names may repeat."""

    wanted = {
        "night_owl_score": 0.75,
        "organic_affinity": 0.75,
        "weekend_concentration": 0.75,
        "pct_festival_orders": 0.75,
        "frequency": 0.35,
        "avg_basket_size": 0.5,
    }
    levels = profile.agg(
        F.struct(*[F.percentile(c, F.lit(share)).alias(c) for c, share in wanted.items()]).alias("q")
    ).scalar()

    def high(c: str) -> Column:
        return F.col(c) > F.col(f"_q.{c}")

    def low(c: str) -> Column:
        return F.col(c) < F.col(f"_q.{c}")

    is_power = F.lit(False) if power_label is None else F.col("cluster_id") == power_label
    name = (
        F.when(is_power, "power_user")
        .when(high("night_owl_score"), "late_night_bachelor")
        .when(high("organic_affinity"), "morning_health_buyer")
        .when(high("weekend_concentration"), "weekend_family_shopper")
        .when(high("pct_festival_orders"), "festival_bulk_buyer")
        .when(low("frequency") & low("avg_basket_size"), "student_exam_buyer")
        .otherwise("impulse_buyer")
    )
    return profile.withColumn("_q", levels).select("cluster_id", name.alias("cluster_name"))


def outlier_labels(labels: DataFrame, noise: DataFrame) -> DataFrame:
    """(user_id, cluster_id, power_label): outliers (``is_noise``) become the cluster after the last."""
    marked = materialize(labels.join(noise, "user_id"), "marked")  # read for the last cluster and for the rows
    power = (marked.agg(F.max("cluster_id").alias("m")).scalar() + 1).cast("int")
    label = F.when(F.col("is_noise") == 1, power).otherwise(F.col("cluster_id")).cast("int")
    return marked.select("user_id", label.alias("cluster_id"), power.alias("power_label"))


def segment_labels(features: DataFrame, k: int | None = None, p: SegmentParams = SegmentParams()) -> DataFrame:
    """(user_id, cluster_id, cluster_name): K-Means, density outliers as a cluster of their own,
    then names. Without ``k`` the sweep chooses it."""
    raw = materialize(features.select("user_id", *p.features), "features")
    scaled = materialize(scaled_features(raw, p), "scaled")
    if k is None:
        k = k_selection(scaled, p).filter("best = 1").first()["k"]
    labels = kmeans_segments(scaled, k, p).select("user_id", "cluster_id")
    noise = density_noise(scaled, p.features, "user_id", p.eps, p.min_samples)
    final = materialize(outlier_labels(labels, noise), "labels")
    profile = materialize(cluster_profile(raw.join(final, "user_id"), p.features), "profile")
    power_label = final.agg(F.max("power_label").alias("m")).scalar()
    names = persona_names(profile, power_label)
    return final.drop("power_label").join(names, "cluster_id").select("user_id", "cluster_id", "cluster_name")


def pca_projection(scaled: DataFrame, labels: DataFrame, p: SegmentParams = SegmentParams()) -> DataFrame:
    """Two principal components of all rows with labels and explained variance shares."""
    picked = materialize(with_vector(scaled, p.features), "pca_rows")
    means = picked.agg(F.array(*[F.avg(c) for c in p.features]).alias("m")).scalar()
    centred = picked.withColumn("_m", means).withColumn(
        "features",
        array_to_vector(F.zip_with(vector_to_array("features"), F.col("_m"), lambda x, m: x - m)),
    )
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(centred)
    share = [float(v) for v in model.explainedVariance.toArray()]
    out = model.transform(centred).withColumn("pc", vector_to_array("pc"))
    return out.join(labels, "user_id").select(
        "user_id",
        "cluster_id",
        F.col("pc")[0].alias("pc1"),
        F.col("pc")[1].alias("pc2"),
        F.lit(share[0]).alias("pc1_share"),
        F.lit(share[1]).alias("pc2_share"),
    )
