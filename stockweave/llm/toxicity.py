"""Toxicity by logistic regression, trained with FTRL-proximal over hashed word n-grams and skip-grams.

Every coordinate has a learning rate of its own, and the L1 term leaves most weights at exactly zero:
what is left is a short list that travels with every task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, map_batches, record_batch, utf8
from stockweave.session import materialize

by_value(__name__)


@dataclass(frozen=True)
class ToxicityParams:
    """The training sample: at most ``sample_rows`` labelled documents of at most ``sample_bytes`` UTF-8
    bytes each, those of smallest hash. Features are words, pairs of neighbours and pairs of words
    with each of ``gaps`` words between them, hashed to ``bits`` bits; one must occur in ``least_docs``
    documents of the sample to be learned. ``shard_rows`` documents are passed through in one task,
    ``passes`` times in each of ``rounds``; after a round the shards' states are averaged. ``alpha``, ``beta``: the rate of a
    coordinate is alpha / (beta + root of its summed squared gradients); ``l1``, ``l2``: penalties. A toxic document
    counts as ``toxic_weight`` others, as there are fewer."""

    sample_rows: int = 8_000
    sample_bytes: int = 32 << 10
    bits: int = 40
    gaps: tuple[int, ...] = (1, 2)
    least_docs: int = 3
    shard_rows: int = 2_000
    rounds: int = 4
    passes: int = 2
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    toxic_weight: float = 3.0


#: Any ASCII but letters and digits parts words; so do the signs of the general punctuation blocks.
SPACED = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
SIGNS = "[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f\ufe30-\ufe4f\uff00-\uff0f]+"


def word_list(text: str) -> list[bytes]:
    """The lower-cased words of a text, as UTF-8."""
    import re

    text = text.lower()
    if not text.isascii():
        text = re.sub(SIGNS, " ", text)
    return text.encode("utf-8", "replace").translate(SPACED).split()


def hashed_features(texts: list, params: ToxicityParams):
    """(owner, feature) arrays: every occurrence of a feature and the index of the text it is in."""
    import numpy as np
    import pandas as pd
    import xxhash

    lists = [word_list(t) if t else [] for t in texts]
    words = [w for ws in lists for w in ws]
    owner = np.repeat(np.arange(len(lists)), [len(ws) for ws in lists])
    if not words:
        return owner, np.zeros(0, np.uint64)
    codes, different = pd.factorize(np.array(words, dtype=object))
    single = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in different), np.uint64, len(different))[codes]
    shift = np.uint64(64 - params.bits)
    owners, found = [owner], [single >> shift]
    for gap in (0, *params.gaps):
        ahead = gap + 1
        if len(words) > ahead:
            same = owner[:-ahead] == owner[ahead:]
            pair = single[:-ahead][same] * np.uint64(0x9E3779B97F4A7C15) + single[ahead:][same]
            pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(2 * gap + 0xBF58476D1CE4E5B9)
            owners.append(owner[:-ahead][same])
            found.append(pair >> shift)
    return np.concatenate(owners), np.concatenate(found)


def proximal_weights(z, n, params: ToxicityParams):
    """The weights that FTRL-proximal holds at the state (z, n)."""
    import numpy as np

    shrunk = np.sign(z) * np.maximum(np.abs(z) - params.l1, 0.0)
    return -shrunk / ((params.beta + np.sqrt(n)) / params.alpha + params.l2)


def ftrl_pass(rows: list, z, n, params: ToxicityParams) -> None:
    """One pass over (coordinates, label) rows, in order; ``z`` and ``n`` change in place."""
    import numpy as np

    for at, label in rows:
        own, squares = z[at], n[at]
        w = proximal_weights(own, squares, params)
        gradient = 1.0 / (1.0 + np.exp(-min(max(w.sum(), -35.0), 35.0))) - label
        gradient *= params.toxic_weight if label else 1.0
        more = squares + gradient * gradient
        z[at] = own + gradient - (np.sqrt(more) - np.sqrt(squares)) / params.alpha * w
        n[at] = more


def training_sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """(doc_id, label, text) of the labelled documents to learn from, one row per id.

    Of several labels of an id the highest counts, of several texts the smallest.
    """
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    known = (
        labels.filter(learned & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample_rows)
    )
    fits = F.octet_length(F.coalesce("text", F.lit(""))) <= params.sample_bytes
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(fits)
    # The sample's bound is a parameter, so this side is small by construction.
    return rows.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def sample_features(sample: DataFrame, params: ToxicityParams) -> DataFrame:
    """(doc_id, label, features): the different features of each document of the sample."""

    def run(batch):
        import numpy as np

        owner, feature = hashed_features(batch.column(2).to_pylist(), params)
        order = np.lexsort((feature, owner))
        owner, feature = owner[order], feature[order].astype(np.int64)
        fresh = np.append(True, (np.diff(owner) != 0) | (np.diff(feature) != 0))[: len(owner)]
        owner, feature = owner[fresh], feature[fresh]
        parts = np.split(feature, np.searchsorted(owner, np.arange(1, batch.num_rows)))
        return record_batch(
            doc_id=(batch.column(0), None), label=(batch.column(1), "int32"), features=(parts, None)
        )

    rows = sample.select("doc_id", F.col("label").cast("int"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return map_batches(rows, run, f"doc_id {kind}, label int, features array<long>")


def shard_pass(z, n, params: ToxicityParams):
    """``f(shard's rows) -> arrow table``: how its passes from the state (z, n) move it."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by("place")
        own_z, own_n = z.copy(), n.copy()
        at = table.column("at").combine_chunks()
        at = np.split(at.values.to_numpy(), at.offsets.to_numpy()[1:-1])
        rows = list(zip(at, table.column("label").to_pylist()))
        for _ in range(params.passes):
            ftrl_pass(rows, own_z, own_n, params)
        moved = np.flatnonzero((own_n != n) | (own_z != z))
        return pa.table({"at": moved.astype(np.int32), "z": own_z[moved] - z[moved], "n": own_n[moved] - n[moved]})

    return run


def learn_weights(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> dict[int, float]:
    """Feature -> weight, zero weights left out; -1 is the constant that every text has.

    What reaches the driver is bounded by the sample: its frequent features and, per round, one state
    row per feature that a shard touched.
    """
    import numpy as np

    sample = materialize(sample_features(training_sample(docs, labels, params), params), "toxicity_sample")
    size = sample.count()
    frequent = (
        sample.select(F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= params.least_docs).select("feature").toArrow()
    )
    features = np.sort(frequent.column("feature").to_numpy())
    shards = max(1, -(-size // params.shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(shards))

    # Places of the frequent features, once; later passes read only these.
    def places(batch):
        kept = []
        for row in batch.column(3).to_pylist():
            row = np.array(row, np.int64)
            at = np.searchsorted(features, row)
            hit = at < len(features)
            hit[hit] = features[at[hit]] == row[hit]
            kept.append(np.append(0, at[hit] + 1).astype(np.int32))
        return record_batch(
            shard=(batch.column(0), None), place=(batch.column(1), None), label=(batch.column(2), None), at=(kept, None)
        )

    rows = sample.select(shard.alias("shard"), F.xxhash64("doc_id", F.lit(7)).alias("place"), "label", "features")
    rows = materialize(map_batches(rows, places, "shard long, place long, label int, at array<int>"), "toxicity_rows")
    z, n = np.zeros((2, len(features) + 1))
    for _ in range(params.rounds):
        moves = rows.groupBy("shard").applyInArrow(shard_pass(z, n, params), "at int, z double, n double").toArrow()
        at = moves.column("at").to_numpy()
        order = np.lexsort((moves.column("n").to_numpy(), moves.column("z").to_numpy(), at))
        z, n = (
            old + np.bincount(at[order], moves.column(c).to_numpy()[order], len(old)) / shards
            for old, c in ((z, "z"), (n, "n"))
        )
    weights = proximal_weights(z, n, params)
    some = np.flatnonzero(weights)
    return {int(features[i - 1]) if i else -1: float(weights[i]) for i in some}


def scored(docs: DataFrame, weights: dict[int, float], params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """(doc_id, held_out, score) of every whole text; no shuffle."""
    constant = weights.get(-1, 0.0)
    known = sorted((f, w) for f, w in weights.items() if f >= 0)
    names, values = [f for f, _ in known], [w for _, w in known]
    coarse = 20

    def run(batch):
        import numpy as np

        feature = np.array(names, np.uint64)
        weight = np.array(values)
        # A bit map by the first bits tells most features apart without a search.
        some = np.zeros(1 << coarse, bool)
        some[feature >> np.uint64(params.bits - coarse)] = True
        sums = np.full(batch.num_rows, constant)
        owner, found = hashed_features(batch.column(2).to_pylist(), params)
        maybe = some[found >> np.uint64(params.bits - coarse)]
        owner, found = owner[maybe], found[maybe]
        at = np.searchsorted(feature, found)
        hit = at < len(feature)
        hit[hit] = feature[at[hit]] == found[hit]
        # A feature counts once in a text.
        once = np.unique(owner[hit] * len(feature) + at[hit])
        if len(once):
            sums += np.bincount(once // len(feature), weight[once % len(feature)], batch.num_rows)
        return record_batch(
            doc_id=(batch.column(0), None), held_out=(batch.column(1), None),
            score=(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))), "float64"),
        )

    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select("doc_id", out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """Toxicity of every whole text, one row per row of ``docs``.

    doc_id, held_out (crc32 of the id as text leaves 0 modulo 5; such labels are never learned; false
    for a null id), score (0 to 1), predicted (1 from 0.5 on). A score looks at the text alone: null and
    empty texts get the constant's score, equal texts equal scores; labels that are null or not 0 or 1
    are no labels; without any label every score is 0.5 and predicted 1; further columns are ignored.
    """
    weights = learn_weights(docs, labels, params)
    return scored(docs, weights, params).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
