"""Importance resampling towards a target: documents whose word runs are likelier in a target corpus.

Runs of one to three words fall into hashed buckets; a bucket's gain is the log ratio of its shares
in target and corpus, a document's weight the sum over its runs, and Gumbel noise of the document id
turns the highest scores into a sample without replacement.

The hash is CRC-32, computed for many runs at once: the different runs of a batch are grouped by
length into two-dimensional byte arrays, all checksums of a group move on column by column, and the
buckets are scattered back to the runs' places.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.ordering import ranked
from stockweave.llm.common import by_value, record_batch, utf8
from stockweave.session import materialize

by_value(__name__)


@dataclass(frozen=True)
class ImportanceParams:
    """Runs of up to ``longest`` words in ``buckets``; documents of at least ``least_words`` words are
    drawn, ``percent`` of them. ``segment_words`` words are hashed at once, a longer text in several
    segments; ``matrix_bytes`` bounds one byte array."""

    longest: int = 3
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 5
    seed: int = 42
    segment_words: int = 400_000
    piece_bytes: int = 4 << 20
    matrix_bytes: int = 1 << 20


#: Bytes to words: A-Z lower-cased, ASCII but letters and digits becomes a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


#: Longest runs, in bytes, that are hashed in columns.
COLUMNS = 1024


def crc_table():
    """The 256 steps of CRC-32, reflected polynomial 0xEDB88320."""
    import numpy as np

    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


def checksums(buffer, starts, lengths, matrix_bytes: int = ImportanceParams.matrix_bytes):
    """CRC-32 of the byte ranges of ``buffer`` (uint8), all ranges of one length column by column.

    Ranges of more than ``COLUMNS`` bytes are single monsters, where a column has one entry: they are
    summed one by one.
    """
    import zlib

    import numpy as np

    table = crc_table()
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, edges):
        if not len(group):
            continue
        length = int(lengths[group[0]])
        if length > COLUMNS:
            for k in group:
                out[k] = zlib.crc32(buffer[starts[k] : starts[k] + length])
            continue
        step = max(1, matrix_bytes // max(1, length))
        columns = np.arange(length)
        for i in range(0, len(group), step):
            members = group[i : i + step]
            rows = buffer[starts[members][:, None] + columns]
            crc = np.full(len(members), 0xFFFFFFFF, np.uint32)
            for j in range(length):
                crc = table[crc.astype(np.uint8) ^ rows[:, j]] ^ (crc >> np.uint32(8))
            out[members] = ~crc
    return out


def _numbered(values):
    """Number of each value among the different ones, and where each of those stands first."""
    import numpy as np
    import pandas as pd

    codes, different = pd.factorize(values)
    first = np.empty(len(different), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes.astype(np.int64), first


def _pieces(data: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, a bounded stretch of it at a time, no word cut."""
    clean = data.translate(WORD_BYTES)
    at = 0
    while at < len(clean):
        end = len(clean) if len(clean) - at <= size else clean.find(b" ", at + size)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def run_buckets(texts: list, params: ImportanceParams) -> Iterator[tuple]:
    """(owner, bucket, words): bucket of every run of words and the index of the text it stands in,
    by segments; ``words`` counts the words per text in the segment."""
    import numpy as np

    words: list[bytes] = []
    owners: list[tuple[int, int]] = []
    carried = 0  # words at the front that an earlier segment has ended runs at

    def hashed():
        owner = np.repeat([k for k, _ in owners], [n for _, n in owners])
        joined = np.frombuffer(b" ".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        single, first = _numbered(np.array(words, dtype=object))
        found, codes, n_single = [], single, len(first)
        for size in range(1, params.longest + 1):
            last = size - 1
            if len(words) <= last:
                break
            if size > 1:  # the run is a shorter one and a word
                codes, first = _numbered(codes[:-1] * n_single + single[last:])
            until = first + last
            crc = checksums(joined, starts[first], starts[until] + lengths[until] - starts[first], params.matrix_bytes)
            inside = owner[: len(codes)] == owner[last:]
            inside[: max(0, carried - last)] = False
            found.append((owner[last:][inside], (crc % np.uint32(params.buckets)).astype(np.int64)[codes[inside]]))
        counted = np.bincount(owner[carried:], minlength=len(texts))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), counted

    for k, data in enumerate(texts):
        for part in _pieces(data or b"", params.piece_bytes):
            at = 0
            while at < len(part):
                room = max(1, params.segment_words - len(words))
                taken = part[at : at + room]
                words += taken
                owners.append((k, len(taken)))
                at += len(taken)
                if len(words) >= params.segment_words:
                    yield hashed()
                    # Runs that go on in the next segment may begin in the last words of this text.
                    own = sum(n for o, n in owners if o == k)
                    carried = min(params.longest - 1, own)
                    words, owners = words[len(words) - carried :], [(k, carried)]
    if len(words) > carried:
        yield hashed()


def bucket_counts(docs: DataFrame, params: ImportanceParams = ImportanceParams()) -> DataFrame:
    """(bucket, n): runs of all texts per bucket; a task adds up its own before anything is shuffled."""

    def run(batches):
        import numpy as np

        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in run_buckets(batch.column(0).to_pylist(), params):
                total += np.bincount(bucket, minlength=params.buckets)
        some = np.flatnonzero(total)
        if len(some):
            yield record_batch(bucket=(some, "int64"), n=(total[some], "int64"))

    parts = docs.select(utf8("text").alias("data")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, params: ImportanceParams = ImportanceParams()) -> list[int]:
    """Gain of every bucket, floor of 1000 log share ratios with one run added to each bucket.

    One row per bucket reaches the driver, a number that the parameter fixes.
    """
    known = [{r["bucket"]: r["n"] for r in bucket_counts(df, params).collect()} for df in (docs, target)]
    whole = [float(sum(k.values()) + params.buckets) for k in known]
    out = []
    for b in range(params.buckets):
        s, t = (float(k.get(b, 0) + 1) for k in known)
        out.append(math.floor(1000 * math.log(t * whole[0] / (s * whole[1]))))
    return out


def weighted(docs: DataFrame, gains: list[int], params: ImportanceParams = ImportanceParams()) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; no shuffle."""

    def run(batches):
        import numpy as np

        gain = np.array(gains, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            n_words, n_runs, weight = np.zeros((3, batch.num_rows), np.int64)
            for owner, bucket, words in run_buckets(batch.column(1).to_pylist(), params):
                n_words += words
                n_runs += np.bincount(owner, minlength=batch.num_rows)
                # Sums of integers far below 2^53: exact.
                weight += np.bincount(owner, gain[bucket], batch.num_rows).astype(np.int64)
            yield record_batch(
                doc_id=(batch.column(0), None), n_words=(n_words, "int64"), n_features=(n_runs, "int64"),
                weight=(weight, "int64"),
            )

    rows = docs.select("doc_id", utf8("text").alias("data"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_features long, weight long")


def noise(params: ImportanceParams):
    """Gumbel noise of the document id, floor of a thousandfold."""
    name = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_ranks(
    docs: DataFrame, target: DataFrame, params: ImportanceParams = ImportanceParams()
) -> DataFrame:
    """Weight, score and draw of every document, one row per row of ``docs``.

    doc_id, n_words, n_features (runs of words, repeats counted), weight (sum of gains, 0 without
    words), score (weight plus noise), rank (1, 2, 3... of the ``percent`` highest scores among
    documents of enough words, ties to the smaller doc_id, a null one last; null where not drawn).
    Null and empty texts have no words; repeated rows are documents of their own with equal scores;
    an empty target makes all shares of it equal; no rows give no rows; further columns are ignored.

    Texts are read twice, once for the counts and once for the weights: the buckets of a text are as
    long as the text, and writing them would cost more than hashing again. Ranks come from range
    partitions over slim rows, so neither one task nor the driver holds the order.
    """
    gains = bucket_gains(docs, target, params)
    rows = weighted(docs, gains, params).withColumn("score", F.col("weight") + noise(params))
    scored = materialize(rows, "importance_scores")
    eligible = F.col("n_words") >= params.least_words
    drawn = F.floor(scored.filter(eligible).count() * F.lit(params.percent) / 100)
    keyed = scored.select(
        "*", (~eligible).alias("late"), (-F.col("score")).alias("descending"), F.col("doc_id").isNull().alias("unnamed")
    )
    placed = ranked(keyed, ["late", "descending", "unnamed", "doc_id"], "place")
    rank = F.when(eligible & (F.col("place") < drawn), F.col("place") + 1).cast("long")
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, params: ImportanceParams = ImportanceParams()) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, all columns as they are; ids are taken as unique."""
    drawn = importance_ranks(docs, target, params).filter("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
