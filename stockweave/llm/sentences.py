"""Substring deduplication by runs of consecutive sentences.

Every run of a few consecutive sentences is hashed. The first occurrence of a run over the corpus, by
document and place, is kept; sentences that lie in any later occurrence of a repeated run go. Long
sentences are cut into pieces at words that their own hash chooses, so a passage inside one is cut
alike wherever it stands, and a run of short ones takes in further ones until it says enough.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, map_batches, numbered, record_batch, utf8
from stockweave.session import materialize

by_value(__name__)


@dataclass(frozen=True)
class SentenceParams:
    """Runs of ``run`` sentences, and of as many more as it takes to ``least_words`` words. A sentence of
    more than ``longest`` words is cut after each word whose checksum ``cut_modulus`` divides, and after
    every ``longest`` words since the last cut. ``map_bits``: see ``repeated_bits``."""

    run: int = 3
    least_words: int = 30
    longest: int = 12
    cut_modulus: int = 6
    map_bits: int = 27


LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Full stops of other scripts, which need no white space behind them.
STOPS = "。！？؟।"
#: Where a sentence ends: after a closing mark and the white space behind it, or after a line feed. Every
#: branch begins with a byte of its own, so the search skips from one such byte to the next.
BOUNDARY = b"|".join(
    [mark + rb"[ \t\r\n]+" for mark in (rb"\.", rb"!", rb"\?")] + [rb"\n[ \t\r\n]*"]
    + [stop.encode() + rb"(?:" + "|".join(STOPS).encode() + rb")*[ \t\r\n]*" for stop in STOPS]
)


#: Bits of a run's hash that the first count goes by; the fewer, the less is shuffled.
KEY_BITS = 40


def long_cuts(part: bytes, words: list[bytes], params: SentenceParams) -> tuple[list[int], list[int]]:
    """(words, bytes) before the end of each piece of a long sentence."""
    import re
    from itertools import accumulate
    from zlib import crc32

    modulus, longest, n = params.cut_modulus, params.longest, len(words)
    ends, last = [], 0
    for i in [*[i for i, w in enumerate(words, 1) if crc32(w) % modulus == 0], n]:
        while i - last > longest:
            last += longest
            ends.append(last)
        if i > last:
            ends.append(i)
            last = i
    if part.startswith(b" ".join(words)):  # one space between words
        upto = list(accumulate(map(len, words)))
        places = [upto[i - 1] + i for i in ends]
    else:
        upto = [m.end() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+[ \t\n\r\x0b\x0c]*", part)]
        places = [upto[i - 1] for i in ends]
    places[-1] = len(part)
    return ends, places


def pieces(data: bytes, params: SentenceParams) -> tuple[list[int], list[int], list[bytes]]:
    """(end, number of words, words joined by a space) of every sentence, long ones cut into pieces."""
    import re

    lowered = data.translate(LOWER)
    ends, sizes, texts = [], [], []
    a = 0
    for b in [*[m.end() for m in re.finditer(BOUNDARY, data)], len(data)]:
        if b == a:
            continue
        part = lowered[a:b]
        words = part.split()
        if len(words) <= params.longest:
            ends.append(b)
            sizes.append(len(words))
            texts.append(b" ".join(words))
        else:
            first = 0
            for end, place in zip(*long_cuts(part, words, params)):
                ends.append(a + place)
                sizes.append(end - first)
                texts.append(b" ".join(words[first:end]))
                first = end
        a = b
    return ends, sizes, texts


def sentences(data: bytes, params: SentenceParams = SentenceParams()) -> list[bytes]:
    """The text cut into sentences, long ones into pieces, with the white space behind them; joined,
    they are the text."""
    ends = pieces(data, params)[0]
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def runs_of(sizes: list[int], counts: list[int], params: SentenceParams):
    """(text, first, end) arrays of every run of a batch of texts: ``sizes`` are the sentences' words, one
    text after another, ``counts`` the texts' sentences. A text with words but without a run is one."""
    import numpy as np

    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    counts = np.array(counts, np.int64)
    limit = np.cumsum(counts)
    begin = limit - counts
    text, first = np.repeat(np.arange(len(counts)), counts), np.arange(len(sizes))
    end = np.maximum(first + params.run, np.searchsorted(total, total[:-1] + params.least_words))
    whole = end <= limit[text]
    text, first, end = text[whole], first[whole], end[whole]
    short = np.flatnonzero((np.bincount(text, minlength=len(counts)) == 0) & (total[limit] > total[begin]))
    return np.append(text, short), np.append(first, begin[short]), np.append(end, limit[short])


def cut_all(texts: list[bytes | None], params: SentenceParams):
    """``pieces`` of all texts, one after another, and how many each has."""
    ends, sizes, joined, counts = [], [], [], []
    for data in texts:
        found = pieces(data, params) if data else ((), (), ())
        ends += found[0]
        sizes += found[1]
        joined += found[2]
        counts.append(len(found[0]))
    return ends, sizes, joined, counts


def run_hashes(texts: list[bytes | None], params: SentenceParams):
    """(128 bits of hash as two longs, text, first sentence) arrays of every run of the texts."""
    import numpy as np
    from xxhash import xxh3_128_digest

    _, sizes, joined, counts = cut_all(texts, params)
    text, first, end = runs_of(sizes, counts, params)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in joined], dtype=np.int64)])
    data = b"\n".join(joined)
    digests = [xxh3_128_digest(data[a:b]) for a, b in zip(at[first].tolist(), (at[end] - 1).tolist())]
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    begin = np.cumsum(counts, dtype=np.int64) - np.array(counts, np.int64)
    return both, text, first - begin[text]


def repeated_bits(rows: DataFrame, params: SentenceParams):
    """A bit map of ``2 ** map_bits`` bits, set for the first bits of hashes that occur more than once.

    ``KEY_BITS`` of a run's hash are counted, combined per task before the shuffle. Whatever the corpus,
    the map is of one size: a fuller one only lets more runs through to the exact count.
    """
    import numpy as np

    def run(batch):
        high = run_hashes(batch.column(0).to_pylist(), params)[0][:, 0].view(np.uint64)
        return record_batch(key=((high >> np.uint64(64 - KEY_BITS)).view(np.int64), "int64"))

    counts = map_batches(rows.select(utf8("text").alias("data")), run, "key long").groupBy("key").count()
    place = F.shiftright("key", KEY_BITS - params.map_bits)
    bits = counts.filter("count > 1").groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftright(key, {KEY_BITS - params.map_bits}) & 63 AS INT))")).alias("bits")
    ).toArrow()
    out = np.zeros(1 << max(params.map_bits - 6, 0), np.int64)
    out[bits.column("at").to_numpy()] = bits.column("bits").to_numpy()
    return out


def span_rows(rows: DataFrame, params: SentenceParams, bits) -> DataFrame:
    """(high, low, doc_id, row, place) of the runs that ``bits`` lets through: 128 bits of hash and
    where the run starts."""

    def run(batch):
        import numpy as np

        both, owners, places = run_hashes(batch.column(2).to_pylist(), params)
        at = both[:, 0].view(np.uint64) >> np.uint64(64 - params.map_bits)
        keep = (bits[at >> np.uint64(6)].view(np.uint64) >> (at & np.uint64(63))) & np.uint64(1) == 1
        both, owners, places = both[keep], owners[keep], places[keep]
        index = record_batch(k=(owners, "int64")).column(0)
        return record_batch(
            high=(both[:, 0], "int64"), low=(both[:, 1], "int64"), doc_id=(batch.column(0).take(index), None),
            row=(batch.column(1).take(index), "int64"), place=(places, "int32"),
        )

    texts = rows.select("doc_id", "row", utf8("text").alias("data"))
    kind = dict(texts.dtypes)["doc_id"]
    return map_batches(texts, run, f"high long, low long, doc_id {kind}, row long, place int")


def later_occurrences(rows: DataFrame, params: SentenceParams) -> DataFrame:
    """(row, starts) of every row with runs that occurred before, in order of doc_id, row and place.

    Texts are cut twice: most runs occur once, and writing or sending those costs more than their hashes.
    """
    spans = materialize(span_rows(rows, params, repeated_bits(rows, params)), "spans")
    key = ["high", "low"]
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "place")
    # Counts and first places add up per task before the shuffle, so a hot run is a row per task.
    repeated = (
        spans.groupBy(*key).agg(F.count("*").alias("n"), F.min(order).alias("first")).filter("n > 1")
        .select(*key, F.col("first.row").alias("first_row"), F.col("first.place").alias("first_place"))
    )
    # Written, so that Spark may split a hot run's rows in the join: it can't below an aggregate.
    repeated = materialize(repeated, "repeated")
    later = spans.select(*key, "row", "place").join(repeated, key).filter(
        (F.col("row") != F.col("first_row")) | (F.col("place") != F.col("first_place"))
    )
    return later.groupBy("row").agg(F.collect_list("place").alias("starts"))


def dedup_sentences(docs: DataFrame, params: SentenceParams = SentenceParams(), with_text: bool = False) -> DataFrame:
    """Every document without the sentences of runs that occurred before.

    One row per row of ``docs``: doc_id, n_sentences, n_removed, n_spans (runs that are later
    occurrences), kept_sha256 (of the UTF-8 text left) and, with ``with_text``, kept_text. Sentences
    compare by their words, A-Z lower-cased. The first occurrence is that of the smallest doc_id,
    then place; rows without an id come last, and of equal ids any one row is first. Null and empty
    texts have no sentences and keep nothing; a text of fewer sentences or words than a run counts as
    one run, unless it has no word. Pieces of long sentences count as sentences.
    """
    rows = numbered(docs.select("doc_id", F.col("text").cast("string").alias("text")), "numbered_docs", "row", "zstd")
    starts = later_occurrences(rows, params)

    def cut(batch):
        import hashlib

        import numpy as np

        data_of, starts_of = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        stops, sizes, _, counts = cut_all(data_of, params)
        _, first, end = runs_of(sizes, counts, params)
        end_of = np.zeros(len(sizes), np.int64)
        end_of[first] = end
        removed, digests, texts = [], [], []
        base = 0  # sentences of the texts before
        for data, at, count in zip(data_of, starts_of, counts):
            data = data or b""
            kept, n_removed = data, 0
            if at:
                places = [0, *stops[base : base + count]]
                left, upto = [], 0
                for start in sorted(at):
                    left.append(data[places[upto] : places[max(start, upto)]])
                    reach = int(end_of[base + start]) - base
                    n_removed += reach - max(start, upto)
                    upto = reach
                kept = b"".join([*left, data[places[upto] :]])
            base += count
            removed.append(n_removed)
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode() if with_text else None)
        spans = [len(at or ()) for at in starts_of]
        columns = dict(
            doc_id=(batch.column(0), None), n_sentences=(counts, "int64"), n_removed=(removed, "int64"),
            n_spans=(spans, "int64"), kept_sha256=(digests, "string"),
        )
        return record_batch(**columns, **({"kept_text": (texts, "string")} if with_text else {}))

    joined = rows.join(starts, "row", "left").select("doc_id", utf8("text").alias("data"), "starts")
    kind = dict(joined.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_sentences long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(joined, cut, schema + (", kept_text string" if with_text else ""))
