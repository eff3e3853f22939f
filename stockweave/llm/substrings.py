"""Exact substring deduplication: bytes of strings of 400 bytes that start more than once.

Windows of ``length`` bytes that are equal have their smallest 64-byte gram, by hash, at the same
offset. So the windows of a document fall into runs around such anchors, and only runs around equal
anchors can hold equal windows.

* A run whose whole context occurs again is a duplicate as it is: copies are counted, not gathered,
  and those that meet in one batch of texts are settled there, so that a short line repeated many
  times over, a run for each, does not fill one task of the join.
* Anchors with several different contexts are cut into narrow cells of window offsets; windows of
  equal cells share a core of bytes. Cells that occur as a whole again are duplicates, cells whose
  core occurs once are unique.
* What is left are cells at the edges of repeats: same core, different fringes. Their fringes, with
  the core as one symbol, are joined and sorted by a suffix array (linear grouping); neighbours that
  agree over a whole window are duplicates.
* A core shared by more cells than one array may hold is cut into single windows, which are counted.

All is judged on the input. Only hashes and positions are shuffled, and the fringes of edge cells;
texts are written once, bucketed by row, so that joins on the row do not move them again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, map_batches, record_batch, utf8
from stockweave.llm.suffixes import suffix_array
from stockweave.session import materialize, scratch_path

by_value(__name__)


@dataclass(frozen=True)
class SubstringParams:
    """``length`` of the strings in bytes, ``gram`` of the anchors; ``cell`` window offsets per cell;
    ``members``: cells of one core in one suffix array at most; ``symbols``: size of an array, about."""

    length: int = 400
    gram: int = 64
    cell: int = 24
    members: int = 512
    symbols: int = 50_000

    @property
    def offsets(self) -> int:
        """A window's anchor lies at one of so many offsets."""
        return self.length - self.gram + 1


BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
#: Windows of a text that are looked at together; longer texts are taken in such segments.
SEGMENT = 1 << 18
POSITION_BITS = 20


def powers(base: int, n: int):
    """base^0 .. base^(n-1) modulo 2^64."""
    import numpy as np

    out = np.ones(n, np.uint64)
    known = 1
    while known < n:
        more = min(known, n - known)
        out[known : known + more] = out[:more] * np.uint64(pow(base, known, 1 << 64))
        known += more
    return out


class Anchors:
    """Runs of windows around their smallest gram, for one text after another."""

    def __init__(self, params: SubstringParams):
        import numpy as np

        self.p = params
        random = np.random.default_rng(400)
        self.letters = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = powers(BASE, 1)
        self.down = self.up

    def runs(self, data: bytes):
        """(gram hash, anchor, first window, last window) arrays of every segment of the text."""
        import numpy as np

        length = self.p.length
        for at in range(0, len(data) - length + 1, SEGMENT):
            part = np.frombuffer(data, np.uint8)[at : at + SEGMENT + length - 1]
            keys, anchor, low, high = self.segment(part)
            yield keys, anchor + at, low + at, high + at

    def segment(self, part):
        import numpy as np

        gram, width, n = self.p.gram, self.p.offsets, len(part)
        if len(self.up) < n:
            self.up = powers(BASE, n)
            self.down = powers(pow(BASE, -1, 1 << 64), n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.letters[part] * self.up[:n], out=sums[1:])
        grams = (sums[gram:] - sums[:-gram]) * self.down[: n - gram + 1]
        # Mixed, so that the smallest is anywhere; the position makes the leftmost of equals smallest.
        mixed = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        low_bits = np.uint64((1 << POSITION_BITS) - 1)
        chosen = (mixed & ~low_bits) | np.arange(len(mixed), dtype=np.uint64)
        # Sliding minimum: of a block's tail and of the next block's head.
        padded = np.full(-(-len(chosen) // width) * width, MASK, np.uint64)
        padded[: len(chosen)] = chosen
        blocks = padded.reshape(-1, width)
        heads = np.minimum.accumulate(blocks, axis=1).ravel()
        tails = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - self.p.length + 1
        anchor = (np.minimum(tails[:windows], heads[width - 1 : width - 1 + windows]) & low_bits).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        last = np.append(first[1:], windows) - 1
        return mixed[anchor[first]].view(np.int64), anchor[first], first, last


def signed(values, kind="int64"):
    """64-bit hashes as Spark's longs."""
    import numpy as np

    return np.array(values, np.uint64).view(np.int64), kind


NODES = "key long, full long, row long, at int, low int, high int, settled boolean"


def repeated_pairs(keys, fulls):
    """Which (key, full) pairs of two arrays occur more than once in them."""
    import numpy as np

    order = np.lexsort((fulls, keys))
    same = (keys[order[1:]] == keys[order[:-1]]) & (fulls[order[1:]] == fulls[order[:-1]])
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    return again


def run_rows(texts: DataFrame, params: SubstringParams) -> DataFrame:
    """A node for every run: hash of its anchor, hash of its whole context, and where it lies;
    ``settled`` where its batch holds it again."""
    anchors = Anchors(params)

    def run(batch):
        import numpy as np
        import xxhash

        digest, length = xxhash.xxh3_64_intdigest, params.length
        parts, fulls = [], []
        for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if data is None or len(data) < length:
                continue
            for keys, at, low, high in anchors.runs(data):
                parts.append((keys, np.full(len(keys), row, np.int64), at, low, high))
                fulls += [
                    digest(data[s : e + length], (a - s) << 20 | e - s)
                    for a, s, e in zip(at.tolist(), low.tolist(), high.tolist())
                ]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
        keys, rows, at, low, high = columns
        wholes, kind = signed(fulls)
        return record_batch(
            key=(keys, "int64"), full=(wholes, kind), row=(rows, "int64"), at=(at, "int32"), low=(low, "int32"),
            high=(high, "int32"), settled=(repeated_pairs(keys, wholes), "bool"),
        )

    return map_batches(texts, run, NODES)


def judged(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that occur again as a whole: (row, low, high); and what stays open: one node for each
    different whole of a key that has several, with their number, ``settled`` where it is a copy."""
    place = ("row", "at", "low", "high")
    # Any one of the copies stands for them; the firsts of one row stay together.
    wholes = nodes.groupBy("key", "full").agg(
        F.count("*").alias("n"), F.max("settled").alias("settled"), *[F.first(c).alias(c) for c in place]
    )
    wholes = materialize(
        wholes.select("key", "full", (F.col("settled") | (F.col("n") > 1)).alias("settled"), "n", *place), "wholes"
    )
    copies = wholes.filter("n > 1").select("key", "full")
    marks = nodes.filter("not settled").join(copies, ["key", "full"]).select("row", "low", "high")
    keys = wholes.groupBy("key").agg(
        F.count("*").alias("members"), F.count_if(~F.col("settled")).alias("single")
    ).filter("members > 1 and single > 0")
    open_nodes = wholes.join(keys.select("key", "members"), "key").select("key", "members", *place, "settled")
    return marks, open_nodes


def by_row(nodes: DataFrame, *columns: str) -> DataFrame:
    """One list of nodes per row; a text has at most a node per byte."""
    return nodes.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("nodes"))


def cells(texts: DataFrame, open_nodes: DataFrame, width: int, params: SubstringParams) -> DataFrame:
    """The open nodes cut into cells of ``width`` window offsets: a node for each, keyed by its core."""
    places = by_row(open_nodes, "at", "low", "high", "settled")
    joined = texts.join(places.hint("shuffle_hash"), "row").select("row", "data", "nodes")

    def run(batch):
        import xxhash

        digest, length, last = xxhash.xxh3_64_intdigest, params.length, params.offsets
        out = []
        for row, data, nodes in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            for node in nodes:
                at, settled = node["at"], node["settled"]
                least, most = at - node["high"], at - node["low"]
                for start in range(least - least % width, most + 1, width):
                    stop = min(start + width, last)
                    a, b = max(least, start), min(most, stop - 1)
                    core = digest(data[at - start : at + length + 1 - stop], start << 20 | stop)
                    full = digest(data[at - b : at + length - a], a << 20 | b)
                    out.append((core, full, row, at, at - b, at - a, settled))
        key, full, row, at, low, high, settled = zip(*out)
        return record_batch(
            key=signed(key), full=signed(full), row=(row, "int64"), at=(at, "int32"), low=(low, "int32"),
            high=(high, "int32"), settled=(settled, "bool"),
        )

    return map_batches(joined, run, NODES)


def fringes(texts: DataFrame, open_cells: DataFrame, params: SubstringParams) -> DataFrame:
    """The bytes before and behind the core of every open cell."""
    places = by_row(open_cells, "key", "at", "low", "high", "settled")
    joined = texts.join(places.hint("shuffle_hash"), "row").select("row", "data", "nodes")

    def run(batch):
        length, width, last = params.length, params.cell, params.offsets
        out = []
        for row, data, nodes in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            for node in nodes:
                at, low, high = node["at"], node["low"], node["high"]
                start = at - high - (at - high) % width
                stop = min(start + width, last)
                out.append((
                    node["key"], row, low, high, node["settled"], stop - start,
                    data[low : at - start], data[at + length + 1 - stop : high + length],
                ))
        key, row, low, high, settled, span, left, right = zip(*out)
        return record_batch(
            key=(key, "int64"), row=(row, "int64"), low=(low, "int32"), high=(high, "int32"), settled=(settled, "bool"),
            span=(span, "int32"), left=(left, "binary"), right=(right, "binary"),
        )

    schema = "key long, row long, low int, high int, settled boolean, span int, left binary, right binary"
    return map_batches(joined, run, schema)


def repeated_windows(members: list[tuple]) -> list[tuple[int, int, int]]:
    """(row, low, high) of the windows of ``members`` (key, row, low, high, settled, span, left, right)
    that another member of the same key has too, by one suffix array over all of them.

    A window of a member is its substring of ``span`` symbols from that window on: bytes of the left
    fringe, the core, bytes of the right one. Bytes are symbols 0 to 255, every core and every end of
    a member is a symbol of its own.
    """
    number = {key: 256 + i for i, key in enumerate(dict.fromkeys(m[0] for m in members))}
    text: list[int] = []
    owner: dict[int, int] = {}
    begins = []
    for k, (key, _, low, high, _, _, left, right) in enumerate(members):
        begins.append(len(text))
        for i in range(len(text), len(text) + high - low + 1):
            owner[i] = k
        text += [*left, number[key], *right, 256 + len(number) + k]
    hit = set()
    previous, known = -1, None
    for suffix in suffix_array(text):
        k = owner.get(suffix)
        if k is None:
            previous = -1
            continue
        window = text[suffix : suffix + members[k][5]]
        if previous >= 0 and window == known:
            hit |= {previous, suffix}
        previous, known = suffix, window
    found = []
    for k, (_, row, low, high, settled, *_) in enumerate(members):
        if not settled:
            found += [(row, low + i, low + i) for i in range(high - low + 1) if begins[k] + i in hit]
    return found


def sorted_edges(edge_cells: DataFrame, params: SubstringParams) -> DataFrame:
    """Repeated windows of the edge cells; all cells of a core meet in one task, at most ``members``."""
    # A stated number of tasks: the cells are few bytes, sorting their suffixes is the work.
    tasks = int(edge_cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = edge_cells.repartition(tasks, "key").sortWithinPartitions("key", "row", "low")

    def run(batches):
        held, symbols = [], 0

        def flush(members):
            found = repeated_windows(members)
            row, low, high = zip(*found) if found else ((), (), ())
            return record_batch(row=(row, "int64"), low=(low, "int32"), high=(high, "int32"))

        for batch in batches:
            for member in zip(*[c.to_pylist() for c in batch.columns]):
                if symbols > params.symbols and member[0] != held[-1][0]:
                    yield flush(held)
                    held, symbols = [], 0
                held.append(member)
                symbols += len(member[6]) + len(member[7]) + 2
        if held:
            yield flush(held)

    return ordered.mapInArrow(run, "row long, low int, high int")


def bucketed_texts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, data) with a number for every row, written once, bucketed and joined by it."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", utf8("text").alias("data"))
    rows.repartition(buckets, "row").write.bucketBy(buckets, "row").option(
        "path", scratch_path(spark, "texts")
    ).saveAsTable(name)
    return spark.table(name)


def repeated_spans(texts: DataFrame, params: SubstringParams) -> DataFrame:
    """(row, low, high): windows from low to high start a string that starts elsewhere too."""
    runs = materialize(run_rows(texts.select("row", "data"), params), "runs")
    near = runs.filter("settled").select("row", "low", "high")
    copies, open_runs = judged(runs)
    first = materialize(cells(texts, open_runs, params.cell, params), "cells")
    again, open_cells = judged(first)
    open_cells = materialize(open_cells, "open_cells")
    edges = sorted_edges(fringes(texts, open_cells.filter(F.col("members") <= params.members), params), params)
    single = cells(texts, open_cells.filter(F.col("members") > params.members), 1, params)
    crowded, _ = judged(materialize(single, "single_windows"))
    return near.unionByName(copies).unionByName(again).unionByName(edges).unionByName(crowded)


def dedup_substrings(docs: DataFrame, params: SubstringParams = SubstringParams(), with_text: bool = False) -> DataFrame:
    """Every document without the bytes that repeated strings cover.

    A string of ``length`` bytes that starts at two or more places, in one or in several documents,
    is removed at all of them. One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and, with ``with_text``, kept (bytes: what is left need not
    be valid UTF-8). Null and short texts lose nothing; null ids stay null; repeated rows are
    documents of their own, so they remove each other.
    """
    texts = bucketed_texts(docs)
    spans = materialize(repeated_spans(texts, params), "repeats")
    packed = F.shiftleft(F.col("low").cast("long"), 32) + F.col("high")
    marks = spans.groupBy("row").agg(F.collect_list(packed).alias("spans"))
    joined = texts.join(marks.hint("shuffle_hash"), "row", "left").select("doc_id", "data", "spans")

    def cut(batch):
        import hashlib

        import numpy as np

        sizes, removed, runs, digests, texts_left = [], [], [], [], []
        for data, spans_of in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = data or b""
            n_removed = n_runs = 0
            kept = data
            if spans_of:
                spans_of = np.sort(np.array(spans_of, np.int64))
                low, high = spans_of >> 32, (spans_of & 0xFFFFFFFF) + params.length
                reach = np.maximum.accumulate(high)
                fresh = np.flatnonzero(np.append(True, low[1:] > reach[:-1]))
                begin, stop = low[fresh], reach[np.append(fresh[1:], len(reach)) - 1]
                n_removed, n_runs = int((stop - begin).sum()), len(begin)
                edges = [0, *np.stack([begin, stop], 1).ravel().tolist(), len(data)]
                kept = b"".join([data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)])
            sizes.append(len(data))
            removed.append(n_removed)
            runs.append(n_runs)
            digests.append(hashlib.sha256(kept).hexdigest())
            texts_left.append(kept)
        columns = dict(
            doc_id=(batch.column(0), None), n_bytes=(sizes, "int64"), n_removed=(removed, "int64"),
            n_spans=(runs, "int64"), kept_sha256=(digests, "string"),
        )
        return record_batch(**columns, **({"kept": (texts_left, "binary")} if with_text else {}))

    kind = dict(joined.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(joined, cut, schema + (", kept binary" if with_text else ""))
