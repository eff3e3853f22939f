"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Every run of 13 consecutive words of a benchmark item (the whole item where it has fewer) is a
pattern. Patterns of one length share a shift table over pairs of words and buckets of patterns by
their last pair; a pair that ends no pattern tells how far the search may jump, and only patterns of
a matching bucket and first pair are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, free_name, map_batches, record_batch, utf8

by_value(__name__)

WINDOW = 13
#: Item text, in bytes, whose tables are sent to the tasks at once; more items make more passes.
BLOCK_BYTES = 32 << 20
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(data: bytes | None) -> list[bytes]:
    """Words of UTF-8 text: A-Z lower-cased, any ASCII but letters and digits parts words."""
    return data.translate(LETTERS).split() if data else []


class WuManber:
    """Patterns of one length over word numbers; number 0 is a word that no pattern has."""

    def __init__(self, patterns: dict[tuple[int, ...], list[str]]):
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.default = m - b + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.bucket: dict[tuple[int, ...], dict[tuple[int, ...], list]] = {}
        for pattern, items in patterns.items():
            for end in range(b, m + 1):
                block, jump = pattern[end - b : end], m - end
                if jump < self.shift.get(block, m):
                    self.shift[block] = jump
            heads = self.bucket.setdefault(pattern[m - b :], {})
            heads.setdefault(pattern[:b], []).append((pattern, items))

    def search(self, words: list[int]) -> list[tuple[int, list[str]]]:
        """(first word, item ids) of every occurrence."""
        found = []
        m, b, shift, bucket, default = self.length, self.block, self.shift, self.bucket, self.default
        end, n = m, len(words)
        while end <= n:
            if not words[end - 1]:
                end += m
                continue
            block = tuple(words[end - b : end])
            jump = shift.get(block, default)
            if jump:
                end += jump
                continue
            window = tuple(words[end - m : end])
            for pattern, items in bucket[block].get(window[:b], ()):
                if pattern == window:
                    found.append((end - m, items))
            end += 1
        return found


def tables(items: list[tuple[str, bytes]], window: int) -> tuple[dict[bytes, int], list[WuManber]]:
    """Word numbers and one search table per pattern length."""
    numbers: dict[bytes, int] = {}
    by_length: dict[int, dict[tuple[int, ...], list[str]]] = {}
    for item, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        m = min(window, len(ids))
        for start in range(len(ids) - m + 1) if m else ():
            owners = by_length.setdefault(m, {}).setdefault(tuple(ids[start : start + m]), [])
            if item not in owners:
                owners.append(item)
    return numbers, [WuManber(p) for p in by_length.values()]


def item_blocks(benchmark: DataFrame, block_bytes: int):
    """Item ids and texts, a bounded block at a time. Equal rows count once; null texts have no words."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), utf8("text").alias("data")
    ).filter(F.octet_length("data") > 0)
    total = items.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "data"), F.lit(n)) == k) if n > 1 else items
        yield sorted({(r.item, bytes(r.data)) for r in part.collect()})


def scanned(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, keep: list[str]):
    """``keep`` columns, words and merged hit word spans [start, end, ...], item ids of every row."""
    names = {c: free_name(docs, c) for c in ("scan_data", "scan_spans", "scan_items", "scan_words")}
    data, spans, items, n_words = names.values()
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        utf8("text").alias(data),
        F.lit(0).cast("long").alias(n_words),
        F.array().cast("array<int>").alias(spans),
        F.array().cast("array<string>").alias(items),
    )

    def searcher(shared):
        def search(batch):
            import pyarrow as pa

            numbers, searches = shared.value
            at = {c: batch.schema.get_field_index(c) for c in (data, spans, items, n_words)}
            all_spans, all_items, all_words = [], [], []
            before = zip(batch.column(at[spans]).to_pylist(), batch.column(at[items]).to_pylist())
            for text, (old_spans, old_items) in zip(batch.column(at[data]).to_pylist(), before):
                words = words_of(text)
                ids = [numbers.get(w, 0) for w in words]
                hits = [(s, s + t.length, o) for t in searches for s, o in t.search(ids)]
                edges = sorted([*((s, e) for s, e, _ in hits), *zip(old_spans[::2], old_spans[1::2])])
                merged: list[int] = []
                for s, e in edges:
                    if merged and s <= merged[-1]:
                        merged[-1] = max(merged[-1], e)
                    else:
                        merged += [s, e]
                all_spans.append(merged)
                all_items.append(sorted({*old_items, *(i for _, _, o in hits for i in o)}))
                all_words.append(len(words))
            for column, values, kind in (
                (spans, all_spans, pa.list_(pa.int32())),
                (items, all_items, pa.list_(pa.string())),
                (n_words, all_words, pa.int64()),
            ):
                batch = batch.set_column(at[column], column, pa.array(values, kind))
            return batch

        return search

    spark = docs.sparkSession
    empty = True
    for block in item_blocks(benchmark, block_bytes):
        rows, empty = map_batches(rows, searcher(spark.sparkContext.broadcast(tables(block, window))), rows.schema), False
    if empty:
        rows = map_batches(rows, searcher(spark.sparkContext.broadcast(({}, []))), rows.schema)
    return rows, names


def digest(names: dict[str, str]):
    """n_words, n_hit, n_items, items_sha256, contaminated from the scan's columns."""
    spans, items, n_words = (F.col(names[c]) for c in ("scan_spans", "scan_items", "scan_words"))
    n_hit = F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0), lambda a, x: a + x
    ).cast("long")
    return {
        "n_words": n_words,
        "n_hit": n_hit,
        "n_items": F.size(items).cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", F.array_sort(items)).cast("binary"), 256),
        "contaminated": (n_hit > 0) & (n_hit * 20 >= n_words),
    }


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """How much of every whole document occurs in the benchmark.

    One row per row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence), n_items,
    items_sha256, contaminated (a twentieth of the words or more is hit). Null and empty texts have
    no words and are clean; a null item_id counts as the empty id; repeated documents are judged
    each, repeated items count once; an empty benchmark hits nothing. The benchmark is gathered in
    blocks of bounded size, one search pass over the documents per block, chained without a shuffle.
    """
    rows, names = scanned(docs.select("doc_id", "text"), benchmark, window, block_bytes, ["doc_id"])
    return rows.select("doc_id", *[c.alias(k) for k, c in digest(names).items()])


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay."""
    rows, names = scanned(docs, benchmark, window, block_bytes, docs.columns)
    return rows.filter(~digest(names)["contaminated"]).select(*[F.col(f"`{c}`") for c in docs.columns])
