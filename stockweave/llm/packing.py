"""Best-fit packing of tokenised documents into sequences by sums of squares.

Documents are tokenised where they are read. Lengths are then packed in groups of bounded size: a
piece goes where the sum of the squared numbers of open sequences per gap becomes smallest. Pieces of
sequences that a group leaves with a gap are packed again together with those of other groups, until
one group is left or packing again no longer fills sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, map_batches, record_batch
from stockweave.session import materialize

by_value(__name__)

END_ID = 1


@dataclass(frozen=True)
class PackingParams:
    """``group_rows``: pieces packed in one task at most, about; ``least_closed``: share of its
    sequences that a level must close for another one to follow; ``spare``: share of its room that a
    group may leave before best fit is tried; ``cached_words``: bound of a worker's table of known words."""

    capacity: int = 4096
    vocabulary: str = "word_bpe_49k.json"
    group_rows: int = 20_000
    least_closed: float = 0.2
    spare: float = 0.01
    cached_words: int = 400_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Token ids of whole texts, as little-endian 32-bit bytes, word by word.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its
    parts between spaces. Parts of basic Latin letters, digits and marks come apart by a plain rule,
    and each distinct word goes through the vocabulary's model once; all others, and whatever looks
    like a special token, go through the whole tokenizer.
    """

    def __init__(self, path: str, cached_words: int):
        import re

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.bound = cached_words
        self.words: dict[bytes, bytes] = {}
        # Without U+0130, which lower-cases to two characters; up to U+0233 the rest stay in range.
        self.plain = re.compile("[ \t\n\r\x0b\x0c!-~À-ÖØ-öø-įı-ȳ]*")
        letters = "a-zß-öø-ȳ"
        self.split = re.compile(f"[{letters}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{letters}0-9 \t\n\r\x0b\x0c]+")
        # The visible stand-in for every byte: printable Latin-1 as it is, the rest from U+0100 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.stand_in = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        # Kinds of bytes of plain lower-cased text: white space 0, letters 1, marks 2, digits 3.
        self.kinds = bytes(
            0 if b in b" \t\n\r\x0b\x0c" else 3 if 0x30 <= b <= 0x39 else 1 if 0x61 <= b <= 0x7A or b >= 0x80 else 2
            for b in range(256)
        )

    def ids(self, text: str) -> bytes:
        import numpy as np

        if self.plain.fullmatch(text) and "<|" not in text:
            known, learn = self.words.get, self.learn
            return b"".join([known(w) or learn(w) for w in self.runs(text.lower())])
        parts = text.replace("\n", " ").split(" ")
        if len(parts) == 1:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self.ids(part) for part in parts if part])

    def runs(self, text: str) -> list[bytes]:
        """Runs of letters, runs of marks and single digits; words after an apostrophe by the rule."""
        import numpy as np

        if "'" in text:
            return [w.encode() for w in self.split.findall(text)]
        data = text.encode()
        kind = np.frombuffer(data.translate(self.kinds), np.uint8)
        first = np.ones(len(kind), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 3)
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(kind))
        words = kind[starts] > 0
        return [data[s:e] for s, e in zip(starts[words].tolist(), ends[words].tolist())]

    def learn(self, word: bytes) -> bytes:
        if len(self.words) >= self.bound:
            self.words.clear()
        shown = word.decode() if word.isascii() else "".join([self.stand_in[b] for b in word])
        out = self.words[word] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        return out


def token_pieces(docs: DataFrame, params: PackingParams, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 (and ids).

    Null texts are empty; every document ends with the end id, so every document has a piece.
    """
    limit = 4 * params.capacity
    end = END_ID.to_bytes(4, "little")
    made = []

    def cut(batch):
        import zlib

        if not made:
            made.append(WordTokenizer(vocabulary_path(params.vocabulary), params.cached_words))
        rows = []
        for k, text in enumerate(batch.column(1).to_pylist()):
            ids = made[0].ids(text or "") + end
            for piece, at in enumerate(range(0, len(ids), limit)):
                part = ids[at : at + limit]
                rows.append((k, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
        index, piece, start, length, crc, body = zip(*rows)
        columns = dict(
            doc_id=(batch.column(0).take(record_batch(i=(index, "int64")).column(0)), None),
            piece=(piece, "int32"), start=(start, "int64"), length=(length, "int64"), ids_crc32=(crc, "int64"),
        )
        if with_ids:
            columns["ids"] = (body, "binary")
        return record_batch(**columns)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long"
    return map_batches(rows, cut, schema + (", ids binary" if with_ids else ""))


def sum_of_squares(lengths, capacity: int):
    """Bin and offset of every length, in the order given, and the bins' gaps.

    A length s in a bin of gap g takes one bin from gap g and gives one to g - s (nothing, if full);
    a new bin counts as gap ``capacity`` without a cost of its own. The choice with the smallest sum
    of squared counts wins; ties go to the smallest gap left, then to an open bin.
    """
    import numpy as np

    counts = np.zeros(capacity + 1, np.int64)
    at_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    never = np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        change = counts[: capacity + 1 - s] - counts[s:]
        change += 1
        change *= 2
        change[0] = 1 - 2 * counts[s]
        change[counts[s:] == 0] = never
        left = int(change.argmin())
        new = 2 * int(counts[capacity - s]) + 1 if s < capacity else 0
        if change[left] <= new:
            g = left + s
            b = at_gap[g].pop()
            counts[g] -= 1
        else:
            g, left, b = capacity, capacity - s, len(gaps)
            gaps.append(capacity)
        bins[k], offsets[k] = b, capacity - g
        gaps[b] = left
        if left:
            counts[left] += 1
            at_gap[left].append(b)
    return bins, offsets, np.array(gaps, np.int64)


def best_fit(lengths, capacity: int):
    """Like ``sum_of_squares``, every length going where the smallest gap is left."""
    import numpy as np

    at_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, bool)
    gaps: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, s in enumerate(lengths.tolist()):
        g = s + int(filled[s:].argmax())
        if filled[g]:
            b = at_gap[g].pop()
            filled[g] = bool(at_gap[g])
        else:
            g, b = capacity, len(gaps)
            gaps.append(capacity)
        bins[k], offsets[k] = b, capacity - g
        gaps[b] = g - s
        if gaps[b]:
            at_gap[gaps[b]].append(b)
            filled[gaps[b]] = True
    return bins, offsets, np.array(gaps, np.int64)


def group_packer(capacity: int, level: int, spare: float):
    """Packs one group, longest pieces first; every piece has the gap that its sequence is left with.

    Sums of squares keep sequences of all gaps open, for nothing where no lengths fill them: with more
    than ``spare`` of the room left, best fit is tried too and taken if it needs fewer sequences.
    """

    def pack(group):
        import numpy as np
        import pyarrow as pa

        number = group.column("pack_group")[0].as_py()
        row, length = (group.column(c).to_numpy() for c in ("row", "length"))
        order = np.lexsort((row, -length))
        bins, offsets, gaps = sum_of_squares(length[order], capacity)
        if gaps.sum() > spare * capacity * len(gaps):
            other = best_fit(length[order], capacity)
            if len(other[2]) < len(gaps):
                bins, offsets, gaps = other
        batch = record_batch(
            row=(row[order], "int64"), length=(length[order], "int64"),
            sequence_id=((np.int64(level) << 56) + (np.int64(number) << 32) + bins, "int64"),
            offset=(offsets, "int64"), gap=(gaps[bins], "int64"),
        )
        return pa.Table.from_batches([batch])

    return pack


def closing_gap(tried: DataFrame, params: PackingParams) -> int | None:
    """The gap from which on sequences stay open, or None if this level's packing is to be the last.

    Full sequences close. Where they are too few (lengths that hardly ever add up to the capacity),
    those close, too, that no open piece fits into; if even that closes too few, the groups, all drawn
    alike, would come out of another level as they are.
    """
    gap, first = F.col("gap"), F.col("offset") == 0
    made, shortest = tried.agg(F.count_if(first), F.min(F.when(gap > 0, F.col("length")))).first()
    for bound in (1, shortest or 1):
        if tried.filter(first & (gap < bound)).count() >= params.least_closed * made:
            return bound
    return None


def packed(pieces: DataFrame, params: PackingParams) -> DataFrame:
    """``pieces`` (with length) and their sequence_id and offset."""
    columns = pieces.columns
    rows = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    waiting = rows.select("row", "length").withColumn("level", F.lit(0))
    done, level = None, 0
    while True:
        n = waiting.count()
        groups = max(1, -(-n // params.group_rows))

        spread = waiting.withColumn("pack_group", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)))
        tried = materialize(
            spread.groupBy("pack_group").applyInArrow(
                group_packer(params.capacity, level, params.spare), "row long, length long, sequence_id long, offset long, gap long"
            ),
            "packed",
        )
        bound = closing_gap(tried, params) if groups > 1 else None
        kept = (tried if bound is None else tried.filter(F.col("gap") < bound)).select("row", "sequence_id", "offset")
        done = kept if done is None else done.unionByName(kept)
        if bound is None:
            break
        waiting = tried.filter(F.col("gap") >= bound).select("row", "length")
        level += 1
    return rows.join(done, "row").select(*columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, params: PackingParams = PackingParams(), with_ids: bool = False) -> DataFrame:
    """All documents packed into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with
    ``with_ids`` the ids as little-endian 32-bit integers. Only documents longer than a sequence are
    cut. Null and empty texts are one end id; repeated rows are packed each; null ids stay null.
    """
    return packed(token_pieces(docs, params, with_ids), params)
