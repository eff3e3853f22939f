"""Spelling variants: every rare word with the frequent word one edit away.

Near pairs are found by asymmetric q-chunks. One edit in a word cut into two disjoint chunks leaves
one of them whole, and in the rest, cut in two again, one more: so the shorter word of a pair gives
its chunks, the longer one the grams at the places where those can stand, which an edit moves by one
place at most. Words meet where all these chunks are grams, and each meeting is verified.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, record_batch, utf8
from stockweave.session import materialize

by_value(__name__)

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Letters of a run, after A-Z were lower-cased.
LETTERS = "a-zÀ-ÿ"


@dataclass(frozen=True)
class SpellingParams:
    """Words of ``least_letters`` code points and ``least_count`` occurrences; a form occurs at least
    ``ratio`` times as often as the word. ``held_words`` different words wait in a task at most before
    their counts leave it."""

    least_letters: int = 7
    least_count: int = 2
    ratio: int = 10
    held_words: int = 300_000


def word_counts(
    docs: DataFrame, params: SpellingParams = SpellingParams(), change: Callable[[str, str], str] | None = None
) -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, of enough letters and occurrences.

    ``change(doc_id as text, run)`` gives the word to count in place of a run. Counts add up in the
    task, per bounded number of words, and then by partial aggregation: a hot word is a row per task.
    """
    least, held = params.least_letters, params.held_words
    pattern = f"[{LETTERS}]{{{least},}}"

    def run(batches):
        import re
        from collections import Counter

        runs = re.compile(pattern)
        counts: dict = {}

        def rows():
            out = record_batch(word=(list(counts), "string"), n=(list(counts.values()), "int64"))
            counts.clear()
            return out

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(runs.findall(data.translate(LOWER).decode())).items():
                    if change is not None:
                        word = change(doc_id, word)
                        if len(word) < least:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= held:
                    yield rows()
        if counts:
            yield rows()

    named = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), utf8("text").alias("data")
    )
    parts = named.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= params.least_count)


def _cuts(length: Column) -> list[Column]:
    """Where the four pieces of a word of this length begin and end: halves, each halved again."""
    half = F.floor(length / 2).cast("int")
    return [
        F.lit(0), F.floor(half / 2).cast("int"), half, (half + F.floor((length - half) / 2)).cast("int"), length
    ]


def _signatures(words: DataFrame, moved: int) -> DataFrame:
    """(key, piece, start, moved, word, n): what stands around each of four pieces of a word.

    With ``moved`` the word is the longer one by an edit: it is cut as a word one shorter, and what
    follows the piece stands one place further on.
    """
    shorter = (F.length("word") - moved).cast("int")
    cuts = _cuts(shorter)

    def around(i: int) -> Column:
        text = F.concat(
            F.substr("word", F.lit(1), cuts[i]), F.substr("word", cuts[i + 1] + F.lit(1 + moved))
        )
        return F.struct(
            F.xxhash64(F.lit(i), shorter, text).alias("key"), F.lit(i).cast("byte").alias("piece"),
            cuts[i].alias("start"),
        )

    return words.select("word", "n", F.inline(F.array(*[around(i) for i in range(4)]))).withColumn(
        "moved", F.lit(moved)
    )


def near_pairs(words: DataFrame, least_letters: int = SpellingParams.least_letters) -> DataFrame:
    """(word, n, other, other_n) of all pairs one edit apart, each once, the shorter word first (of
    equal lengths the smaller). ``words`` (word, n) are different words of at least ``least_letters``.

    Keys hold three quarters of a word, so a key's words differ in one short piece only; AQE splits
    what is skewed all the same. Meetings never leave the join unverified.
    """
    chunks = _signatures(words, 0)
    longer = words.filter(F.length("word") > least_letters)
    grams = chunks.unionByName(_signatures(longer, 1)).select(
        "key", "piece", "moved", F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    met = chunks.drop("moved").join(grams, ["key", "piece"])
    lengths = F.length("other") - F.length("word") == F.col("moved")
    order = (F.col("moved") == 1) | (F.col("word") < F.col("other"))
    near = F.levenshtein("word", "other", 1) == 1
    # An insertion can fall into several pieces ("ll" at a border): the first one counts.
    first = (F.col("moved") == 0) | (F.col("piece") == 0) | (
        F.substr("word", F.col("start") + 1) != F.substr("other", F.col("start") + 2)
    )
    return met.filter(lengths & order & first & near).select("word", "n", "other", "other_n")


def with_forms(words: DataFrame, pairs: DataFrame, ratio: int = SpellingParams.ratio) -> DataFrame:
    """``words`` (word, n) with n_near, form, form_n: the near word of largest n, the smallest of
    equals, where it occurs at least ``ratio`` times as often as the word."""
    both = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("word").alias("word"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
                F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
            )
        )
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    taken = -F.col("best.less") >= F.col("n") * ratio
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` with root: the last word reached by following forms, the word itself without one.

    A form occurs more often than its word, so forms never turn in a circle. Every round doubles the
    steps followed, and is written.
    """
    ends = materialize(
        formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling_roots"
    )
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = ends.join(onward, "root", "left")
        ends = materialize(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")),
            "spelling_roots",
        )
        if ends.filter("went").isEmpty():
            break
        ends = ends.drop("went")
    return formed.join(ends.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, params: SpellingParams = SpellingParams(), change: Callable[[str, str], str] | None = None
) -> DataFrame:
    """Words of the texts with their more frequent spelling, one row per word.

    word, form (the near word of largest n if that is at least ``ratio`` times the word's n, else
    null), root (from word, follow forms to the last), n (occurrences), n_near (words one inserted,
    deleted or replaced code point away), form_n (form's n or null). Null and empty texts have no
    words; a null doc_id counts as empty text for ``change``; repeated rows count as often as they
    occur; of equally frequent near words the first in code-point order is the form; no text with
    words gives no rows; other columns of ``docs`` are not looked at.
    """
    words = materialize(word_counts(docs, params, change), "spelling_words")
    formed = materialize(with_forms(words, near_pairs(words, params.least_letters), params.ratio), "spelling_forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def dropped_letter(doc_id: str, run: str) -> str:
    """The run, in one of 31 cases by checksum of document and run without one of its letters."""
    import zlib

    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]
