"""Secret scans: every rule in one pass of a combined deterministic automaton.

Rules are compiled on the driver by subset construction and minimisation (``automaton``) and sent
with the task; documents are scanned where they are read, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.automaton import Automaton, Pattern, RuleScanner
from stockweave.llm.common import by_value, free_name, map_batches, record_batch, utf8

by_value(__name__)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least``: bytes that the match must have after what ``head`` matches."""

    kind: str
    pattern: str
    fold: bool = False
    least: int = 0
    head: str | None = None


# Rule patterns. The first three kinds are the base ones.
# ``fold`` is harmless in the first: its value class has both cases of every letter.
ASSIGNED = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", ASSIGNED + r"[A-Za-z0-9+/_.=-]+", fold=True, least=8, head=ASSIGNED),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")
NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of no bytes

SCHEMA = "{id} {type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def kept_spans(scanner: RuleScanner, heads: list, rules: tuple, data: bytes) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes, ordered, without the matches that are too short."""
    out = []
    for rule, start, end in scanner.spans(data):
        length = end - start
        if heads[rule]:
            length -= heads[rule].longest(data, range(start, end))
        if length >= rules[rule].least:
            out.append((start, rule, end))
    return sorted(out)


def compiled(rules: tuple[Rule, ...]):
    scanner = RuleScanner([(r.pattern, r.fold) for r in rules])
    heads = [Automaton([Pattern(r.head, r.fold)], search=False) if r.head else None for r in rules]
    return scanner, heads


def code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as code point spans."""
    if data.isascii():
        return spans
    at = {}
    count = last = 0
    for edge in sorted({e for s, _, t in spans for e in (s, t)}):
        count += len(data[last:edge].decode("utf-8", "replace"))
        at[edge], last = count, edge
    return [(at[s], rule, at[t]) for s, rule, t in spans]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of every rule in every whole text.

    Returns one row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256 and spans
    (kind:start:end in code points, by start, then rule). Null and empty texts have no spans; a null
    doc_id stays null; repeated rows are scanned each. Only doc_id and text are read.
    """
    scanner, heads = compiled(rules)
    kinds = [r.kind for r in rules]

    def scan(batch):
        import hashlib

        counts: dict[str, list[int]] = {k: [] for k in BASE_KINDS}
        digests, texts = [], []
        for data in batch.column(1).to_pylist():
            spans = code_points(data, kept_spans(scanner, heads, rules, data)) if data else []
            base = [f"{kinds[r]}:{s}:{e}" for s, r, e in spans if kinds[r] in BASE_KINDS]
            for k in BASE_KINDS:
                counts[k].append(sum(kinds[r] == k for _, r, _ in spans))
            digests.append(hashlib.sha256(",".join(base).encode()).hexdigest() if base else NOTHING)
            texts.append(",".join(f"{kinds[r]}:{s}:{e}" for s, r, e in spans))
        return record_batch(
            doc_id=(batch.column(0), None),
            n_assign=(counts["assign"], "int64"),
            n_access=(counts["access"], "int64"),
            n_hex=(counts["hex"], "int64"),
            base_sha256=(digests, "string"),
            spans=(texts, "string"),
        )

    rows = docs.select(F.col("doc_id"), utf8("text").alias("data"))
    return map_batches(rows, scan, SCHEMA.format(id="doc_id", type=dict(rows.dtypes)["doc_id"]))


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[{kind}]") -> DataFrame:
    """``docs`` with every span replaced by its mask; overlapping spans count as the first of them.

    Columns and rows stay; null stays null. n_chars, where there, is counted again for changed texts.
    """
    scanner, heads = compiled(rules)
    clean = free_name(docs, "masked_text")

    def cover(batch):
        import pyarrow as pa

        at = batch.schema.get_field_index(clean)
        out = []
        for data in batch.column(at).to_pylist():
            spans = kept_spans(scanner, heads, rules, data) if data else []
            if spans:
                parts, done, i = [], 0, 0
                while i < len(spans):
                    start, rule, end = spans[i]
                    i += 1
                    while i < len(spans) and spans[i][0] < end:
                        end = max(end, spans[i][2])
                        i += 1
                    parts += [data[done:start], mask.format(kind=rules[rule].kind).encode()]
                    done = end
                data = b"".join([*parts, data[done:]])
            out.append(data)
        return batch.set_column(at, clean, pa.array(out, pa.binary()))

    rows = docs.withColumn(clean, utf8("text"))
    # The masked bytes are valid UTF-8: spans are ASCII.
    masked = map_batches(rows, cover, rows.schema)
    text = F.col(clean).cast("string")
    changed = ~F.col("text").eqNullSafe(text)
    return masked.select(
        *[
            text.alias(c) if c == "text"
            else F.when(changed, F.char_length(text).cast(t)).otherwise(F.col(c)).alias(c) if c == "n_chars"
            else F.col(f"`{c}`")
            for c, t in docs.dtypes
        ]
    )
