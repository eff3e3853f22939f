"""Language identification by compression with one raw-content dictionary per language.

A text is compressed with each language's dictionary, a long one in blocks that each start from it;
the language whose dictionary leaves the fewest bytes is the prediction, and where the runner-up needs
hardly more, the text is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, free_name, map_batches

by_value(__name__)

UNDETERMINED = "und"
SAMPLE_PARTS = 16


@dataclass(frozen=True)
class LanguageParams:
    """``dictionary_bytes`` of each language are learned from at most ``sample_rows`` labelled texts,
    at most ``sample_chars`` characters of each: the bounds of the training sample. A language needs
    no least number of texts. ``margin``: share of its bytes by which the runner-up must be longer.
    Texts whose lead is below ``close`` are compressed again at ``close_level``; those of fewer than
    ``short_bytes`` behind each of a few ``primers`` cut from the dictionary: a block that compresses
    anyway shows what the text adds, where a short text alone would be stored as it is. Longer texts
    than ``block_bytes`` are compressed in equal blocks of that size at most and the bytes summed up: a
    dictionary helps only near the start of a block, so the lead stays a like share at every length."""

    dictionary_bytes: int = 64 << 10
    sample_rows: int = 400
    sample_chars: int = 600
    level: int = 6
    margin: float = 0.002
    close: float = 0.04
    close_level: int = 12
    primers: int = 4
    primer_bytes: int = 256
    short_bytes: int = 1024
    block_bytes: int = 32 << 10


def normalised(text: str) -> bytes:
    """Lower-cased letters; all between words becomes one space."""
    import re

    return re.sub(r"[\W\d_]+", " ", text.lower()).strip().encode("utf-8", "replace")


def held_out(column: str = "doc_id"):
    """Rows whose crc32 of the id, as text, leaves 2 modulo 4. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_dictionaries(docs: DataFrame, params: LanguageParams = LanguageParams()) -> dict[str, bytes]:
    """Dictionary of every non-null ``lang`` of ``docs`` (text, lang), from a fixed sample.

    The sample takes the different texts of smallest hash, so it does not depend on order, partitions
    or copies. It and the result are bounded by languages x ``sample_rows`` x ``sample_chars``.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64("text").alias("rank"), "text"
    )
    # Copies count once. First within parts of a language, so that one with most rows is no single task.
    chosen = rows.select("lang", "rank").distinct().withColumn("part", F.pmod("rank", F.lit(SAMPLE_PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        order = W.partitionBy(*keys).orderBy("rank")
        chosen = chosen.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= params.sample_rows)
    sample = (
        rows.join(F.broadcast(chosen.select("lang", "rank", "n")), ["lang", "rank"])
        .groupBy("lang", "n")
        .agg(F.min(F.substring("text", 1, params.sample_chars)).alias("text"))
        .collect()
    )
    out: dict[str, bytes] = {}
    for row in sorted(sample, key=lambda r: (r.lang, r.n)):
        known = out.get(row.lang, b"")
        if len(known) < params.dictionary_bytes:
            # What stands last is cheapest to refer to; texts of the sample are all alike in that.
            out[row.lang] = normalised(row.text) + b" " + known
    return {k: v[: params.dictionary_bytes] for k, v in out.items()}


def predictor(dictionaries: dict[str, bytes], params: LanguageParams):
    """``predict(text) -> (lang, score, rejected)``; compressors are made once in every worker."""
    made: dict = {}

    def compressors(level):
        import zstandard

        if level not in made:
            made[level] = {}
            for lang in sorted(dictionaries):
                content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=level)
                made[level][lang] = zstandard.ZstdCompressor(
                    level=level, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False
                )
        return made[level].items()

    def sizes(data, level):
        step = -(-len(data) // -(-len(data) // params.block_bytes))
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        return sorted((sum([len(c.compress(b)) for b in blocks]), lang) for lang, c in compressors(level))

    def closer_sizes(data):
        """Bytes at the stronger level; for a short text, the mean that it adds to a primer."""
        if len(data) >= params.short_bytes:
            return sizes(data, params.close_level)
        out = []
        for lang, c in compressors(params.close_level):
            known = dictionaries[lang]
            step = max(1, len(known) // params.primers)
            primers = [known[i : i + params.primer_bytes] for i in range(0, len(known), step)]
            if ("alone", lang) not in made:
                made["alone", lang] = [len(c.compress(p)) for p in primers]
            added = [len(c.compress(p + b" " + data)) - n for p, n in zip(primers, made["alone", lang])]
            out.append((sum(added) / len(added), lang))
        return sorted(out)

    def predict(text):
        data = normalised(text) if text else b""
        if not data or not dictionaries or not any(c.isalpha() for c in data.decode()):
            return UNDETERMINED, 0.0, True
        ranked = sizes(data, params.level)
        if len(ranked) == 1:
            return ranked[0][1], 1.0, False
        if ranked[1][0] - ranked[0][0] < params.close * ranked[0][0]:
            ranked = closer_sizes(data)
        best, lang = ranked[0]
        lead = ranked[1][0] - best
        # The odds against the runner-up, a byte of lead doubling them.
        return lang, 1.0 / (1.0 + 2.0 ** -min(lead, 60)), lead == 0 or lead < params.margin * best

    return predict


def identified(docs: DataFrame, dictionaries: dict[str, bytes], params: LanguageParams, names: tuple[str, str, str]):
    """``docs`` with predicted language, score and rejection under ``names``; no shuffle."""
    predict = predictor(dictionaries, params)
    lang, score, rejected = names

    def run(batch):
        import pyarrow as pa

        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        found = list(zip(*[predict(t) for t in texts]))
        for name, values, kind in zip((lang, score, rejected), found, (pa.string(), pa.float64(), pa.bool_())):
            batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values, kind))
        return batch

    rows = docs.withColumns(
        {lang: F.lit(None).cast("string"), score: F.lit(0.0), rejected: F.lit(True)}
    )
    nullable = [f.jsonValue() | {"nullable": True} for f in rows.schema.fields]
    return map_batches(rows, run, type(rows.schema).fromJson({"type": "struct", "fields": nullable}))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out()).select("text", "lang")


def identify_languages(docs: DataFrame, params: LanguageParams = LanguageParams()) -> DataFrame:
    """Predicted language of every whole text.

    Learns from text and lang of the rows not held out; predicts from text alone. One row per row of
    ``docs``: doc_id, held_out, lang_pred (``und`` where the text is null, has no letter, or no
    language was learned), score (0 to 1, chance against the runner-up), rejected (``und``, or the
    margin is narrow). Equal texts get equal results; ties go to the smaller language name.
    """
    base = docs.select("doc_id", "text", "lang")
    dictionaries = learn_dictionaries(training_rows(base), params)
    rows = base.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    out = identified(rows, dictionaries, params, ("lang_pred", "score", "rejected"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, params: LanguageParams = LanguageParams()) -> DataFrame:
    """``docs`` without the rejected rows; all columns stay as they are."""
    dictionaries = learn_dictionaries(training_rows(docs), params)
    names = tuple(free_name(docs, n) for n in ("lang_found", "lang_score", "lang_rejected"))
    out = identified(docs, dictionaries, params, names)
    return out.filter(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])
