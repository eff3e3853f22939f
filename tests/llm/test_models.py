"""Language, packing, neighbours, sharding and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import with_clashes
from stockweave.llm.language import LanguageParams, identify_languages, keep_identified, learn_dictionaries
from stockweave.llm.neighbours import SearchParams, exact_nearest, nearest
from stockweave.llm.packing import PackingParams, WordTokenizer, pack_documents, sum_of_squares, vocabulary_path
from stockweave.llm.sharding import ShardParams, assign_shards, hilbert_index, write_shards

SYLLABLES = {"en": "the ing th er on and wh ou", "de": "der sch ung ein ich heit ü pf", "es": "que ción ado ñ os ía rr ll"}


def prose(rnd, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choices(parts, k=rnd.randint(1, 3))) for _ in range(n)).capitalize() + "."


def test_languages_on_held_out_rows(docs):
    rnd = random.Random(1)
    rows = []
    for i in range(900):
        lang = rnd.choice(list(SYLLABLES))
        rows.append((i, prose(rnd, lang, rnd.randint(3, 80)), lang, "s", 0))
    got = {r.doc_id: r for r in identify_languages(with_clashes(docs(rows), "score", "rejected")).collect()}
    for i, _, lang, *_ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1
    held = [r for r in rows if got[r[0]].held_out]
    right = sum(got[r[0]].lang_pred == r[2] for r in held)
    assert len(held) > 150 and right / len(held) > 0.95
    # Held-out labels are never read.
    wrong = [(i, t, "es" if got[i].held_out else lang, s, n) for i, t, lang, s, n in rows]
    assert {r.doc_id: tuple(r) for r in identify_languages(docs(wrong)).collect()} == {k: tuple(v) for k, v in got.items()}


def test_languages_of_awkward_rows(docs, awkward):
    rows = identify_languages(awkward).collect()
    assert len(rows) == awkward.count()
    by_text = {(r.doc_id, r.lang_pred) for r in rows}
    assert {(1, "und"), (2, "und"), (3, "und"), (7, "und")} <= by_text
    digits = identify_languages(docs([(1, "hello there"), (9, "12 34 ½ _")]))
    assert {r.doc_id: r.lang_pred for r in digits.collect()}[9] == "und"
    unlabelled = docs([(1, "hello", None, None, 5)])
    assert [r.lang_pred for r in identify_languages(unlabelled).collect()] == ["und"]
    assert identify_languages(awkward.limit(0)).count() == 0
    kept = keep_identified(with_clashes(awkward, "lang_found"))
    assert kept.columns == with_clashes(awkward, "lang_found").columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "5", "6", "None"]


def test_copies_do_not_fill_the_sample(docs):
    rnd = random.Random(4)
    rows = [(i, prose(rnd, "en", 40), "en", "s", 0) for i in range(30)]
    copies = [(1000 + i, rows[k][1], "en", "s", 0) for k in range(5) for i in range(200)]
    few = learn_dictionaries(docs(rows).select("text", "lang"), LanguageParams(sample_rows=25))
    many = learn_dictionaries(docs(rows + copies).select("text", "lang"), LanguageParams(sample_rows=25))
    assert few == many and len(few["en"]) > 25 * 60


def test_narrow_margins_are_rejected(docs):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, lang, 30), lang, "s", 0) for i, lang in enumerate(["en", "de", "es"] * 60)]
    rows.append((1000, "zzz", "en", "s", 0))
    params = LanguageParams(margin=1e9)
    assert sum(r.rejected for r in identify_languages(docs(rows), params).collect()) == len(rows)
    assert sum(r.rejected for r in identify_languages(docs(rows)).filter("doc_id < 1000").collect()) == 0


def test_long_texts_are_not_rejected(docs):
    """A dictionary helps only at the start of a text; the lead must not shrink to nothing beside its length."""
    rnd = random.Random(8)
    rows = [(i, prose(rnd, lang, 60), lang, "s", 0) for i, lang in enumerate(["en", "de", "es"] * 100)]
    rows += [(1000 + i, prose(rnd, lang, n), None, "s", 0) for n in (40_000, 700_000) for i, lang in enumerate(["en", "de", "es"], n)]
    got = {r.doc_id: r for r in identify_languages(docs(rows)).filter("doc_id >= 1000").collect()}
    assert len(got) == 6 and not any(r.rejected for r in got.values())
    assert all(got[1000 + n + i].lang_pred == lang for n in (40_000, 700_000) for i, lang in enumerate(["en", "de", "es"]))


ODD = [
    "a", "Th'e", "it's", "don't", "İstanbul", "ſ", "K", "é", "é", "Σας", "ΟΔΟΣ", "<|endoftext|>", "<|x", "1234", "½",
    "日本語", " ", "\t", "\r\n", "\x1c", "\x85", "«q»", "x×y", "😀", "ß", "ŉ", "Ǆ", "Ⱥ", "ȳ", " ", "_-_", "...", "a.b",
    "ⅷ", "​", "\x00", "'", "''s", "'S", "'ll",
]


def test_token_ids_equal_the_whole_tokenizer():
    from tokenizers import Tokenizer

    path = vocabulary_path("word_bpe_49k.json")
    whole, ours = Tokenizer.from_file(path), WordTokenizer(path, 50)
    rnd = random.Random(3)
    for _ in range(2500):
        text = "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 12)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert ours.ids(text) == np.array(ids, "<u4").tobytes(), repr(text)


def test_sum_of_squares_takes_the_smallest_sum():
    rnd = random.Random(5)
    for _ in range(60):
        capacity = rnd.randint(4, 15)
        lengths = np.array([rnd.randint(1, capacity) for _ in range(25)])
        bins, offsets, gaps = sum_of_squares(lengths, capacity)
        level: dict[int, int] = {}
        for k, s in enumerate(lengths.tolist()):
            def squares(b):
                after = level | {b: level.get(b, 0) + s}
                counts = np.bincount([capacity - v for v in after.values()], minlength=capacity + 1)
                return int((counts[1:capacity] ** 2).sum())

            choices = [b for b in [*level, len(level)] if level.get(b, 0) + s <= capacity]
            assert squares(bins[k]) == min(map(squares, choices))
            assert offsets[k] == level.get(int(bins[k]), 0)
            level[int(bins[k])] = level.get(int(bins[k]), 0) + s
        assert [capacity - v for _, v in sorted(level.items())] == gaps.tolist()


@pytest.mark.parametrize("group_rows", [20_000, 25])
def test_packing(docs, awkward, group_rows):
    from tokenizers import Tokenizer

    rnd = random.Random(6)
    whole = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    rows = [(1000 + i, prose(rnd, "en", rnd.choice([3, 20, 60, 150]))) for i in range(150)] + [(i, t) for i, t, *_ in awkward.collect()]
    params = PackingParams(capacity=256, group_rows=group_rows)
    pieces = pack_documents(with_clashes(docs(rows), "piece", "row", "length"), params, with_ids=True).collect()
    sequences: dict[int, list] = {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length and p.start == 256 * p.piece
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 256
    want = sorted(
        (str(i), np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows
    )
    unnamed = b"".join(p.ids for p in sorted((p for p in pieces if p.doc_id is None), key=lambda p: p.length))
    assert unnamed == b"".join(sorted((b for i, b in want if i == "None"), key=len))
    for doc in {i for i, _ in rows if i not in (None, 4)}:
        got = b"".join(p.ids for p in sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.piece))
        assert (str(doc), got) in want
    total = sum(p.length for p in pieces)
    assert len(sequences) <= -(-total // 256) * 1.02 + 1
    assert pack_documents(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("short", [0, 5])
def test_packing_of_lengths_that_never_fill(docs, short):
    """Equal pieces leave the same gap in every sequence; a few short ones fit into it but cannot fill it."""
    rows = [(i, "1 " * 99) for i in range(75)] + [(100 + i, "") for i in range(short)]
    pieces = pack_documents(docs(rows), PackingParams(capacity=256, group_rows=25)).collect()
    assert sorted(p.doc_id for p in pieces) == [i for i, _ in rows]
    assert sorted({p.length for p in pieces}) == [1, 100][not short :]
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for members in sequences.values():
        ends = [offset + length for offset, length in sorted(members)]
        assert [0, *ends[:-1]] == [offset for offset, _ in sorted(members)] and ends[-1] <= 256
    # Of equal pieces, only what one sequence of a group lacks goes on to the next level.
    assert len(sequences) == 38 if not short else len(sequences) <= 38 + 4


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_recall_and_scores(spark):
    rnd = np.random.default_rng(1)
    points = rnd.standard_normal((1500, 24)).astype(np.float32)
    points[900:] = points[:600] + 0.05 * rnd.standard_normal((600, 24)).astype(np.float32)
    points[10] = points[30] = points[7]
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    params = SearchParams(block_rows=300, query_rows=20)
    df = with_clashes(vectors(spark, rows), "rank", "score", "row", "vector")
    got = nearest(df, F.col("vec_id") % 20 == 0, params).collect()
    exact = points.astype(float)
    hits = 0
    for q in range(0, 1500, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        scores = (exact * exact[q]).sum(1)
        want = sorted((i for i in range(1500) if i != q), key=lambda i: (-scores[i], i))[:20]
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(r.score == scores[r.vec_id] for r in mine)
        hits += len(set(want) & {r.vec_id for r in mine})
    assert hits / (75 * 20) > 0.95
    full = exact_nearest(vectors(spark, rows[:200]), F.col("vec_id") == 0, 5).orderBy("rank").collect()
    scores = (exact[:200] * exact[0]).sum(1)
    assert [r.vec_id for r in full] == sorted(range(1, 200), key=lambda i: (-scores[i], i))[:5]


@pytest.mark.parametrize("spread,outlier", [(0.0, 2.0), (0.0, 10.0), (0.25, 1.0), (0.5, 1.0)])
def test_neighbours_recall_of_unequal_norms(spark, spread, outlier):
    rnd = np.random.default_rng(2)
    points = rnd.standard_normal((2000, 48))
    points *= (np.exp(spread * rnd.standard_normal(2000)) / np.linalg.norm(points, axis=1))[:, None]
    points[77] *= outlier
    exact = points.astype(np.float32).astype(float)
    got: dict[int, set] = {}
    for r in nearest(vectors(spark, [(i, p.tolist(), 0) for i, p in enumerate(exact)]), F.col("vec_id") % 20 == 0).collect():
        assert abs(r.score - exact[r.vec_id] @ exact[r.query_id]) < 1e-9
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 2000, 20):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & got[q])
    assert hits / (100 * 20) > 0.95


def test_neighbours_of_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 0), (20, [0.0, 0.0], 0), (40, None, 0), (1, [float("nan"), 1.0], 0), (2, [float("inf"), 1.0], 0),
        (3, [None, 1.0], 0), (4, [], 0), (5, [2.0, 2.0], 0), (6, [2.0, 2.0], 0), (6, [2.0, 2.0], 0), (7, [1.0, 1.0, 1.0], 0),
        (0, [1.0, 0.0], 0), (None, [9.0, 9.0], 0), (60, [3.0, 0.0, 0.0], 0),
    ]
    got = sorted(tuple(r) for r in nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect())
    one = [(0, 1, 5, 2.0), (0, 2, 6, 2.0), (0, 3, 6, 2.0), (0, 4, 0, 1.0)]
    assert got == sorted([*one, *one, (60, 1, 7, 3.0)])
    assert nearest(vectors(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("d,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_is_one_path(d, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
    index = hilbert_index(grid, bits)
    assert sorted(index.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards(spark, docs, awkward, tmp_path):
    rnd = random.Random(7)
    rows = [(i, "x" * rnd.randint(0, 300), rnd.choice("abc"), rnd.choice(["s1", "s2", "s30"]), 0) for i in range(300)]
    rows += [(500, "same", "a", "s1", 0)] * 150
    df = with_clashes(docs(rows).unionByName(awkward), "size", "shard", "row", "curve")
    got = assign_shards(df).collect()
    assert len(got) == df.count()
    by_shard: dict[int, list] = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    sizes = [len(v) for v in by_shard.values()]
    assert set(by_shard) == set(range(40)) and max(sizes) - min(sizes) <= 1
    for members in by_shard.values():
        members.sort(key=lambda r: r.slot)
        assert [r.slot for r in members] == list(range(len(members)))
        assert [r.curve for r in members] == sorted(r.curve for r in members)
    for k in range(39):
        assert by_shard[k][-1].curve <= by_shard[k + 1][0].curve
    texts = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in [r.text for r in df.collect()])
    assert sorted((r.size, r.text_crc32) for r in got) == texts
    few = assign_shards(awkward).collect()
    assert sorted(r.shard for r in few) == [k * 40 // 10 for k in range(10)] and {r.slot for r in few} == {0}
    assert assign_shards(awkward.limit(0)).count() == 0
    # Files hold narrow ranges in several dimensions: fewer pairs than all.
    write_shards(docs(rows), str(tmp_path / "out"), ShardParams(shards=8))
    files = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(str(tuple(r)) for r in files.select("doc_id", "text", "lang", "source", "n_chars").collect()) == sorted(
        str(r) for r in rows
    )
    pairs = files.groupBy("shard").agg(F.count_distinct("source", "lang").alias("n")).collect()
    assert len(pairs) == 8 and sum(p.n for p in pairs) / 8 < 6.5  # of nine


def test_pipeline_stages(spark, docs, awkward, tmp_path):
    rnd = random.Random(11)
    secret = "0123456789abcdef" * 2
    item = prose(rnd, "en", 40)
    clean = [(i, prose(rnd, lang, 60), lang, "s", 1) for i, lang in enumerate(["en", "de", "es"] * 30, 100)]
    rows = clean + [
        (900, clean[0][1], "en", "s", 1), (901, item, "en", "s", 1), (902, f"{prose(rnd, 'en', 40)} token={secret}", "en", "s", 1),
        (903, "123", "en", "s", 1), (904, None, "en", "s", 1),
    ]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        assert out.columns == table.columns
        out.write.parquet(str(tmp_path / name))
        table = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r.text for r in table.collect()}
    ids = {r[0] for r in clean}
    assert set(kept["language_id"]) == ids | {900, 901, 902}
    assert set(kept["simhash_dedup"]) == ids | {901, 902}
    assert set(kept["decontamination"]) == ids | {902} and ids | {902} == set(kept["secret_scan"])
    assert secret not in kept["secret_scan"][902] and "[assign]" in kept["secret_scan"][902]
    assert all(kept["secret_scan"][r[0]] == r[1] for r in clean)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == ids | {902}


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_awkward_tables(spark, awkward, tmp_path, stage):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = corpus_pipeline.STAGES[stage][1]
    df = with_clashes(awkward, "row", "data", "sequence_id")
    out = run(spark, df, str(tmp_path))
    assert out.count() == (5, 4, awkward.count(), awkward.count(), None)[stage] or stage == 4
    assert run(spark, df.limit(0), str(tmp_path)).count() == 0
