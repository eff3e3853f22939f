"""Near-duplicates, sentence runs and substrings: against comparing everything."""

import hashlib
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import with_clashes
from stockweave.llm.components import connected_components, local_roots
from stockweave.llm.sentences import SentenceParams, dedup_sentences, later_occurrences, sentences
from stockweave.llm.simhash import SimHashParams, fingerprint, keep_one_of_each, links, linked, near_duplicates
from stockweave.llm.substrings import Anchors, SubstringParams, dedup_substrings, repeated_windows, run_rows
from stockweave.llm.suffixes import suffix_array
from stockweave.session import RUNTIME_SETTINGS


def roots_of(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


def plain_fingerprint(text):
    import xxhash

    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x1c", "?").split(" ")
    words = [w for part in words for w in __import__("re").findall("[^\x20\x09-\x0d]+", part)]
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), seed=42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_of_words():
    for text in (None, "", " \n", "One", "a B c", "The quick brown fox jumps over the lazy dog " * 9, "é ü x\u0085y z w v"):
        assert fingerprint(text.encode() if text else None, 4) & (1 << 64) - 1 == plain_fingerprint(text)


def test_spark_hash_is_the_shingle_hash(spark):
    import xxhash

    row = spark.sql("select xxhash64('one two three four') as h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three four", seed=42)


def near_prints(rnd, n):
    import numpy as np

    prints = [0, 15, 31, (1 << 64) - 1]
    while len(prints) < n:
        near = rnd.choice(prints) if rnd.random() < 0.6 else rnd.getrandbits(64)
        for _ in range(rnd.randint(0, 5)):
            near ^= 1 << rnd.randrange(64)
        prints.append(near)
    return np.array(sorted(set(prints)), "<u8")


@pytest.mark.parametrize("block", [3, 64])
def test_tiles_find_all_links(block):
    rnd = random.Random(block)
    prints = near_prints(rnd, 160)
    n = len(prints)
    want = roots_of(n, [(i, j) for i in range(n) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 4])
    place = {int(p): i for i, p in enumerate(prints)}
    edges = []
    halves = [prints[: n // 2], prints[n // 2 :]]
    for a, b in ((0, None), (1, None), (0, 1)):
        x, y = linked(halves[a].tobytes(), halves[b].tobytes() if b is not None else None, 4, block)
        edges += [(place[int(p)], place[int(q)]) for p, q in zip(x, y)]
    assert roots_of(n, edges) == want
    assert len(edges) < 2 * n


def test_components_of_a_table(spark):
    rnd = random.Random(1)
    n = 300
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 180)]
    edges += [(rnd.randrange(200, n), rnd.randrange(200, n)) for _ in range(70)] + [(5, 5)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots_of(n, edges)
    linked_nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert out == {x: want[x] for x in linked_nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_roots():
    import numpy as np

    rnd = random.Random(4)
    edges = [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)]
    a, b = (np.array(x) for x in zip(*edges))
    assert local_roots(90, a, b).tolist() == roots_of(90, edges)


def test_near_duplicates_equal_all_pairs(spark, docs):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rnd.choices(words, k=rnd.randint(1, 120))) for _ in range(30)]
    texts = base + [t.replace("w1 ", "w2 ", 1) for t in base] + base[:5] + [None, "", " "]
    rows = list(enumerate(texts, 10)) + [(None, base[0]), (None, "only here " * 9)]
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = roots_of(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    want = sorted((str(i), f"{p:016x}", str(least[r])) for (i, _), p, r in zip(rows, prints, roots))
    df = with_clashes(docs(rows), "fingerprint", "print", "component_id")
    for params in (SimHashParams(), SimHashParams(tiles=8, tile_rows=6, block=4)):
        got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in near_duplicates(df, params).collect())
        assert got == want
    kept = keep_one_of_each(with_clashes(df, "row", "row_number", "best"))
    assert kept.columns == with_clashes(df, "row", "row_number", "best").columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))


def test_near_duplicates_of_awkward_rows(awkward):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert near_duplicates(awkward.limit(0)).count() == 0
    assert keep_one_of_each(awkward.limit(0)).count() == 0
    assert keep_one_of_each(awkward).count() == 4


def test_tile_links_of_skewed_prints(spark):
    """A chain of near prints: links connect it, and there are far fewer than pairs."""
    chain = [0]
    for i in range(500):
        chain.append(chain[-1] ^ 1 << (i * 7 % 60))
    prints = spark.createDataFrame([(p,) for p in set(chain)], "print long")
    found = links(prints, SimHashParams(tiles=4, block=16))
    assert connected_components(found).select("root").distinct().count() == 1


def plain_sentences(rows, params):
    """(doc, sentences, removed) by going through all documents in order."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        parts = sentences(text.encode(), params) if text else []
        keys = [b" ".join(p.lower().split()) for p in parts]
        sizes = [len(k.split()) for k in keys]
        runs = []
        for i in range(len(parts)):
            ends = [j for j in range(i + params.run, len(parts) + 1) if sum(sizes[i:j]) >= params.least_words]
            runs += [(i, ends[0])] if ends else []
        if not runs and sum(sizes):
            runs = [(0, len(parts))]
        gone = set()
        for i, j in runs:
            key = tuple(keys[i:j])
            if key in seen:
                gone |= set(range(i, j))
            seen.add(key)
        kept = b"".join(p for i, p in enumerate(parts) if i not in gone)
        out[doc] = (len(parts), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_sentences_equal_plain_search(docs):
    rnd = random.Random(6)
    stock = ["A b c d e.", "F g h i j! ", "Klm n o p\n", "q r s t?? ", "U v 3.14 w x. ", "Short. ", "z z z z z z. ", "日本語。", "!! "]
    rows = [(i, "".join(rnd.choice(stock) for _ in range(rnd.randint(0, 14)))) for i in range(40)]
    rows += [(50 + i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 60)))) for i in range(40)]
    for params in (SentenceParams(least_words=9), SentenceParams(least_words=9, longest=4, cut_modulus=2, map_bits=6)):
        got = dedup_sentences(with_clashes(docs(rows), "row", "place", "starts"), params, with_text=True).collect()
        want = plain_sentences(rows, params)
        assert {r.doc_id: (r.n_sentences, r.n_removed, r.kept_sha256) for r in got} == want
        assert sum(r.n_removed for r in got) > 20
        assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_sentences_rejoin():
    rnd = random.Random(8)
    long = "".join(rnd.choice(["word ", "other\t", "third  ", "x\x0b", "\u00a0", "no-break ", "é"]) for _ in range(500))
    for text in ("", "a", "a. b! c?\n\n d", "\n\nx. ", "3.14 is. e.g. that", "...", long, " " * 50, "一。二！三"):
        parts = sentences(text.encode())
        assert b"".join(parts) == text.encode() and all(len(p.split()) <= 12 for p in parts)


def test_marks_without_white_space_take_time_by_their_length():
    began = time.process_time()
    assert sentences(b"." * 400_000) == [b"." * 400_000]
    assert sentences("?!.。。 x".encode() * 2) == ["?!.。。 ".encode(), "x?!.。。 ".encode(), b"x"]
    assert time.process_time() - began < 5


def test_rows_of_a_hot_run_are_split(spark, docs):
    """The join of later runs spreads one run's rows over many tasks."""
    small = RUNTIME_SETTINGS | {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in small}
    rows = docs([(i, f"The very same words for every document. Number {i % 400}.") for i in range(4000)])
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        found = later_occurrences(rows.repartition(8).withColumn("row", F.col("doc_id")), SentenceParams(run=1, least_words=5))
        assert found.count() == 3999
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_passage_is_found_wherever_it_stands(docs):
    """One sentence, short sentences, inside a longer sentence: over 50 words."""
    rnd = random.Random(3)

    def words(n):
        return ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n)]

    passage = words(80)
    shouted = [w + "!!" for w in words(80)]
    rows = [(1, " ".join(passage)), (2, " ".join([*words(30), *passage, *words(30)])), (3, " ".join(words(200))),
            (4, " ".join(shouted)), (5, "Before. " + " ".join([*words(7), *shouted]) + " after"), (6, "Two words."), (7, "Two words.")]
    got = {r.doc_id: r.kept_text for r in dedup_sentences(docs(rows), with_text=True).collect()}
    assert [got[i] for i in (1, 3, 4, 6)] == [dict(rows)[i] for i in (1, 3, 4, 6)] and got[7] == ""
    assert len(got[2].split()) < 60 + 30 and len(got[5].split()) < 40


def test_sentences_of_awkward_rows(docs, awkward):
    rows = {(r.doc_id, r.n_sentences, r.n_removed) for r in dedup_sentences(awkward).collect()}
    assert {r for r in rows if r[2]} == {(4, 1, 1), (None, 1, 1), (5, 5000, 4999)}  # later copies, one word repeated
    assert dedup_sentences(awkward.limit(0)).count() == 0
    passage = "One two three four five. Six seven eight nine. Ten eleven twelve and so on. " * 2
    copies = dedup_sentences(docs([(1, passage), (1, passage), (None, passage), (2, passage + "After. ")]), with_text=True)
    assert sorted(r.kept_text for r in copies.collect()) == ["", "", "After. ", passage]


def test_suffix_array_equals_sorting():
    rnd = random.Random(2)
    for _ in range(800):
        text = [rnd.randint(1, rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randint(0, 40))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_a_long_period():
    text = list(b"abcab" * 900)
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def plain_removed(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def patchwork(rnd, n):
    """Texts cut from a few sources at any place, with edits, repeats inside and shared passages."""
    sources = ["".join(rnd.choice("abcdé \n") for _ in range(400)) for _ in range(4)] + ["xy" * 150, "-" * 300]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            source = rnd.choice(sources)
            a = rnd.randrange(len(source))
            parts.append(source[a : a + rnd.randint(1, 250)])
            if rnd.random() < 0.3:
                parts.append("".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 30))))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("params", [
    SubstringParams(length=40, gram=8, cell=5), SubstringParams(length=40, gram=8, cell=5, members=2, symbols=50),
    SubstringParams(length=30, gram=30, cell=4), SubstringParams(length=50, gram=4, cell=47),
])
def test_substrings_equal_plain_search(docs, params):
    rnd = random.Random(params.cell)
    texts = patchwork(rnd, 90)
    texts += texts[:4]
    got = dedup_substrings(with_clashes(docs(list(enumerate(texts))), "row", "spans", "data"), params, with_text=True).collect()
    want = dict(enumerate(plain_removed([t.encode() for t in texts], params.length)))
    assert {r.doc_id: tuple(r)[1:5] for r in got} == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert sum(r.n_removed for r in got) > 1000


def test_anchors_do_not_depend_on_segments(monkeypatch):
    from stockweave.llm import substrings

    rnd = random.Random(9)
    data = bytes(rnd.choice(b"ab") for _ in range(3000))
    params = SubstringParams(length=60, gram=9)

    def anchors():
        out = {}
        for keys, at, low, high in Anchors(params).runs(data):
            for k, a, s, e in zip(keys.tolist(), at.tolist(), low.tolist(), high.tolist()):
                out.update({w: (k, a) for w in range(s, e + 1)})
        return out

    whole = anchors()
    monkeypatch.setattr(substrings, "SEGMENT", 97)
    assert anchors() == whole and sorted(whole) == list(range(len(data) - 59))


def test_edge_windows():
    members = [
        (7, 1, 0, 2, False, 3, b"ab", b"cd"), (7, 2, 10, 12, False, 3, b"xb", b"cd"), (7, 3, 5, 7, True, 3, b"ab", b"xy"),
        (9, 4, 0, 2, False, 3, b"ab", b"cd"),
    ]
    assert sorted(repeated_windows(members)) == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 11, 11), (2, 12, 12)]


@pytest.mark.parametrize("parts", [1, 5])
def test_repeats_of_a_batch_stay_out_of_the_join(docs, parts):
    rnd = random.Random(parts)
    texts = ["-" * 700, "ab" * 300, *patchwork(rnd, 20)] * 3 + ["-" * 90 + "x", "y" * 39, "z" * 40, "w" * 41]
    frame = docs(list(enumerate(texts))).repartition(parts, "doc_id")
    params = SubstringParams(length=40, gram=8, cell=5)
    got = {r.doc_id: tuple(r)[1:5] for r in dedup_substrings(frame, params).collect()}
    assert got == dict(enumerate(plain_removed([t.encode() for t in texts], params.length)))
    nodes = run_rows(frame.select(F.col("doc_id").alias("row"), F.encode("text", "utf-8").alias("data")), params)
    left = nodes.filter("not settled").groupBy("key", "full").count().agg(F.max("count")).first()[0]
    assert left <= parts < nodes.groupBy("key", "full").count().agg(F.max("count")).first()[0]


def test_substrings_of_awkward_rows(docs, awkward):
    rows = dedup_substrings(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id: r.n_removed for r in rows if r.n_removed} == {5: 300_000}
    assert dedup_substrings(awkward.limit(0)).count() == 0
    long_text = "".join(random.Random(1).choices("abcdefgh", k=700))
    twice = dedup_substrings(docs([(1, long_text), (1, long_text), (None, "z" + long_text)])).collect()
    assert [r.n_bytes - r.n_removed for r in sorted(twice, key=lambda r: r.n_bytes)] == [0, 0, 1]
