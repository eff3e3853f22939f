"""Toxicity, importance resampling and spelling variants against plain searches."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from conftest import with_clashes

from stockweave.llm import importance, spelling, toxicity

LABELS = "doc_id long, quality int, toxic int"


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, ratio=10):
    form = {}
    close = {w: [v for v in counts if near(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(close[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(close[w]), form[w] and counts[form[w]]) for w, n in counts.items())


def spelled(df):
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: r[0])


class TestSpelling:
    def words(self, spark, counts):
        return spark.createDataFrame(list(counts.items()), "word string, n long")

    def test_near_pairs_against_all_pairs(self, spark):
        rng = random.Random(3)
        words = set()
        while len(words) < 300:
            w = "".join(rng.choice("abé") for _ in range(rng.randint(7, 9)))
            words.add(w)
            k = rng.randrange(len(w))
            words.add(rng.choice([w[:k] + "a" + w[k:], w[:k] + "b" + w[k + 1 :], w[:k] + w[k + 1 :] + "é"]))
        counts = {w: rng.choice([2, 3, 30, 300]) for w in words}
        pairs = spelling.near_pairs(self.words(spark, counts)).collect()
        got = [tuple(sorted((r["word"], r["other"]))) for r in pairs]
        assert len(got) == len(set(got))
        assert set(got) == {tuple(sorted((a, b))) for a in words for b in words if a < b and near(a, b)}

    def test_insertions_at_every_place_come_once(self, spark):
        base = "aaaabbbb"
        words = {base, *(base[:i] + c + base[i:] for i in range(9) for c in "ab")}
        got = spelling.near_pairs(self.words(spark, {w: 2 for w in words})).collect()
        want = [(a, b) for a in words for b in words if a < b and near(a, b)]
        assert len(got) == len(want)

    def test_query_against_plain_search(self, docs):
        rng = random.Random(5)
        vocabulary = ["recieving", "receiving", "receivings", "Straßenbahn", "élevages", "elevages", "shortly"]
        rows = [(i, " ".join(rng.choices(vocabulary, [1, 40, 3, 20, 30, 3, 10], k=60))) for i in range(40)]
        counts = Counter()
        for d, text in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text):
                run = "".join(c.lower() if c.isascii() else c for c in run)
                h = zlib.crc32(f"{d}:{run}".encode())
                counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
        counts = {w: n for w, n in counts.items() if n > 1 and len(w) > 6}
        got = spelled(spelling.spelling_variants(docs(rows), change=spelling.dropped_letter))
        assert got == plain_variants(counts)
        assert any(form for _, form, *_ in got)

    def test_chains_and_ties(self, spark, docs):
        counts = {"aaaaaaaa": 2, "aaaaaaab": 25, "aaaaaabb": 300, "aaaaaaba": 25, "bbbbbbbb": 9}
        text = " ".join(w for w, n in counts.items() for _ in range(n))
        got = spelled(spelling.spelling_variants(docs([(1, text)])))
        assert got == plain_variants(counts)
        roots = {w: (form, root) for w, form, root, *_ in got}
        assert roots["aaaaaaaa"] == ("aaaaaaab", "aaaaaabb")  # the smaller of two equally frequent ones

    def test_awkward_rows(self, docs, awkward):
        got = spelled(spelling.spelling_variants(with_clashes(awkward, "word", "n", "form", "key")))
        assert got == []
        long = docs([(None, "abcdefgh " * 30_000 + "abcdefgx " * 2), (None, None), (1, ""), (2, "x" * 100_000), (2, "x" * 100_000)])
        got = spelled(spelling.spelling_variants(long))
        assert [r[:1] + r[3:5] for r in got] == [("abcdefgh", 30_000, 1), ("abcdefgx", 2, 1), ("x" * 100_000, 2, 0)]
        assert spelled(spelling.spelling_variants(docs([]))) == []


def plain_importance(rows, items, p=importance.ImportanceParams()):
    def runs(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        return len(ws), [" ".join(ws[i : i + k]) for k in (1, 2, 3) for i in range(len(ws) - k + 1)]

    def bucket(g):
        return zlib.crc32(g.encode()) % p.buckets

    docs = [(d, *runs(t)) for d, t in rows]
    s = Counter(bucket(g) for _, _, gs in docs for g in gs)
    t = Counter(bucket(g) for x in items for g in runs(x)[1])
    whole_s, whole_t = sum(s.values()) + p.buckets, sum(t.values()) + p.buckets
    out = []
    for d, n, gs in docs:
        w = sum(math.floor(1000 * math.log((t[b] + 1) * whole_s / ((s[b] + 1) * whole_t))) for b in map(bucket, gs))
        h = int(sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(gs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((i for i in range(len(out)) if out[i][1] >= 20), key=lambda i: (-out[i][4], out[i][0] is None, out[i][0]))
    rank = {i: k + 1 for k, i in enumerate(order[: 5 * len(order) // 100])}
    return [r + (rank.get(i),) for i, r in enumerate(out)]


def by_text(rows):
    return sorted(map(str, rows))


class TestImportance:
    def corpus(self, n=60):
        rng = random.Random(9)
        common, special = [f"w{i}" for i in range(50)], [f"Spécial{i}" for i in range(20)]
        return [(i, " ".join(rng.choices(special if i % 9 == 0 else common, k=rng.randint(1, 60)))) for i in range(n)], [
            " ".join(rng.choices(special, k=30)) for _ in range(10)
        ]

    @pytest.mark.parametrize("segment", [400_000, 7, 2])
    def test_against_plain_search(self, spark, docs, segment):
        rows, items = self.corpus()
        target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
        p = importance.ImportanceParams(segment_words=segment, piece_bytes=9 if segment < 9 else 4 << 20)
        got = importance.importance_ranks(docs(rows), target, p)
        assert by_text(tuple(r) for r in got.collect()) == by_text(plain_importance(rows, items))

    def test_checksums_by_length(self):
        rng = np.random.RandomState(1)
        buffer = rng.randint(0, 256, 5_000).astype(np.uint8)
        starts = rng.randint(0, 2_000, 300)
        lengths = rng.choice([0, 1, 2, 5, 17, 1_500], 300)
        got = importance.checksums(buffer, starts, lengths, matrix_bytes=64)
        assert got.tolist() == [zlib.crc32(buffer[s : s + n].tobytes()) for s, n in zip(starts, lengths)]

    def test_resample_prefers_the_target(self, spark, docs):
        rows, items = self.corpus(400)
        target = spark.createDataFrame([(t,) for t in items], "text string")
        p = importance.ImportanceParams(percent=10)
        base = with_clashes(docs(rows), "rank", "score")
        drawn = importance.resample(base, target, p)
        assert drawn.columns == base.columns
        ids = [r["doc_id"] for r in drawn.collect()]
        enough = sum(len(t.split()) >= 20 for _, t in rows)
        assert len(ids) == enough // 10 and sum(i % 9 == 0 for i in ids) > 0.9 * len(ids)

    def test_awkward_rows(self, spark, docs, awkward):
        rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
        target = spark.createDataFrame([(None,), ("one two",), ("",)], "text string")
        got = importance.importance_ranks(with_clashes(awkward, "rank", "place", "bucket"), target)
        assert by_text(tuple(r) for r in got.collect()) == by_text(plain_importance(rows, [None, "one two", ""]))
        empty = target.filter("false")
        assert importance.importance_ranks(docs([]), target).collect() == []
        assert {r["weight"] for r in importance.importance_ranks(docs([(1, "")]), empty).collect()} == {0}
        many = [(i % 3, "same text again and again, " * 5) for i in range(60)] + [(None, "same text again and again, " * 5)] * 40
        got = importance.importance_ranks(docs(many), target).collect()
        assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
        assert by_text(tuple(r) for r in got) == by_text(plain_importance(many, [None, "one two", ""]))

    def test_one_very_long_run_of_letters(self, docs, spark):
        rows = [(1, "x" * 50_000 + " y " + "z" * 50_000)]
        target = spark.createDataFrame([("y",)], "text string")
        got = importance.importance_ranks(docs(rows), target).collect()
        assert by_text(tuple(r) for r in got) == by_text(plain_importance(rows, ["y"]))


class TestToxicity:
    BAD = ("vilest", "RotTen")

    def corpus(self, spark, docs, n=600):
        rng = random.Random(4)
        words = [f"w{i}" for i in range(400)]
        rows, labels = [], []
        for i in range(n):
            ws = rng.choices(words, k=40)
            bad = i % 5 == 1
            if bad:
                ws[rng.randrange(40)] = rng.choice(self.BAD) + "!!"
            rows.append((i, " ".join(ws)))
            labels.append((i, 1, int(bad)))
        return docs(rows), spark.createDataFrame(labels, LABELS), {i: y for i, _, y in labels}

    def test_held_out_accuracy(self, spark, docs):
        base, labels, truth = self.corpus(spark, docs)
        got = toxicity.score_toxicity(base, labels).collect()
        held = [r for r in got if r["held_out"]]
        assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
        assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
        assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)

    def test_labels_of_held_out_rows_change_nothing(self, spark, docs):
        base, labels, _ = self.corpus(spark, docs, 200)
        held = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
        other = labels.selectExpr("doc_id", "quality", f"CASE WHEN {held} THEN 1 - toxic ELSE toxic END AS toxic")
        assert toxicity.learn_weights(base, labels) == toxicity.learn_weights(base, other)

    def test_few_weights(self, spark, docs):
        base, labels, _ = self.corpus(spark, docs)
        weights = toxicity.learn_weights(base, labels)
        _, bad = toxicity.hashed_features(list(self.BAD), toxicity.ToxicityParams())
        assert all(weights[int(b)] > 1 for b in bad) and len(weights) < 300

    def test_state_equals_the_published_steps(self):
        """Follow-the-regularised-leader, one coordinate at a time."""
        p = toxicity.ToxicityParams(alpha=0.7, beta=1.0, l1=0.3, l2=0.1)
        rng = random.Random(1)
        rows = [(sorted(rng.sample(range(6), 3)), rng.randint(0, 1)) for _ in range(40)]
        z, n = [0.0] * 6, [0.0] * 6
        for at, y in rows:
            w = {
                i: 0.0 if abs(z[i]) <= p.l1
                else -(z[i] - math.copysign(p.l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)
                for i in at
            }
            g = (1 / (1 + math.exp(-sum(w.values()))) - y) * (p.toxic_weight if y else 1)
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / p.alpha * w[i]
                n[i] += g * g
        got_z, got_n = np.zeros((2, 6))
        toxicity.ftrl_pass([(np.array(at), y) for at, y in rows], got_z, got_n, p)
        assert np.allclose(got_z, z) and np.allclose(got_n, n)

    def test_skip_grams(self):
        p = toxicity.ToxicityParams()
        features = {t: set(toxicity.hashed_features([t], p)[1].tolist()) for t in ("a b c", "a x c", "c b a", "A, b! c")}
        # Three words, two neighbours, one pair around a gap.
        assert len(features["a b c"]) == 6 and features["a b c"] == features["A, b! c"]
        assert len(features["a b c"] & features["a x c"]) == 3 and len(features["a b c"] & features["c b a"]) == 3

    def test_awkward_rows(self, spark, docs, awkward):
        base, labels, _ = self.corpus(spark, docs, 100)
        labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (2, 1, None), (4, 0, 7), (3, 1, 1), (3, 1, 1)], LABELS))
        rows = with_clashes(awkward.unionByName(base), "score", "label", "toxic")
        got = toxicity.score_toxicity(rows, labels).collect()
        assert len(got) == awkward.count() + base.count()
        by_id = {}
        for r in got:
            by_id.setdefault(r["doc_id"], set()).add(r["score"])
        assert len(by_id[4] - by_id[None]) <= 1
        assert toxicity.score_toxicity(docs([]), labels).collect() == []
        unlabelled = toxicity.score_toxicity(awkward, labels.filter("false")).collect()
        assert {(r["score"], r["predicted"]) for r in unlabelled} == {(0.5, 1)}
