"""Hard negatives, periodic runs and quality rules against brute force and on hard rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebelt.llm import negatives, periodic, quality, simhash
from orebelt.llm.common import BLANK_WORD, words

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ["row", "anchor", "slot", "vec", "dim", "m", "runs", "found", "body", "lines", "features", "score", "kept", "n_words"]


# hard negatives

VEC = "vec_id long, label int, embedding array<bigint>"


def brute_negatives(rows, anchors, n_positives=5, k=10, low=30, high=90):
    rows = {(i, label, tuple(v)) for i, label, v in rows if None not in (i, label, v) and None not in v and sum(x * x for x in v) < 1 << 56}
    out = []
    for a, a_label, a_vec in rows:
        if not anchors(a):
            continue
        met = [(-sum(x * y for x, y in zip(a_vec, v)), i, label) for i, label, v in rows if i != a and len(v) == len(a_vec)]
        positives = sorted((m, i) for m, i, label in met if label == a_label)[:n_positives]
        for m, i in positives:
            inside = sorted((n, j) for n, j, label in met if label != a_label and low * -m <= 100 * -n <= high * -m)[:k]
            out += [(a, i, r, j, -m, -n) for r, (n, j) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, VEC)
    for name in CLASH:
        df = df.withColumn(name, F.lit("own"))
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 10 == 0, **options).collect()))


def test_negatives_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    monkeypatch.setattr(negatives, "CELL", 64)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 4)), [int(x) for x in rng.integers(-6, 9, 5)]) for i in range(200)]
    rows += [(200 + i, i % 3, [4, 4, 4, 4, 4]) for i in range(60)]  # ties
    rows += [(300 + i, i % 2, [1, 2, 3]) for i in range(25)]  # another length
    rows += rows[:30]  # repeated rows
    rows += [(10, 3, [9, 9, 9, 9, 9]), (None, 1, [1] * 5), (400, None, [1] * 5), (410, 1, None), (420, 1, [1, None, 1, 1, 1]), (430, 1, []), (440, 1, [1 << 40] * 5)]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, n_positives=2, k=3, low=10, high=100) == brute_negatives(rows, lambda i: i % 10 == 0, 2, 3, 10, 100)


def test_negatives_of_large_numbers_are_exact(spark):
    big = 1 << 27
    rows = [(0, 0, [big, 1]), (1, 0, [big, 3]), (2, 0, [big, 2]), (3, 1, [big // 2, 1]), (4, 1, [big // 2, 2]), (5, 1, [-big, 0])]
    assert mined(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_without_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 0, [1, 2])]) == []
    assert mined(spark, [(0, 0, [1, 2]), (1, 0, [-1, -2]), (2, 1, [1, 1])]) == []  # the only positive is below zero


# periodic runs


def brute_runs(seq, min_length=6, exponent=4):
    n, out = len(seq), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and seq[j] == seq[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in out.items())


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        seq = []
        while len(seq) < rng.randint(1, 160):
            piece = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 9))]
            seq += piece * rng.choice([1, 1, 2, 4, 5, 9]) + piece[: rng.randint(0, len(piece))]
        for least, exponent in ((6, 4), (3, 3), (20, 5)):
            assert periodic.runs(np.array(seq), least, exponent) == brute_runs(seq, least, exponent), seq
    assert periodic.runs(np.zeros(0, np.int64)) == []
    with pytest.raises(ValueError):
        periodic.runs(np.array([1, 1]), 6, 2)


def test_runs_of_documents(spark):
    loop = "a b c d e f g h i j k l m n o p q r s t".split()
    texts = {
        1: "x x x x x x x x", 2: "one two " * 6 + "three", 3: " ".join(loop * 5), 4: None, 5: "", 6: "no run in here at all",
        7: " ".join(f"w{i}" for i in range(400)) + " z" * 50_000, 8: "x x x x x x x x", None: "y y y y y y",
    }
    df = spark.createDataFrame([(k, v) for k, v in texts.items()] + [(1, texts[1])], "doc_id long, text string")
    df = df.withColumn("words", words(F.col("text"), BLANK_WORD))
    for name in CLASH:
        df = df.withColumn(name, F.lit("own"))
    found = periodic.find_runs(df).withColumn("out", periodic.collapse(F.col("words"), F.col("kept"))).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        seq = BLANK.findall(texts[r.doc_id] or "")
        want = brute_runs(seq) if len(seq) < 1000 else [(400, 50_000, 1)]
        assert [tuple(x) for x in r.runs] == want
        dropped = {i for s, length, q in want for i in range(s + q, s + length)}
        assert r.out == " ".join(w for i, w in enumerate(seq) if i not in dropped)
        assert r.row == r.body == "own"
    assert periodic.find_runs(df.limit(0)).count() == 0


def test_documents_of_a_batch_do_not_meet(spark, monkeypatch):
    """Equal words at the end of one document and the start of the next are two runs, or none."""
    rows = [(i, ["t"] * 4) for i in range(9)] + [(9, ["t"] * 7)]
    df = spark.createDataFrame(rows, "doc_id long, words array<string>").coalesce(1)
    assert sorted((r.doc_id, len(r.runs)) for r in periodic.find_runs(df).collect()) == [(i, 0) for i in range(9)] + [(9, 1)]


# quality rules


def base(text):
    seq = BLANK.findall(text or "")
    grams = [tuple(seq[i : i + 3]) for i in range(len(seq) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    full = [line for line in (text or "").split("\n") if BLANK.search(line)]
    failed = len(seq) < 50 or 100 * len(hit) > 50 * len(seq)
    return len(seq), sum(map(len, seq)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(hit), failed


def prose(n, seed, mark="", upper=False):
    rng = random.Random(seed)
    out = [w + mark for w in ("".join(rng.choice(["ka", "lo", "mi", "ter", "un", "sä"]) for _ in range(rng.randint(1, 4))) for _ in range(n))]
    out = [w.upper() for w in out] if upper else out
    return "\n".join(" ".join(out[i : i + 12]) for i in range(0, n, 12))


@pytest.fixture(scope="module")
def judged_docs(spark):
    good = [prose(60 + 5 * i, i) for i in range(60)]
    poor = [prose(60 + 5 * i, 100 + i, "###") for i in range(30)] + [prose(60 + 5 * i, 200 + i, "!!", True) for i in range(30)]
    rows = list(enumerate(good + poor))
    labels = [(i, int(t in good)) for i, t in rows if i % 3]
    hard = [(500, None), (501, ""), (502, " \n "), (503, "one two three"), (None, good[0]), (504, "a b c " * 40), (505, prose(40_000, 7)), (0, good[0])]
    hard += [(506, "same line\n" * 3 + prose(80, 9) + "\n\x0b\n\n"), (507, "ÄÖ x " * 30)]
    df = spark.createDataFrame(rows + hard, "doc_id long, text string")
    for name in CLASH:
        df = df.withColumn(name, F.lit("own"))
    marked = spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1)], "doc_id long, quality int")
    return df, marked, len(good), rows


def test_base_statistics_and_verdicts(spark, judged_docs):
    df, labels, n_good, rows = judged_docs
    model = quality.fit(df, labels)
    got = quality.judge(df, model).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id != 505:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text), r.doc_id
        assert r.kept == (not r.base_failed and r.score >= 0.5)
        assert r.row == r.features == r.body == "own"
    held = {r.doc_id: r.kept for r in got if r.doc_id is not None and r.doc_id < len(rows) and r.doc_id % 3 == 0}
    assert all(kept == (i < n_good) for i, kept in held.items())


def test_scores_equal_a_node_by_node_walk_and_only_fall(spark):
    rng = np.random.default_rng(2)
    data = rng.random((3000, len(quality.FEATURES)))
    good = (data[:, 2] + 0.3 * data[:, 0] + 0.2 * rng.standard_normal(3000) < 0.7).astype(float)
    signs = list(quality.FEATURES.values())
    trees = quality.boost(data, good, signs)

    def one(row):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(quality.walk(tuple(trees), data[:200]), [one(r) for r in data[:200]])
    assert ((quality.walk(tuple(trees), data) >= 0.5) == (good > 0)).mean() > 0.85
    for f, sign in enumerate(signs):
        if sign:
            rising = np.repeat(data[:50], 21, axis=0)
            rising[:, f] = np.tile(np.linspace(0, 1, 21), 50)
            assert (sign * np.diff(quality.walk(tuple(trees), rising).reshape(50, 21), axis=1) >= -1e-12).all()


def test_quality_without_labels_or_rows(spark, judged_docs):
    df, labels, _, _ = judged_docs
    for none in (labels.limit(0), labels.where("quality = 1")):
        kept = quality.judge(df, quality.fit(df, none)).where("kept = base_failed").count()
        assert kept == 0
    assert quality.judge(df.limit(0), quality.fit(df.limit(0), labels)).count() == 0
    assert not quality.judge(df, quality.fit(df, labels.where("quality = 0"))).where("kept").count()


# near copies of the pipeline, where no text of a bucket resembles the first one


def test_links_between_blocks_join_what_all_pairs_join():
    rng = np.random.default_rng(4)
    for _ in range(40):
        base = rng.integers(0, 400, (6, 30))
        texts = [np.unique(np.where(rng.random(30) < rng.choice([0.02, 0.1, 0.2]), rng.integers(0, 400, 30), base[rng.integers(0, 6)])) for _ in range(40)]
        comps = rng.integers(0, 30, 40)
        block = lambda at: (np.array(at), comps[at], np.array([len(texts[i]) for i in at]), np.concatenate([texts[i] for i in at]).astype(np.int32))
        root = {int(c): int(c) for c in comps}
        want = dict(root)

        def join(of, x, y):
            a, b = of[int(comps[x])], of[int(comps[y])]
            for c, r in of.items():
                if r == b:
                    of[c] = a

        asking, held = list(range(15)), list(range(40))
        for x in asking:
            for y in held:
                common = len(np.intersect1d(texts[x], texts[y]))
                if common >= 0.8 * (len(texts[x]) + len(texts[y]) - common):
                    join(want, x, y)
        links = simhash._linked(0.8, block(asking), block(held))
        for x, y in links:
            join(root, x, y)
        classes = lambda of: {frozenset(c for c in of if of[c] == r) for r in of.values()}
        assert classes(root) == classes(want)
        assert len(links) <= 29


def test_near_copies_in_a_crowd_that_is_no_copy(spark, monkeypatch):
    """Texts of one family at Jaccard about 0.6 share buckets without being copies; the planted pairs are."""
    monkeypatch.setattr(simhash, "ASKED", 400)
    monkeypatch.setattr(simhash, "HELD", 900)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for n in range(60):
        own = list(base)
        for k in rng.sample(range(120), 6):
            own[k] = f"x{n}-{k}"
        texts[2 * n] = own
        texts[2 * n + 1] = own[:-1] + [f"y{n}"] if n % 2 else [f"{w}-{n}" for w in own]
    sets = {i: {tuple(t[k : k + 5]) for k in range(len(t) - 4)} for i, t in texts.items()}
    root = {i: i for i in texts}
    for i in texts:
        for j in texts:
            if i < j and root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if r == old else r for k, r in root.items()}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    assert {r.doc_id for r in simhash.drop_near_copies(df).collect()} == set(root.values())
    assert len(set(root.values())) < len(texts)


def test_near_copies_are_found_by_fingerprints_too(spark, monkeypatch):
    monkeypatch.setattr(simhash, "bands_for", lambda similarity: 1)
    words = [f"w{i}" for i in range(400)]
    text, near = " ".join(words), lambda a, b: (simhash.fingerprint(a, 3) ^ simhash.fingerprint(b, 3)) & (2**64 - 1)
    edited = (" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(400))
    apart = lambda t: simhash.minhashes(t, 5, 1)[1] != simhash.minhashes(text, 5, 1)[1]
    copy = next(t for t in edited if apart(t) and near(text, t).bit_count() <= 3)
    docs = spark.createDataFrame([(1, text), (2, copy), (3, "quite another text")], "doc_id long, text string")
    assert {r.doc_id for r in simhash.drop_near_copies(docs).collect()} == {1, 3}
