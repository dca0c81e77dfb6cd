"""Operators of the subpackage on small fixtures: brute force, round trips and hard rows."""

from __future__ import annotations

import math
import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from orebelt.llm import ann, chat, components, decontaminate, language, licenses, lines, mixing, mixlm, queries, simhash, tokens

DATA = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside under the same names.
CLASH = ["row", "_key", "_id", "key", "k", "gone", "lines", "lang_pred", "score", "fp", "h", "w"]


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(["ka", "lo", "mi", "ter", "un", "sa"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, clashing columns."""
    long = " ".join(words(30_000, 1))
    rows = [
        (1, "One text of a few words.", "en", "a", 24),
        (1, "One text of a few words.", "en", "a", 24),
        (2, None, "en", "a", None),
        (None, "A text without an id", None, None, 20),
        (None, "A text without an id", None, None, 20),
        (3, "", "en", "b", 0),
        (4, " \n\t ", None, "b", 4),
        (5, long, "en", "c", len(long)),
        (6, "x" * 5000, "en", "c", 5000),
        (7, "one", "en", None, 3),
        (8, "1234 !!", "en", "d", 7),
    ]
    df = spark.createDataFrame(rows, DOC)
    for name in CLASH:
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def empty(spark, schema=DOC):
    return spark.createDataFrame([], schema)


def key(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLE])
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = con.sql(queries.ORACLE[name])
    order = [found.columns.index(c) for c in columns]
    want = [[row[i] for i in order] for row in found.fetchall()]
    assert sorted(map(key, got.select(columns).collect())) == sorted(map(key, want))


# nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    data = (centres[rng.integers(0, 6, 600)] + 0.6 * rng.normal(size=(600, 24))).astype(np.float32)
    data[100:180] = data[0]  # ties: 81 equal vectors
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(data)]
    rows += [(1000, None, 0), (1100, [0.0] * 24, 0), (1200, [float("nan")] + [1.0] * 23, 0), (1300, [float("inf")] + [1.0] * 23, 0), (1400, [1.0] * 7, 0), (1500, [None] + [1.0] * 23, 0)]
    got = ann.neighbours(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    exact = data.astype(float)
    hits = total = 0
    for q in range(0, 600, 20):
        dist = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(600), dist)) if i != q][:10]
        mine = sorted(by[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(abs(r.score - dist[r.vec_id]) < 1e-12 for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & set(order))
        total += 10
    assert set(by) == set(range(0, 600, 20))
    assert hits / total >= 0.9
    assert [r.vec_id for r in sorted(by[0], key=lambda r: r["rank"])] == list(range(100, 110))


def test_nearest_of_few_vectors(spark):
    assert ann.neighbours(vectors(spark, []), F.lit(True)).count() == 0
    two = vectors(spark, [(0, [1.0, 2.0], 0), (1, [1.0, 3.0], 0), (1, [1.0, 3.0], 0), (None, [5.0, 5.0], 0)])
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.neighbours(two, F.lit(True)).collect()) == [(0, 1, 1, 1.0), (1, 1, 0, 1.0)]


# licenses


def test_licenses(spark, hard):
    mit = licenses.TEMPLATES["MIT"][0]
    rows = [
        (1, f"Some text\n{mit}\nmore"), (1, f"Some text\n{mit}\nmore"), (2, "nothing here"), (3, None), (4, ""),
        (5, licenses.TEMPLATES["Apache-2.0"][1]), (6, "Licensed under the Apache License, Version 1.1."),
        (None, "a\n" * 50 + "This work is licensed under the GNU General Public License, version 3."),
        (7, "The driver's license was lost."),
    ]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((str(r.doc_id), r.line, r.license, r.exact) for r in got)
    assert found.count(("1", 2, "MIT", True)) == 2
    assert ("5", 1, "Apache-2.0", True) in found and ("None", 51, "GPL-3.0", True) in found
    assert ("6", 1, "Apache-2.0", False) in found
    assert not [f for f in found if f[0] in ("2", "3", "4", "7")]
    assert licenses.scan_licenses(hard).count() == 0
    assert licenses.scan_licenses(empty(spark)).count() == 0


def test_wrapped_licenses(spark):
    long = {n: max(f, key=len) for n, f in licenses.TEMPLATES.items() if n in ("MIT", "BSD-3-Clause", "ISC", "MPL-2.0", "Apache-2.0")}
    rows, want = [], []
    for k, (name, form) in enumerate(sorted(long.items())):
        for j, (width, mark) in enumerate([(60, ""), (80, ""), (60, " * "), (72, "// ")]):
            body = "\n".join(mark + x for x in textwrap.wrap(form, width))
            rows.append((10 * k + j, f"first line\n\n{body}\n\n" + " ".join(words(80, k))))
            want.append((10 * k + j, 3, name, True))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.line, r.license, r.exact) for r in got) == want


def test_licenses_at_different_places(spark):
    mit, gpl = (licenses.TEMPLATES[n][1] for n in ("MIT", "GPL-3.0"))
    text = f"{mit} {' '.join(words(20, 3))} {gpl.replace('published', 'issued')} {' '.join(words(20, 4))} {mit}"
    got = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sorted((r.license, r.exact) for r in got) == [("GPL-3.0", False), ("MIT", True), ("MIT", True)]


# chats


def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "<|turn|>user<|sep|>hi<|end|>", "<~|turn|>", "<~~/s> [~INST]", "a\nb", "", None, "[INST", "<s>" * 3, "é😀<|é"]
    rows = [(c, t, ("user", "assistant")[t % 2], tricky[(c + t) % len(tricky)]) for c in range(6) for t in range(5)]
    rows += [(None, None, None, "x"), (99, 1, "assistant", "twice"), (99, 1, "assistant", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df.withColumn("content", chat.text_part(F.col("text"))))
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    texts = {r.conv_id: r.formatted for r in out.collect()}
    for c in {r[0] for r in rows}:
        want = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        assert [(t.role, t.text) for t in back[c].turns] == want
        assert back[c].loss_text == "".join(x for role, x in want if role == "assistant")
        inner = re.sub(r"<\|(turn|sep|end)\|>", "", texts[c])
        assert not re.search(r"<\||</?s>|\[/?INST\]", inner)
        assert texts[c].count("<|turn|>") == len(want)


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, **more: (kind, text, ref, *(more.get(x) for x in ("width", "height", "seconds", "pages")))
    content = [part("text", "see "), part("image", ref="a.png", width=280, height=57), None, part("text", " and "), part("audio", ref="b", seconds=1.5), part("document", ref="c", pages=2), part(None, "end")]
    rows = [(1, 0, "assistant", content), (1, 1, "user", None), (2, 0, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert got[1].formatted == "<|turn|>assistant<|sep|>see <|image|> and <|audio|><|document|>end<|end|><|turn|>user<|sep|><|end|>"
    assert [(a.turn, a.type, a.ref, a.tokens) for a in got[1].attachments] == [(0, "image", "a.png", 30), (0, "audio", "b", 38), (0, "document", "c", 1152)]
    assert got[1].expanded_tokens == 30 + 38 + 1152
    body = got[1].formatted.split("<|turn|>")[1]
    assert [body[s.start : s.start + s.length] for s in got[1].loss] == ["see ", " and ", "end"]
    assert got[2].n_turns == 1 and not got[2].loss
    assert chat.format_chats(empty(spark, f"conv_id long, turn long, role string, content array<{chat.PART}>")).count() == 0


# tokens


def test_tokens_equal_the_library(spark, hard):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(5)
    parts = ["a", "b", "the", " ", "  ", "\n", "é", "😀", "</s>", "<s>", "<0x0A>", "in", "g", "▁", "\t", "ed", "Ａ", "1", "==", "////", "\x00", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["a" * 5000, " " * 3000, "ab" * 4000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("n_tokens", F.lit("own"))
    got = {r.doc_id: r for r in tokens.count_tokens(df, path).collect()}
    for i, t in enumerate(texts):
        n = len(model.encode(t))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 4096), repr(t)
    own = tokens.count_tokens(hard, path).collect()
    assert len(own) == 11 and {r.n_tokens for r in own if not r.text} == {0}
    assert tokens.count_tokens(empty(spark), path).count() == 0


def test_long_words_merge_alike():
    merges = tokens.load(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    some = ["".join(rng.choice("ab▁é1=/tion") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    assert tokens.count_words(some, merges) == [tokens._long(w, merges) for w in some]


# lines


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    docs = [(k, ("aba bab " if k % 3 else "xyz zyx ") * 20, ("l1" if k % 3 else "l0"), "a", 0) for k in range(30)]
    docs += [(100 + k, "q", f"rare{k}", "a", 0) for k in range(5)]
    df = spark.createDataFrame(docs, DOC)
    model = language.fit(df)
    assert model.languages == ["l0", "l1"]
    got = {r.doc_id: r.lang_pred for r in language.identify(df, model).collect()}
    assert all(got[d[0]] == d[2] for d in docs[:30]) and set(got.values()) == {"l0", "l1"}


def test_windows_in_parts(spark, monkeypatch):
    """Windows that many items share, and more windows than one broadcast takes, change no result."""
    common = " ".join(words(10, 1))
    items = spark.createDataFrame([(k, f"{common} {' '.join(words(6, 10 + k))}") for k in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a b {common} c", "en", "a", 0), (2, "nothing here", "en", "a", 0), (3, None, "en", "a", 0)], DOC)
    whole = sorted(map(key, decontaminate.contamination(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 20_000)
    assert sorted(map(key, decontaminate.contamination(docs, items).collect())) == whole
    assert {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(docs, items).collect()} == {1: (10, 60), 2: (0, 0), 3: (0, 0)}


def test_boilerplate_in_a_fixed_place(spark):
    """Headers, footers, blank lines between paragraphs, a passage of several lines; copies stay."""
    head, foot = "Welcome to the daily pages of our small town", "All rights reserved."
    passage = [" ".join(words(20, 9000 + j)) for j in range(3)]
    docs = []
    for k in range(200):
        parts = [" ".join(words(30, 100 * k + j)) for j in range(4)]
        if k % 20 == 0:
            parts[2:2] = passage
        docs.append((k, "\n\n".join([head, *parts, foot]), "en", "a", 0))
    source = [" ".join(words(25, 77_000 + j)) for j in range(6)]
    copies = []
    for k in range(300):  # one word of one line differs
        edited = list(source)
        edited[k % 6] = edited[k % 6].replace(" ", f" edit{chr(97 + k % 26)} ", 1)
        copies.append((1000 + k, "\n".join(edited), "en", "a", 0))
    got = {r.doc_id: r for r in lines.drop_recurring_lines(spark.createDataFrame(docs + copies, DOC), counts=True).collect()}
    for k, text, *_ in docs:
        kept = [x for x in text.split("\n") if x not in (head, foot, *passage)]
        assert got[k].text == "\n".join(kept) and got[k]._n_dropped == (5 if k % 20 == 0 else 2)
    for k, text, *_ in copies:
        assert got[k].text == text


def test_lines(spark, hard):
    rng = random.Random(8)
    body = lambda k: [" ".join(words(rng.randint(5, 30), 1000 * k + j)) for j in range(4)]
    docs = []
    for k in range(8):
        some = body(k)
        some.insert(rng.randint(0, 4), f"Posted on {k}-03-2020 by user{k} in the forum section")
        docs.append((k, "\n".join(some), "en", "a", 0))
    copies = [(100 + k, "\n".join(body(77)[:1] + ["same words in every copy here"] + [" ".join(words(9, 5))]), "en", "a", 0) for k in range(1)]
    copies += [(101 + k, copies[0][1].replace("every", f"e{k}very"), "en", "a", 0) for k in range(12)]
    df = spark.createDataFrame(docs + copies, DOC)
    got = {r.doc_id: r for r in lines.drop_recurring_lines(df, counts=True).collect()}
    for d in docs:
        assert "Posted on" not in got[d[0]].text and got[d[0]]._n_dropped == 1
        assert got[d[0]].text == "\n".join(x for x in d[1].split("\n") if not x.startswith("Posted on"))
    for d in copies:  # copies of one text are no boilerplate
        assert got[d[0]].text == d[1]
    own = lines.drop_recurring_lines(hard)
    assert own.columns == hard.columns
    assert sorted(map(key, own.collect())) == sorted(map(key, hard.collect()))
    assert lines.drop_recurring_lines(empty(spark)).count() == 0


# decontamination


def brute_hits(text, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    mine, hit, found = low(text), set(), set()
    for item, body in items:
        w = low(body)
        for n in {min(10, len(w))} - {0}:
            wins = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
            for i in range(len(mine) - n + 1):
                if tuple(mine[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(mine), len(hit), sorted(found)


def test_decontamination(spark, hard):
    items = [(1, " ".join(words(30, 50))), (2, "Short item here"), (3, None), (4, ""), (10, " ".join(words(30, 50)[5:25])), (11, "é À-la 12 carte")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        " ".join(words(80, 1) + words(30, 50)[3:18] + words(90, 2)), "A SHORT  item, here! and short item here", None, "", "short item",
        " ".join(words(30, 50)[:9]), "é À-la 12 carte", " ".join(words(64, 9) + words(30, 50)), " ".join(words(59, 9) + words(30, 50) + words(200, 4)),
    ]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(0, texts[0], "en", "s", 0), (1, "a clean text", "en", "s", 0), (None, texts[1], None, None, None)]
    df = spark.createDataFrame(rows, DOC)
    for extra in CLASH:
        df = df.withColumn(extra, F.lit("own"))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(df, bench).collect())
    assert got == sorted((str(r[0]), *brute_hits(r[1], items)) for r in rows)
    clean = decontaminate.decontaminate(df, bench)
    assert clean.columns == df.columns
    assert sorted(map(key, clean.collect())) == sorted(key(r) for r in df.collect() if not brute_hits(r.text, items)[1])
    cut = {(r.doc_id, r.text) for r in decontaminate.decontaminate(df, bench, action="span").collect()}
    assert all(not brute_hits(t, items)[1] or brute_hits(t, items)[1] < 10 for _, t in cut)
    assert (1, "a clean text") in cut and (None, "A,!and") in {(d, (t or "").replace(" ", "")) for d, t in cut}
    assert sorted(r.n_hit for r in decontaminate.contamination(hard, bench).collect()) == [0] * 11
    assert decontaminate.contamination(df, bench.limit(0)).count() == len(rows)
    assert decontaminate.contamination(empty(spark), bench).count() == 0


# languages


def test_language(spark, hard):
    rng = random.Random(3)
    syllables = {"en": ["the", "ing", "wh", "ou"], "de": ["sch", "ung", "ä", "ei"], "fr": ["eau", "é", "ou", "qu"], "es": ["ción", "ll", "ez", "ue"]}
    make = lambda k: " ".join("".join(rng.choice(syllables[k]) for _ in range(rng.randint(1, 3))) for _ in range(30))
    rows = [(i, make(k), k, "s", 0) for i, k in enumerate(list(syllables) * 30)]
    df = spark.createDataFrame(rows, DOC)
    held = language.held_out(F.col("doc_id"), 3, 1)
    out = language.held_out(F.col("doc_id"), 3, 1)
    model = language.fit(df.where(~held))
    got = language.identify(df, model).withColumn("out", out).collect()
    assert [r.out for r in got] == [zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got]
    mine = [r for r in got if r.out]
    assert sum(r.lang_pred == r.lang for r in mine) / len(mine) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    own = language.identify(hard, model).collect()
    assert len(own) == 11
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in own if not re.search(r"[^\W\d_]", r.text or ""))
    assert all(r.lang_pred in syllables for r in own if re.search(r"[^\W\d_]", r.text or ""))
    nothing = language.fit(empty(spark))
    assert {(r.lang_pred, r.score) for r in language.identify(df, nothing).collect()} == {("und", 0.0)}
    alone = language.fit(df.where("lang = 'fr'"))
    assert {r.lang_pred for r in language.identify(df, alone).collect()} == {"fr"}


def test_codewords_differ():
    for n in (2, 3, 4, 5, 9, 40):
        code = language.codewords(n)
        assert len({tuple(c) for c in code}) == n
        assert all(len(set(code[:, b])) == 2 for b in range(code.shape[1]))


# near duplicates


def brute_fingerprint(text, width=3):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(spark, hard):
    base = words(300, 4)
    texts = [" ".join(base)] * 3 + [" ".join(base[:k] + ["zz"] + base[k + 1 :]) for k in range(0, 300, 4)] + [" ".join(words(200, 100 + k)) for k in range(40)] + ["", None, "two words", "TWO words"]
    df = spark.createDataFrame([(i * 7 % 1009, t) for i, t in enumerate(texts)], "doc_id long, text string")
    ids = {i * 7 % 1009: brute_fingerprint(t) for i, t in enumerate(texts)}
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            least = min(group[b] for b in ids if (ids[a] ^ ids[b]).bit_count() <= 3)
            if least < group[a]:
                group[a], changed = least, True
    got = {r.doc_id: r for r in simhash.near_groups(df).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in ids.items()}
    assert {i: r.component_id for i, r in got.items()} == group
    assert simhash.near_groups(hard).count() == 11
    assert simhash.near_groups(empty(spark)).count() == 0


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_masks_cover(radius):
    rng = random.Random(radius)
    masks = simhash.covering_masks(radius)
    again = simhash.covering_masks(radius, masks[0])
    assert all(m & masks[0] == masks[0] for m in again)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & flips for m in masks)
        if not flips & masks[0]:
            assert any(not m & flips for m in again)


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    values = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}
    values = sorted(simhash._signed(v) for v in values)
    links = simhash.hamming_links(spark.createDataFrame([(v,) for v in values], "fp long"), 3)
    roots = {r.node: r.root for r in components.components(links).collect()}
    near = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3
    for a in values:
        for b in values:
            if a < b and near(a, b):
                assert roots[a] == roots[b]
    assert all(near(r.a, r.b) for r in links.collect())


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components.components(edges.limit(0)).count() == 0


def test_near_copies_leave_one(spark, hard):
    base = words(300, 14)
    other = words(300, 15)
    texts = {5: base, 6: base, 3: base[:100] + ["zz"] + base[101:], 8: base[:200] + ["yy"] + base[201:], 9: other, 10: words(300, 16)}
    df = spark.createDataFrame([(k, " ".join(w), "en", "s", 0) for k, w in texts.items()], DOC)
    assert {r.doc_id for r in simhash.drop_near_copies(df).collect()} == {3, 9, 10}
    own = simhash.drop_near_copies(hard)
    assert own.columns == hard.columns
    kept = own.collect()
    assert sorted(str(r.text)[:20] for r in kept if (r.text or "").strip()) == sorted({str(r.text)[:20] for r in hard.collect() if (r.text or "").strip()})
    assert sum(not (r.text or "").strip() for r in kept) == 1
    assert simhash.drop_near_copies(empty(spark)).count() == 0


def edited(rng, base, n):
    """A copy of ``base`` with ``n`` words changed, far enough apart to break five shingles each."""
    out = list(base)
    for at in rng.sample(range(0, len(base) // 6), n):
        out[at * 6 + 3] = f"e{rng.random()}"
    return out


def shingle_sets(texts):
    return {k: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))} for k, t in texts.items()}


def test_near_copies_are_complete(spark):
    rng = random.Random(31)
    texts = {}
    for k in range(120):
        base = [f"{w}{rng.randrange(40)}" for w in words(rng.choice([40, 120, 400]), 500 + k)]
        texts[2 * k] = " ".join(base)
        texts[2 * k + 1] = " ".join(edited(rng, base, max(1, round(len(base) * rng.uniform(0.005, 0.03)))))
    sets = shingle_sets(texts)
    copies = {2 * k + 1 for k in range(120) if len(sets[2 * k] & sets[2 * k + 1]) >= 0.8 * len(sets[2 * k] | sets[2 * k + 1])}
    assert 20 < len(copies) < 120
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in texts.items()], DOC)
    assert set(texts) - {r.doc_id for r in simhash.drop_near_copies(df).collect()} == copies


def test_near_copies_that_differ_from_the_first_of_their_bucket(spark):
    rng = random.Random(32)
    texts = {}
    for k in range(6):
        base = [f"{w}{rng.randrange(40)}" for w in words(400, 700 + k)]
        texts |= {60 * k + j: " ".join(edited(rng, base, rng.randint(3, 9))) for j in range(60)}
    sets, root = shingle_sets(texts), {k: k for k in texts}
    for a in texts:
        for b in range(a // 60 * 60, a):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in texts.items()], DOC)
    assert {r.doc_id for r in simhash.drop_near_copies(df).collect()} == set(root.values())
    # one bucket of all: its first text resembles none, the others form two chains
    runs = {0: range(1000, 1040)} | {10 * c + j: range(100 * c + j, 100 * c + j + 40) for c in (1, 2) for j in range(8)}
    members = spark.createDataFrame([(7, k, 0) for k in runs], "bucket long, same long, hub long")
    shingled = spark.createDataFrame([(k, list(v)) for k, v in runs.items()], "same long, shingles array<int>")
    got = components.components(simhash._copies(members, shingled, 0.95))
    assert {r.node: r.root for r in got.collect()} == {10 * c + j: 10 * c for c in (1, 2) for j in range(8)}


# mixing


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = sum(w[s] for s in names if s not in full)
        share = {s: cap * sizes[s] if s in full else rest * w[s] / open_ for s in names}
        above = {s for s in names if s not in full and share[s] > cap * sizes[s]}
        if not above:
            return share
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice([0, 1, 10, 100, 5000]) for k in range(rng.randint(1, 9))} | {None: 7}
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in got} == brute_targets(sizes)


def test_mix(spark, hard):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng.randint(0, 40), i)), "en", rng.choice(["a", "b", "c", None]), 0) for i in range(600)]
    df = spark.createDataFrame(rows, DOC)
    got = mixing.mix(df).collect()
    sizes = Counter()
    taken = Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken == r.copies * r.size <= 3 * r.size
    want = brute_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 40 for s in sizes)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(mixing.mix(hard).collect()) == 11
    assert mixing.mix(empty(spark)).count() == 0


def test_quality_raises_the_odds(spark):
    rows = [(i, "one two three four", "en", "b" if i % 2 else "a", 0) for i in range(4000)]
    good = spark.createDataFrame([(i, 4.0) for i in range(0, 4000, 4)] + [(1, None), (3, -1.0)], "doc_id long, quality double")
    got = mixing.mix(spark.createDataFrame(rows, DOC), weights=(1.0, 3.0), quality=good).collect()
    a = [r for r in got if r.source == "a"]
    share = lambda rows: sum(r.copies > 0 for r in rows) / len(rows)
    assert share([r for r in a if r.doc_id % 4 == 0]) > 1.5 * share([r for r in a if r.doc_id % 4 == 2])


# language model


def test_scores(spark, hard):
    rng = random.Random(4)
    vocabulary = words(120, 1)
    make = lambda: " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = [(i, make().capitalize(), "en", "s", 0) for i in range(200)]
    df = spark.createDataFrame(rows, DOC)
    held = language.held_out(F.col("doc_id"), 7, 2)
    got = {r.doc_id: r for r in mixlm.score_documents(df, ~held).collect()}
    split = lambda t: [*t.lower().split(), None]
    train = Counter(w for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in split(t))
    total, different = sum(train.values()), len(train)
    for i, t, *_ in rows:
        r = got[i]
        base = sum(math.log10((train[w] + 1) / (total + different + 1)) for w in split(t))
        assert r.base_score == pytest.approx(base) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (61, sum(train[w] > 0 for w in split(t)))
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / (len(t.encode()) + 1))
    out = [r for i, r in got.items() if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(r.score for r in out) / sum(-r.n_tokens for r in out) < 4
    random_text = spark.createDataFrame([(1, " ".join(words(60, 999)), "en", "s", 0)], DOC)
    both = mixlm.score_documents(df.unionAll(random_text.withColumn("doc_id", F.lit(10**6))), ~held & (F.col("doc_id") < 10**6))
    assert both.where("doc_id = 1000000").first().bits_per_byte > np.mean([r.bits_per_byte for r in out])
    own = mixlm.score_documents(hard, F.lit(True)).collect()
    assert len(own) == 11 and all(math.isfinite(r.score) and r.score < 0 for r in own)
    assert {r.n_tokens for r in own if not (r.text if "text" in r else "x")} <= {1}
    assert mixlm.score_documents(empty(spark), F.lit(True)).count() == 0
    assert {r.n_known for r in mixlm.score_documents(df.limit(3), F.lit(None)).collect()} == {0}


def small_model():
    rng = np.random.default_rng(1)
    head = {b"some": 0, b"words": 1, b"of": 2, b"it": 3}
    codes = mixlm.Codes.build(rng.integers(0, 50, (256, 256)), [9, 7, 5, 3, 6, 2])
    tables = [rng.integers(-30, 30, 1 << b).astype(np.int8) for b in mixlm.BITS]
    gate = rng.integers(0, mixlm.GATES, 1 << mixlm.BITS[mixlm.GATE]).astype(np.int8)
    return mixlm.Model(codes, head, np.array([9, 7, 5, 3, 0, 2]), rng.integers(-30, 30, codes.nodes).astype(np.int8), tables, gate)


def cost_at(words_, model, place):
    return mixlm.score(mixlm.lay_out([words_], model.head), model)[0][place]


def test_probabilities_sum_to_one():
    model, begin = small_model(), [b"some", b"words"]
    # the third word: those that have a code, the escape, and the end
    after = [cost_at([*begin, w], model, 2) for w in [*model.head, b"zq"]] + [cost_at(begin, model, 2)]
    assert np.exp(-np.array(after)).sum() == pytest.approx(1.0)
    # the third byte of a word that is spelled, its end included
    spelt = [cost_at([*begin, b"zq" + bytes([b])], model, 5) for b in range(256) if b != 32] + [cost_at([*begin, b"zq"], model, 5)]
    assert np.exp(-np.array(spelt)).sum() == pytest.approx(1.0)


def test_scores_bit_by_bit():
    """Blocks, gates, weights and the mix, one bit after another."""
    model, rng = small_model(), random.Random(2)
    text = [rng.choice([b"some", b"words", b"of", b"it", b"zebra", b"q"]) for _ in range(150)]
    laid = mixlm.lay_out([[b"of"], text], model.head)
    got, last = mixlm.score(laid, model, final=True)
    first = int(laid.sizes[0])
    alone = mixlm.lay_out([text], model.head)
    assert all((a[first:] == b).all() for a, b in zip(laid.contexts, alone.contexts, strict=True))  # nothing of another text
    weights, want, at, block = model.weights.copy(), [], 0, mixlm._FIRST
    while at < len(alone.symbol):
        push, seen = np.zeros_like(weights), np.full(mixlm.GATES, 32.0)
        for i in range(at, min(at + block, len(alone.symbol))):
            cost, start = 0.0, model.codes.start[alone.symbol[i]]
            for j in range(start, start + model.codes.length[alone.symbol[i]]):
                node, bit = int(model.codes.node[j]), int(model.codes.bit[j])
                slots = [((int(c[i]) + node * 0x2C1B3C6D) * 0x9E3779B1 % 2**32) >> (32 - b) for c, b in zip(alone.contexts, mixlm.BITS, strict=True)]
                x = np.array([model.first[node], *(t[s] for t, s in zip(model.tables, slots, strict=True))]) / 12
                gate = model.level[slots[mixlm.GATE]]
                p = 1 / (1 + math.exp(-float(weights[gate] @ x)))
                cost -= math.log(p if bit else 1 - p)
                push[gate] += (bit - p) * x
                seen[gate] += 1
            want.append(cost)
        weights += mixlm._RATE * push / seen[:, None]
        at, block = at + block, min(2 * block, mixlm._LARGEST)
    assert got[first:] == pytest.approx(want, rel=1e-3, abs=1e-3) and last[1] == pytest.approx(weights, abs=1e-4)


def test_counts_by_paths(spark):
    """Nodes take whole paths, paths and gates are read in one number, lone counts stay packed."""
    model, rng = small_model(), np.random.default_rng(3)
    codes, symbols = model.codes, rng.integers(0, 5, len(model.codes.start))
    want = Counter()
    for s in np.flatnonzero(symbols):
        for j in range(codes.start[s], codes.start[s] + codes.length[s]):
            want[int(codes.node[j]) * 2 + int(codes.bit[j])] += int(symbols[s])
    got = mixlm._node_counts(codes, symbols, codes.nodes + 7)
    assert len(got) == 2 * (codes.nodes + 7) and {k: int(got[k]) for k in np.flatnonzero(got)} == want
    assert (mixlm._node_counts(codes, symbols + 2**33, codes.nodes) <= mixlm._MOST).all()
    length, before, node, bit = mixlm._steps(codes, np.array([65536, 300, 65541], np.int32))
    assert length.tolist() == codes.length[[65536, 300, 65541]].tolist() and before.tolist() == (np.cumsum(length) - length).tolist()
    at = np.concatenate([np.arange(codes.start[s], codes.start[s] + codes.length[s]) for s in (65536, 300, 65541)])
    assert (node == codes.node[at]).all() and (bit == codes.bit[at]).all()
    assert (model.gating.astype(np.int8) == model.tables[mixlm.GATE]).all() and (model.gating >> 8 == model.level).all()
    pack = lambda *n: mixlm.zstandard.compress(np.array(n, np.int32).tobytes())
    rows = [(1, pack(1, 2)), (2, b"as it came"), (1, pack(2**31 - 2, 5)), (1, pack(7, 0))]
    sums = {r.piece: bytes(r.data) for r in mixlm._summed(spark.createDataFrame(rows, "piece int, data binary"), ["piece"]).collect()}
    assert sums[2] == b"as it came" and np.frombuffer(mixlm.zstandard.decompress(sums[1]), np.int32).tolist() == [2**31 - 1, 7]


# pipeline


def test_stages_keep_columns(spark, hard):
    docs = hard.select(*[c.split()[0] for c in DOC.split(", ")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).where("copies <= 0").count() == 0


def test_pipeline_by_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    one = corpus_pipeline.identify_language(spark, docs, DATA)
    assert {r.doc_id for r in one.collect()} == {i for i, r in rows.items() if re.search(r"[^\W\d_]", r.text or "")}
    three = {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, DATA).collect()}
    texts = {}
    for i, r in sorted(rows.items()):
        texts.setdefault(r.text, i)
    assert three <= set(texts.values())  # of equal texts the smallest id at most
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    kept = [shingles(rows[i].text) for i in three]
    for i in set(rows) - three:  # whatever goes has a copy of similarity 0.8 that stays
        mine = shingles(rows[i].text)
        assert any(len(mine & k) >= 0.8 * len(mine | k) for k in kept)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    four = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, DATA).collect()}
    assert four == {i for i, r in rows.items() if not brute_hits(r.text, bench)[1]}
    assert corpus_pipeline.run(spark, DATA).count() > 0
