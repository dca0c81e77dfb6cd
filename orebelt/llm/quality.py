"""Quality rules: base limits, then gradient-boosted trees over document statistics.

The trees are fitted by histograms of gradients to a bounded sample of labelled documents. On
chosen statistics their score may only fall as the statistic rises, so a document never gains by
more symbols, repeats or shouting. A fitted ensemble is four arrays of nodes; a batch of documents
walks all trees at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.llm.common import BLANK_WORD, words
from orebelt.llm.wordgrams import joined, recurring, slices

#: About this many labelled documents are fitted, those of the smallest id hashes.
SAMPLE = 20_000
#: Trees, their depth, bins of a statistic, shrinkage and regularisation.
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 60, 3, 64, 0.2, 1.0, 8
#: Statistics the trees read, and the way the score may follow each (0: any, -1: only down).
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "mark_share": -1, "upper_share": -1, "digit_share": 0,
    "dup_line_share": -1, "repeat_share": -1, "words_per_line": 0,
}
_BLANKS = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_MARKS = "!?\"'()[]{}/\\@^~+=_-"
_OWN = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]


def repeated_words(lists: pa.Array) -> np.ndarray:
    """Per array of words: how many lie in a three-word window that occurs twice or more."""
    out = []
    for numbers, offsets in slices(lists):
        hit = np.zeros(len(numbers) + 1, np.int64)
        at = np.flatnonzero(joined(joined(recurring(numbers), 1), 1) >= 0)
        for step in range(3):
            hit[at + step] = 1
        out.append(np.diff(np.concatenate(([0], np.cumsum(hit)))[offsets]))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as a column ``row``, with base statistics and features of whole texts (null: empty)."""

    @F.arrow_udf("bigint")
    def repeated(lists: pa.Array) -> pa.Array:
        return pa.array(repeated_words(lists), pa.int64())

    body = F.coalesce(F.col(text), F.lit(""))
    without = lambda c, drop: F.length(F.translate(c, drop, ""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body.alias("body"), words(body, BLANK_WORD).alias("words"))
    lined = rows.withColumn("lines", F.filter(F.split("body", "\n", -1), lambda line: line.rlike(BLANK_WORD)))
    size = F.length("body")
    counted = lined.select(
        "row", repeated("words").alias("n_repeat_words"), F.size("words").cast("long").alias("n_words"),
        without("body", _BLANKS).cast("long").alias("word_chars"),
        (size - without("body", _SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        (size - without("body", _MARKS)).alias("n_marks"),
        (size - without("body", "0123456789")).alias("n_digits"),
        F.length(F.regexp_replace("body", r"\P{Lu}+", "")).alias("n_upper"),
    )
    chars, count = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    lines = F.greatest("n_lines", F.lit(1))
    features = {
        "log_words": F.log(1.0 + F.col("n_words")), "word_length": F.col("word_chars") / count, "symbol_share": F.col("n_symbols") / chars,
        "mark_share": F.col("n_marks") / chars, "upper_share": F.col("n_upper") / chars, "digit_share": F.col("n_digits") / chars,
        "dup_line_share": F.col("n_dup_lines") / lines, "repeat_share": F.col("n_repeat_words") / count, "words_per_line": F.col("n_words") / lines,
    }
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select("row", *_OWN[:5], failed.alias("base_failed"), F.array(*[features[f].cast("double") for f in FEATURES]).alias("features"))


class Trees(NamedTuple):
    """Node arrays of all trees, tree by tree; a leaf points to itself and holds its value."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float


def walk(trees: tuple, data: np.ndarray) -> np.ndarray:
    """Probability of a good document for every row of features, all trees at once."""
    feature, limit, left, right, value, roots, start = trees
    at = np.broadcast_to(roots, (len(data), len(roots)))
    for _ in range(DEPTH):
        below = np.take_along_axis(data, feature[at], axis=1) <= limit[at]
        at = np.where(below, left[at], right[at])
    return 1 / (1 + np.exp(-(start + value[at].sum(axis=1))))


def boost(data: np.ndarray, good: np.ndarray, signs: list[int]) -> Trees:
    """Trees fitted to rows of features and 0/1 labels by Newton steps on the logistic loss.

    A split on a statistic with a sign keeps the two sides' values in its order, and bounds all
    values below it by their middle. Without rows, or with labels of one kind, there are no trees.
    """
    rate = (good.sum() + 1) / (len(good) + 1) if len(good) else 1.0
    start = float(np.log(rate / (1 - rate))) if rate < 1 else 40.0
    nodes: list[list] = []
    roots: list[int] = []
    if len(np.unique(good)) == 2:
        edges = [np.unique(np.quantile(column, np.arange(1, BINS) / BINS)) for column in data.T]
        binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, data.T, strict=True)], axis=1)
        raw = np.full(len(data), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            roots.append(_grow(nodes, np.arange(len(data)), binned, edges, p - good, p * (1 - p), signs, raw, -np.inf, np.inf, DEPTH))
    columns = list(zip(*nodes, strict=True)) if nodes else [(), (), (), (), ()]
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Trees(*[np.array(c, k) for c, k in zip(columns, kinds, strict=True)], np.array(roots, np.int64), start)


def _grow(nodes, at, binned, edges, slope, bend, signs, raw, low, high, depth) -> int:
    """Append the subtree of the rows ``at`` within value bounds; returns its first node."""
    mine = len(nodes)
    value = lambda g, h: np.clip(-g / (h + RIDGE), low, high)
    gain_of = lambda g, h, v: -(g * v + 0.5 * (h + RIDGE) * v * v)
    g, h = slope[at].sum(), bend[at].sum()
    best = (1e-9, -1, 0, 0.0, 0.0)
    for f, cut in enumerate(edges if depth else []):
        if not len(cut):
            continue
        width = len(cut) + 1
        n_left = np.cumsum(np.bincount(binned[at, f], minlength=width))[:-1]
        g_left = np.cumsum(np.bincount(binned[at, f], slope[at], width))[:-1]
        h_left = np.cumsum(np.bincount(binned[at, f], bend[at], width))[:-1]
        v_left, v_right = value(g_left, h_left), value(g - g_left, h - h_left)
        gain = gain_of(g_left, h_left, v_left) + gain_of(g - g_left, h - h_left, v_right) - gain_of(g, h, value(g, h))
        fits = (n_left >= LEAST) & (len(at) - n_left >= LEAST) & (signs[f] * (v_right - v_left) >= 0)
        gain = np.where(fits, gain, -np.inf)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k, float(v_left[k]), float(v_right[k]))
    nodes.append([0, 0.0, mine, mine, 0.0])
    _, f, k, v_left, v_right = best
    if f < 0:
        nodes[mine][4] = RATE * float(value(g, h))
        raw[at] += nodes[mine][4]
        return mine
    middle = (v_left + v_right) / 2
    sides = [(low, high), (low, high)]
    if signs[f]:
        sides = [(middle, high), (low, middle)] if signs[f] < 0 else [(low, middle), (middle, high)]
    goes = binned[at, f] <= k
    nodes[mine][:2] = f, float(edges[f][k])
    for side, (part, (a, b)) in enumerate(zip((at[goes], at[~goes]), sides, strict=True)):
        nodes[mine][2 + side] = _grow(nodes, part, binned, edges, slope, bend, signs, raw, a, b, depth - 1)
    return mine


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Fit to about ``sample`` of the labelled documents, chosen by the hash of their id.

    A document with several labels counts as poor if one of them says so; null ids and labels
    and labels without a document are ignored; several documents of an id all count. Where nothing
    is labelled, or everything alike, the score is the same for all.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(F.col(label)).alias("good"))
    share = sample / max(1, marked.count())
    chosen = lambda c: F.shiftrightunsigned(F.xxhash64(c.cast("string"), F.lit("quality")), 33) < share * (1 << 31)
    some = docs.where(chosen(F.col(doc_id))).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    some = measure(some.join(marked.where(chosen(F.col("id"))), "id"))
    rows = some.select("row.id", "row.good", "features").toPandas().sort_values(["id"], kind="stable")
    data = np.stack(rows["features"].to_numpy()) if len(rows) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*data.T, rows["id"].to_numpy()))  # rows in one order whatever the partitioning
    return boost(data[order], (rows["good"].to_numpy(float)[order] > 0).astype(float), list(FEATURES.values()))


def judge(docs: DataFrame, model: Trees, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with base statistics, ``base_failed``, the trees' ``score`` and ``kept``.

    ``word_chars`` are code points in words, ``n_symbols`` characters of ``#*$%&|<>``,
    ``n_dup_lines`` lines with a word that equal an earlier one, ``n_repeat_words`` words in
    three-word windows that the text holds twice or more. Base limits fail texts of fewer than 50
    words and those with more than half of their words repeated; the trees judge the rest. Null
    and empty texts have no words and fail; repeated rows get equal verdicts; an empty table stays
    empty; a text of any length is one value in its task. Columns of the same names are replaced,
    all others stay.
    """
    carried = docs.sparkSession.sparkContext.broadcast(tuple(model))  # plain arrays: executors need not know this package

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        return pd.Series(walk(carried.value, np.stack(features.to_numpy())) if len(features) else [])

    kept = [c for c in docs.columns if c.lower() not in _OWN]
    source = docs.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("kept")) if kept else docs.select(F.col(f"`{text}`").alias("text"))
    measured = measure(source).withColumn("score", score("features"))
    verdict: Column = ~F.col("base_failed") & (F.col("score") >= threshold)
    return measured.select("row.kept.*", *_OWN[:6], verdict.alias("kept"), "score")
