"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. One binary classifier per codeword position tells
the languages of one side from those of the other by the byte n-grams of a text; all of them
are fitted to n-gram counts that Spark sums over every labelled document, so the model's size
depends on languages and buckets only. A text's margins are decoded to the codeword of least
total logistic loss; a small gap to the runner-up flags the text as ambiguous.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.session import materialize

UNDETERMINED = "und"
#: Hash buckets of n-grams (a power of two).
BUCKETS = 1 << 14
#: Labels learned at most: those of most n-grams. It bounds the model; other labels are never predicted.
MAX_LANGUAGES = 512
#: Texts are read in slices of this many bytes; a slice also holds the two bytes before it.
_SLICE = 1 << 18
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Score below which a decision counts as ambiguous.
AMBIGUOUS = 0.6


def buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all byte trigrams and bigrams of a text, slice by slice.

    A-Z are lower-cased, all other ASCII that is no letter becomes a space.
    """
    data = np.frombuffer((" " + text + " ").encode("utf-8", "surrogatepass").translate(_FOLD), np.uint8)
    for at in range(2, len(data), _SLICE):
        part = data[at - 2 : at + _SLICE].astype(np.uint32)
        two = part[:-1] << np.uint32(8) | part[1:]
        three = two[:-1] << np.uint32(8) | part[2:]
        grams = np.concatenate((two[1:] + np.uint32(0x7F000000), three))
        yield (grams * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def profile(text: str) -> np.ndarray:
    """How often each bucket occurs in a text."""
    total = np.zeros(BUCKETS, np.int64)
    for part in buckets(text):
        total += np.bincount(part, minlength=BUCKETS)
    return total


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A row of +1 / -1 per language: all different splits up to five languages (the exhaustive
    code), beyond them random splits, of which the set with the largest least distance is kept."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 5:
        splits = [[1] + [1 if s >> k & 1 else -1 for k in range(languages - 1)] for s in range((1 << (languages - 1)) - 1)]
        return np.array(splits, float).T
    rng = random.Random(seed)
    length = 15 * max(1, (languages - 1).bit_length())
    best, gap = None, -1
    for _ in range(20):
        columns = []
        while len(columns) < length:
            half = [1] * (languages // 2) + [-1] * (languages - languages // 2)
            rng.shuffle(half)
            columns.append(half)
        code = np.array(columns, float).T
        least = min(int((code[i] != code[j]).sum()) for i in range(languages) for j in range(i))
        if least > gap:
            best, gap = code, least
    return best


@dataclass
class Model:
    """Languages in order, their codewords, and weights of n-gram buckets per codeword position."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: float = 20.0

    def decide(self, counts: np.ndarray) -> tuple[str, float]:
        total = counts.sum()
        if not self.languages or not total:
            return UNDETERMINED, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        margins = self.scale * (counts @ self.weights) / total
        loss = np.logaddexp(0.0, -self.code * margins).sum(axis=1)
        share = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        return self.languages[best], float(share[best] / share.sum())


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fit to all rows with a text and a label.

    Spark sums, per label, the shares of n-grams that its documents give to each bucket; each
    document counts up to its length's square root, so long ones do not outweigh all others.
    The driver receives one number per label and bucket. Of more than ``MAX_LANGUAGES`` labels
    those of the largest sums are learned (ties: smaller by code point). No labelled text: a
    model without languages, which calls everything ``und``.
    """

    def shares(sums: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for label, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": label, "bucket": at.astype("int32"), "n": total[at]})

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for label, body in zip(frame["lang"], frame["text"], strict=True):
                counts = profile(body)
                if n := counts.sum():
                    sums[label] = sums.get(label, 0.0) + np.sqrt(n) * counts / n
                if len(sums) > MAX_LANGUAGES:  # a task holds no more, however many labels there are
                    yield from shares(sums)
                    sums = {}
        yield from shares(sums)

    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    sums = labelled.mapInPandas(tally, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = materialize(sums, "language_counts")
    most = sums.groupBy("lang").agg(F.round(F.sum("n"), 3).alias("total")).orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES)
    names = sorted(r["lang"] for r in most.collect())
    counts = np.zeros((len(names), BUCKETS))
    row = {name: k for k, name in enumerate(names)}
    for name, bucket, n in sums.where(F.col("lang").isin(names)).toLocalIterator():
        counts[row[name], bucket] = round(n, 6)  # sums of doubles differ in the last digits between runs
    code = codewords(len(names))
    share = (counts + 0.02) / (counts + 0.02).sum(axis=1, keepdims=True) if names else counts
    weights = np.zeros((BUCKETS, code.shape[1] if len(names) > 1 else 1))
    for bit in range(code.shape[1] if len(names) > 1 else 0):
        yes, no = code[:, bit] > 0, code[:, bit] < 0
        weights[:, bit] = np.log(share[yes].mean(axis=0)) - np.log(share[no].mean(axis=0))
    return Model(names, code, weights)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    Only the text is looked at, all of it. Null texts and texts without a letter are ``und``
    with score 0, as is everything where no language was learned; so are texts whose letters
    leave no n-gram. Columns of the same names are replaced; all others stay.
    """
    carried = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        found = [carried.value.decide(profile(t)) if t is not None else (UNDETERMINED, 0.0) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    readable: Column = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "ambiguous")]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), decide(readable).alias("found"))
    out = row.select("row.*", "found.lang_pred", "found.score")
    return out.withColumn("ambiguous", F.col("score") < AMBIGUOUS)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for documents whose crc32 of the id as text falls in the fold; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
