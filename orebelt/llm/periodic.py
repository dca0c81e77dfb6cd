"""Runs of words that repeat with a period, by seeds on diagonals that are extended.

A run of smallest period q lies on the diagonal of lag q as a stretch of words equal to those q
later. Lags are taken in classes [2^c, 2^(c+1)). In a class every run guarantees a stretch of k
words with k >= q, so the k-gram at its start occurs again exactly q words later and, as q is
the smallest period, nowhere between: consecutive occurrences of k-grams seed every run, at most
one pair per word and class, never all pairs. A seed is extended to both sides; a table of how
far each lag has been covered stops seeds of a stretch that is known. In a stretch with a
smaller period no consecutive occurrences are q words apart, so every stretch long enough is a run.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.llm.wordgrams import joined, recurring, slices

_SPANS = "runs array<struct<start: bigint, length: bigint, period: bigint>>, kept array<struct<start: bigint, length: bigint>>"


def _agree(words: np.ndarray, lag: int, at: int) -> int:
    """First position from ``at`` on whose word differs from the one ``lag`` later."""
    width = 32
    while True:
        here, there = words[at : at + width], words[at + lag : at + lag + width]
        odd = np.flatnonzero(here[: len(there)] != there)
        if len(odd):
            return at + int(odd[0])
        at += len(there)
        if len(there) < width:
            return at
        width *= 4


def _agree_back(words: np.ndarray, lag: int, at: int) -> int:
    """Start of the stretch before ``at`` whose words all equal those ``lag`` later."""
    width = 32
    while at:
        low = max(0, at - width)
        odd = np.flatnonzero(words[low:at] != words[low + lag : at + lag])
        if len(odd):
            return low + int(odd[-1]) + 1
        at = low
        width *= 4
    return 0


def runs(words: np.ndarray, min_length: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all maximal runs of at least ``max(min_length,
    exponent * period)`` words, by start and period. ``exponent`` is 3 or more: with less, a run
    does not guarantee a stretch as long as its period."""
    if exponent < 3:
        raise ValueError("exponent must be 3 or more")
    found = []
    power, grams = 1, recurring(words)
    low = 1  # smallest lag of the class
    while exponent * low <= len(words) and (grams >= 0).any():
        k = min(max(min_length - q, (exponent - 1) * q) for q in (range(low, 2 * low) if low < min_length else [low]))
        while 2 * power <= k:
            power, grams = 2 * power, joined(grams, power)
        seeds = joined(grams, k - power) if k > power else grams
        at = np.flatnonzero(seeds >= 0)
        at = at[np.argsort(seeds[at], kind="stable")]
        lag = np.diff(at)
        near = np.flatnonzero((np.diff(seeds[at]) == 0) & (lag >= low) & (lag < 2 * low))
        order = np.lexsort((at[near], lag[near]))
        at, lag = at[near][order], lag[near][order]
        head = np.concatenate(([True], (np.diff(lag) != 0) | (np.diff(at) > 1))) if len(at) else np.zeros(0, bool)
        covered: dict[int, int] = defaultdict(int)
        for i, q in zip(at[head].tolist(), lag[head].tolist(), strict=True):
            if i < covered[q]:
                continue
            start, end = _agree_back(words, q, i), _agree(words, q, i + k)
            covered[q] = end
            if end - start + q >= max(min_length, exponent * q):
                found.append((start, end - start + q, q))
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_spans(n: int, found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, length) of the words that no run contains after its first period."""
    out, at = [], 0
    for low, high in sorted((start + q, start + length) for start, length, q in found):
        if low > at:
            out.append((at, low - at))
        at = max(at, high)
    return out + [(at, n - at)] if n > at else out


def find_runs(docs: DataFrame, words: str = "words", min_length: int = 6, exponent: int = 4) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; by start, then period) and ``kept`` (start,
    length of the spans of words outside all repetitions), from an array of words.

    Words are compared as they are; a null word equals another null word. Null and empty arrays
    have no runs and no spans. Each row is looked at by itself, so repeated rows get equal
    results and an empty table stays empty; a text of any length is one value, held as about ten
    integers per word in its task. Columns ``runs`` and ``kept`` are replaced; all others stay.
    """

    @F.arrow_udf(_SPANS)
    def spans(lists: pa.Array) -> pa.Array:
        run_rows, kept_rows, run_counts, kept_counts = [], [], [], []
        for numbers, offsets in slices(lists):
            found = runs(numbers, min_length, exponent)
            home = np.searchsorted(offsets, [r[0] for r in found], side="right") - 1
            of: dict[int, list] = defaultdict(list)
            for doc, (start, length, q) in zip(home.tolist(), found, strict=True):
                of[doc].append((start - int(offsets[doc]), length, q))
            for doc, n in enumerate(np.diff(offsets).tolist()):
                mine = of.get(doc, [])
                kept = kept_spans(n, mine)
                run_rows += mine
                kept_rows += kept
                run_counts.append(len(mine))
                kept_counts.append(len(kept))
        return pa.StructArray.from_arrays([_lists(run_rows, run_counts, ["start", "length", "period"]), _lists(kept_rows, kept_counts, ["start", "length"])], ["runs", "kept"])

    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("runs", "kept")]
    row = docs.select(F.struct(*others).alias("row"), spans(F.col(words)).alias("found"))
    return row.select("row.*", "found.runs", "found.kept")


def _lists(rows: list[tuple], counts: list[int], names: list[str]) -> pa.ListArray:
    values = np.array(rows, np.int64).reshape(-1, len(names))
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(values[:, k]) for k in range(len(names))], names))


def collapse(words, kept):
    """The kept words, joined by one space; the empty text where nothing is kept."""
    parts = F.transform(kept, lambda s: F.slice(words, s["start"].cast("int") + 1, s["length"].cast("int")))
    return F.array_join(F.flatten(parts), " ")
