"""Words of many documents as one integer sequence, and exact numbers for their n-grams.

Words are numbered per document, so a gram of one document never equals a gram of another, and a
gram that reaches over the end of a document equals no other gram at all: the same two documents
would have to meet at another place in it. No hash stands for a word or gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: Documents are worked on together up to this many words; a longer document alone.
SLICE = 1 << 20


def slices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers and the documents' offsets in them, for consecutive documents of a batch.

    Null lists are documents without words.
    """
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    ends = np.cumsum(lengths)
    words = lists.flatten()
    first = at = 0
    while first < len(lists):
        last = max(first + 1, int(np.searchsorted(ends, at + SLICE, side="right")))
        offsets = np.concatenate(([0], np.cumsum(lengths[first:last])))
        codes = np.asarray(words.slice(at, offsets[-1]).dictionary_encode().indices, np.int64)
        doc = np.repeat(np.arange(last - first), lengths[first:last])
        yield numbered(doc, codes), offsets
        first, at = last, at + int(offsets[-1])


def numbered(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Numbers of the different pairs, from 0 in order of appearance."""
    if not len(high):
        return np.zeros(0, np.int64)
    return pd.factorize(high * (int(low.max()) + 1) + low)[0].astype(np.int64)


def recurring(numbers: np.ndarray) -> np.ndarray:
    """The numbers, with -1 in place of those that occur once."""
    seen = numbers >= 0
    count = np.bincount(numbers[seen], minlength=1)
    return np.where(seen & (count[numbers] > 1), numbers, -1)


def joined(grams: np.ndarray, shift: int) -> np.ndarray:
    """From recurring grams those ``shift`` words longer, each two grams ``shift`` words apart."""
    out = np.full(max(len(grams) - shift, 0), -1, np.int64)
    both = np.flatnonzero((grams[: len(out)] >= 0) & (grams[shift:] >= 0))
    out[both] = numbered(grams[both], grams[both + shift])
    return recurring(out)
