"""Token counts by rank-synchronous merging of ragged arrays.

Counts what sentencepiece's BPE gives for a text, without building the pieces. A text falls
into pre-tokens that no merge can cross; pre-tokens not met before are laid end to end in one
array of symbols, and in each round every sequence merges its lowest-ranked adjacent pair, all
sequences at once, until none has a pair left. What survives is counted.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Counts of pre-tokens a worker remembers; the memory starts anew when it is full.
REMEMBERED = 400_000
#: Texts whose pre-tokens are merged together.
GROUP = 128
#: Longer sequences take one merge at a time from a heap: their rounds would be too many.
LONG = 2048
_NONE = np.int32(2**31 - 1)


@dataclass
class Merges:
    """What counting needs of a vocabulary: symbols of characters, and ranked pairs."""

    symbols: dict[str, int]
    pairs: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    newline_alone: bool

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; rank _NONE where the pair does not merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        hit = (self.pairs[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], _NONE), self.merged[at]


def load(path: str) -> Merges:
    """Read a sentencepiece BPE model with byte fallback, white space escaped and a leading space.

    A pair merges if its concatenation is a piece, by the piece's score; pieces of equal score
    have equal rank, and of equal ranks the leftmost merges first.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): k for k, i in enumerate(normal)}
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("pieces that hold a space after other characters are not supported")
    order = {score: k for k, score in enumerate(sorted({model.get_score(i) for i in normal}, reverse=True))}
    found = []
    for piece, k in pieces.items():
        rank = order[model.get_score(normal[k])]
        for cut in range(1, len(piece)):
            left, right = pieces.get(piece[:cut]), pieces.get(piece[cut:])
            if left is not None and right is not None:
                found.append((left << 32 | right, rank, k))
    found.sort()
    pairs, rank, merged = (np.array(x) for x in zip(*found, strict=True))
    alone = not any("\n" in p and len(p) > 1 for p in pieces)
    return Merges({p: k for p, k in pieces.items() if len(p) == 1}, pairs.astype(np.int64), rank.astype(np.int32), merged.astype(np.int32), alone)


def _long(word: str, merges: Merges) -> int:
    """The same merges, one at a time, from a heap of (rank, position)."""
    sym = [merges.symbols.get(c, -1) for c in word]
    after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
    table: dict[tuple[int, int], tuple[int, int] | None] = {}
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(sym) and sym[i] >= 0 and sym[j] >= 0:
            key = (sym[i], sym[j])
            if key not in table:
                rank, to = merges.look_up(np.array([key[0]]), np.array([key[1]]))
                table[key] = (int(rank[0]), int(to[0])) if rank[0] != _NONE else None
            if (found := table[key]) is not None:
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

    for i in range(len(sym) - 1):
        offer(i)
    left = len(sym)
    dead = [False] * len(sym)
    while heap:
        _, i, a, b, to = heapq.heappop(heap)
        j = after[i]
        if dead[i] or j >= len(sym) or sym[i] != a or sym[j] != b:
            continue
        sym[i], dead[j], after[i] = to, True, after[j]
        if after[j] < len(sym):
            before[after[j]] = i
        left -= 1
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return left + sum(len(c.encode("utf-8", "surrogatepass")) - 1 for c in word if c not in merges.symbols)


def count_words(found: list[str], merges: Merges) -> list[int]:
    """Tokens of each pre-token. Characters outside the vocabulary count their UTF-8 bytes."""
    counts = np.zeros(len(found), np.int64)
    short = []
    for k, word in enumerate(found):
        if len(word) > LONG:
            counts[k] = _long(word, merges)
        else:
            short.append(k)
    if not short:
        return counts.tolist()
    get = merges.symbols.get
    sym = np.array([get(c, -1) for k in short for c in found[k]], np.int32)
    owner = np.repeat(np.array(short), [len(found[k]) for k in short])
    if len(strange := np.flatnonzero(sym < 0)):
        text = "".join(found[k] for k in short)
        np.add.at(counts, owner[strange], [len(text[i].encode("utf-8", "surrogatepass")) - 1 for i in strange.tolist()])
    np.add.at(counts, owner, 1)

    rank, to = merges.look_up(sym[:-1], sym[1:])
    rank = np.append(np.where(owner[:-1] == owner[1:], rank, _NONE), _NONE)
    to = np.append(to, 0)
    while len(sym):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        least = np.minimum.reduceat(rank, starts)
        size = np.diff(np.append(starts, len(sym)))
        live = least != _NONE
        if not live.any():
            break
        keep = np.repeat(live, size)
        if not keep.all():  # finished sequences leave the arrays
            sym, owner, rank, to = sym[keep], owner[keep], rank[keep], to[keep]
            least, size = least[live], size[live]
            starts = np.cumsum(size) - size
        hits = np.flatnonzero(rank == np.repeat(least, size))
        at = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]  # the leftmost of each
        counts[owner[at]] -= 1
        sym[at] = to[at]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        moved = at - np.arange(len(at))
        sym, owner, rank, to = sym[stay], owner[stay], rank[stay], to[stay]
        # only pairs that touch a merged symbol have a new rank
        touched = np.unique(np.concatenate((moved, moved[moved > 0] - 1)))
        right = np.minimum(touched + 1, len(sym) - 1)
        new_rank, new_to = merges.look_up(sym[touched], sym[right])
        same = (touched + 1 < len(sym)) & (owner[right] == owner[touched])
        rank[touched], to[touched] = np.where(same, new_rank, _NONE), new_to
    return counts.tolist()


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``path`` names a sentencepiece BPE model; no begin, end or special tokens are added, and
    strings that look like them are ordinary text. Null and empty texts have none of either.
    Whole texts of any length are counted; columns of the same names are replaced.
    """
    carried = docs.sparkSession.sparkContext.broadcast(load(path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merges = carried.value
        pattern = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if merges.newline_alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        known: dict[str, int] = {}
        for batch in batches:
            totals: list[int] = []
            for at in range(0, len(batch), GROUP):
                found = [pattern.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in batch.iloc[at : at + GROUP]]
                if len(known) > REMEMBERED:
                    known = {}
                new = list(set().union(*found).difference(known))
                known.update(zip(new, count_words(new, merges), strict=True))
                totals += [sum(map(known.__getitem__, f)) for f in found]
            yield pd.Series(totals, dtype="int64")

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    body = F.col(text)
    out = docs.select(*kept, F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"), count(body).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
