"""Language-model scores by online logistic context mixing.

A text is scored as its words, A-Z lower-cased, and an end mark. Each is a path of binary
decisions, so a step predicts one bit: a frequent training word or the end has its prefix code;
any other word is an escape, then spelled byte by byte down the prefix code of the byte before
it. Predictors look the step up under different contexts: the code's own node; the word before,
and the two words before (when spelling: three bytes, and the word so far). All
but the first are hashed into tables of bit counts that Spark sums over every training document.
Their log-odds are mixed by weights that a gate selects, by how often the widest context has been
seen, and the weights are refined online, block by block of each document, by the gradient of
what the block cost. Last, the probability of an escaped word is mixed with its share of the
escaped words in training, whose counts grow with the corpus and are joined by shuffle. The
product over all steps is the text's probability; its negative binary logarithm over the bytes
is the bits per byte.
"""

from __future__ import annotations

import heapq
import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property
from itertools import chain, compress, repeat

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.session import materialize

#: Address bits of the hashed tables (word before / three bytes, two words before / word so far),
#: and slots a row carries.
BITS, PIECE = (21, 22), 16384
HASHED = len(BITS)
#: The hashed context that gates the weights, by how often it has been seen: 0, 1, 2-3, 4-7, ...
#: It is the last one.
GATE, GATES = 1, 10
#: The most frequent training words have codes of their own, unless they are longer than WIDEST
#: bytes; both bound what is broadcast. All other words' counts are joined.
HEAD, WIDEST = 1 << 17, 256
#: Training documents (crc32 of the id modulo TUNING[0] = TUNING[1]) that start the weights
#: before they, too, are added to the tables.
TUNING = (61, 3)
_BLANK = 32
_BYTES = 65536
_FIRST, _LARGEST = 64, 8192
#: Words of the texts that are laid out together.
_GROUP = 1 << 15
#: Symbols whose steps are taken at once, so that they stay in cache.
_PART = 1 << 13
_RATE = 0.7
#: Log-odds are kept in a byte, in steps of this size: the model is broadcast several times.
ODDS = np.float32(1 / 12)
_FLUSH = 150_000
_ROWS = 128


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _paths(weights: list[float]) -> Iterator[list[tuple[int, int]]]:
    """Huffman path of every leaf from the root: (inner node, bit). Nodes count from 0."""
    n = len(weights)
    heap = [(float(w) + 0.01, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    above = [0] * (2 * n - 1)
    for k in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        above[x], above[y] = k << 1, k << 1 | 1
        heapq.heappush(heap, (a + b, k))
    for at in range(n):
        path = []
        while at != 2 * n - 2:
            at, bit = above[at] >> 1, above[at] & 1
            path.append((at - n, bit))
        yield path[::-1]


@dataclass
class Codes:
    """Paths of nodes and bits, end to end in one array. Symbol ``before * 256 + byte`` is a byte
    after another; from 65,536 on follow the words of the head, the escape and the end."""

    start: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @staticmethod
    def build(pairs: np.ndarray, words: list[float]) -> Codes:
        """From 256 x 256 counts of bytes after bytes and counts of words, escape and end."""
        nodes, bits, length = array("I"), array("B"), array("i")
        for base, weights in chain(((before * 256, pairs[before]) for before in range(256)), [(_BYTES, words)]):
            for path in _paths(weights):
                length.append(len(path))
                nodes.extend(base + k for k, _ in path)
                bits.extend(bit for _, bit in path)
        size = np.array(length, np.int32)
        return Codes(np.cumsum(size, dtype=np.int32) - size, size, np.array(nodes, np.uint32), np.array(bits, np.uint8))

    @cached_property
    def place(self) -> np.ndarray:
        """Start and length of each symbol's path in one number, read at once."""
        return self.start.astype(np.int64) << 8 | self.length

    @cached_property
    def step(self) -> np.ndarray:
        """Node and bit of each step in one number."""
        return self.node << np.uint32(1) | self.bit

    @property
    def nodes(self) -> int:
        return len(self.start) - 1


@dataclass
class Model:
    codes: Codes
    #: Number of each word that has a code; the next two numbers are escape and end.
    head: dict[bytes, int]
    #: How often the training documents have each of them (zero for the escape).
    seen: np.ndarray
    #: Log-odds of a one in steps of ODDS: by node, and by slot of each hashed table.
    first: np.ndarray
    tables: list[np.ndarray]
    #: Gate of each slot of the gating table.
    level: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, HASHED + 1), 0.3, np.float64))

    @cached_property
    def gating(self) -> np.ndarray:
        """Odds and gate of each slot of the gating table in one number."""
        return self.tables[GATE].view(np.uint8) | self.level.astype(np.int16) << 8


@dataclass
class Laid:
    """Symbols of some texts, text after text, and the contexts each stands in."""

    sizes: np.ndarray
    symbol: np.ndarray
    contexts: list[np.ndarray]
    #: Words that are spelled: the word, its text, and where its bytes begin and end.
    spelled: list[bytes]
    owner: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def levels(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(seen + 1.0)), GATES - 1).astype(np.int8)


def _spelling(spelled: list[bytes], size: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Symbols and hashed contexts (32 bit) of words that are spelled, each closed by a blank.
    Nothing before a word is context of its bytes."""
    data = np.frombuffer(b" ".join(spelled) + b" ", np.uint8)
    n = len(data)
    begin = np.repeat(np.cumsum(size) - size, size)
    at = np.arange(n) - begin
    wide = np.concatenate((np.full(3, _BLANK, np.uint8), data))
    back = [np.where(at >= k, wide[3 - k : n + 3 - k], _BLANK).astype(np.uint32) for k in range(1, 4)]
    three = back[2] << np.uint32(16) | back[1] << np.uint32(8) | back[0]
    # word so far: a polynomial hash, as differences of one running sum modulo 2 ** 64
    odd, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n - 1, odd, np.uint64))))
        down = np.cumprod(np.full(n, inverse, np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down)))
        # relative to the word's begin, so that the hash does not depend on where the word stands
        word = (total[:-1] - total[begin]) * up[begin]
        word *= np.uint64(0xD6E8FEB86659FD93)
        word ^= word >> np.uint64(32)
    symbol = back[0].astype(np.int32) << 8 | data
    return symbol, [three * np.uint32(0x27D4EB2F), word.astype(np.uint32)]


def lay_out(texts: list[list[bytes]], head: dict[bytes, int]) -> Laid:
    """Symbols and contexts of texts given as words. Nothing of one text is context of the next."""
    escape = len(head)
    n_words = np.array([len(t) for t in texts], np.int64)
    tokens = n_words + 1
    number = np.full(tokens.sum(), escape + 1, np.int32)  # the end of each text, and its words before
    last = np.cumsum(tokens) - 1
    inner = np.ones(len(number), bool)
    inner[last] = False
    known = np.fromiter(map(head.get, chain.from_iterable(texts), repeat(escape)), np.int32, int(n_words.sum()))
    number[inner] = known
    escaped = np.flatnonzero(number == escape)
    spelled = list(compress(chain.from_iterable(texts), (known == escape).tolist()))
    # what a word is as context: its number, or a checksum where it has none
    value = number.astype(np.uint32) + np.uint32(1)
    value[escaped] = np.fromiter(map(zlib.crc32, spelled), np.uint32, len(spelled)) | np.uint32(1 << 31)
    value *= np.uint32(0x9E3779B1)
    value ^= value >> np.uint32(15)
    before, earlier = np.zeros_like(value), np.zeros_like(value)
    before[1:], earlier[2:] = value[:-1], value[:-2]
    first = last - n_words
    before[first] = 0
    earlier[first] = 0
    earlier[np.minimum(first + 1, last)] = 0
    own = [before ^ np.uint32(0x5BD1E995), before * np.uint32(0x846CA68B) ^ (earlier >> np.uint32(7)) + earlier]
    width = np.ones(len(number), np.int64)
    size = np.fromiter(map(len, spelled), np.int64, len(spelled)) + 1
    width[escaped] += size
    place = np.cumsum(width) - width
    total = int(width.sum())
    symbol, contexts = np.empty(total, np.int32), [np.empty(total, np.uint32) for _ in own]
    symbol[place] = number + _BYTES
    for c, x in zip(contexts, own, strict=True):
        c[place] = x
    if spelled:
        rest = np.ones(total, bool)
        rest[place] = False
        codes, inside = _spelling(spelled, size)
        symbol[rest] = codes
        for c, x in zip(contexts, inside, strict=True):
            c[rest] = x
    text_of = np.repeat(np.arange(len(texts)), tokens)
    sizes = np.bincount(text_of, width, len(texts)).astype(np.int64)
    return Laid(sizes, symbol, contexts, spelled, text_of[escaped], place[escaped] + 1, place[escaped] + 1 + size)


def _steps(codes: Codes, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number and first place of each symbol's binary steps; node and bit of every step."""
    place = codes.place[symbol]
    length = place & 255
    before = np.cumsum(length) - length
    place >>= 8
    place -= before
    at = np.repeat(place, length)
    at += np.arange(len(at))
    step = codes.step[at]
    return length, before, step >> np.uint32(1), step & np.uint32(1)


def _slots(context: np.ndarray, length: np.ndarray, mixed: np.ndarray, bits: int) -> np.ndarray:
    value = np.repeat(context, length)
    value += mixed
    value *= np.uint32(0x9E3779B1)
    value >>= np.uint32(32 - bits)
    return value.astype(np.intp)


def _tally(counts: np.ndarray, at: np.ndarray) -> None:
    """Count each place once; indices and increment of these types take numpy's fast path."""
    np.add.at(counts, at, counts.dtype.type(1))


def _blocks(sizes: np.ndarray) -> np.ndarray:
    """Block number of each symbol within its text: blocks double from 64 to 8192 symbols."""
    top = int(math.log2(_LARGEST // _FIRST)) + 1
    limit = _FIRST * (2**top - 1)
    longest = np.arange(max(sizes))
    number = np.where(longest < limit, np.log2(longest // _FIRST + 1).astype(np.int32), top + (longest - limit) // _LARGEST)
    return np.concatenate([number[:n] for n in sizes])


def score(laid: Laid, model: Model, final: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """What each symbol costs in natural units, and each text's last weights if ``final``."""
    n = len(laid.sizes)
    rank = np.argsort(-laid.sizes, kind="stable")  # long texts first: those with further blocks lead each block
    sizes = laid.sizes[rank]
    ends = np.cumsum(sizes)
    number = _blocks(sizes)
    order = np.argsort(number, kind="stable")  # block by block, within a block text by text
    row = np.repeat(np.arange(n) * GATES, sizes)[order]
    order += np.repeat((np.cumsum(laid.sizes) - laid.sizes)[rank] - (ends - sizes), sizes)[order]
    symbol = laid.symbol[order]
    contexts = [c[order] for c in laid.contexts]
    edges = np.concatenate(([0], np.cumsum(np.bincount(number))))
    further = np.count_nonzero(number[ends - 1] > np.arange(len(edges) - 1)[:, None], axis=1)
    weights = np.repeat(model.weights[None], n, axis=0).reshape(-1, HASHED + 1)
    cost = np.empty(len(symbol))
    for a, b, lead in zip(edges[:-1], edges[1:], further, strict=True):
        push, seen = np.zeros_like(weights), np.full(len(weights), 32.0)
        factors = weights.astype(np.float32).T.copy()
        for i in range(a, b, _PART):
            j = min(i + _PART, b)
            length, before, node, bit = _steps(model.codes, symbol[i:j])
            mixed = node * np.uint32(0x2C1B3C6D)
            slots = [_slots(c[i:j], length, mixed, bits) for c, bits in zip(contexts, BITS, strict=True)]
            gating = model.gating[slots[GATE]]
            inputs = [model.first[node.astype(np.intp)]]
            inputs += [gating.astype(np.int8) if k == GATE else model.tables[k][at] for k, at in enumerate(slots)]
            inputs = [x * ODDS for x in inputs]
            key = np.repeat(row[i:j], length)
            key += gating >> 8
            odds = np.zeros(len(key), np.float32)
            for factor, x in zip(factors, inputs, strict=True):
                odds += factor[key] * x
            sign = bit.astype(np.float32)
            sign *= 2
            sign -= 1
            odds *= sign
            np.clip(odds, -30, 30, out=odds)
            miss = np.exp(-odds)
            whole = 1 + miss
            cost[i:j] = np.add.reduceat(np.log(whole), before)
            # nothing reads the weights of a text after its last block
            m = len(key) if final else length[: np.searchsorted(row[i:j], lead * GATES)].sum()
            key, miss = key[:m], miss[:m]
            miss /= whole[:m]  # the probability the mix gave to the other bit
            miss *= sign[:m]
            seen += np.bincount(key, minlength=len(weights))
            for k, x in enumerate(inputs):
                push[:, k] += np.bincount(key, miss * x[:m], len(weights))
        weights += _RATE * push / seen[:, None]
    result = np.empty(len(cost))
    result[order] = cost
    return result, weights.reshape(n, GATES, HASHED + 1)[np.argsort(rank)] if final else weights[:0]


def _groups(sizes: Iterator[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of together about _GROUP words."""
    begin = total = 0
    last = 0
    for last, size in enumerate(sizes, 1):
        total += size + 1
        if total >= _GROUP:
            yield begin, last
            begin, total = last, 0
    if begin < last:
        yield begin, last


def _tuned(docs: DataFrame, model: Model) -> np.ndarray:
    """Sum over the tuning documents of their last weights, and how much they were summed by."""
    carried = docs.sparkSession.sparkContext.broadcast(model)
    width = GATES * (HASHED + 1) + 1

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width)
        for frame in frames:
            texts = [split(t) for t in frame["text"]]
            for a, b in _groups(map(len, texts)):
                laid = lay_out(texts[a:b], carried.value.head)
                _, last = score(laid, carried.value, final=True)
                share = np.sqrt(laid.sizes)
                total[:-1] += (last.reshape(b - a, -1) * share[:, None]).sum(axis=0)
                total[-1] += share.sum()
        yield pd.DataFrame({"k": np.arange(width, dtype=np.int32), "n": total})

    out = np.zeros(width)
    sums = docs.select("text").mapInPandas(gather, "k int, n double").groupBy("k").agg(F.sum("n").alias("n"))
    for k, n in sums.collect():  # ``width`` rows
        out[k] = round(n, 4)
    carried.destroy()
    return out


def _summed(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Add up count arrays of equal keys, streaming over each partition."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        counts_of = lambda data: np.frombuffer(unpack.decompress(data), np.int32)
        key, data, total = None, None, None  # counts that meet no others stay packed
        row_of = lambda: pd.DataFrame([(*key, data if total is None else pack.compress(total.tobytes()))], columns=[*keys, "data"])
        for frame in frames:
            for row in frame.itertuples(index=False):
                mine = tuple(getattr(row, k) for k in keys)
                if mine == key:
                    total = counts_of(data).copy() if total is None else total
                    total += np.minimum(counts_of(row.data), _MOST - total)
                    continue
                if key is not None:
                    yield row_of()
                key, data, total = mine, row.data, None
        if key is not None:
            yield row_of()

    schema = ", ".join(f"{k} int" for k in keys) + ", data binary"
    return pieces.select(*keys, "data").repartition(*keys).sortWithinPartitions(*keys).mapInPandas(add, schema)


#: Counts of a slot stop here; odds are kept no finer.
_MOST = np.int32(2**31 - 1)


def _node_counts(codes: Codes, symbols: np.ndarray, n_nodes: int) -> np.ndarray:
    """Zeros and ones of every node: each symbol takes its whole path as often as it occurs."""
    return np.minimum(np.bincount(codes.step, np.repeat(symbols, codes.length), 2 * n_nodes), _MOST).astype(np.int32)


def _bit_counts(docs: DataFrame, codes: Codes, head: dict[bytes, int], name: str) -> DataFrame:
    """Zeros and ones of every node and slot over the documents, in pieces."""
    carried = docs.sparkSession.sparkContext.broadcast((codes, head))
    n_nodes = codes.nodes + -codes.nodes % PIECE  # whole pieces

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, head = carried.value
        symbols = np.zeros(len(codes.start), np.int64)
        tables = [np.zeros(2 << bits, np.int32) for bits in BITS]
        part = TaskContext.get().partitionId() % 32
        for frame in frames:
            for at in range(0, len(frame), _ROWS):
                texts = [split(t) for t in frame["text"].iloc[at : at + _ROWS]]
                for a, b in _groups(map(len, texts)):
                    laid = lay_out(texts[a:b], head)
                    _tally(symbols, laid.symbol.astype(np.intp))
                    for i in range(0, len(laid.symbol), _PART):
                        length, _, node, bit = _steps(codes, laid.symbol[i : i + _PART])
                        mixed = node * np.uint32(0x2C1B3C6D)
                        for table, context, bits in zip(tables, laid.contexts, BITS, strict=True):
                            slot = _slots(context[i : i + _PART], length, mixed, bits)
                            slot *= 2
                            slot += bit
                            _tally(table, slot)
        nodes = _node_counts(codes, symbols, n_nodes)
        pack = zstandard.ZstdCompressor(level=1)
        base = 0
        for counts in (nodes, *tables):
            whole = counts.reshape(-1, 2 * PIECE)
            for at in range(0, len(whole), 16):
                rows = [(base + at + k, part, pack.compress(x.tobytes())) for k, x in enumerate(whole[at : at + 16]) if x.any()]
                yield pd.DataFrame(rows, columns=["piece", "part", "data"])
            base += len(whole)

    gathered = materialize(docs.select("text").mapInPandas(count, "piece int, part int, data binary"), name)
    pieces = materialize(_summed(_summed(gathered, ["piece", "part"]), ["piece"]), f"{name}_sums")
    carried.destroy()
    return pieces


def _fill(model: Model, pieces: DataFrame) -> Model:
    """The model with odds and gates from bit counts. Tables have a fixed number of slots, so what
    reaches the driver, a byte or two a slot, does not grow."""

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for frame in frames:
            counts = [np.frombuffer(unpack.decompress(x), np.int32).reshape(-1, 2) for x in frame["data"]]
            odds = [np.clip(np.rint(np.log((x[:, 1] + 0.2) / (x[:, 0] + 0.2)) / ODDS), -127, 127).astype(np.int8).tobytes() for x in counts]
            gates = [levels(x.sum(axis=1, dtype=np.int64)).tobytes() if k >= gated else b"" for k, x in zip(frame["piece"], counts, strict=True)]
            yield pd.DataFrame({"piece": frame["piece"], "odds": odds, "gates": gates})

    sizes = [model.codes.nodes + -model.codes.nodes % PIECE, *(1 << bits for bits in BITS)]
    cuts = np.cumsum(sizes)
    gated = cuts[GATE] // PIECE
    odds, gates = np.zeros(cuts[-1], np.int8), np.zeros(cuts[-1] - cuts[GATE], np.int8)
    for piece, some, gate in pieces.mapInPandas(weigh, "piece int, odds binary, gates binary").toLocalIterator():  # the tables' pieces
        at = piece * PIECE
        odds[at : at + PIECE] = np.frombuffer(some, np.int8)
        if gate:
            gates[at - cuts[GATE] : at - cuts[GATE] + PIECE] = np.frombuffer(gate, np.int8)
    first, *tables = np.split(odds, cuts[:-1])
    return replace(model, first=first, tables=tables, level=gates)


def count_words(training: DataFrame) -> DataFrame:
    """``w, c``: every training word (the end mark is a line feed) and how often it occurs; for
    byte pairs of words ``w`` is null, ``k`` the pair and ``c`` its count."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        pairs = np.zeros(_BYTES, np.int64)
        table = lambda: pd.DataFrame({"w": list(words), "k": 0, "c": np.fromiter(words.values(), np.int64, len(words))})
        for frame in frames:
            for text in frame["text"]:
                found = split(text)
                words.update(found)
                words[b"\n"] += 1
                data = np.frombuffer(b" " + b" ".join(found) + b" ", np.uint8)
                for at in range(0, len(data) - 1, 1 << 16):
                    some = data[at : at + (1 << 16) + 1].astype(np.intp)
                    _tally(pairs, some[:-1] << 8 | some[1:])
                if len(words) > _FLUSH:
                    yield table()
                    words = Counter()
        yield table()
        at = np.flatnonzero(pairs)
        yield pd.DataFrame({"w": None, "k": at.astype(np.int32), "c": pairs[at]})

    rows = training.select("text").mapInPandas(count, "w binary, k int, c long")
    return materialize(rows.groupBy("w", "k").agg(F.sum("c").alias("c")), "words")


def learn(training: DataFrame, doc_id: str = "doc_id") -> tuple[Model, DataFrame]:
    """The model, and the table of training words: ``w`` and ``c`` (count).

    ``training`` has ``doc_id`` and ``text``. One pass counts words and byte pairs, a second the
    bits under the codes they give; weights start from a slice that is added to the bits last.
    """
    tuning = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % TUNING[0] == TUNING[1], F.lit(False))
    training = training.select(F.col("text"), tuning.alias("tuning"))
    counted = count_words(training)
    vocabulary = counted.where("w IS NOT NULL").select("w", "c")
    pairs = np.zeros(_BYTES, np.int64)
    for k, c in counted.where("w IS NULL").select("k", "c").collect():  # at most 65,536 rows
        pairs[k] = c
    mark = F.lit(b"\n")
    usual = vocabulary.where((F.col("w") != mark) & (F.octet_length("w") <= WIDEST) & (F.col("c") > 1))
    head = [(bytes(w), c) for w, c in usual.orderBy(F.desc("c"), "w").limit(HEAD).collect()]
    total, ends = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("w") == mark, F.col("c"))), F.lit(0))).first()
    codes = Codes.build(pairs.reshape(256, 256), [*(c for _, c in head), total - ends - sum(c for _, c in head), ends])
    numbers = {w: k for k, (w, _) in enumerate(head)}
    slice_ = materialize(training.where("tuning").select("text"), "tuning")
    counts = _bit_counts(training.where("NOT tuning"), codes, numbers, "bits")
    model = Model(codes, numbers, np.array([*(c for _, c in head), 0, ends], np.int64), np.empty(0), [], np.empty(0))
    model = _fill(model, counts)
    for _ in range(4):
        sums = _tuned(slice_, model)
        if sums[-1]:
            model.weights = (sums[:-1] / sums[-1]).reshape(GATES, HASHED + 1)
    more = _bit_counts(slice_, codes, numbers, "tuning_bits")
    return _fill(model, _summed(counts.unionAll(more), ["piece"])), vocabulary


def score_documents(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all ``docs`` under what the rows of the condition ``training`` teach.

    ``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``: tokens are the
    words and one end; ``base_score`` sums log10((c + 1) / (N + V + 1)) over them, c being a
    token's count in training, N all and V different training tokens; ``score`` is the mixing
    model's log10 probability of the text, ``bits_per_byte`` its cost over the bytes it scores.

    Null and empty texts are the end mark alone. Repeated rows are scored alike and come back as
    often as they came; a null training condition is false; with nothing to learn from, every
    bit is even odds; an empty table gives an empty one. Words of equal count are ordered by
    their bytes. Texts are scored whole: a very long one holds some 30 bytes of memory for each of
    its bytes. Other columns, of any name, are left out. Frequent words' counts are broadcast
    (HEAD of them), all others joined.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("_train"))
    model, vocabulary = learn(rows.where("_train").select("doc_id", "text"))
    once = F.sum(F.when(F.col("c") == 1, 1).otherwise(0))
    total, different, singles = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(once, F.lit(0))).first()
    escapes = total - int(model.seen.sum())
    # chance that an escaped word has been seen: all but the share of those seen once
    seen_before = (escapes - min(singles, escapes) + 0.5) / (escapes + 1)
    carried = docs.sparkSession.sparkContext.broadcast(model)

    def rate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = carried.value
        logs = np.log10(model.seen + 1.0)
        number = TaskContext.get().partitionId() << 32
        columns = ["n_tokens", "n_known", "part", "plain", "size", "tail_w", "tail_cost"]
        # a batch of Arrow holds thousands of texts; their words are held for a few of them
        for frame in (f.iloc[at : at + _ROWS] for f in frames for at in range(0, len(f), _ROWS)):
            texts = [split(t) for t in frame["text"]]
            out: list[tuple] = []
            for a, b in _groups(map(len, texts)):
                laid = lay_out(texts[a:b], model.head)
                cost, _ = score(laid, model)
                text_of = np.repeat(np.arange(b - a), laid.sizes)
                plain = laid.symbol >= _BYTES
                token = laid.symbol[plain] - _BYTES
                value = np.bincount(text_of[plain], cost[plain], b - a)
                part = np.bincount(text_of[plain], logs[token], b - a)
                # cost of each spelling: sums between two places of the running total of its text's costs
                running = np.concatenate(([0.0], np.cumsum(np.where(plain, 0.0, cost))))
                spelled = running[laid.end] - running[laid.begin]
                cuts = np.searchsorted(laid.owner, np.arange(b - a + 1))
                for k, words in enumerate(texts[a:b]):
                    i, j = cuts[k], cuts[k + 1]
                    end_known = int(logs[-1] > 0)
                    out.append((len(words) + 1, len(words) - (j - i) + end_known, part[k], value[k], len(b"".join(words)) + max(len(words), 1), laid.spelled[i:j], spelled[i:j]))
            result = pd.DataFrame(out, columns=columns)
            result.insert(0, "doc_id", frame["doc_id"].to_numpy())
            result.insert(0, "row", np.arange(number, number + len(frame)))
            number += len(frame)
            yield result

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n_tokens long, n_known long, part double, plain double, size long, tail_w array<binary>, tail_cost array<double>"
    rated = materialize(rows.select("doc_id", "text").mapInPandas(rate, schema), "rated")
    carried.destroy()
    tail = rated.select("row", F.inline(F.arrays_zip(F.col("tail_w").alias("w"), F.col("tail_cost").alias("cost"))))
    share = F.col("c") * (seen_before / max(escapes, 1)) + F.exp(-F.col("cost")) * (1 - seen_before)
    gain = F.when(F.col("c").isNull(), math.log(1 - seen_before) - F.col("cost")).otherwise(F.log(share))
    tail = tail.join(vocabulary, "w", "left").groupBy("row").agg(
        F.count("c").alias("more"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rest"), F.sum(gain).alias("gain")
    )
    none = F.lit(0.0)
    out = rated.drop("tail_w", "tail_cost").join(tail, "row", "left")
    base = F.col("part") + F.coalesce("rest", none) - F.col("n_tokens") * math.log10(total + different + 1)
    value = F.coalesce("gain", none) - F.col("plain")
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"), (value / math.log(10)).alias("score"), (-value / math.log(2) / F.col("size")).alias("bits_per_byte"),
    )
