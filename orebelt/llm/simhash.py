"""SimHash near-duplicates by covering locality-sensitive hashing.

A covering family (Pagh, 2016) for radius r gives every bit position a vector of r + 1 bits;
each non-zero vector v selects the positions whose vector has an odd inner product with v.
Whatever r positions two fingerprints differ in, some v is orthogonal to all their vectors,
so the pair agrees on all bits that v selects and meets in that table: no link is lost.
Buckets that many different fingerprints share are covered again over the bits still free,
which at least halves them, so a bucket is compared only once it is small by construction.

Near copies by Jaccard similarity are found by minimum hashes (Broder, 1997) of the shingles
themselves: fingerprints of short or evenly edited texts lie too far apart for any small radius.
"""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.llm.common import BLANK_WORD, ascii_lower, window_hashes, words
from orebelt.llm.components import components
from orebelt.session import materialize

#: Buckets up to this many different fingerprints are compared directly.
BUCKET = 128
#: Below this many free bits a bucket cannot grow past 2 ** FREE and is compared directly.
FREE = 9
#: Minimum hashes of a band, and the share of pairs at the wanted similarity that all bands may miss.
ROWS, MISSED = 4, 1e-9
#: Shingles of the texts that ask, and of those that are asked, in a block.
ASKED, HELD = 1 << 17, 1 << 20
_ALL = (1 << 64) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int) -> int:
    """Signed 64-bit SimHash: the majority of XXH64 (seed 42) over the word shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - width + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        last = ends[at + width - 1 : to + width - 1] if len(found) >= width else ends[-1:]
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at:to].tolist(), last.tolist(), strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, width: int = 3, text: str = "text", name: str = "fp") -> DataFrame:
    """Add the SimHash of ``text``. Null and wordless texts have fingerprint zero; a text of
    fewer than ``width`` words is one shingle."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.withColumn(name, simhash(F.col(text)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def covering_masks(radius: int, taken: int = 0) -> list[int]:
    """Masks over the bits outside ``taken`` (each joined with ``taken``) that cover ``radius``."""
    free = [i for i in range(64) if not taken >> i & 1]
    vectors = list(range(1, 1 << (radius + 1)))
    random.Random(20160 + radius).shuffle(vectors)
    of = {bit: vectors[k % len(vectors)] for k, bit in enumerate(free)}
    masks = {taken | sum(1 << bit for bit in free if (of[bit] & v).bit_count() & 1) for v in vectors}
    return sorted(masks)


def spanning(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Minimum spanning forest of the values under links of at most ``radius`` bits.

    For every smaller radius too, the links up to it join the same values as all pairs would.
    """
    unsigned = values.view(np.uint64)
    far = np.full(len(values), radius + 1, np.int64)
    nearest = np.zeros(len(values), np.int64)
    left = np.ones(len(values), bool)
    links: list[tuple[int, int]] = []
    at = 0
    for _ in range(len(values)):
        left[at] = False
        distance = np.bitwise_count(unsigned ^ unsigned[at]).astype(np.int64)
        closer = left & (distance < far)
        far[closer], nearest[closer] = distance[closer], at
        if not left.any():
            break
        at = int(np.argmin(np.where(left, far, 99)))
        if far[at] <= radius:
            links.append((int(values[nearest[at]]), int(values[at])))
    return links


def _deal(fps: DataFrame, masks: DataFrame | None, radius: int) -> DataFrame:
    """(mask, bucket, fp) of every fingerprint under the masks; ``masks``: taken, masks of a next level."""
    if masks is None:
        tables = F.explode(F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])).alias("mask")
        fps = fps.select("fp", tables)
    else:
        fps = fps.join(masks, "taken").select("fp", F.explode("masks").alias("mask"))
    return fps.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"), "fp").distinct()


def hamming_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between different ``fp`` values whose components equal those of all pairs
    at most ``radius`` bits apart. ``fps`` holds each value once."""
    spark = fps.sparkSession

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            links = [x for v in frame["members"] for x in spanning(np.asarray(v, np.int64), radius)]
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    links, level, masks = None, _deal(fps, None, radius), None
    while True:
        buckets = level.groupBy("mask", "bucket").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        buckets = materialize(buckets.where("n > 1"), "buckets")
        pairs = buckets.where("n = 2 and bit_count(a ^ b) <= %d" % radius).select("a", "b")
        small = (F.col("n") <= BUCKET) | (F.bit_count("mask") >= 64 - FREE)
        many = buckets.where("n > 2").select("mask", "bucket", small.alias("small"))
        members = level.join(many, ["mask", "bucket"])
        found = members.where("small").groupBy("mask", "bucket").agg(F.sort_array(F.collect_list("fp")).alias("members"))
        pairs = pairs.unionAll(found.select("members").mapInPandas(compare, "a long, b long"))
        links = pairs if links is None else links.unionAll(pairs)
        left = [r[0] for r in many.where("not small").select("mask").distinct().collect()]  # masks, not data
        if not left:
            return links.distinct()
        rows = [(m, [_signed(x) for x in covering_masks(radius, m & _ALL)]) for m in left]
        masks = spark.createDataFrame(rows, "taken bigint, masks array<bigint>")
        crowded = materialize(members.where("not small").select("fp", F.col("mask").alias("taken")), "crowded")
        level = _deal(crowded, masks, radius)


def near_groups(docs: DataFrame, width: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and group of every row: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest non-null id among the rows linked, directly or through
    others, by fingerprints at most ``radius`` bits apart, so it is null only where the whole
    group has null ids. Repeated rows come back as often as they came; null and wordless texts
    have fingerprint zero and link like any other; further columns are ignored.
    """
    rows = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), width).select("doc_id", "fp")
    rows = materialize(rows, "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = materialize(classes, "classes")
    roots = components(hamming_links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", hexed, "component_id")


def bands_for(similarity: float) -> int:
    """Bands of ``ROWS`` minima of which pairs at ``similarity`` share none once in 10 ** 9 times."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    return 1 if similarity == 1 else math.ceil(math.log(MISSED) / math.log1p(-(similarity**ROWS)))


@functools.cache
def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20160)
    return rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def minhashes(text: str | None, shingle: int, bands: int) -> tuple[int, list[int]]:
    """Digest of the set of word shingles (0 if wordless), and a bucket for each band.

    Two texts share a band's bucket if ``ROWS`` minima over their shingle sets agree, each of
    which does with the probability of their Jaccard similarity, whatever the texts' lengths.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0, []
    each = {w: xxhash.xxh64_intdigest(w, 42) for w in set(found)}
    hashes = np.fromiter((each[w] for w in found), np.uint64, len(found))
    width = min(shingle, len(found))
    mixed = np.full(len(found) - width + 1, width, np.uint64)
    for j in range(width):
        mixed = (mixed ^ hashes[j : j + len(mixed)]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    values = np.unique(mixed)
    same = xxhash.xxh64_intdigest(values.tobytes(), 42) or 1
    short = (values >> np.uint64(32)).astype(np.uint32)
    factor, shift = _orders(ROWS * bands)
    least = np.full(ROWS * bands, (1 << 32) - 1, np.uint32)
    for at in range(0, len(short), 256):
        ranks = factor * short[at : at + 256, None]
        ranks += shift
        np.minimum(least, ranks.min(axis=0), out=least)
    buckets = [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(bands, ROWS))]
    return _signed(same), [_signed(x) for x in buckets]


def _alike(similarity: float) -> Column:
    common = F.size(F.array_intersect("one", "other"))
    union = F.size("one") + F.size("other") - common
    return (union == 0) | (common >= F.lit(similarity) * union)


def _verified(pairs: DataFrame, shingled: DataFrame, similarity: float) -> DataFrame:
    side = lambda end, name: shingled.select(F.col("same").alias(end), F.col("shingles").alias(name))
    return pairs.join(side("a", "one"), "a").join(side("b", "other"), "b").where(_alike(similarity)).select("a", "b")


def _linked(similarity: float, mine: tuple[np.ndarray, ...], theirs: tuple[np.ndarray, ...]) -> list[tuple[int, int]]:
    """Links between the texts of two blocks that are in different components, as few as join the
    same components as all such pairs at the similarity would.

    A block is ids, components, numbers of shingles and all shingles in a row. Overlaps with a whole block are
    counted through its shingles in order, for texts of a fitting size only.
    """
    ids, comps, sizes, shingles = mine
    other_ids, other_comps, other_sizes, other_shingles = theirs
    _, labels = np.unique(np.concatenate((comps, other_comps)), return_inverse=True)
    own, other = labels[: len(ids)].copy(), labels[len(ids) :].copy()
    order = np.argsort(other_shingles, kind="stable")
    values, owners = other_shingles[order], np.repeat(np.arange(len(other_ids)), other_sizes)[order]
    links = []
    for i, part in enumerate(np.split(shingles, np.cumsum(sizes)[:-1])):
        small, large = np.minimum(other_sizes, sizes[i]), np.maximum(other_sizes, sizes[i])
        fits = (other != own[i]) & (small >= similarity * large)
        if not fits.any():
            continue
        low, high = np.searchsorted(values, part, "left"), np.searchsorted(values, part, "right")
        count = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        common = np.bincount(owners[at], minlength=len(other_ids))
        alike = np.flatnonzero(fits & (common >= similarity * (sizes[i] + other_sizes - common)))
        for label, first in zip(*np.unique(other[alike], return_index=True), strict=True):
            links.append((int(ids[i]), int(other_ids[alike[first]])))
            own[own == label], other[other == label] = own[i], own[i]
    return links


def _links_between(texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between components of a group, complete up to what they join.

    ``texts`` (grp, same, comp, shingles). The largest component of a group is not compared with
    itself; the texts of the others are compared with the whole group, block by block. Blocks
    hold a bounded number of shingles, so a group of any size is many tasks.
    """
    sized = texts.withColumn("size", F.size("shingles"))
    by_comp = sized.groupBy("grp", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("part"))
    largest = F.max(F.struct("n", "comp", "part")).alias("main")
    whole = by_comp.groupBy("grp").agg(largest, F.sum("part").alias("total"))
    sized = sized.join(whole.select("grp", F.col("main.comp").alias("main"), "total", (F.col("total") - F.col("main.part")).alias("asked")), "grp")

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        blob = lambda column, kind: np.asarray(column, kind).tobytes()
        whole = np.concatenate([np.asarray(x, np.int32) for x in frame["shingles"]])
        return pd.DataFrame({"grp": [key[0]], "ids": [blob(frame["same"], np.int64)], "comps": [blob(frame["comp"], np.int64)], "sizes": [blob(frame["size"], np.int64)], "shingles": [whole.tobytes()]})

    def blocks(rows: DataFrame, total: str, limit: int) -> DataFrame:
        chunk = F.pmod(F.xxhash64("same"), F.ceil(F.col(total) / limit)).alias("chunk")
        return rows.select("grp", chunk, "same", "comp", "size", "shingles").groupBy("grp", "chunk").applyInPandas(pack, "grp bigint, ids binary, comps binary, sizes binary, shingles binary")

    @F.udf("array<struct<a: bigint, b: bigint>>", useArrow=False)
    def compare(*blobs: bytes) -> list[tuple[int, int]]:
        kinds = (np.int64, np.int64, np.int64, np.int32)
        opened = [np.frombuffer(x, kind) for x, kind in zip(blobs, kinds * 2, strict=True)]
        return _linked(similarity, tuple(opened[:4]), tuple(opened[4:]))

    names = ("ids", "comps", "sizes", "shingles")
    asking = blocks(sized.where("comp <> main"), "asked", ASKED).select("grp", *[F.col(c).alias(f"q_{c}") for c in names])
    met = materialize(asking, "asking").join(materialize(blocks(sized, "total", HELD), "held"), "grp")
    return met.select(F.inline(compare(*[f"q_{c}" for c in names], *names)))


def fingerprint_pairs(texts: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b) of ``texts`` (same, fp) that join what fingerprints at most ``radius`` bits apart
    link: every text with the first of its fingerprint, and the firsts of linked fingerprints."""
    classes = materialize(texts.groupBy("fp").agg(F.min("same").alias("lead")), "classes")
    lead = lambda end: classes.select(F.col("fp").alias(end), F.col("lead").alias(f"lead_{end}"))
    links = hamming_links(classes.select("fp"), radius).join(lead("a"), "a").join(lead("b"), "b")
    inside = texts.join(classes, "fp").where("same <> lead").select(F.col("lead").alias("a"), F.col("same").alias("b"))
    return inside.unionAll(links.select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b")))


def _copies(members: DataFrame, shingled: DataFrame, similarity: float, near: DataFrame) -> DataFrame:
    """Copies (a, b) whose components equal those of all copies that share a bucket or are ``near`` pairs.

    At first near pairs are measured and every text meets the first text of one of its buckets, then, where that left it in
    another component, the first texts of all its buckets: a bounded number of pairs a text.
    Copies of one text are joined by then. What is left are buckets that still hold several
    components: buckets with a text in common form a group, and inside a group the components
    are compared block by block, which adds rows for links only.
    """
    pairs = members.where("same <> hub").groupBy("same").agg(F.min("hub").alias("hub")).select(F.col("hub").alias("a"), F.col("same").alias("b"))
    pairs = near.unionAll(pairs).distinct()
    copies = materialize(_verified(materialize(pairs, "pairs"), shingled, similarity), "copies")
    placed = _placed(members, components(copies))
    pairs = placed.where("comp <> hub_comp").select(F.col("hub").alias("a"), F.col("same").alias("b")).distinct()
    copies = copies.unionAll(materialize(_verified(materialize(pairs, "pairs"), shingled, similarity), "copies"))
    placed = materialize(_placed(members, components(copies)), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
    mixed = materialize(placed.join(mixed.select("bucket"), "bucket", "left_semi").select("hub", "same", "comp").distinct(), "mixed")
    groups = components(mixed.select(F.col("hub").alias("a"), F.col("same").alias("b")))
    texts = mixed.select("same", "comp").distinct().join(groups.select(F.col("node").alias("same"), F.col("root").alias("grp")), "same")
    return copies.unionAll(materialize(_links_between(texts.join(shingled, "same"), similarity), "links"))


def _placed(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members of buckets with their component and that of the bucket's first text."""
    of = lambda end, name: joined.select(F.col("node").alias(end), F.col("root").alias(f"_{name}"))
    rows = members.select("bucket", "hub", "same").join(of("same", "comp"), "same", "left").join(of("hub", "hub_comp"), "hub", "left")
    return rows.select("bucket", "hub", "same", F.coalesce("_comp", "same").alias("comp"), F.coalesce("_hub_comp", "hub").alias("hub_comp"))


def drop_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` without near copies; one document of each group stays, in all its columns.

    Pairs whose sets of ``shingle``-word shingles have Jaccard similarity ``similarity`` or more
    are copies, measured on 31-bit hashes of the shingles of both whole texts. Candidates are linked
    by SimHash fingerprints at most 3 bits apart, found by covering masks, or, farther apart, share
    the bucket of a band of minimum hashes over the same shingles; as many bands are searched as
    miss a pair at ``similarity`` once in 10 ** 9 times, and closer ones less often. A group is
    what copies join; its smallest id stays. Equal texts and repeated rows are one text; null and
    wordless texts are copies of each other; null ids stay only in groups without any other.
    """
    key = F.xxhash64(F.col(text), F.lit(1))
    bands = bands_for(similarity)

    @F.pandas_udf("same bigint, bands array<bigint>, fp bigint")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(*minhashes(t, shingle, bands), fingerprint(t, 3)) for t in texts], columns=["same", "bands", "fp"])

    rows = docs.select(F.col(doc_id).alias("_id"), key.alias("_key"), hashed(F.col(text)).alias("h"))
    # wordless texts, null or not, are one text, and so are texts with equal shingles
    rows = materialize(rows.select("_id", "_key", "h.same", "h.bands", "h.fp"), "rows")
    texts = rows.where(F.size("bands") > 0).groupBy("same").agg(F.min("_key").alias("_key"), F.first("bands").alias("bands"), F.min("fp").alias("fp"))
    near = materialize(fingerprint_pairs(texts.select("same", "fp")), "near")
    dealt = texts.select("same", "_key", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.min("same").alias("hub")).where("n > 1").select("bucket", "hub")
    members = materialize(dealt.join(shared, "bucket"), "members")
    ends = near.select(F.explode(F.array("a", "b")).alias("same")).distinct()
    named = members.select("same", "_key").unionAll(texts.join(ends, "same").select("same", "_key")).distinct()
    rows = rows.drop("bands", "fp")
    source = docs.select(words(ascii_lower(F.col(text)), BLANK_WORD).alias("w"), key.alias("_key"))
    source = source.join(named, "_key", "left_semi").dropDuplicates(["_key"])
    short = F.transform(window_hashes(F.col("w"), shingle), lambda h: h.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    shingled = source.select("_key", F.array_distinct(short).alias("shingles")).join(named, "_key").select("same", "shingles")
    groups = components(_copies(members, materialize(shingled, "shingles"), similarity, near)).withColumnRenamed("node", "same")
    order = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_key").alias("key"))
    rooted = rows.join(groups, "same", "left").withColumn("root", F.coalesce("root", "same"))
    first = rooted.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    crowded = rooted.join(first, "root")
    gone = crowded.where(~F.col("first.id").eqNullSafe(F.col("_id")) | (F.col("first.key") != F.col("_key"))).select("_id", "_key").distinct()
    again = rows.groupBy("_id", "_key").count().where("count > 1").select("_id", "_key")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("_i"), key.alias("_k"))
    same = lambda side: whole["_k"].eqNullSafe(side["_key"]) & whole["_i"].eqNullSafe(side["_id"])
    left = whole.join(gone, same(gone), "left_anti")
    # rows that repeat an id and a text are one document
    once = left.join(again, same(again), "left_anti").select("row")
    repeated = left.join(again, same(again), "left_semi").dropDuplicates(["_i", "_k"]).select("row")
    return once.unionAll(repeated).select("row.*")
