"""Benchmark decontamination by a broadcast hash set of test n-grams.

Every run of ``width`` words of a benchmark item is a window. Document windows are hashed and
probe the broadcast set in the scan's own stage; hits are verified there by comparing the words
themselves, so only verified occurrences are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.llm.common import ascii_lower, run_hash, window_hashes, words
from orebelt.session import materialize

#: ASCII digits and letters, and everything beyond ASCII, make words.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased.
RAW_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of windows broadcast at once; a larger set is cut by hash into parts that are broadcast
#: one after the other, each to a scan of its own.
BROADCAST_BYTES = 64 << 20
#: Ids of items beside a window: where more items exist, a window's ids are dealt to several rows.
ITEMS = 10_000
#: Words of a text that are looked at together.
CHUNK = 64


def _tokens(text: Column) -> Column:
    return words(ascii_lower(text), PATTERN)


def benchmark_windows(benchmark: DataFrame, width: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Different windows of all items: ``len, hash, window`` (words) and the ``items`` that hold them.

    Item ids are dealt by hash, so that a row holds about ``ITEMS`` of them at most; a window that
    more items share has several rows, told apart by ``deal``.

    An item of fewer than ``width`` words, but not none, is one window; null texts have none.
    Item ids are kept as strings; items without an id count under a null that hits but is not listed.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), _tokens(F.col(text)).alias("w")).where("size(w) > 0")
    last = F.greatest(F.size("w") - F.lit(width - 1), F.lit(1))
    window = F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("w", i, width))).alias("window")
    deals = -(-benchmark.count() // ITEMS) or 1
    each = items.select("item", F.pmod(F.xxhash64("item"), F.lit(deals)).alias("deal"), window)
    each = each.groupBy("window", "deal").agg(F.collect_set("item").alias("items"))
    return each.select(F.size("window").alias("len"), run_hash(F.col("window"), width).alias("hash"), "window", "items", "deal")


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified occurrences per document: ``doc_id, key, copies, n_words, spans, items``.

    ``key`` is a hash of the text and ``copies`` counts the rows that share id and text;
    ``spans`` are sorted (start, end) word positions of occurrences, 1-based and half-open,
    ``items`` the sorted ids of the items that occur. Null texts have no words.
    """
    windows = materialize(benchmark_windows(benchmark, width), "windows")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most ``width`` values
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text), F.lit(1)).alias("key"), _tokens(F.col(text)).alias("w"))
    # long texts are cut into overlapping chunks, so that a window carries a chunk's words at most
    starts = F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1)), F.lit(CHUNK))
    chunks = F.posexplode(F.transform(starts, lambda i: F.slice("w", i, CHUNK + width - 1))).alias("c", "words")
    rows = rows.select("doc_id", "key", F.size("w").alias("n_words"), chunks)
    # the first element stands for the chunk itself, the others for its windows in order
    hashes, length, at, seen = [F.array(F.lit(None).cast("bigint"))], F.lit(0), F.lit(0), F.lit(0)
    for n in lengths:
        count = F.least(F.greatest(F.size("words") - F.lit(n - 1), F.lit(0)), F.lit(CHUNK))
        own = F.slice("words", 1, CHUNK + n - 1)
        hashes.append(F.when(F.size("words") >= n, window_hashes(F.col("words") if n == width else own, n)).otherwise(F.array().cast("array<bigint>")))
        mine = (F.col("k") > seen) & (F.col("k") <= seen + count)
        length, at, seen = F.when(mine, F.lit(n)).otherwise(length), F.when(mine, F.col("k") - seen).otherwise(at), seen + count
    rows = rows.select("doc_id", "key", "n_words", "c", "words", F.posexplode(F.concat(*hashes)).alias("k", "h"))
    held = F.lit(48) + F.octet_length(F.array_join("window", "")) + F.octet_length(F.array_join("items", "")) + 16 * (F.col("len") + F.size("items"))
    parts = -(-(windows.agg(F.sum(held)).first()[0] or 0) // BROADCAST_BYTES) or 1
    met = None
    for part in range(parts):
        known = F.broadcast(windows.where(F.pmod(F.xxhash64("hash", "deal"), F.lit(parts)) == part))
        joined = rows.join(known, rows["h"] == known["hash"], "left")
        verified = F.col("items").isNotNull() & (F.slice("words", F.greatest(at, F.lit(1)), length) == F.col("window"))
        marker = F.lit(part == 0) & (F.col("k") == 0) & (F.col("c") == 0)
        start = F.col("c") * CHUNK + at
        span = F.when(F.col("items").isNotNull(), F.struct(start.alias("start"), (start + F.col("len")).alias("end")))
        joined = joined.where(marker | verified).select("doc_id", "key", "n_words", ((F.col("k") == 0) & (F.col("c") == 0)).alias("first"), span.alias("span"), "items")
        met = joined if met is None else met.unionAll(joined)
    return met.groupBy("doc_id", "key", "n_words").agg(
        F.sum(F.col("first").cast("long")).alias("copies"),
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def merged(spans: Column) -> Column:
    """Sorted spans joined where they meet or overlap."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(done: Column, span: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        meets = (F.size(done) > 0) & (last["end"] >= span["start"])
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.when(F.size(spans) == 0, empty).otherwise(F.aggregate(spans, empty, add))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items`` and ``spans``.

    ``n_hit`` counts words inside any occurrence of a window, each once; ``spans`` are the
    merged word ranges. Null, empty and wordless texts have zero of everything; repeated rows
    come back as often as they came, even with equal or null ids; further columns are ignored;
    an empty benchmark hits nothing.
    """
    found = hits(docs, benchmark, width, doc_id, text).withColumn("spans", merged(F.col("spans")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    out = found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    return out.drop("_copy")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, action: str = "document", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without contaminated documents (``action="document"``), or with the words of
    every occurrence cut from the text (``action="span"``; what stands between the other words
    stays as it is). Clean rows are returned unchanged, in all their columns; contaminated ones
    are found by id and text, so a repeated id with a clean text stays.
    """
    found = hits(docs, benchmark, width, doc_id, text).where("size(spans) > 0").select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), merged(F.col("spans")).alias("_spans"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("_id"), F.xxhash64(F.col(text), F.lit(1)).alias("_key"))
    same = whole["_id"].eqNullSafe(found["_d"]) & (whole["_key"] == found["_k"])
    if action == "document":
        return whole.join(found, same, "left_anti").select("row.*")
    if action != "span":
        raise ValueError(f"action must be document or span, not {action}")
    marked = whole.join(found, same, "left")
    body = F.col("row")[text]
    # gaps[i] stands before word i; gaps and words alternate, so the text is rebuilt exactly
    gaps = F.split(body, RAW_PATTERN, -1)
    tokens = words(body, RAW_PATTERN)
    inside = lambda i: F.exists("_spans", lambda s: (i + 1 >= s["start"]) & (i + 1 < s["end"]))
    kept = F.transform(tokens, lambda w, i: F.when(inside(i), F.lit("")).otherwise(w))
    pairs = F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(kept, i), F.lit(""))))
    cleaned = F.when(F.col("_spans").isNull(), body).otherwise(F.array_join(pairs, ""))
    return marked.select(F.col("row").withField(text, cleaned).alias("row")).select("row.*")
