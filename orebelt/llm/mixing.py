"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document of weight w gets the key -ln(u) / w with u uniform; taking documents by ascending
key samples without replacement in proportion to weight. Each source takes complete epochs of
all its documents first, then the documents whose running size fits what is left of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebelt.llm.common import BLANK_WORD
from orebelt.session import materialize

#: Key ranges per source: a source is ordered range by range, never in one task.
RANGES = 4096
_UNIFORM = float(1 << 52)


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(BLANK_WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes;
    no target passes ``cap`` times its source's size, the excess is shared again by weight. That
    process ends at min(cap * size, level * weight) for one level, found here in a single pass:
    sources sorted by cap * size / weight fill up in that order.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(onwards)
    weighed = weighed.withColumn("level", level)
    # the level is right from the first source on that it does not fill
    fits = F.col("level") * F.col("weight") <= F.col("most")
    final = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.coalesce(F.least("most", final * F.col("weight")), F.col("most"))
    return weighed.select("source", "source_size", share.alias("target"))


def uniform(doc_id: Column, seed: int) -> Column:
    """Repeatable uniform number in (0, 1) from an id (null: from an empty one) and a seed."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(_UNIFORM)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0, seed: int = 20, quality: DataFrame | None = None,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, epochs, copies, taken``.

    ``quality`` (doc_id, quality) gives sampling weights above zero; documents without one, or
    with a null or non-positive one, weigh 1; the largest counts where ids repeat. ``copies`` is
    the number of complete epochs, plus one for documents of the fractional epoch, which takes
    documents by key as long as at least half of the document fits; ``taken`` = copies * size.
    The key depends on id and seed alone, so reruns agree; rows with equal ids are ordered by
    size. Null texts have size 0; a source without words has target 0; null is a source too.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    if quality is not None:
        best = quality.groupBy("doc_id").agg(F.max("quality").cast("double").alias("_q"))
        rows = rows.join(best, "doc_id", "left")
        rows = rows.select("doc_id", "source", "size", F.when(F.col("_q") > 0, F.col("_q")).otherwise(1.0).alias("w"))
    else:
        rows = rows.withColumn("w", F.lit(1.0))
    rows = materialize(rows, "sizes")
    sized = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    rows = rows.withColumn("key", -F.ln(uniform(F.col("doc_id"), seed)) / F.col("w"))
    # exp(-key) falls as the key grows: an even cut into ranges that follows the order of keys
    rows = rows.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * RANGES).cast("int"))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    below = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("range_size").over(below), F.lit(0)))
    sized = sized.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    sized = sized.withColumnRenamed("source", "_t")
    plan = ranges.join(sized, F.col("source").eqNullSafe(F.col("_t"))).select(
        F.col("source").alias("_s"), F.col("range").alias("_r"), "before", "source_size", "target", "epochs"
    )
    both = rows.join(plan, rows["source"].eqNullSafe(plan["_s"]) & (rows["range"] == plan["_r"]))
    ordered = Window.partitionBy("source", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = F.col("before") + F.sum("size").over(ordered)
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    part = (F.col("size") > 0) & (through - F.col("size") / 2 <= left)
    copies = (F.col("epochs") + part.cast("long")).alias("copies")
    out = both.select("doc_id", "source", "size", "source_size", "target", "epochs", copies)
    return out.withColumn("taken", F.col("copies") * F.col("size"))
