"""Hard negatives by slot-decomposed selection.

An anchor asks, for each of its positives, for the best rows of another label whose score lies in
a window below the positive's score. The windows overlap, and their upper limits split the scores
into disjoint slots. One pass over all rows keeps the best ``k`` of each slot: combiners inside a
pair of blocks, then Spark's limited ranking before and after the shuffle. Merging the slots from
the lowest up gives, after each slot, the best ``k`` at or below its limit, which answers every
window that ends there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebelt.session import materialize

#: Rows and anchors that are multiplied together at once, and rows an anchor block meets in one cell.
ROWS, ANCHORS, CELL = 1024, 256, 4096
#: Squared length from which a vector takes no part: below it all scores are exact in 64 bits.
TOO_LONG = float(1 << 56)

_BEST = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "slot", "m", "id")]))
_BLOCK = "dim int, ids binary, labels binary, numbers binary"


def _packed(frame: pd.DataFrame, size: int, *more: str) -> Iterator[pd.DataFrame]:
    """Rows of equal vector length as blocks, sorted by id."""
    for dim, part in frame.groupby("dim"):
        part = part.sort_values("id", kind="stable")
        for at in range(0, len(part), size):
            some = part.iloc[at : at + size]
            packed = {"dim": [dim], "ids": [some["id"].to_numpy(np.int64).tobytes()], "labels": [some["label"].to_numpy(np.int64).tobytes()], "numbers": [np.stack(some["vec"].to_numpy()).astype(np.int32).tobytes()]}
            yield pd.DataFrame(packed | {c: [np.stack(some[c].to_numpy()).astype(np.int64).tobytes()] for c in more})


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where no partial sum can pass 2^53, else in integers."""
    a, b = anchors.astype(np.float64), rows.astype(np.float64)
    if len(a) and len(b) and (a * a).sum(axis=1).max() * (b * b).sum(axis=1).max() < 2.0**104:
        return (a @ b.T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def best(values: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the positions ``at`` (by id) the ``k`` with the highest values, ties to the first."""
    if len(at) > k:
        mine = values[at]
        at = at[mine >= np.partition(mine, len(mine) - k)[len(mine) - k]]
    return at[np.argsort(-values[at], kind="stable")[:k]]


def mine(
    vectors: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    k: int = 10,
    low: int = 30,
    high: int = 90,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embedding`` holds integers; a score is the inner product. An anchor's positives are its
    ``n_positives`` best other rows of its label, its negatives for one of them the ``k`` best
    rows of other labels with ``low * positive <= 100 * negative <= high * positive``; ties go
    to the smaller id. Fewer are returned where there are fewer; a positive below zero has no
    negatives, an anchor without positives no rows.

    No part take rows without id, label or vector, with a null component, or of a squared length
    of 2^56 or more. Vectors of different length never meet. Equal rows count once; different
    rows of one id are anchors and candidates of their own, but never meet each other. An empty
    table gives no rows; further columns are ignored.

    Anchors meet rows block by block, dealt to cells of a fixed number of rows; nothing is
    broadcast on purpose and no label, score or vector decides where a row goes.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{embedding}`").cast("array<bigint>").alias("vec"), F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.where("id is not null and label is not null and vec is not null").where(F.coalesce(length < TOO_LONG, F.lit(False)))
    rows = materialize(rows.distinct().withColumn("dim", F.size("vec")), "rows")
    # the written table fixes what an anchor's number stands for
    asked = materialize(rows.where("asks").select(F.monotonically_increasing_id().alias("anchor"), "id", "label", "dim", "vec"), "anchors")
    cells = max(1, -(-rows.count() // CELL))

    def row_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from _packed(frame, ROWS)

    def anchor_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from _packed(frame, ANCHORS, *[c for c in ("anchor", "limits", "least") if c in frame])

    blocks = rows.select("id", "label", "dim", "vec").mapInPandas(row_blocks, _BLOCK)
    blocks = materialize(blocks.withColumn("cell", F.pmod(F.xxhash64("ids", "numbers"), F.lit(cells))), "row_blocks")

    def meet(packed: DataFrame, compare, *more: str) -> DataFrame:
        """The best of each anchor and slot from all blocks of rows."""
        names = ["ids", "labels", "numbers", "anchor", *more]
        copies = packed.select("dim", *[F.col(c).alias(f"a_{c}") for c in names], F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"))
        met = blocks.join(copies, ["cell", "dim"])
        return met.select(F.inline(compare("ids", "labels", "numbers", *[f"a_{c}" for c in names])))

    def opened(ids, labels, numbers):
        ids = np.frombuffer(ids, np.int64)
        return ids, np.frombuffer(labels, np.int64), np.frombuffer(numbers, np.int32).reshape(len(ids), -1)

    @F.udf(_BEST, useArrow=False)
    def nearest_same(ids, labels, numbers, a_ids, a_labels, a_numbers, anchor):
        ids, labels, data = opened(ids, labels, numbers)
        a_ids, a_labels, a_data = opened(a_ids, a_labels, a_numbers)
        found = []
        for number, own, mark, values in zip(np.frombuffer(anchor, np.int64).tolist(), a_ids, a_labels, scores(a_data, data), strict=True):
            at = best(values, np.flatnonzero((labels == mark) & (ids != own)), n_positives)
            found += [(number, 0, -m, i) for m, i in zip(values[at].tolist(), ids[at].tolist(), strict=True)]
        return found

    @F.udf(_BEST, useArrow=False)
    def nearest_other(ids, labels, numbers, a_ids, a_labels, a_numbers, anchor, limits, least):
        ids, labels, data = opened(ids, labels, numbers)
        a_ids, a_labels, a_data = opened(a_ids, a_labels, a_numbers)
        limits, least = np.frombuffer(limits, np.int64).reshape(len(a_ids), -1), np.frombuffer(least, np.int64)
        found = []
        for number, own, mark, values, ends, floor in zip(np.frombuffer(anchor, np.int64).tolist(), a_ids, a_labels, scores(a_data, data), limits, least, strict=True):
            at = np.flatnonzero((labels != mark) & (ids != own) & (values >= floor) & (values <= ends[0]))
            slot = (ends >= values[at][:, None]).sum(axis=1) - 1
            for s in np.unique(slot).tolist():
                top = best(values, at[slot == s], k)
                found += [(number, s, -m, i) for m, i in zip(values[top].tolist(), ids[top].tolist(), strict=True)]
        return found

    def ranked(found: DataFrame, limit: int) -> DataFrame:
        order = Window.partitionBy("anchor", "slot").orderBy("m", "id")
        return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= limit)

    packed = asked.select("id", "label", "dim", "vec", "anchor").mapInPandas(anchor_blocks, _BLOCK + ", anchor binary")
    near = ranked(meet(packed, nearest_same), n_positives)
    # a positive below zero has an empty window: low * p > high * p
    near = near.where("m <= 0").groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("m", "id"))).alias("positives"))
    ends = F.transform("positives", lambda p: _whole(-p["m"] * high, 0))
    # the lowest limit fills up the slots that fewer positives leave
    near = near.withColumn("limits", F.concat(ends, F.array_repeat(F.element_at(ends, -1), F.lit(n_positives) - F.size("positives"))))
    near = near.withColumn("least", F.array_min(F.transform("positives", lambda p: _whole(-p["m"] * low, 99))))
    near = materialize(asked.join(near, "anchor"), "positives")

    packed = near.select("id", "label", "dim", "vec", "anchor", "limits", "least").mapInPandas(anchor_blocks, _BLOCK + ", anchor binary, limits binary, least binary")
    slots = ranked(meet(packed, nearest_other, "limits", "least"), k).groupBy("anchor", "slot").agg(F.array_sort(F.collect_list(F.struct("m", "id"))).alias("top"))
    slots = slots.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "top"))).alias("slots"))

    nothing = F.array().cast("array<struct<m: bigint, id: bigint>>")
    start = F.struct(nothing.alias("top"), F.array().cast("array<array<struct<m: bigint, id: bigint>>>").alias("through"))

    def merge(state: Column, slot: Column) -> Column:
        """A slot before all lower ones: every score of it is higher."""
        top = F.slice(F.concat(F.coalesce(F.try_element_at("slots", slot), nothing), state["top"]), 1, k)
        return F.struct(top.alias("top"), F.concat(F.array(top), state["through"]).alias("through"))

    # through[s]: the best k of the slots from s down
    through = F.aggregate(F.sequence(F.lit(n_positives - 1).cast("long"), F.lit(0).cast("long"), F.lit(-1).cast("long")), start, merge, lambda state: state["through"])
    answers = near.select("anchor", F.col("id").alias("anchor_id"), "positives", "limits").join(slots, "anchor").withColumn("through", through)
    answers = answers.select("anchor_id", "limits", "through", F.explode("positives").alias("p")).withColumn("positive_score", -F.col("p.m"))
    slot = F.size(F.filter("limits", lambda x: x >= _whole(F.col("positive_score") * high, 0))) - 1
    inside = F.filter(F.get("through", slot), lambda n: -n["m"] * 100 >= F.col("positive_score") * low)
    answers = answers.select("anchor_id", F.col("p.id").alias("positive_id"), "positive_score", F.posexplode(inside).alias("at", "n"))
    return answers.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", (-F.col("n.m")).alias("negative_score")
    )


def _whole(hundredfold: Column, up: int) -> Column:
    """A hundredth of a number not below zero, rounded down (``up`` 0) or up (99)."""
    return F.call_function("div", hundredfold + up, F.lit(100).cast("long"))
