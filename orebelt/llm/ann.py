"""Nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are rotated at random, so that any first dimensions of a rotated vector are a sample of
its energy, and stored list by list in blocks of columns (ADSampling, Gao and Long 2023; PDX,
Kuffo et al. 2025). A scan adds the squared differences of one column block after another. After
each it tests the hypothesis that a candidate's full distance still reaches the query's tenth
best: if the partial distance, scaled up to all dimensions, passes the threshold by more than
the sampling error allows, the candidate is abandoned. Survivors are measured exactly on the
original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebelt.session import materialize

#: The index (centroids, thresholds) is fitted to this many vectors, those of the smallest id
#: hashes, and to at most this many numbers altogether; every vector is indexed.
SAMPLE_ROWS, SAMPLE_NUMBERS = 4096, 1 << 22
#: Vectors of a list that are scanned together, queries that scan them together, columns a step adds.
BLOCK, QUERIES, COLUMNS = 512, 32, 16
#: Width of the hypothesis test in standard errors, as in the paper.
EPSILON = 2.1

_FOUND = T.ArrayType(T.StructType([T.StructField("q", T.LongType()), T.StructField("v", T.LongType()), T.StructField("d", T.DoubleType())]))


def _valid(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _fit(sample: np.ndarray, lists: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random rotation and centroids of the rotated sample (Lloyd's algorithm, ten rounds)."""
    rng = np.random.default_rng(seed)
    rotation, r = np.linalg.qr(rng.standard_normal((sample.shape[1], sample.shape[1])))
    rotation *= np.sign(np.diag(r))
    data = sample @ rotation
    centres = data[rng.permutation(len(data))[:lists]].copy()
    for _ in range(10):
        near = _squared(data, centres).argmin(axis=1)
        for k in np.unique(near):
            centres[k] = data[near == k].mean(axis=0)
    return rotation, centres


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)


def scan(queries: np.ndarray, reach: np.ndarray, columns: np.ndarray, k: int) -> list[np.ndarray]:
    """Rows of a block, stored column by column, that may be among each query's ``k`` nearest.

    ``reach`` bounds each query's k-th squared distance from above; the block's own best lower it.
    """
    dim, n = columns.shape
    out = []
    for query, bound in zip(queries, reach, strict=True):
        alive = np.arange(n)
        partial = np.zeros(n)
        for at in range(0, dim, COLUMNS):
            to = min(dim, at + COLUMNS)
            part = columns[at:to] if len(alive) == n else columns[at:to, alive]
            partial = partial + ((part - query[at:to, None]) ** 2).sum(axis=0)
            if to < dim:
                ratio = math.sqrt(to / dim) * (1 + EPSILON / math.sqrt(to))
                stay = partial <= bound * ratio * ratio
                alive, partial = alive[stay], partial[stay]
            if not len(alive):
                break
        if len(alive) > k:
            bound = min(bound, float(np.partition(partial, k - 1)[k - 1]))
        out.append(alive[partial <= bound * (1 + 1e-9)])
    return out


def neighbours(
    vectors: DataFrame, queries: Column, k: int = 10, probes: float = 0.8, seed: int = 11, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest other vectors.

    ``queries`` is a condition on the rows of ``vectors``; candidates are all rows but the
    query's own. ``score`` is the Euclidean distance in double precision; ties go to the smaller
    id; a query with fewer candidates has fewer rows. ``probes`` is the share of the lists that
    a query scans, nearest first. Null, zero and non-finite vectors, vectors of another length
    than most (the longer of equally frequent ones) and rows without an id take no part. Rows
    that repeat an id are candidates and queries of their own once per different vector.

    Equal vectors are searched as one: of each, the ``k`` + 1 smallest ids are kept, which no
    further copy could displace. Lists are cut by id into blocks, so a crowded one is scanned by
    many tasks.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    double = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), double.alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("vec"))).withColumn("dim", F.size("vec"))
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return empty
    dim = dims[0]
    rows = rows.where(F.col("dim") == dim).withColumn("h", F.xxhash64("vec"))
    rows = materialize(rows.select("id", "h", "vec", "asks").distinct(), "vectors")
    # one vector, the ids that can matter; the rank limit is applied before the shuffle too
    ranked = rows.select("id", "h", "vec").distinct().withColumn("r", F.row_number().over(Window.partitionBy("h", "vec").orderBy("id"))).where(F.col("r") <= k + 1)
    holders = materialize(ranked.select("h", "vec", "id", "r"), "holders")
    single = holders.where("r = 1").select(F.col("id").alias("rep"), "h", "vec")
    n = single.count()
    size = max(k + 2, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dim))
    sample = np.array([r[0] for r in single.orderBy(F.xxhash64("rep", F.lit(seed)), "rep").limit(size).select("vec").collect()])
    lists = max(1, min(int(math.sqrt(n)), len(sample) // 8))
    rotation, centres = _fit(sample, lists, seed)
    sample = sample @ rotation
    probed = max(1, math.ceil(probes * len(centres)))
    carried = spark.sparkContext.broadcast((rotation, centres, sample))

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of one list, sorted together, become column blocks."""
        for frame in frames:
            for number, part in frame.groupby("list"):
                for at in range(0, len(part), BLOCK):
                    some = part.iloc[at : at + BLOCK]
                    data = np.stack(some["vec"].to_numpy())
                    yield pd.DataFrame({"list": [number], "ids": [some["rep"].to_numpy(np.int64).tobytes()], "columns": [np.ascontiguousarray((data @ carried.value[0]).T).tobytes()], "plain": [np.ascontiguousarray(data).tobytes()]})

    @F.pandas_udf("int")
    def nearest(vecs: pd.Series) -> pd.Series:
        rotation, centres, _ = carried.value
        return pd.Series(_squared(np.stack(vecs.to_numpy()) @ rotation, centres).argmin(axis=1).astype("int32"))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with the lists it probes and a bound on its k-th distance from the sample."""
        rotation, centres, sample = carried.value
        homes = _squared(sample, centres).argmin(axis=1)
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                data = np.stack(part["vec"].to_numpy()) @ rotation
                near = np.argsort(_squared(data, centres), axis=1, kind="stable")[:, :probed]
                seen = np.zeros((len(part), len(centres)), bool)
                np.put_along_axis(seen, near, True, axis=1)
                far = np.where(seen[:, homes], _squared(data, sample), np.inf)  # sample vectors of the probed lists
                reach = np.partition(far, k, axis=1)[:, k] * (1 + 1e-9) + 1e-9 if far.shape[1] > k else np.full(len(part), np.inf)
                yield pd.DataFrame({"list": near.ravel().astype("int32"), "rep": np.repeat(part["rep"].to_numpy(), probed), "reach": np.repeat(reach, probed), "vec": [v for v in part["vec"] for _ in range(probed)]})

    def group(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, part in frame.groupby("list"):
                for at in range(0, len(part), QUERIES):
                    some = part.iloc[at : at + QUERIES]
                    yield pd.DataFrame({"list": [number], "asking": [some["rep"].to_numpy(np.int64).tobytes()], "reach": [some["reach"].to_numpy(np.float64).tobytes()], "wanted": [np.stack(some["vec"].to_numpy()).tobytes()]})

    @F.udf(_FOUND, useArrow=False)
    def compare(ids: bytes, columns: bytes, plain: bytes, asking: bytes, reach: bytes, wanted: bytes) -> list[tuple[int, int, float]]:
        ids, asking = np.frombuffer(ids, np.int64), np.frombuffer(asking, np.int64)
        data, want = np.frombuffer(plain).reshape(-1, dim), np.frombuffer(wanted).reshape(-1, dim)
        found = scan(want @ carried.value[0], np.frombuffer(reach), np.frombuffer(columns).reshape(dim, -1), k + 1)
        out = []
        for one, query, at in zip(asking.tolist(), want, found, strict=True):
            exact = np.sqrt(((data[at] - query) ** 2).sum(axis=1))
            out += [(one, v, d) for v, d in zip(ids[at].tolist(), exact.tolist(), strict=True)]
        return out

    listed = single.withColumn("list", nearest("vec")).select("list", "rep", "vec")
    # ranges of (list, id) from Spark's own sampling: a crowded list is cut across partitions
    index = listed.repartitionByRange("list", "rep").sortWithinPartitions("list", "rep").mapInPandas(blocks, "list int, ids binary, columns binary, plain binary")
    index = materialize(index, "blocks")
    asking = rows.where("asks").select("id", "h", "vec")
    asked = single.join(asking.select("h", "vec").distinct(), ["h", "vec"], "left_semi").select("rep", "vec").mapInPandas(ask, "list int, rep long, reach double, vec array<double>")
    asked = asked.repartitionByRange("list", "rep").sortWithinPartitions("list", "rep").mapInPandas(group, "list int, asking binary, reach binary, wanted binary")
    met = index.join(asked, "list").select(F.inline(compare("ids", "columns", "plain", "asking", "reach", "wanted"))).select(F.col("q").alias("rep_q"), "v", "d")
    best = Window.partitionBy("rep_q").orderBy("d", "v")
    met = met.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    # from vectors back to ids, on both sides
    copies = holders.join(single.select("rep", "h", "vec"), ["h", "vec"]).select(F.col("rep").alias("v"), "id")
    askers = asking.join(single, ["h", "vec"]).select(F.col("rep").alias("rep_q"), F.col("id").alias("query_id"))
    final = met.join(copies, "v").join(askers, "rep_q").where("id <> query_id")
    final = final.groupBy("query_id", F.col("id").alias("vec_id")).agg(F.min("d").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return final.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
