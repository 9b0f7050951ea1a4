"""Approximate nearest neighbours by shifted space-filling curves.

Each of several Hilbert curves runs through the vectors after a random rotation onto a few axes and a random shift. Its
keys are range-partitioned in Spark into blocks; near vectors tend to have near keys on one curve at least. A query
meets the vectors of its own and the neighbouring blocks of every curve; what they bring is merged and ranked by exact
distance on the original vectors.

How many neighbouring blocks are needed depends on the data. It is measured: for a bounded sample of queries the true
neighbours are found by comparing with all vectors, and the width is the least that reaches the wanted share of them.

Equal vectors are one point with its smallest ids, so a vector that a third of all rows share is no crowded block.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recall_lens.llm.staging import Staging

CURVES = 12
AXES = 8
BITS = 6
#: Points of a block, and queries that meet a block in one task, on average.
BLOCK = 2_048
QUERIES = 2_048
#: Queries on which the width is measured, and the share of their true neighbours that it must reach.
MEASURED = 96
REACH = 0.97
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each cell (n, axes) of a grid with 2**bits cells an axis, by Skilling's
    transformation of the coordinates' bits."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> b) & 1
    return key


class Curves:
    """Rotations and shifts of the curves, from a seed; the box of the projections comes from the data."""

    def __init__(self, dimension: int, curves: int = CURVES, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.axes = min(AXES, dimension)
        self.turns = [np.linalg.qr(rng.normal(size=(dimension, dimension)))[0][:, : self.axes] for _ in range(curves)]
        self.shifts = [rng.random(self.axes) / 2 for _ in range(curves)]

    def keys(self, vectors: np.ndarray, radius: float) -> list[np.ndarray]:
        """Keys of the vectors on each curve; a projection lies within `radius` of the origin on every axis."""
        top = (1 << BITS) - 1
        out = []
        for turn, shift in zip(self.turns, self.shifts, strict=True):
            place = (vectors @ turn / radius + 1) / 2  # 0 to 1
            out.append(hilbert_keys(np.clip((place + shift) / 1.5 * (top + 1), 0, top).astype(np.int64), BITS))
        return out


_FOUND = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of rows whose vector takes part.

    Left out: null vec_id, null or empty vectors, null or non-finite components, and zero vectors.
    """
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long"), v.alias("v")).where(sound)


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _ranked(df: DataFrame, by: str, most: int) -> DataFrame:
    """The `most` nearest points of each `by`, ties to the smaller point."""
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(by).orderBy("score", "point"))).where(F.col("r_") <= most).drop("r_")


def search(vectors: DataFrame, is_query, k: int = 10, block: int = BLOCK, reach: float = REACH) -> DataFrame:
    """The `k` nearest of all vectors found for each query: query_id, rank (from 1), vec_id, score (Euclidean distance).

    `vectors` has vec_id and embedding; `is_query` is a condition on vec_id. A query is no candidate of its own; rows
    that repeat a vec_id are told apart by their vectors only, so equal rows count once. Ties go to the smaller vec_id.
    Fewer than `k` candidates give fewer rows, no queries none. Between vectors of different lengths there is no distance:
    each length is searched by itself.
    """
    spark = vectors.sparkSession
    staging = Staging(spark, "neighbours")
    rows = staging.table(usable(vectors).dropDuplicates(), "rows")
    sizes = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    found = [_search(rows.where(F.size("v") == n), staging, f"-{n}", is_query, k, block, reach) for n in sizes]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _FOUND)


def _search(rows: DataFrame, staging: Staging, of: str, is_query, k: int, block: int, reach: float) -> DataFrame:
    """`search` among distinct rows of vectors of one length; `of` ends the names of its tables."""
    spark = rows.sparkSession
    first = Window.partitionBy("v").orderBy("vec_id")
    ranked = rows.withColumn("r_", F.row_number().over(first)).where(F.col("r_") <= k + 1)
    members = staging.table(ranked.withColumn("point", F.min("vec_id").over(Window.partitionBy("v"))).drop("r_"), f"members{of}")
    points = members.where("vec_id = point").select("point", "v")
    asked = rows.where(is_query).join(points, "v").select("vec_id", "point")
    asked = staging.table(asked.withColumnRenamed("vec_id", "query_id"), f"asked{of}")
    about = points.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("most"), F.max(F.size("v")).alias("size")).first()
    empty = spark.createDataFrame([], _FOUND)
    if not about.n:
        return empty
    curves, radius = Curves(about["size"]), math.sqrt(about.most)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                for c, keys in enumerate(curves.keys(_matrix(b.column(1)), radius)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), c, np.int32)), pa.array(keys), *b.columns], names=["curve", "key", "point", "v"])

    keyed = points.mapInArrow(place, "curve int, key long, point long, v array<double>")
    n_blocks = CURVES * max(1, -(-about.n // block))
    blocks = staging.table(keyed.repartitionByRange(n_blocks, "curve", "key", "point").withColumn("block", F.spark_partition_id()).drop("key"), f"blocks{of}")
    query_points = asked.select("point").distinct()
    queries = staging.table(blocks.join(query_points, "point", "left_semi"), f"queries{of}")
    sample = queries.where("curve = 0").orderBy(F.xxhash64("point")).limit(MEASURED).select("point", "v").collect()
    if not sample:
        return empty
    width = _width(points, blocks, sample, k, reach)

    ranges = blocks.groupBy("curve").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    wanted = queries.join(F.broadcast(ranges), "curve").withColumn(
        "block", F.explode(F.sequence(F.greatest(F.col("low"), F.col("block") - width), F.least(F.col("high"), F.col("block") + width)))
    )
    n_queries = queries.where("curve = 0").count()
    # as many parts of the queries as keep those that meet a block in one task few; each part sees the whole block
    per_curve = max(1, n_blocks // CURVES)
    parts = max(1, -(-n_queries * min(2 * width + 1, per_curve) // per_curve // QUERIES))
    wanted = wanted.select("block", F.pmod(F.xxhash64("point"), F.lit(parts)).cast("int").alias("part"), "point", "v")
    held = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "point", "v")

    def nearest(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(b):
            return pd.DataFrame({"query": [], "point": [], "score": []}).astype({"query": "int64", "point": "int64"})
        b = b.drop_duplicates("point")
        q = q.drop_duplicates("point")
        matrix, ids, out = np.stack(b["v"]), b["point"].to_numpy(), []
        for point, v in zip(q["point"], q["v"], strict=True):
            d = np.sqrt(((matrix - v) ** 2).sum(1))
            near = np.lexsort((ids, d))[: k + 1]
            out.append(pd.DataFrame({"query": point, "point": ids[near], "score": d[near]}))
        return pd.concat(out)

    found = wanted.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInPandas(nearest, "query long, point long, score double")
    best = _ranked(found.groupBy("query", "point").agg(F.min("score").alias("score")), "query", k + 1)
    near = best.join(members.select("point", "vec_id"), "point").join(asked.select("query_id", F.col("point").alias("query")), "query")
    near = near.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _width(points: DataFrame, blocks: DataFrame, sample: list, k: int, reach: float) -> int:
    """Blocks to each side that bring the share `reach` of the true neighbours of the sampled queries."""
    ids, matrix = np.array([r.point for r in sample]), np.array([r.v for r in sample])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                own, vectors = b.column(0).to_numpy(), _matrix(b.column(1))
                for point, v in zip(ids, matrix, strict=True):
                    d = np.sqrt(((vectors - v) ** 2).sum(1))
                    near = np.lexsort((own, d))[: k + 1]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), point)), pa.array(own[near]), pa.array(d[near])], names=["query", "point", "score"])

    true = _ranked(points.mapInArrow(compare, "query long, point long, score double"), "query", k + 1).where("query <> point")
    places = blocks.select("curve", "block", "point")
    there = true.join(F.broadcast(places.where(F.col("point").isin(ids.tolist()))).select("curve", F.col("block").alias("at"), F.col("point").alias("query")), "query")
    apart = there.join(places, ["point", "curve"]).groupBy("query", "point").agg(F.min(F.abs(F.col("block") - F.col("at"))).alias("apart"))
    got = apart.agg(F.percentile("apart", reach).alias("p")).first().p
    return math.ceil(got or 0)


def exact(vectors: DataFrame, query_ids: list[int], k: int = 10) -> dict[int, list[tuple[float, int]]]:
    """True neighbours of a few queries, for measuring recall: (distance, vec_id) nearest first."""
    rows = [(r.vec_id, np.array(r.v)) for r in usable(vectors).dropDuplicates().collect()]
    by = dict(rows)
    return {q: sorted((float(np.sqrt(((v - by[q]) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(by[q]))[:k] for q in query_ids if q in by}
