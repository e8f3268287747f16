"""Nearest neighbours through stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to a few dimensions by a fixed Gaussian matrix, so the squared
projected distance over the squared true one follows a chi-square law.  A kd-tree over the
projections deals the vectors to shards; its splits are fitted on a bounded sample, every
vector is indexed.  A query first searches the shard it falls into, which bounds the distance
of its k-th neighbour, then every shard whose box is near enough that the test cannot rule
it out.  Within a shard, neighbours come in the order of projected distance, a leaf of the
shard's own tree at a time, and are verified on the original vectors until the next leaf is
so far that a nearer neighbour would have shown up before with probability ``sure``.

Equal vectors are searched once, with the k + 1 smallest of their ids: no query needs more.
Queries of a shard are cut into blocks, and a shard of more than SLAB vectors into slabs, each
of which its queries visit; no group holds more than a block and a slab.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without vec_id, nor vectors of another length than most (of equally
frequent lengths the largest).  Rows equal in id and vector count once.  Ties go to the
smaller vec_id.  Fewer candidates than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import hash_sample, map_columns, query, read, written

DIMENSIONS = 8
SURE = 0.97
SHARD, SHARDS_MOST = 4096, 2048
SLAB = 4 * SHARD  # vectors of a shard searched in one group; more come where shards are at their most
SAMPLE = 1 << 16
LEAF = 64
QUERY_BLOCK = 4096


def chi_square_quantile(sure: float, dimensions: int = DIMENSIONS) -> float:
    """For an even number of dimensions."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))
        low, high = (x, high) if 1 - tail < sure else (low, x)
    return high


def projection(length: int) -> np.ndarray:
    return np.random.default_rng(length).standard_normal((length, DIMENSIONS))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def grow(points: np.ndarray, levels: int) -> list:
    """Nested [axis, cut, below, above]; an empty list is a leaf."""
    if not levels or len(points) < 2:
        return []
    axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
    cut = float(np.median(points[:, axis]))
    below = points[:, axis] < cut
    if below.all() or not below.any():
        return []
    return [axis, cut, grow(points[below], levels - 1), grow(points[~below], levels - 1)]


def boxes(tree: list, low=None, high=None, path: int = 1):
    """(leaf, lower corner, upper corner)."""
    low = np.full(DIMENSIONS, -np.inf) if low is None else low
    high = np.full(DIMENSIONS, np.inf) if high is None else high
    if not tree:
        yield path, low, high
        return
    axis, cut, below, above = tree
    here = np.arange(DIMENSIONS) == axis
    yield from boxes(below, low, np.where(here, cut, high), 2 * path)
    yield from boxes(above, np.where(here, cut, low), high, 2 * path + 1)


def leaf_of(tree: list, points: np.ndarray) -> np.ndarray:
    out = np.ones(len(points), dtype=np.int64)

    def walk(node: list, rows: np.ndarray, path: int) -> None:
        if not node or not len(rows):
            out[rows] = path
            return
        below = points[rows, node[0]] < node[1]
        walk(node[2], rows[below], 2 * path)
        walk(node[3], rows[~below], 2 * path + 1)

    walk(tree, np.arange(len(points)), 1)
    return out


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes; either may be many."""
    return np.square(np.maximum(np.maximum(low - points, points - high), 0)).sum(axis=-1)


def leaves(points: np.ndarray) -> list[np.ndarray]:
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        part = points[rows]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        order = rows[np.argpartition(part[:, axis], len(rows) // 2)]
        todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return out


def search_shard(vectors, ids, queries, query_ids, bounds, k: int, reach: float):
    """For each query the k nearest rows of a shard: lists of (query row, vec_id, distance)."""
    near = projection(vectors.shape[1])
    points, asked = vectors @ near, queries @ near
    parts = leaves(points)
    low = np.array([points[rows].min(axis=0) for rows in parts])
    high = np.array([points[rows].max(axis=0) for rows in parts])
    for q in range(len(queries)):
        gap = box_distance(asked[q], low, high)
        best = bound = float(bounds[q])
        rows_found, far = np.empty(0, dtype=np.int64), np.empty(0)
        for leaf in np.argsort(gap, kind="stable"):
            if gap[leaf] > reach * bound * bound:
                break
            rows = parts[leaf]
            distance = np.sqrt(np.square(vectors[rows] - queries[q]).sum(axis=1))
            close = distance <= bound
            if close.any():
                rows_found = np.concatenate([rows_found, rows[close]])
                far = np.concatenate([far, distance[close]])
                if len(far) > k + 1:
                    # One more than k: the query's own vector may give no other row.
                    bound = min(best, float(np.partition(far, k)[k]))
                    rows_found, far = rows_found[far <= bound], far[far <= bound]
        found = sorted(
            (d, i) for d, row in zip(far.tolist(), rows_found.tolist()) for i in ids[row] if i != query_ids[q]
        )
        for d, i in found[:k]:
            yield q, i, d


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.where(
        "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size("vector") == (most["length"] if most else -1))


def search(index: DataFrame, queries: DataFrame, tree, k: int, reach: float, width: int) -> DataFrame:
    """(query_id, query, vec_id, score) per shard; ``queries`` has shard, query_id, vector and
    bound."""
    # A row per shard each, so SHARDS_MOST or so.
    counts = F.broadcast(queries.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks")))
    slabs = F.broadcast(index.groupBy("shard").agg(F.ceil(F.count("*") / SLAB).alias("slabs")))
    dealt = (
        queries.join(counts, "shard").withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.col("blocks")))
        .join(slabs, "shard").withColumn("slab", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)))
    )
    copies = (
        index.join(slabs, "shard").withColumn("slab", F.pmod(F.xxhash64("vector"), F.col("slabs")))
        .join(counts, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )

    def run(points: pa.Table, asked: pa.Table) -> pa.Table:
        columns = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if points.num_rows and asked.num_rows:
            asked_ids = asked["query_id"].to_pylist()
            names = asked["query"].to_pylist()
            for q, i, d in search_shard(
                matrix(points["vector"], width), points["ids"].to_pylist(), matrix(asked["vector"], width),
                asked_ids, asked["bound"].to_numpy(), k, reach,
            ):
                columns["query_id"].append(asked_ids[q])
                columns["query"].append(names[q])
                columns["vec_id"].append(i)
                columns["score"].append(d)
        return pa.table({
            "query_id": pa.array(columns["query_id"], type=pa.int64()),
            "query": pa.array(columns["query"], type=pa.int64()),
            "vec_id": pa.array(columns["vec_id"], type=pa.int64()),
            "score": pa.array(columns["score"], type=pa.float64()),
        })

    return (
        copies.select("shard", "slab", "block", "vector", "ids").groupBy("shard", "slab", "block")
        .cogroup(
            dealt.select("shard", "slab", "block", "query_id", "query", "vector", "bound").groupBy("shard", "slab", "block")
        )
        .applyInArrow(run, "query_id long, query long, vec_id long, score double")
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the nearest rows of
    ``vectors`` to each row of ``queries``, but for rows with the query's own vec_id."""
    spark = vectors.sparkSession
    rows = valid(vectors)
    # The k + 1 smallest ids of each distinct vector, pruned before the shuffle.
    nth = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    ids = rows.distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    index = written(ids.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = written(valid(queries).distinct().select(
        F.col("vec_id").alias("query_id"), "vector", F.xxhash64("vec_id", "vector").alias("query")
    ))
    total = index.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = min(SHARDS_MOST, max(1, total // SHARD))
    taken = hash_sample(index, total, min(SAMPLE, 64 * shards), F.xxhash64("vector")).select("vector").collect()
    taken = taken or index.select("vector").limit(1).collect()
    width = len(taken[0]["vector"])
    near = projection(width)
    tree = grow(np.array([row["vector"] for row in taken]) @ near, math.ceil(math.log2(shards)))
    names, low, high = (np.array(x) for x in zip(*boxes(tree)))
    reach = chi_square_quantile(sure)

    schema = "vector array<double>, shard long"
    index = written(
        map_columns(index, lambda v, i: ([v, i, leaf_of(tree, matrix(v, width) @ near)],),
                    "vector array<double>, ids array<long>, shard long", F.col("vector"), F.col("ids"))
    )
    first = written(
        map_columns(asked, lambda i, q, v: ([i, q, v, leaf_of(tree, matrix(v, width) @ near)],),
                    f"query_id long, query long, {schema}", F.col("query_id"), F.col("query"), F.col("vector"))
        .withColumn("bound", F.lit(float("inf")))
    )
    found = written(search(index, first, tree, k, reach, width))
    bounds = found.groupBy("query_id", "query").agg(
        F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("limit")
    )

    def near_shards(query_ids, queries, vectors, homes, limits):
        points, limits = matrix(vectors, width) @ near, limits.to_numpy(zero_copy_only=False)
        for name, lower, upper in zip(names, low, high):
            rows = np.flatnonzero(
                (box_distance(points, lower, upper) <= reach * limits**2) & (homes.to_numpy() != name)
            )
            pick = pa.array(rows)
            yield [
                query_ids.take(pick), queries.take(pick), vectors.take(pick), np.full(len(rows), name),
                pa.array(limits[rows]),
            ]

    second = map_columns(
        first.drop("bound").join(bounds, ["query_id", "query"], "left"), near_shards,
        f"query_id long, query long, {schema}, bound double",
        F.col("query_id"), F.col("query"), F.col("vector"), F.col("shard"), F.coalesce("limit", F.lit(float("inf"))),
    )
    found = found.union(search(index, written(second), tree, k, reach, width))
    rank = F.row_number().over(W.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op9_neighbours")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
