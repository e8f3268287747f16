"""SimHash near-dedup with vantage-point trees.

Texts become 64-bit fingerprints; equal ones collapse.  A tree of vantage points, fitted on
a bounded sample, deals the distinct fingerprints to shards by their bit distance from each
vantage.  Two fingerprints within the allowed distance that a vantage parts both lie close
to its boundary, by the triangle inequality; so the inner one also goes across as a probe.
Every shard grows its own tree below, prunes the same way and compares exactly in its
leaves.  A shard returns a spanning forest of its links, which connects the same
fingerprints as all its pairs do.  A leaf of many shards' size that no vantage parts, as a very
large group of near copies makes, is not gathered: its links are joined by shared
neighbours.  Components are joined up by :mod:`components`.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and link
like any other.  Rows without doc_id take part; a component_id is the smallest doc_id that is
not null, or null.  Repeated rows are returned as often as they come; extra columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import hash_sample, keep_rows, map_columns, query, read, row_key, shingle_hashes, utf8, written
from tidemark.llm.components import components

SEED, BITS = 42, 64
SHARD = 2048  # distinct fingerprints a shard is planned for
SAMPLE_PER_SHARD, SAMPLE_MOST = 64, 1 << 18  # the sample that the tree of shards is fitted on
LEAF = 512
DENSE_LEAF = "dense"
DENSE_SHARDS = 4  # a leaf of so many shards' points that no vantage parts is linked by key
DENSE = 8192  # a larger leaf that no vantage parts is linked through the neighbours of its points


def fingerprint(text: bytes, shingle: int) -> int:
    """Each bit is set if more than half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    hashes = shingle_hashes(words, min(shingle, len(words)), SEED)
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        rows = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, row_key and the fingerprint as a signed long, per row of ``docs``."""

    def hashed(ids, keys, texts):
        found = np.array([fingerprint(text, shingle) for text in utf8(texts)], dtype=np.uint64)
        yield [ids, keys, found.view(np.int64)]

    return map_columns(
        docs, hashed, "doc_id long, row_key string, fingerprint long",
        F.col("doc_id").cast("long"), row_key(), F.col("text"),
    )


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def vantage_point(
    points: np.ndarray, radius: int, worst: float, tries: int = 24
) -> tuple[np.uint64, int] | None:
    """The vantage and boundary with the fewest points near the boundary, among some evenly
    chosen ones; None if that is more than a share of ``worst`` of all points."""
    best = None
    for vantage in points[:: max(1, len(points) // tries)][:tries]:
        counts = np.cumsum(np.bincount(distances(points, vantage), minlength=BITS + 1))
        for cut in np.flatnonzero((counts >= 0.3 * len(points)) & (counts <= 0.7 * len(points))):
            near = counts[cut] - counts[max(0, cut - radius)]
            if best is None or near < best[0]:
                best = (near, vantage, int(cut))
    return None if best is None or best[0] > worst * len(points) else (best[1], best[2])


def grow(points: np.ndarray, radius: int, levels: int, most: int) -> list:
    """A tree as nested [vantage, boundary, inner, outer].  An empty list is a leaf, [DENSE_LEAF]
    one of more than ``most`` sample points that no vantage parts."""
    if not levels or len(points) < 32:
        return []
    # Of points all over the space a fifth lie that near; more of them would be dealt twice.
    if (node := vantage_point(points, radius, 0.3)) is None:
        return [DENSE_LEAF] if len(points) > most and radius == 2 else []
    inner = distances(points, node[0]) <= node[1]
    return [
        *node, grow(points[inner], radius, levels - 1, most), grow(points[~inner], radius, levels - 1, most),
    ]


def route(tree: list, points: np.ndarray, rows: np.ndarray, radius: int, probe: bool, path: int = 1):
    """(leaf, rows, probe, dense) of all leaves that ``points`` belong to or must be compared in."""
    if not len(points):
        return
    if len(tree) < 2:
        yield path, rows, probe, bool(tree)
        return
    vantage, cut, inside, outside = tree
    d = distances(points, vantage)
    inner, outer = d <= cut, d > cut
    for side, choice, as_probe in (
        (0, inner, probe),
        (1, outer, probe),
        (1, inner & (d > cut - radius), True),
        *([(0, outer & (d <= cut + radius), True)] if probe else []),
    ):
        yield from route((inside, outside)[side], points[choice], rows[choice], radius, as_probe, 2 * path + side)


class Forest:
    """Union-find over the rows of a shard, for links given as arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.label[a], self.label[b]
            apart = a != b
            a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            np.minimum.at(self.label, a, b)
            while (self.label != (up := self.label[self.label])).any():
                self.label = up


def link_leaf(points: np.ndarray, rows: np.ndarray, home: np.ndarray, radius: int, forest: Forest) -> None:
    """Compare every point with every home point, a block at a time."""
    homes, step = np.flatnonzero(home), max(1, (1 << 21) // max(1, len(points)))
    for i in range(0, len(homes), step):
        block = homes[i : i + step]
        a, b = np.nonzero(np.bitwise_count(points[block, None] ^ points[None, :]) <= radius)
        forest.link(rows[block[a]], rows[b])


def link_dense(points: np.ndarray, rows: np.ndarray, radius: int, forest: Forest) -> None:
    """Link points that share a point within half the radius: exact for even radii, as the
    middle of a pair within the radius is such a point."""
    near = points[:, None] ^ np.concatenate([[0], 1 << np.arange(BITS, dtype=np.uint64)]).astype(np.uint64)
    keys, owners = near.ravel(), np.repeat(rows, BITS + 1)
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    same = keys[1:] == keys[:-1]
    forest.link(owners[1:][same], owners[:-1][same])


def link(points: np.ndarray, rows: np.ndarray, home: np.ndarray, radius: int, forest: Forest) -> None:
    """The shard's own tree: part, prune, and compare in the leaves."""
    if not home.any():
        return
    if len(points) > LEAF and (node := vantage_point(points, radius, 0.5)) is not None:
        d = distances(points, node[0])
        inner, outer = d <= node[1], d > node[1]
        # Homes across the boundary meet on the outer side; probes visit both.
        for side, crossing in (
            (inner, outer & (d <= node[1] + radius) & ~home),
            (outer, inner & (d > node[1] - radius)),
        ):
            here = np.concatenate([np.flatnonzero(side), np.flatnonzero(crossing)])
            stays = np.concatenate([home[side], np.zeros(crossing.sum(), dtype=bool)])
            link(points[here], rows[here], stays, radius, forest)
        return
    if len(points) > DENSE and radius == 2:
        link_dense(points, rows, radius, forest)
    else:
        link_leaf(points, rows, home, radius, forest)


def links(distinct: DataFrame, radius: int = 2, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``radius`` bits."""
    spark = distinct.sparkSession
    total = distinct.count()
    shards = max(1, math.ceil(total / shard))
    taken = min(SAMPLE_MOST, SAMPLE_PER_SHARD * shards)
    sample = hash_sample(distinct, total, taken, F.xxhash64("fingerprint", F.lit("vantage"))).collect()
    points = np.array(sorted(r[0] for r in sample), dtype=np.int64).view(np.uint64)
    # Sample points that stand for DENSE_SHARDS shards, of all that there are.
    most = DENSE_SHARDS * max(32, len(points) // shards)
    tree = spark.sparkContext.broadcast(grow(points, radius, math.ceil(math.log2(shards)), most))

    def deal(values):
        points = values.to_numpy(zero_copy_only=False).view(np.uint64)
        for leaf, rows, probe, dense in route(tree.value, points, np.arange(len(points)), radius, False):
            n = len(rows)
            yield [np.full(n, leaf), points[rows].view(np.int64), np.full(n, not probe), np.full(n, dense)]

    def connect(table: pa.Table) -> pa.Table:
        points = table["fingerprint"].to_numpy().view(np.uint64)
        home = table["home"].to_numpy(zero_copy_only=False)
        forest = Forest(len(points))
        link(points, np.arange(len(points)), home, radius, forest)
        linked = np.flatnonzero(forest.label != np.arange(len(points)))
        return pa.table({
            "a": points[linked].view(np.int64), "b": points[forest.label[linked]].view(np.int64),
        })

    dealt = map_columns(
        distinct, deal, "shard long, fingerprint long, home boolean, dense boolean", F.col("fingerprint")
    )
    # Comparing costs far more than the few bytes of a shard let adaptive execution expect.
    found = (
        dealt.where("NOT dense").drop("dense").repartition(shards, "shard").groupBy("shard")
        .applyInArrow(connect, "a long, b long")
    )
    if DENSE_LEAF in str(tree.value):
        found = found.union(dense_links(dealt.where("dense").select("fingerprint").distinct()))
    return found


def dense_links(points: DataFrame) -> DataFrame:
    """Links of points that share a point within one bit, each with the smallest that does:
    two points within two bits always share one.  65 rows per point, wherever they go."""
    near = F.transform(
        F.sequence(F.lit(-1), F.lit(BITS - 1)),
        lambda i: F.when(i < 0, F.col("fingerprint")).otherwise(
            F.col("fingerprint").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
        ),
    )
    keys = points.select("fingerprint", F.explode(near).alias("key"))
    smallest = keys.groupBy("key").agg(F.min("fingerprint").alias("b"), F.count("*").alias("n")).where("n > 1")
    return keys.join(smallest, "key").where("fingerprint <> b").select(F.col("fingerprint").alias("a"), "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, row_key, fingerprint (signed long) and component_id per row of ``docs``."""
    marked = written(fingerprints(docs, shingle))
    distinct = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    joined = components(links(distinct.select("fingerprint"), radius))
    members = joined.join(distinct, joined["node"] == distinct["fingerprint"]).select("node", "root", "first")
    smallest = members.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = members.join(smallest, "root").select(F.col("node").alias("fingerprint"), "root", "smallest")
    named = distinct.join(linked, "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("root", "fingerprint").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id"),
    )
    # Written, so that the join can split the partition of a fingerprint that many rows have.
    return marked.join(written(named), "fingerprint")


def simhash_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, rows
    without one last."""
    groups = written(near_duplicates(docs, shingle, radius))
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    )
    return keep_rows(docs, first.select("first.row_key"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
