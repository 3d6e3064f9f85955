"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree halves the space again and again: a node's hyperplane is the bisector of two vectors of its part of a sample,
chosen by the tree's own random numbers, and moved to the median so that both halves are as large. A vector's leaf
follows from these few numbers. All vectors are indexed: each is sent to its leaf in every tree. A query goes down all
trees at once with one shared priority queue: the node that is nearest, by the squared margins on the way to it, is opened
next, of whichever tree, until the leaves taken hold a `share` of the vectors, those met in several trees counted again. Leaves and the queries that open them meet by a join; there the
inner products are computed exactly, and each query keeps its best.

The sample is bounded (`sample`, the least by a hash of the id), so the forest is small, whatever the table. Equal
vectors are one point with its smallest ids, as many as can be wanted; a leaf with more points than `block` is searched
in blocks. Vectors that are null, empty, zero, of another length than most, or hold nulls or numbers that aren't finite
take no part, nor do rows without an id. Repeated rows of an id and vector count once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from llm.tables import stage


@dataclass(frozen=True)
class Index:
    """k: neighbours wanted; trees; depth: halvings of the space by a tree; sample: vectors the forest is fitted on;
    share: of the points, to look at for each query in all trees together; least: different points to look at, or all; block: points, or queries, compared at once.

    Vectors without any structure need a large share: with 64 independent dimensions, two thirds of the points must be
    looked at to find 0.95 of the 20 nearest. Vectors with clusters need far less, and then deeper trees pay."""

    k: int = 20
    trees: int = 6
    depth: int = 6
    sample: int = 16_384
    share: float = 1.5
    least: int = 512
    block: int = 4096
    seed: int = 7


class Tree:
    """Hyperplanes of a full tree: node i has the children 2 i + 1 and 2 i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        random = np.random.default_rng(seed)
        size = 2**depth - 1
        self.depth, self.normal, self.offset = depth, np.zeros((size, sample.shape[1])), np.zeros(size)
        parts = {0: np.arange(len(sample))}
        for node in range(size):
            part = parts.pop(node)
            normal = random.standard_normal(sample.shape[1])
            for _ in range(5):
                if len(part) > 1:
                    a, b = sample[random.choice(part, 2, replace=False)]
                    if np.any(a != b):
                        normal = a - b
                        break
            normal = normal / np.linalg.norm(normal)
            side = sample[part] @ normal
            self.normal[node], self.offset[node] = normal, np.median(side) if len(part) else 0.0
            right = side > self.offset[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), dtype=np.int64)
        for _ in range(self.depth):
            right = np.einsum("ij,ij->i", vectors, self.normal[node]) > self.offset[node]
            node = 2 * node + 1 + right
        return node - (2**self.depth - 1)


def search(trees: list[Tree], query: np.ndarray, sizes: list[np.ndarray], candidates: float, least: int = 0) -> list[tuple[int, int]]:
    """The leaves (tree, leaf) to open for a query: the nearest first, until they hold enough.

    `sizes` has the number of vectors in each leaf of each tree. A vector is held once by each tree, so `least` different
    ones are met when the leaves of one tree hold as many.
    """
    margins = [t.normal @ query - t.offset for t in trees]
    queue = [(0.0, i, 0) for i in range(len(trees))]
    out, held, own = [], 0, [0] * len(trees)
    while queue and (held < candidates or max(own) < least):
        far, i, node = heapq.heappop(queue)
        tree = trees[i]
        while node < len(tree.offset):
            margin = margins[i][node]
            near = 2 * node + 1 + (margin > 0)
            heapq.heappush(queue, (far + margin * margin, i, 4 * node + 3 - near))
            node = near
        leaf = node - len(tree.offset)
        if sizes[i][leaf]:
            out.append((i, leaf))
            held += int(sizes[i][leaf])
            own[i] += int(sizes[i][leaf])
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("vector", lambda x: x != 0))


def _batches(function, names):
    """A function on Arrow batches from one on columns; vectors come as a matrix."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                column = batch.column(batch.schema.names.index("vector"))
                matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for out in function(batch, matrix):
                    yield pa.RecordBatch.from_pydict(dict(zip(names, out)))

    return run


def nearest(vectors: DataFrame, queries, how: Index = Index()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the `k` nearest found of each row where `queries` holds (a condition
    on vec_id), by the largest inner product, ties to the smaller vec_id. `vectors` has vec_id and embedding."""
    spark = vectors.sparkSession
    rows = usable(vectors).distinct()
    width = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], schema)
    rows = stage(rows.where(F.size("vector") == width.width).withColumn("point", F.xxhash64("vector")), "vectors")
    # of equal vectors the k + 1 smallest ids are all that can be among a query's k nearest; a large group is salted
    some = lambda ids: F.slice(F.array_sort(F.array_distinct(ids)), 1, how.k + 1)
    salted = rows.groupBy("point", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt")).agg(some(F.collect_list("vec_id")).alias("ids"))
    points = stage(salted.groupBy("point", "vector").agg(some(F.flatten(F.collect_list("ids"))).alias("ids")), "points")

    sample = points.orderBy("point").limit(how.sample).select("vector").toArrow().column("vector").combine_chunks()
    sample = sample.flatten().to_numpy().reshape(-1, width.width)
    depth = min(how.depth, int(np.log2(max(len(sample) / 8, 1))))  # as far as the sample can tell a node's halves apart
    forest = spark.sparkContext.broadcast([Tree(sample, depth, how.seed + i) for i in range(how.trees)])

    def index(batch, matrix):
        for i, tree in enumerate(forest.value):
            yield pa.array([i] * len(matrix), pa.int32()), tree.leaves(matrix), batch.column("point"), batch.column("vector"), batch.column("ids")

    placed = points.mapInArrow(_batches(index, ["tree", "leaf", "point", "vector", "ids"]), "tree int, leaf long, point long, vector array<double>, ids array<long>")
    placed = stage(placed, "leaves")
    sizes = [np.zeros(2**depth, dtype=np.int64) for _ in range(how.trees)]
    for r in placed.groupBy("tree", "leaf").count().collect():  # the forest's leaves, a bounded number
        sizes[r.tree][r.leaf] = r["count"]
    known, wanted = spark.sparkContext.broadcast(sizes), how.share * sum(map(int, sizes[0]))
    least = min(max(how.least, how.k + 1), sum(map(int, sizes[0])))

    def probe(batch, matrix):
        ids = batch.column("vec_id").to_pylist()
        found = [search(forest.value, q, known.value, wanted, least) for q in matrix]
        place = [i for i, leaves in enumerate(found) for _ in leaves]
        flat = [x for leaves in found for x in leaves]
        vector = batch.column("vector").take(pa.array(place, pa.int64()))
        yield pa.array([t for t, _ in flat], pa.int32()), pa.array([x for _, x in flat], pa.int64()), pa.array([ids[i] for i in place], pa.int64()), vector

    asked = rows.where(queries).mapInArrow(_batches(probe, ["tree", "leaf", "query_id", "vector"]), "tree int, leaf long, query_id long, vector array<double>")
    # a leaf's queries and points are dealt in blocks: each block of queries meets each block of points
    many = F.greatest(F.lit(1), F.ceil(F.col("count") / how.block))
    queries_of = asked.groupBy("tree", "leaf").count().select("tree", "leaf", many.alias("q_blocks"))
    points_of = placed.groupBy("tree", "leaf").count().select("tree", "leaf", many.alias("p_blocks"))
    blocks = stage(queries_of.join(points_of, ["tree", "leaf"]), "blocks")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = placed.join(blocks, ["tree", "leaf"]).select("tree", "leaf", F.pmod("point", "p_blocks").alias("p"), each("q_blocks").alias("q"), F.lit(None).cast("long").alias("query_id"), "vector", "ids")
    right = asked.join(blocks, ["tree", "leaf"]).select("tree", "leaf", each("p_blocks").alias("p"), F.pmod(F.xxhash64("query_id"), "q_blocks").alias("q"), "query_id", "vector", F.lit(None).cast("array<long>").alias("ids"))

    def compare(table: pa.Table) -> pa.Table:
        column = table.column("vector").combine_chunks()
        matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        asks = table.column("query_id").is_valid().to_numpy()
        ids, asking = table.filter(pa.array(~asks)).column("ids").to_pylist(), table.filter(pa.array(asks)).column("query_id").to_pylist()
        candidates, out = matrix[~asks], ([], [], [])
        if len(candidates):
            for query_id, query in zip(asking, matrix[asks]):
                scores = (candidates * query).sum(axis=1)  # the same order of sums wherever a vector stands
                best = np.argsort(-scores, kind="stable")
                if len(best) > how.k + 1:
                    best = best[scores[best] >= scores[best[how.k]]]
                for score, vec_id in sorted((-scores[i], v) for i in best.tolist() for v in ids[i] if v != query_id)[: how.k]:
                    out[0].append(query_id), out[1].append(vec_id), out[2].append(-score)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    hits = left.unionByName(right).groupBy("tree", "leaf", "p", "q").applyInArrow(compare, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score")
