"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree halves a bounded sample again and again at the median of a random
projection; every row then belongs to one leaf of each tree. A query walks all trees
at once through one shared priority queue: the node whose worst margin on the way
down is smallest comes first, whichever tree it is in, until the visited leaves hold
a given share of the sample. The rows of those leaves are reranked by their exact
inner product in double precision.

Only the forest (fitted on at most ``sample`` vectors) is sent to all tasks. Rows and
queries meet in blocks of fixed size, so one task holds one block of each. Equal
vectors are one entry of the index with its smallest k + 1 ids, because no more of
them can be among anyone's k nearest; a vector that many rows share costs no more.

Defined cases: vectors that are null, zero or hold null, NaN or infinite components
take no part, nor do those whose length is not the most frequent one (the smaller on
ties); repeated rows of one id and vector count once; with fewer than k candidates
all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import shuffle_width, stored

ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 1_024


class Forest:
    """Trees of one depth in heap order: node n of a tree has children 2n + 1, 2n + 2."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, expected: int, seed: int):
        smallest = max(1, len(sample) // 8)
        self.depth = max(0, min(math.ceil(math.log2(max(1, expected) / leaf)),
                                int(math.log2(smallest))))
        self.trees, inner, size = trees, 2 ** self.depth - 1, sample.shape[1]
        rng = np.random.default_rng(seed)
        planes = rng.standard_normal((trees, inner, size)).astype(np.float32)
        self.planes = planes / np.linalg.norm(planes, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, inner), np.float32)
        for tree in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                rows = members.pop(node)
                margin = sample[rows] @ self.planes[tree, node]
                self.cuts[tree, node] = np.median(margin) if len(rows) else 0
                right = margin >= self.cuts[tree, node]
                members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
        self.sample_leaves = self.leaves(sample)
        order = np.argsort(self.sample_leaves, axis=0, kind="stable")
        self.in_leaf = [{} for _ in range(trees)]
        for tree in range(trees):
            numbers, starts = np.unique(self.sample_leaves[order[:, tree], tree], return_index=True)
            parts = np.split(order[:, tree], starts[1:])
            self.in_leaf[tree] = dict(zip(numbers.tolist(), parts))

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        out = np.empty((len(vectors), self.trees), np.int32)
        for tree in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                margin = np.einsum("ij,ij->i", vectors, self.planes[tree, node])
                node = 2 * node + 1 + (margin >= self.cuts[tree, node])
            out[:, tree] = node - (2 ** self.depth - 1)
        return out

    def search(self, query: np.ndarray, share: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until the leaves hold the share."""
        inner = 2 ** self.depth - 1
        margins = (self.planes @ query - self.cuts).tolist()
        queue = [(-math.inf, tree, 0) for tree in range(self.trees)]
        found, seen, wanted = [], np.zeros(len(self.sample_leaves), bool), share * len(self.sample_leaves)
        while queue:
            worst, tree, node = heapq.heappop(queue)
            if node < inner:
                margin = margins[tree][node]
                heapq.heappush(queue, (max(worst, margin), tree, 2 * node + 1))
                heapq.heappush(queue, (max(worst, -margin), tree, 2 * node + 2))
                continue
            leaf = node - inner
            found.append((tree, leaf))
            seen[self.in_leaf[tree].get(leaf, [])] = True
            if len(found) % 4 == 0 and np.count_nonzero(seen) >= wanted:
                break
        return found


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector of double of the rows that take part, once each."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"),
                          vectors[vector_col].cast("array<double>").alias("v"))
    rows = rows.filter("id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND "
                       "NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x != 0)")
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(
        F.desc("count"), "size").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["size"] if sizes else 0))


def matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, trees: int = 16, leaf: int = 64,
            share: float = 0.7, sample: int = 20_000, seed: int = 7,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every id divisible by ``every`` its ``k``
    nearest rows found, largest inner product first, ties to the smaller id.

    ``sample`` bounds the vectors the forest is fitted on; ``share`` is the part of
    all rows a query looks at.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    by_vector = Window.partitionBy("v").orderBy("id")
    members = stored(
        rows.dropDuplicates(["v", "id"]).withColumn("place", F.row_number().over(by_vector))
        .filter(F.col("place") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "v", "ids"), "ann-members")
    total = members.count()
    result = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], result)
    part = min(1.0, sample / total)
    picked = members.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(part * (1 << 20)))
    fitted = [r["v"] for r in picked.orderBy(F.xxhash64("rep")).limit(sample).select("v").collect()]
    if not fitted:
        fitted = [r["v"] for r in members.limit(sample).select("v").collect()]
    forest = Forest(np.array(fitted, np.float32), trees, leaf, total, seed)
    shared = spark.sparkContext.broadcast(forest)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = shared.value.leaves(matrix(batch.column(1)).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.FixedSizeListArray.from_arrays(
                        pa.array(leaves.ravel()), trees).cast(pa.list_(pa.int32()))],
                    ["rep", "v", "leaves"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [shared.value.search(q.astype(np.float32), share)
                         for q in matrix(batch.column(1))]
                codes = [[tree << shared.value.depth | number for tree, number in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(codes, pa.list_(pa.int32()))],
                    ["rep", "v", "visits"])

    asking = rows.filter(F.col("id") % every == 0)
    queries = asking.join(members.select("v", "rep"), "v").select("rep", F.col("id").alias("query_id"))
    queries = stored(queries.distinct(), "ann-queries")
    row_blocks = max(1, math.ceil(total / ROWS_PER_BLOCK))
    query_blocks = max(1, math.ceil(total / every / QUERIES_PER_BLOCK))

    def block(column: str, count: int):
        return F.pmod(F.xxhash64(column), F.lit(count))

    def each(count: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    entries = (members.select("rep", "v").repartition(row_blocks, block("rep", row_blocks))
               .mapInArrow(index, "rep long, v array<double>, leaves array<int>")
               .select("*", block("rep", row_blocks).alias("rb"), each(query_blocks).alias("qb")))
    walks = (queries.select("rep").distinct().join(members.select("rep", "v"), "rep")
             .repartition(shuffle_width(spark), "rep")
             .mapInArrow(visit, "rep long, v array<double>, visits array<int>")
             .select("*", block("rep", query_blocks).alias("qb"), each(row_blocks).alias("rb")))
    depth, kept = forest.depth, k + 1

    def rerank(key, own, walked):
        """The best of each query's visited rows. Single precision finds all rows that can
        be among them, with room for its rounding; double precision ranks those."""
        found = {"asked": [np.zeros(0, np.int64)], "rep": [np.zeros(0, np.int64)],
                 "score": [np.zeros(0)]}
        if own.num_rows and walked.num_rows:
            reps, rows_, asked = own["rep"].to_numpy(), matrix(own["v"]), matrix(walked["v"])
            codes = matrix(own["leaves"]) + (np.arange(trees, dtype=np.int32) << depth)
            small = rows_.astype(np.float32)
            longest = float(np.sqrt((rows_ * rows_).sum(axis=1).max()))
            visits = walked["visits"].combine_chunks()
            for rep, query, seen in zip(walked["rep"].to_numpy(), asked, visits):
                visited = np.zeros(trees << depth, bool)
                visited[seen.values.to_numpy()] = True
                hit = np.flatnonzero(visited[codes].any(axis=1))
                rough = small[hit] @ query.astype(np.float32)
                if len(hit) > kept:
                    slack = 1e-5 * longest * float(np.sqrt((query * query).sum()))
                    least = np.partition(rough, -kept)[-kept] - slack
                    hit = hit[rough >= least]
                scores = (rows_[hit] * query).sum(axis=1)
                best = np.lexsort((reps[hit], -scores))[:kept]
                found["asked"].append(np.full(len(best), rep))
                found["rep"].append(reps[hit[best]])
                found["score"].append(scores[best])
        return pa.table({name: np.concatenate(parts) for name, parts in found.items()})

    near = entries.groupBy("rb", "qb").cogroup(walks.groupBy("rb", "qb")).applyInArrow(
        rerank, "asked long, rep long, score double")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "id")
    lists = (near.join(members.select("rep", "ids"), "rep")
             .select("asked", "score", F.explode("ids").alias("id"))
             .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= kept)
             .groupBy("asked").agg(F.sort_array(F.collect_list(
                 F.struct("place", "id", "score"))).alias("found")))
    return (queries.join(lists, queries["rep"] == lists["asked"])
            .select("query_id", F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")),
                                        1, k).alias("found"))
            .select("query_id", F.posexplode("found").alias("at", "f"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("f.id").alias("vec_id"), F.col("f.score").alias("score")))
