"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Fit. A bounded sample (``sample_rows``) builds ``trees`` trees; a node splits at the median of a
random projection, a leaf holds about ``leaf_rows`` of the sample. Vectors get one more component
that makes their lengths equal, so that the nearest by angle is the largest by inner product.
Index. Every row goes to one leaf of each tree.
Search. A query walks all trees through one priority queue, ordered by the squared margins that a
path lies on the wrong side of, until the leaves popped hold its budget of rows: ``search_share`` of
the table, ``search_rows`` at least. The rows of the sample that lie in those leaves give a bound, which
candidates of the same leaves must reach.
Rerank. Leaves are dealt into blocks of about ``block_rows`` rows, a larger leaf into several. A query
goes once to each block that has a leaf of its own, with a bitmap of its leaves; there the rows of a
block are held, the queries stream past them, and a query is scored against the rows of its leaves
only. A row that it has met in an earlier tree is passed over, and a block gives a query ``k`` rows at
most. Scores are exact: double precision, original vectors.

Exact search: with ``search_share`` = number of trees, all leaves are popped and the result is that
of brute force.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formloom.llm.common import cut

_EPS = 1e-9


def usable(vector: Column) -> Column:
    """True for vectors that take part: not null, no null or non-finite component, not all zeros."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Tree:
    normals: np.ndarray  # (inner nodes, dimensions + 1)
    cuts: np.ndarray
    left: np.ndarray  # an inner node, or ~leaf
    right: np.ndarray
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))] if len(self.cuts) else []
        while todo:
            node, rows = todo.pop()
            right = x[rows] @ self.normals[node] > self.cuts[node]
            for child, part in ((int(self.left[node]), rows[~right]), (int(self.right[node]), rows[right])):
                if child < 0:
                    out[part] = ~child
                elif len(part):
                    todo.append((child, part))
        return out


@dataclass
class Forest:
    trees: list[Tree]
    sample: np.ndarray  # float64, original vectors
    sample_ids: np.ndarray
    longest: float
    sample_leaves: list[np.ndarray] = field(default_factory=list)

    def augment(self, x: np.ndarray) -> np.ndarray:
        """One more component: rows of the index become equally long."""
        rest = np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(axis=1)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def leaves_for(self, queries: np.ndarray, held: list[np.ndarray], enough: float) -> Iterator[list[tuple[int, int]]]:
        """For each query the (tree, leaf) pairs that it searches. held: rows in each leaf of each tree."""
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        margins = [q @ t.normals.T - t.cuts if len(t.cuts) else np.zeros((len(q), 0)) for t in self.trees]
        for i in range(len(q)):
            queue = [(0.0, t, 0 if len(tree.cuts) else ~0) for t, tree in enumerate(self.trees)]
            got, found = 0, []
            while queue and got < enough:
                off, t, node = heapq.heappop(queue)
                if node < 0:
                    found.append((t, ~node))
                    got += held[t][~node]
                    continue
                m = float(margins[t][i, node])
                tree = self.trees[t]
                near, far = (tree.right[node], tree.left[node]) if m > 0 else (tree.left[node], tree.right[node])
                heapq.heappush(queue, (off, t, int(near)))
                heapq.heappush(queue, (off + m * m, t, int(far)))
            yield found

    def bitmaps(self, visits: list[list[tuple[int, int]]]) -> list[np.ndarray]:
        """For each tree which queries search which of its leaves."""
        out = [np.zeros((len(visits), t.leaves), bool) for t in self.trees]
        for i, v in enumerate(visits):
            for t, leaf in v:
                out[t][i, leaf] = True
        return out

    def bounds(self, q: np.ndarray, ids: np.ndarray, seen: list[np.ndarray], k: int) -> np.ndarray:
        """For each query the score of the k-th best of the sample's rows in its leaves; -inf if these are fewer."""
        met = np.zeros((len(q), len(self.sample)), bool)
        for own, leaves in zip(seen, self.sample_leaves):
            met |= own[:, leaves]
        score = np.where(met & (ids[:, None] != self.sample_ids), q @ self.sample.T, -np.inf)
        score = _best_of_id(score, self.sample_ids)
        if score.shape[1] < k:
            return np.full(len(q), -np.inf)
        best = -np.partition(-score, k - 1, axis=1)[:, k - 1]
        return np.where(np.isfinite(best), best - _EPS * (1 + np.abs(best)), -np.inf)


def grow(x: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    normals, cuts, left, right, leaves = [], [], [], [], 0

    def node(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_rows:
            normal = rng.normal(size=x.shape[1])
            normal /= np.linalg.norm(normal)
            d = x[rows] @ normal
            middle = float(np.median(d))
            low = d <= middle
            if not low.all():
                me = len(cuts)
                normals.append(normal)
                cuts.append(middle)
                left.append(0)
                right.append(0)
                left[me] = node(rows[low])
                right[me] = node(rows[~low])
                return me
        leaves += 1
        return -leaves

    node(np.arange(len(x)))
    return Tree(np.array(normals).reshape(-1, x.shape[1]), np.array(cuts), np.array(left, int), np.array(right, int), leaves)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _best_of_id(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """score (queries, rows) -> (queries, distinct ids): an id's rows count once, at their best."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order]) != 0) + 1
    return score if len(first) + 1 >= len(ids) else np.maximum.reduceat(score[:, order], np.concatenate(([0], first)), axis=1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, row by row, added up from the first component on: the same bits in every engine that does so."""
    return np.add.accumulate(a * b, axis=1)[:, -1]


def best_pairs(
    x: np.ndarray, ids: np.ndarray, leaves: np.ndarray, tree: int, q: np.ndarray, query_ids: np.ndarray, seen: list[np.ndarray], bound: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, row position, exact score) of the k best ids for each query that reach its bound, each at its best row.

    The rows lie in the order of their leaves in the tree; leaves (rows, trees); seen: for each tree the leaves of each
    query. Rows of other leaves are not scored, and rows that a query meets in an earlier tree are not counted.
    """
    kinds, first = np.unique(leaves[:, tree], return_index=True)
    rough = np.full((len(q), len(x)), -np.inf)
    for leaf, a, b in zip(kinds.tolist(), first.tolist(), [*first[1:].tolist(), len(x)]):
        who = np.flatnonzero(seen[tree][:, leaf])
        if len(who):
            rough[who, a:b] = q[who] @ x[a:b].T
    for t in range(tree):
        rough[seen[t][:, leaves[:, t]]] = -np.inf
    rough[query_ids[:, None] == ids] = -np.inf
    floor = bound.copy()
    by_id = _best_of_id(rough, ids)
    if by_id.shape[1] > k:
        floor = np.maximum(floor, -np.partition(-by_id, k - 1, axis=1)[:, k - 1])
    slack = _EPS * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)))
    i, j = np.nonzero((rough >= (floor - slack)[:, None]) & np.isfinite(rough))
    score = np.concatenate([_products(x[j[a : a + 16384]], q[i[a : a + 16384]]) for a in range(0, len(i), 16384)]) if len(i) else np.zeros(0)
    order = np.lexsort((-score, ids[j], i))
    i, j, score = i[order], j[order], score[order]
    best = np.ones(len(i), bool)
    best[1:] = (np.diff(i) != 0) | (np.diff(ids[j]) != 0)
    i, j, score = i[best], j[best], score[best]
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    start = np.flatnonzero(np.diff(i, prepend=-1))
    rank = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
    return i[rank < k], j[rank < k], score[rank < k]


def _blocks(held: list[np.ndarray], block_rows: int) -> list[tuple[int, int, int, int]]:
    """(tree, leaf, first block, blocks) of each leaf with rows: leaves fill blocks in turn, larger ones take several of their own."""
    out, block, room = [], -1, 0
    for t, own in enumerate(held):
        room = 0
        for leaf, n in enumerate(own.tolist()):
            if n > block_rows:
                parts = -(-n // block_rows)
                out.append((t, leaf, block + 1, parts))
                block, room = block + parts, 0
            elif n:
                if n > room:
                    block, room = block + 1, block_rows
                out.append((t, leaf, block, 1))
                room -= n
    return out


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = 4, leaf_rows: int = 16, sample_rows: int = 16384,
    search_share: float = 0.9, search_rows: int = 4096, block_rows: int = 4096, seed: int = 5,
) -> DataFrame:
    """vectors(vec_id, embedding), queries(vec_id, embedding) -> (query_id, rank, vec_id, score).

    The k nearest found for each query, best first, ties to the smaller vec_id; all candidates if
    there are fewer. A row is no neighbour of itself: rows with the query's vec_id are left out. Rows
    with a null id, and vectors that are null, zero, of another length than most, or hold null or
    non-finite components, take no part. Rows that repeat an id count once for a query, at their best
    score. search_share and search_rows set the recall, see above; a row is counted in each tree, so
    that at a share of 0.9 a query is scored against fewer rows than brute force scores.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        v = F.col("embedding").cast("array<double>")
        return df.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))

    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # rows that repeat an id and its vector would fill the sample and the blocks
    rows = cut(clean(vectors).dropDuplicates(["vec_id", "v"]), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return empty
    dims = sizes["n"]
    rows, asked = rows.where(F.size("v") == dims), clean(queries).where(F.size("v") == dims)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    x = np.array([r.v for r in picked], np.float64)
    forest = Forest([], x, np.array([r.vec_id for r in picked], np.int64), float(np.sqrt((x * x).sum(axis=1).max())))
    rng = np.random.default_rng(seed)
    wide = forest.augment(x)
    forest.trees = [grow(wide, leaf_rows, rng) for _ in range(trees)]
    forest.sample_leaves = [t.assign(wide) for t in forest.trees]
    known = spark.sparkContext.broadcast(forest)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = known.value
            own = f.augment(_matrix(b.column(1), dims))
            leaf = np.stack([t.assign(own) for t in f.trees], axis=1) if len(own) else np.zeros((0, len(f.trees)), np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, leaf.size + 1, max(1, leaf.shape[1]), dtype=np.int32), pa.array(leaf.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["vec_id", "v", "leaves"])

    index = cut(rows.mapInArrow(assign, "vec_id long, v array<double>, leaves array<int>"), "index")
    # a count for each leaf of the forest: trees times the sample's leaves, whatever the input
    counts = index.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    held = [np.zeros(t.leaves, np.int64) for t in forest.trees]
    for r in counts:
        held[r.tree][r.leaf] = r["count"]
    # budgets count a row in each tree it is met in: the floor of search_rows is one of different rows
    enough = max(float(trees * search_rows), search_share * float(held[0].sum()))
    spots = _blocks(held, block_rows)
    first, many = [np.full(t.leaves, -1, np.int64) for t in forest.trees], [np.zeros(t.leaves, np.int64) for t in forest.trees]
    for t, leaf, block, n in spots:
        first[t][leaf], many[t][leaf] = block, n

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = known.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids, q = part.column(0).to_numpy(), _matrix(part.column(1), dims)
                visits = list(f.leaves_for(q, held, enough))
                seen = f.bitmaps(visits)
                bound = f.bounds(q, ids, seen, k)
                bits = [r.tobytes() for r in np.packbits(np.concatenate(seen, axis=1), axis=1)]
                to = [sorted({block for t, leaf in own for block in range(int(first[t][leaf]), int(first[t][leaf] + many[t][leaf]))}) for own in visits]
                who = np.repeat(np.arange(len(q)), [len(x) for x in to])
                take = pa.array(who, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array([x for own in to for x in own], np.int32)), pa.array(np.ones(len(who), np.int8)), part.column(0).take(take), part.column(1).take(take),
                        pa.nulls(len(who), pa.list_(pa.int32())), pa.array(bits, pa.binary()).take(take), pa.array(bound[who], pa.float64()),
                    ],
                    names,
                )

    names = ["block", "kind", "id", "v", "leaves", "seen", "bound"]
    kinds = "block int, kind tinyint, id long, v array<double>, leaves array<int>, seen binary, bound double"
    spread = asked.repartition(spark.sparkContext.defaultParallelism * 2, "vec_id")
    visiting = spread.mapInArrow(search, kinds)
    # of one entry for each leaf: its size is that of the sample
    placed = spark.createDataFrame(spots, "tree int, leaf int, first int, blocks int")
    lying = (
        index.select("vec_id", "v", "leaves", F.posexplode("leaves").alias("tree", "leaf")).join(F.broadcast(placed), ["tree", "leaf"])
        .select(
            (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).cast("int").alias("block"), F.lit(0).cast("tinyint").alias("kind"), F.col("vec_id").alias("id"), "v",
            "leaves", F.lit(None).cast("binary").alias("seen"), F.lit(None).cast("double").alias("bound"),
        )
    )

    tree_of = np.zeros(max((f + n for _, _, f, n in spots), default=1), np.int64)
    for t, _, at, n in spots:
        tree_of[at : at + n] = t
    edges = np.cumsum([t.leaves for t in forest.trees])

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got, ready = None, [], None
        for b in batches:
            block, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            turns = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for a, e in zip([0, *turns.tolist()], [*turns.tolist(), b.num_rows]):
                if block[a] != now:
                    now, got, ready = block[a], [], None
                if kind[a] == 0:
                    got.append(b.slice(a, e - a))
                    continue
                tree = int(tree_of[now])
                if ready is None:  # the block's rows come before its queries
                    leaves = np.concatenate([g.column(4).flatten().to_numpy() for g in got]).reshape(-1, len(edges))
                    order = np.argsort(leaves[:, tree], kind="stable")
                    ready = np.concatenate([_matrix(g.column(3), dims) for g in got])[order], np.concatenate([g.column(2).to_numpy() for g in got])[order], leaves[order]
                    got = []
                for at in range(a, e, 512):
                    part = b.slice(at, min(512, e - at))
                    bits = np.frombuffer(b"".join(part.column(5).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    seen = np.split(np.unpackbits(bits, axis=1, count=int(edges[-1])).astype(bool), edges[:-1], axis=1)
                    ids = part.column(2).to_numpy()
                    i, j, score = best_pairs(*ready, tree, _matrix(part.column(3), dims), ids, seen, part.column(6).to_numpy(), k)
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ready[1][j]), pa.array(score)], ["query_id", "vec_id", "score"])

    met = lying.unionByName(visiting).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(rerank, "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
