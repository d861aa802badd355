"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (SAMPLE_ROWS vectors, SAMPLE_VALUES numbers): a
node's vectors are split by spherical k-means into BRANCHES children until LEAF_ROWS or
fewer are left. Every row is indexed under the leaf that it descends to. A query walks the
tree best bin first: a priority queue holds the nodes seen so far by their closeness to
the query, the best is opened, and leaves come out in the order in which they are
visited. How many leaves are visited is calibrated: for a bounded number of queries the
true neighbours among all rows are found, and the visits are widened step by step until
RECALL of them lie in the visited leaves.

Leaves of any size are searched: a leaf's rows and the queries that visit it are dealt
into bounded parts, and each pair of parts yields only its best candidates, scored in
double precision on the original vectors.

Rows with a null id, and vectors that are null, empty, zero, or hold null or non-finite
components take no part. Vectors of one length are neighbours of each other only: each length
that occurs has a tree and a search of its own. Rows with the query's vec_id count as the query itself. Ties go to the smaller vec_id.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomseq.llm.common import discard, materialise, sorted_groups, table
from loomseq.llm.lattice import matrix, plain, unit, usable

SAMPLE_ROWS, SAMPLE_VALUES = 5_000, 4_000_000
BRANCHES, LEAF_ROWS = 8, 40
CALIBRATION, RECALL = 96, 0.95
#: Numbers that a part of a leaf's rows, or of its queries, holds at most; queries are
#: compared with a part TILE at a time.
PART_VALUES, TILE = 1 << 19, 512
#: Pairs of a query and a row whose vectors a task holds at a time.
SLICE_PAIRS = 1 << 14


class Tree:
    """Nodes in arrays; children of a node are consecutive, a leaf has none."""

    def __init__(self, sample: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.centers: list[np.ndarray] = [unit(sample.mean(0, keepdims=True) + 1e-12)[0]]
        self.children: list[tuple[int, int]] = [(0, 0)]
        self.leaf: list[int] = [-1]
        self.leaves = 0
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            parts = self._split(sample[rows], rng) if len(rows) > LEAF_ROWS else []
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            first = len(self.centers)
            for center, inside in parts:
                self.centers.append(center)
                self.children.append((0, 0))
                self.leaf.append(-1)
                todo.append((len(self.centers) - 1, rows[inside]))
            self.children[node] = (first, len(self.centers))
        self.matrix = np.stack(self.centers)

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        centers = x[rng.choice(len(x), min(BRANCHES, len(x)), replace=False)]
        owner = np.zeros(len(x), dtype=int)
        for _ in range(8):
            owner = (x @ centers.T).argmax(1)
            sums = np.stack([np.bincount(owner, weights=c, minlength=len(centers)) for c in x.T], axis=1)
            live = np.linalg.norm(sums, axis=1) > 1e-12
            centers = unit(sums[live])
        owner = (x @ centers.T).argmax(1)
        return [(centers[k], np.flatnonzero(owner == k)) for k in range(len(centers)) if (owner == k).any()]

    def descend(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(units), dtype=np.int64)
        todo = [(0, np.arange(len(units)))]
        while todo:
            node, rows = todo.pop()
            lo, hi = self.children[node]
            if lo == hi:
                out[rows] = self.leaf[node]
                continue
            best = (units[rows] @ self.matrix[lo:hi].T).argmax(1)
            for k in np.unique(best).tolist():
                todo.append((lo + k, rows[best == k]))
        return out

    def visit(self, query: np.ndarray, limit: int) -> list[int]:
        """Leaves in the order of a best-bin-first walk."""
        near = self.matrix @ query
        queue = [(-near[0], 0)]
        out = []
        while queue and len(out) < limit:
            _, node = heapq.heappop(queue)
            lo, hi = self.children[node]
            if lo == hi:
                out.append(self.leaf[node])
                continue
            for k in range(lo, hi):
                heapq.heappush(queue, (-near[k], k))
        return out


def _best(ids: np.ndarray, units: np.ndarray, raw: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, raw_queries: np.ndarray, k: int):
    """(query row, row, score) of the k best rows of each query; ties at the edge go to the
    smaller id. Scores are computed on the original vectors."""
    rough = queries @ units.T
    rough[query_ids[:, None] == ids[None, :]] = -2
    n = rough.shape[1]
    edge = np.partition(rough, n - k, axis=1)[:, n - k] if n > k else np.full(len(rough), -1.5)
    near = (rough >= edge[:, None] - 1e-9) & (rough > -1.5)
    # Rows that tie at the edge may be very many: queries are taken so far as some pairs go.
    ends = np.cumsum(near.sum(1))
    out, lo = [], 0
    while lo < len(near):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_PAIRS, side="right")))
        q, r = np.nonzero(near[lo:hi])
        a, b = raw_queries[lo + q], raw[r]
        score = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
        order = np.lexsort((ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        out.append((lo + q[keep], r[keep], score[keep]))
        lo = hi
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _take_part(vectors: DataFrame, dim: int) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long"), plain(vectors).alias("embedding")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")) & (F.size("embedding") == dim))


def lengths(vectors: DataFrame) -> list[int]:
    """The lengths of vectors that take part, ascending."""
    ok = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return sorted(r.d for r in ok.select(F.size("embedding").alias("d")).distinct().collect())


def fit(spark: SparkSession, vectors: DataFrame, d: int, rows: int = SAMPLE_ROWS, values: int = SAMPLE_VALUES) -> Tree:
    """The tree of the vectors of length d, from a bounded sample of rows."""
    ok = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", "embedding")
    order = F.xxhash64("vec_id", F.lit(17))
    ids = ok.where(F.size("embedding") == d).select("vec_id", order.alias("h")).orderBy("h", "vec_id").limit(min(rows, max(1, values // d)))
    ids = materialise(spark, ids.select("vec_id").distinct(), "sample")
    x = matrix(_take_part(vectors, d).join(F.broadcast(ids), "vec_id").select("embedding").toArrow().column(0))
    discard(spark, ids)
    return Tree(unit(x))


def _index(tree: Tree):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.descend(unit(matrix(batch.column("embedding"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "embedding", "leaf"])

    return run


def calibrate(spark: SparkSession, index: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float = RECALL, count: int = CALIBRATION) -> int:
    """Number of leaves to visit: count queries are compared with every row, and visits
    are widened by a quarter until the share recall of their neighbours is reached."""
    some = queries.orderBy(F.xxhash64("vec_id", F.lit(19)), "vec_id").limit(count).toArrow()
    if not some.num_rows:
        return 1
    q_ids, q_raw = some.column("vec_id").to_numpy(), matrix(some.column("embedding"))
    q = unit(q_raw)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("embedding"))
                ids = batch.column("vec_id").to_numpy()
                a, b, s = _best(ids, unit(x), x, q_ids, q, q_raw, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a]), pa.array(ids[b]), pa.array(s), batch.column("leaf").take(pa.array(b))], names=["query_id", "vec_id", "score", "leaf"])

    near = index.mapInArrow(run, "query_id long, vec_id long, score double, leaf long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect()
    at = {i: {leaf: n for n, leaf in enumerate(tree.visit(v, tree.leaves))} for i, v in zip(q_ids.tolist(), q, strict=True)}
    ranks = np.array([at[r.query_id][r.leaf] for r in true])
    visits = 4
    while visits < tree.leaves and (ranks < visits).mean() < recall:
        visits = visits + max(1, visits // 4)
    return min(visits, tree.leaves)


def _visits(tree: Tree, limit: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                q = unit(matrix(batch.column("embedding")))
                lists = [tree.visit(v, limit) for v in q]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(lists, pa.list_(pa.int64()))], names=["vec_id", "leaves"])

    return run


def _search(k: int):
    def run(t: pa.Table, starts: np.ndarray) -> pa.Table | None:
        out = []
        ends = np.append(starts[1:], t.num_rows)
        ids, role = t.column("vec_id").to_numpy(), t.column("role").to_numpy()
        raw = matrix(t.column("embedding"))
        units = unit(raw)
        for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
            mid = lo + int((role[lo:hi] == 0).sum())
            for at in range(mid, hi, TILE) if lo < mid else ():
                to = min(hi, at + TILE)
                q, r, s = _best(ids[lo:mid], units[lo:mid], raw[lo:mid], ids[at:to], units[at:to], raw[at:to], k)
                out.append((ids[at:to][q], ids[lo:mid][r], s))
        if not out:
            return None
        return pa.table({n: pa.array(np.concatenate(c)) for n, c in zip(("query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})

    return run


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each of queries (vec_id,
    embedding) among vectors."""
    found = [_nearest(spark, vectors, queries, d, k, recall) for d in lengths(vectors)]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionAll, found)


def _nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, d: int, k: int, recall: float) -> DataFrame:
    tree = fit(spark, vectors, d)
    kept = _take_part(vectors, d)
    numbers = kept.schema["embedding"].dataType.simpleString()
    index = materialise(spark, kept.mapInArrow(_index(tree), f"vec_id long, embedding {numbers}, leaf long"), "index")
    queries = materialise(spark, _take_part(queries, d).dropDuplicates(["vec_id"]), "queries")
    limit = calibrate(spark, index, queries, tree, k, recall)
    walks = queries.mapInArrow(_visits(tree, limit), "vec_id long, leaves array<long>")
    visits = materialise(spark, walks.select("vec_id", F.explode("leaves").alias("leaf")), "visits")
    part = max(TILE, PART_VALUES // d)
    sizes = index.groupBy("leaf").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    asked = visits.groupBy("leaf").agg(F.ceil(F.count("*") / part).cast("int").alias("q_parts"))
    plan = materialise(spark, sizes.join(asked, "leaf"), "plan")
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(plan, "leaf").select("leaf", deal("parts", 1).alias("part"), every("q_parts").alias("q_part"), F.lit(0).alias("role"), "vec_id", "embedding")
    right = visits.join(plan, "leaf").join(queries, "vec_id").select("leaf", every("parts").alias("part"), deal("q_parts", 2).alias("q_part"), F.lit(1).alias("role"), "vec_id", "embedding")
    found = sorted_groups(left.unionAll(right), ["leaf", "part", "q_part"], _search(k), "query_id long, vec_id long, score double", order=["role"])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    out = materialise(spark, once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
    discard(spark, index, queries, visits, plan)
    return out


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(spark, vectors, vectors.where(F.col("vec_id") % 50 == 0))
