"""Near-duplicate vectors by lattice hashing.

Each of several tables projects the unit vectors at random to eight dimensions, scales
them and decodes them to the nearest point of the E8 lattice, the densest packing there.
A vector is filed under its own cell and under the nearest neighbouring cells, so close
vectors on the two sides of a border still meet. Two vectors are candidates where they
share a cell of a table (and the class that must agree); their cosine is then computed
in double precision. A pair that meets more than once counts only at the first cell they
share, which both sides can tell from their vectors.

Equal vectors of one label form a class, of which one member is compared. Cells are
compared block by block, and a comparison yields for each vector its number of links and
one link to the smallest vector it is joined to there, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and rows with
a null label or id, are linked with nothing: n_links is 0 and the component the vector
itself. Rows of one vec_id with different vectors have links of their own, and one component.
Vectors of different lengths are not compared. Empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import connected_components, discard, forest, materialise, sorted_groups, table
from loomseq.llm.shingles import mix

THRESHOLD = 0.98
TABLES, PROBES, REACH = 5, 4, 0.6
BLOCK = 512


def usable(vector: Column) -> Column:
    """Whether a vector can take part in a comparison by cosine."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def plain(vectors: DataFrame) -> Column:
    """The embedding as it is stored where its numbers are of single precision, which halves
    what is shuffled; tasks compute in double precision either way."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    return F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    peak = np.abs(x).max(1, keepdims=True)
    x = x / peak
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _d8(x: np.ndarray) -> np.ndarray:
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(1) % 2 != 0)
    if len(odd):
        gap = x[odd] - f[odd]
        k = np.abs(gap).argmax(1)
        f[odd, k] += np.where(gap[np.arange(len(odd)), k] >= 0, 1, -1)
    return f


def e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of the E8 lattice to each row."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(nearer[:, None], a, b)


@functools.lru_cache(maxsize=1)
def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


@functools.lru_cache(maxsize=4)
def _projections(dim: int, tables: int) -> np.ndarray:
    rng = np.random.default_rng(20240607)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, max(8, min(dim, 8)))))[0] if dim >= 8 else rng.standard_normal((dim, 8)) / np.sqrt(dim) for _ in range(tables)])


def cells(units: np.ndarray, tables: int = TABLES, probes: int = PROBES, reach: float = REACH, threshold: float = THRESHOLD) -> np.ndarray:
    """[row, table * (1 + probes)] hashes of the cells under which unit vectors are filed.
    reach is the typical length, in lattice units, of the projected difference of two
    vectors at the threshold."""
    n, dim = units.shape
    scale = reach / (np.sqrt(2 - 2 * threshold) * np.sqrt(min(1.0, 8 / dim)))
    out = np.zeros((n, tables, 1 + probes), dtype=np.uint64)
    shift = np.random.default_rng(7).random((tables, 8))
    weight = mix(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for t, p in enumerate(_projections(dim, tables)):
        x = units @ p * scale + shift[t]
        home = e8(x)
        near = np.argpartition(-((x - home) @ _neighbours().T), probes, axis=1)[:, :probes]
        points = np.concatenate([home[:, None, :], home[:, None, :] + _neighbours()[near]], axis=1)
        codes = np.rint(points * 2).astype(np.int64).view(np.uint64)
        out[:, t] = mix((codes * weight).sum(2) + np.uint64(t + 1))
    return out.reshape(n, -1)


def _by_length(batch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vectors in a batch or table."""
    column = batch.column("embedding")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = []
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        out.append((at, matrix(column.take(pa.array(at)))))
    return out


def _file(threshold: float):
    def run(batches):
        for batch in batches:
            node, label = (batch.column(c).to_numpy() for c in ("node", "class"))
            for at, x in _by_length(batch):
                c = cells(unit(x), threshold=threshold)
                c = np.sort(mix(c + label[at].view(np.uint64)[:, None]), axis=1)
                keep = np.ones(c.shape, dtype=bool)
                keep[:, 1:] = c[:, 1:] != c[:, :-1]
                ids = np.repeat(node[at], c.shape[1]).reshape(c.shape)
                yield pa.RecordBatch.from_arrays([pa.array(c[keep].view(np.int64)), pa.array(ids[keep])], names=["cell", "node"])

    return run


def _links(threshold: float):
    """Links inside whole groups (cell, i, j): one row per vector that has any."""

    def run(t: pa.Table, starts: np.ndarray) -> pa.Table:
        group = np.zeros(t.num_rows, dtype=np.int64)
        group[starts] = 1
        group = np.cumsum(group)
        node, rep, count, own, cell, label = (t.column(c).to_numpy() for c in ("node", "rep", "n", "own", "cell", "class"))
        cross = t.column("i").to_numpy() != t.column("j").to_numpy()
        found_a, found_b = [], []
        for at, x in _by_length(t):
            u = unit(x)
            c = mix(cells(u, threshold=threshold) + label[at].view(np.uint64)[:, None])
            g, o, k = group[at], own[at], cross[at]
            for d in range(1, len(at)):
                a = np.flatnonzero(g[d:] == g[:-d])
                if not len(a):
                    break
                b = a + d
                ok = ~k[a] | (o[a] != o[b])
                a, b = a[ok], b[ok]
                ok = np.einsum("ij,ij->i", u[a], u[b]) >= threshold
                a, b = a[ok], b[ok]
                for lo in range(0, len(a), 8192):
                    x_, y_ = a[lo : lo + 8192], b[lo : lo + 8192]
                    same = (c[x_][:, :, None] == c[y_][:, None, :]).any(2)
                    first = np.where(same, c[x_], np.iinfo(np.uint64).max).min(1)
                    here = first == cell[at[x_]].view(np.uint64)
                    found_a.append(at[x_[here]])
                    found_b.append(at[y_[here]])
        if not found_a or not sum(map(len, found_a)):
            return None
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        ends = np.concatenate([a, b])
        ids, one, flat = np.unique(node[ends], return_index=True, return_inverse=True)
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, flat, np.concatenate([count[b], count[a]]))
        reps, roots = forest(rep[a], rep[b])
        own_rep = rep[ends[one]]
        return pa.table({"node": pa.array(ids), "rep": pa.array(own_rep), "links": pa.array(links), "root": pa.array(roots[np.searchsorted(reps, own_rep)])})

    return run


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding,
    label)."""
    e = F.col("embedding")
    ok = usable(e) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(ok, F.xxhash64("label")).alias("class"), F.when(ok, F.xxhash64(e)).alias("h1"), F.when(ok, F.hash(e, F.lit(1)).cast("long")).alias("h2"), plain(vectors).alias("embedding"))
    good = rows.where("class is not null")
    classes = good.groupBy("class", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min_by("embedding", "vec_id").alias("embedding"))
    # A vec_id may have several vectors, so a class has a number of its own.
    classes = materialise(spark, classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    filed = materialise(spark, classes.select("node", "class", "embedding").mapInArrow(_file(threshold), "cell long, node long"), "cells")
    shared = materialise(spark, filed.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    met = filed.join(shared, "cell").join(classes.select("node", "rep", "class", "n", "embedding"), "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int")
    facts = ["node", "rep", "class", "n", "embedding"]
    rows_ = met.select("cell", *facts, own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows_ = rows_.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *facts)
    found = sorted_groups(rows_, ["cell", "i", "j"], _links(threshold), "node long, rep long, links long, root long")
    found = materialise(spark, found, "found")
    discard(spark, filed, shared)
    links = materialise(spark, found.groupBy("node").agg(F.sum("links").alias("links")), "links")
    key = ["class", "h1", "h2"]
    several = good.groupBy("vec_id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi")).where("lo <> hi").select("vec_id")
    same = good.select("vec_id", *key).join(several, "vec_id", "left_semi").join(classes.select(*key, "rep"), key).select("vec_id", "rep")
    comps = connected_components(spark, found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionAll(same))
    facts = classes.select("class", "h1", "h2", "node", "rep", "n").join(links, "node", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    facts = materialise(spark, facts.select("class", "h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")), "facts")
    discard(spark, classes, found, links)
    out = rows.select("vec_id", "class", "h1", "h2").join(facts, ["class", "h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS s FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / a.s / b.s >= {THRESHOLD}),
r AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.node AS vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.node = c.component_id AS kept
FROM (SELECT node, min(root) AS component_id FROM r GROUP BY node) c LEFT JOIN n ON n.a = c.node"""
