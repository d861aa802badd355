"""Embedding whitening with Spark MLlib's block matrices.

Entries are made whole numbers first: x = floor(64 c) + 1000000. The rows get numbers from 0
without a gap, are centred by the exact sums of their dimensions, and become an indexed row
matrix, from it a block matrix C of ROWS rows a block. The scatter is C' C, multiplied over
splits of the rows (so no task holds more than a few blocks) and brought to the driver, being
d x d; its eigenvectors by eigh, scaled by the roots of their eigenvalues, are the whitening
matrix W (d x k); C W projects all rows. The covariance of the projected rows is measured the
same way, so identity_error is what the result has, not what it should have.

Vectors that are null or hold null or non-finite entries take no part. Vectors are whitened
among those of their own length: where all have one length, that is the whole table (the list
of lengths comes to the driver; each is fitted on its own). Empty vectors have no components
and give no rows. Components whose eigenvalue is 0 (FLAT of the largest or less: fewer rows
than dimensions, constant dimensions) have explained 0 and whitened null, and are left out of
identity_error. Repeated rows are rows of their own; ids may be null, repeated and of any
type; an empty table gives no rows; other columns are ignored. deviation is null where the
exact number does not fit a long. Entries beyond about 2 ** 40 are an error (the exact sums
must fit a long).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import discard, materialise, table

COMPONENTS = 32
#: Bytes of a block of rows, and of the blocks that one task multiplies and sums up.
BLOCK_BYTES, SPLIT_BYTES = 4 << 20, 32 << 20
LEAST_ROWS = 256
FLAT = 1e-12


def whole(embedding: Column) -> Column:
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * 64) + 1000000)


def usable(embedding: Column) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return embedding.isNotNull() & F.coalesce(F.forall(embedding, finite), F.lit(False))


def numbered(spark: SparkSession, df: DataFrame) -> DataFrame:
    """df with index: 0, 1, ... without a gap. Rows keep their partitions; only the number of
    rows of each partition is brought together."""
    placed = materialise(spark, df.withColumn("__place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__place", 33)
    counts = placed.groupBy(part.alias("__part")).count().orderBy("__part").collect()
    ends = np.cumsum([r["count"] for r in counts])
    offsets = spark.createDataFrame([(r["__part"], int(e - r["count"])) for r, e in zip(counts, ends, strict=True)], "__part long, __offset long")
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part").select(*df.columns, (F.col("__offset") + within).alias("index"))
    out.loomseq_home = placed.loomseq_home
    return out


def times(left: BlockMatrix, right: BlockMatrix) -> BlockMatrix:
    """left x right, the sum over their common dimension split among tasks."""
    cores = left.blocks.context.defaultParallelism
    size = 8 * left.numCols() * left.numRows()
    splits = max(min(left.numColBlocks, cores), -(-size // SPLIT_BYTES))
    wrapper = left._java_matrix_wrapper
    product = wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def local(m: BlockMatrix) -> np.ndarray:
    return m.toLocalMatrix().toArray()


def block_rows(n: int, dims: int, cores: int) -> int:
    """Rows of a block: BLOCK_BYTES of them, fewer where there would be too few blocks."""
    return max(LEAST_ROWS, min(BLOCK_BYTES // (8 * dims), -(-n // (4 * cores))))


def block_matrix(rows: DataFrame, n: int, dims: int) -> BlockMatrix:
    """rows: index, vector array<double>."""
    height = block_rows(n, dims, rows.sparkSession.sparkContext.defaultParallelism)
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("vector").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(height, dims)


@dataclass
class Whitening:
    n: int
    #: Exact sums of the whole-number entries, and the components: unit columns by falling
    #: eigenvalue, of which as many as asked for are kept.
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def good(self) -> np.ndarray:
        return self.values > FLAT * max(self.values[0], 0.0)

    @property
    def explained(self) -> np.ndarray:
        return np.where(self.good, self.values / self.trace, 0.0) if self.trace > 0 else np.zeros(len(self.values))

    @property
    def matrix(self) -> np.ndarray:
        scale = np.where(self.good, np.sqrt(np.where(self.good, self.values, 1.0)), np.inf)
        return self.components / scale


def fit(centred: BlockMatrix, n: int, sums: list[int], components: int) -> Whitening:
    """Eigenvectors of the covariance (divisor n) of the centred rows."""
    scatter = local(times(centred.transpose(), centred))
    covariance = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, sums, vectors[:, order], np.maximum(values[order], 0.0), float(np.trace(covariance)))


def project(spark: SparkSession, centred: BlockMatrix, model: Whitening) -> BlockMatrix:
    dims, k = model.matrix.shape
    block = DenseMatrix(dims, k, np.asfortranarray(model.matrix).ravel(order="F"))
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), centred.colsPerBlock, k, dims, k)
    return times(centred, right)


def identity_error(white: BlockMatrix, model: Whitening) -> float:
    """Largest entry of |covariance of the projected rows - identity|, over components with
    an eigenvalue above 0. The rows are centred, so their scatter is their covariance."""
    covariance = local(times(white.transpose(), white)) / model.n
    good = model.good
    return float(np.abs(covariance - np.eye(len(good)))[np.ix_(good, good)].max(initial=0.0))


def whiten(spark: SparkSession, df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """df (vec_id, embedding) -> vec_id, dims, n, deviation, white array<double>, explained
    array<double>, identity_error: one row for each vector that takes part."""
    good = df.where(usable(F.col("embedding"))).select("vec_id", whole(F.col("embedding")).alias("x"))
    kept = materialise(spark, good.where("size(x) > 0").withColumn("dims", F.size("x")), "vectors")
    lengths = [r.dims for r in kept.select("dims").distinct().orderBy("dims").collect()]
    outs = [_whiten_one(spark, kept.where(F.col("dims") == d).drop("dims"), d, components) for d in lengths]
    discard(spark, kept)
    if not outs:
        schema = "dims int, n bigint, deviation bigint, white array<double>, explained array<double>, identity_error double"
        return df.select("vec_id").where("false").select("vec_id", *[F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in schema.split(", ")])
    out = outs[0]
    for other in outs[1:]:
        out = out.unionAll(other)
    return out


def _whiten_one(spark: SparkSession, rows: DataFrame, dims: int, components: int) -> DataFrame:
    rows = numbered(spark, rows)
    facts = rows.agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(k))).alias(f"s{k}") for k in range(dims)]).first()
    n, sums = facts["n"], [facts[f"s{k}"] for k in range(dims)]
    total, mean = F.lit(np.array(sums)), F.lit(np.array(sums) / n)
    entries = F.zip_with("x", mean, lambda x, m: x.cast("double") - m)
    centred = block_matrix(rows.select("index", entries.alias("vector")), n, dims)
    model = fit(centred, n, sums, components)
    white = project(spark, centred, model)
    projected = callMLlibFunc("getIndexedRows", white.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    projected = MLUtils.convertVectorColumnsToML(projected, "vector").select("index", vector_to_array("vector").alias("white"))
    far = F.zip_with("x", total, lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n).cast("bigint")), s))
    deviation = F.aggregate(far, F.lit(0).cast("bigint"), lambda a, v: F.try_add(a, F.try_multiply(v, v)))
    explained = F.lit(model.explained)
    if not model.good.all():
        projected = projected.withColumn("white", F.zip_with("white", F.lit(model.explained > 0), lambda w, g: F.when(g, w)))
    error = identity_error(white, model)
    joined = rows.select("index", "vec_id", deviation.alias("deviation")).join(projected, "index")
    out = joined.select("vec_id", F.lit(dims).alias("dims"), F.lit(n).cast("bigint").alias("n"), "deviation", "white", explained.alias("explained"), F.lit(error).alias("identity_error"))
    stored = materialise(spark, out, "whitened")
    discard(spark, rows)
    return stored


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark, table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = found.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("white").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("at")).alias("explained"), "identity_error")
