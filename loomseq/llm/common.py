"""Pieces that several operators share: durable intermediate tables, streaming
group processing inside a partition, and connected components.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores: a scan of one small file would
    otherwise keep the work that follows in one task. Larger scans are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir of the session. Where
    that is unset, one machine chooses a temporary folder; a cluster cannot."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/loomseq-{tag}-{uuid.uuid4().hex}"


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """While a write runs, Arrow batches of rows rows at most: texts are long, and a batch
    is held several times over between Spark and Python."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def materialise(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives
    the loss of executors."""
    path = fresh_path(spark, tag)
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.loomseq_home = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files of materialised tables that nothing reads any more."""
    for df in frames:
        home = vars(df).get("loomseq_home")
        if home:
            delete(spark, home)


FILTER_BITS = 23


def sieve(spark: SparkSession, df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """df split in two: rows whose key may be among keys (all that are, and some others),
    and rows whose key surely is not. One bit for each hash: the bitmap is a table of at
    most 2 ** (FILTER_BITS - 6) rows (2 MB), so it can be broadcast at any size of the
    input; a fuller one only sorts out less. It keeps the texts of unconcerned rows out of
    the shuffle of the exact join that follows."""
    hashed = F.xxhash64(key, F.lit(23))
    word = F.shiftright(F.pmod(hashed, F.lit(1 << FILTER_BITS)), 6).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{key}`, 23), 64) as int))")
    bitmap = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    bitmap = materialise(spark, bitmap, "bitmap")
    marked = df.withColumns({"__word": word, "__bit": bit}).join(F.broadcast(bitmap), "__word", "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(F.col("__bit")) != 0, F.lit(False))
    return marked.where(hit).select(*df.columns), marked.where(~hit).select(*df.columns)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def stable_bucket(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo modulus."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about max_bytes of text, one row at least. At the
    end of a partition memory that is free goes back to the system, as a worker lives on."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def sorted_groups(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pa.Table, np.ndarray], pa.Table | None],
    schema: str,
    order: list[str] | None = None,
    target_rows: int = 4096,
) -> DataFrame:
    """Bring the rows of each key together (hash partitioning and a sort, no group
    object per key) and call fn with tables of whole groups and the groups' start
    offsets. Only for groups that are bounded by construction."""
    placed = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < target_rows:
                continue
            t = pa.Table.from_batches(held)
            starts = group_starts(t, keys)
            if len(starts) == 1:
                continue
            cut = int(starts[-1])
            out = fn(t.slice(0, cut).combine_chunks(), starts[:-1])
            if out is not None and out.num_rows:
                yield from out.to_batches()
            held = t.slice(cut).combine_chunks().to_batches()
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            out = fn(t, group_starts(t, keys))
            if out is not None and out.num_rows:
                yield from out.to_batches()

    return placed.mapInArrow(run, schema)


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.zeros(t.num_rows, dtype=bool)
    changed[:1] = True
    for k in keys:
        v = t.column(k).to_numpy()
        changed[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(changed)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a[i], b[i]) and the smallest node each is joined to by them."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        lo = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], lo)
        np.minimum.at(new, root[y], lo)
        np.minimum.at(new, x, lo)
        np.minimum.at(new, y, lo)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _local_forest(batches):
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if len(a):
            nodes, roots = forest(a, b)
            far = nodes != roots
            yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], names=["a", "b"])


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component_id) of every node in links (a, b); component_id is the smallest
    node reachable. Each round hooks a root to its smallest neighbour, follows the
    pointers to their end and contracts the links, so the number of rounds grows with
    the logarithm of the number of nodes. Links without two ends or with equal ends are
    ignored."""
    clean = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    left = materialise(spark, clean.mapInArrow(_local_forest, "a long, b long").distinct(), "links")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        parent = materialise(spark, hooks.select("node", F.least("node", "up").alias("root")), "hooks")
        while True:
            above = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            jumped = materialise(spark, parent.join(above, "root").select("node", F.col("higher").alias("root"), (F.col("higher") != F.col("root")).alias("moved")), "jump")
            discard(spark, parent)
            parent = jumped
            if jumped.where("moved").isEmpty():
                break
        maps.append(parent)
        pa_, pb = (parent.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in ("a", "b"))
        right = left.join(pa_, "a").join(pb, "b").where("ra <> rb")
        contracted = right.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct()
        new = materialise(spark, contracted, "links")
        discard(spark, left)
        left = new
    if not maps:
        return clean.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    discard(spark, left)
    out = maps[0]
    for m in maps[1:]:
        up = m.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        new = materialise(spark, out.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "roots")
        discard(spark, out, m)
        out = new
    found = out.select("node", F.col("root").alias("component_id"))
    found.loomseq_home = out.loomseq_home
    return found
