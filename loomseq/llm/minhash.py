"""Near-duplicate documents by MinHash with tensored banding.

Two collections of m small hashes (three minhashes each) are computed per document. The
key of table (i, j) is the pair of the i-th hash of the first and the j-th of the second
collection, so m * m tables need only 2 * m * 3 minhashes instead of m * m * 6. A pair of
documents of similarity s meets in some table with probability (1 - (1 - s^3)^m)^2; m is
chosen so that a pair at the threshold is missed with probability 2e-4 at most.

Candidates are confirmed on the full shingle sets. Documents with equal sets form a
class, of which one member goes on. Within a bucket every member is first compared with
one leader, the member that shares most buckets with others; only buckets whose members
are then still in different components are compared pair by pair, in blocks: two blocks once,
if any bucket has members in both. No bucket, partner or candidate is capped, and no bucket is
held in one task.

Documents without words (null, empty or blank text) are linked with nothing. Rows with
equal doc_id count as one document, which is linked with whatever the text of any of its rows
is a near copy of; each row keeps its own n_shingles. A null doc_id is linked with nothing.
Ties go to the smaller doc_id. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import connected_components, discard, materialise, sieve, sorted_groups, table, text_slices
from loomseq.llm.shingles import mix, set_list, shingle_sets

ROWS = 3
MISS = 1e-4
GROUP, BLOCK = 128, 512


def collections(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Number m of small hashes in each of the two collections."""
    return max(2, math.ceil(math.log(miss) / math.log(1 - threshold**rows)))


def signatures(docs: DataFrame, width: int, m: int, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, s1, s2 (128 bits that equal sets share) and keys (2 * m hashes)."""
    factors = (mix(np.arange(1, 2 * m * rows + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)).reshape(2 * m, rows)

    def run(batches):
        for piece in text_slices(batches, 1 << 19):
            hashes, owners, starts = shingle_sets(piece.column("text"), width)
            n = np.zeros(piece.num_rows, dtype=np.int64)
            s = np.zeros((2, piece.num_rows), dtype=np.uint64)
            keys = np.zeros((piece.num_rows, 2 * m), dtype=np.uint64)
            if len(hashes):
                n[owners] = np.diff(np.append(starts, len(hashes)))
                s[0, owners] = np.add.reduceat(mix(hashes ^ np.uint64(0x1234567)), starts)
                s[1, owners] = np.add.reduceat(mix(hashes + np.uint64(0x7654321)), starts)
                for k in range(2 * m):
                    key = np.full(len(owners), k, dtype=np.uint64)
                    for a in factors[k]:
                        key = mix(key * np.uint64(31) + np.minimum.reduceat(hashes * a, starts))
                    keys[owners, k] = key
            flat = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, 2 * m, dtype=np.int32), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n), pa.array(s[0].view(np.int64)), pa.array(s[1].view(np.int64)), flat], names=["doc_id", "n_shingles", "s1", "s2", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>")


def _link_table(a: list, b: list) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _confirm(width: int, percent: int):
    """Members of a group against its leader, which comes first."""

    def run(t: pa.Table, starts: np.ndarray) -> pa.Table:
        a, b = [], []
        ends = np.append(starts[1:], t.num_rows)
        for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
            part = t.slice(lo, hi - lo).combine_chunks()
            sets = set_list(part.column("text").combine_chunks(), width)
            ids = part.column("member").to_numpy()
            lead = sets[0]
            for i in range(1, len(sets)):
                small, large = (lead, sets[i]) if len(lead) < len(sets[i]) else (sets[i], lead)
                if 100 * len(small) < percent * len(large):
                    continue
                shared = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                if 100 * shared >= percent * (len(small) + len(large) - shared):
                    a.append(ids[i])
                    b.append(ids[0])
        return _link_table(a, b)

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes; only shingles that two sets share get a column."""
    sizes = [len(s) for s in sets]
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    row, column = row[keep], column[keep]
    if not len(column):
        return np.zeros((len(sets), len(sets)))
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    step = 4096
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1, step):
        x, y = np.searchsorted(column, [lo, lo + step])
        dense = np.zeros((len(sets), step), dtype=np.float32)
        dense[row[x:y], column[x:y] - lo] = 1
        out += dense @ dense.T
    return out


def _compare(width: int, percent: int):
    """All pairs of a block pair whose members are in different components."""

    def run(t: pa.Table, starts: np.ndarray) -> pa.Table:
        a, b = [], []
        ends = np.append(starts[1:], t.num_rows)
        for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
            part = t.slice(lo, hi - lo).combine_chunks()
            ids, comp = part.column("member").to_numpy(), part.column("comp").to_numpy()
            sets = set_list(part.column("text").combine_chunks(), width)
            size = np.array([len(s) for s in sets])
            shared = intersections(sets)
            union = size[:, None] + size[None, :] - shared
            x, y = np.nonzero(np.triu(100 * shared >= percent * union, 1) & (comp[:, None] != comp[None, :]))
            a += ids[x].tolist()
            b += ids[y].tolist()
        return _link_table(a, b)

    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 5, threshold: float = 0.8, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    percent = round(100 * threshold)
    m = collections(threshold, rows)
    sigs = materialise(spark, signatures(docs, width, m, rows), "sigs")
    some = sigs.where("n_shingles > 0 and doc_id is not null")
    several = some.groupBy("doc_id").agg(F.min(F.struct("s1", "s2")).alias("lo"), F.max(F.struct("s1", "s2")).alias("hi"))
    if not several.where("lo <> hi").isEmpty():
        discard(spark, sigs)
        return _by_rows(spark, docs, width, threshold, rows)
    classes = materialise(spark, some.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.min_by("keys", "doc_id").alias("keys")), "classes")

    # Small hashes that two classes share, and from them the keys of the tables.
    half = classes.select("rep", F.posexplode("keys").alias("slot", "half"))
    common = materialise(spark, half.groupBy("half").count().where("count > 1").select("half"), "halves")
    live = half.join(common, "half").groupBy("rep").agg(F.collect_list(F.when(F.col("slot") < m, F.col("half"))).alias("u"), F.collect_list(F.when(F.col("slot") >= m, F.col("half"))).alias("v"))
    keys = live.select("rep", F.explode("u").alias("u"), "v").select("rep", "u", F.explode("v").alias("v")).select("rep", F.xxhash64("u", "v").alias("key"))
    keys = materialise(spark, keys, "keys")
    sizes = materialise(spark, keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    met = materialise(spark, keys.join(sizes, "key"), "met")
    discard(spark, common, keys)

    # One leader for each bucket: the member that meets most others over all its buckets.
    weight = materialise(spark, met.groupBy("rep").agg(F.sum("n").alias("w")), "weights")
    best = F.max_by("rep", F.struct("w", -F.col("rep")))
    leaders = materialise(spark, met.join(weight, "rep").groupBy("key").agg(best.alias("leader")), "leaders")
    pairs = materialise(spark, met.join(leaders, "key").where("rep <> leader").select("leader", F.col("rep").alias("member")).distinct(), "pairs")
    wanted = weight.select(F.col("rep").alias("doc_id"))
    likely, _ = sieve(spark, docs.select(F.col("doc_id").cast("long"), "text"), wanted, "doc_id")
    text = materialise(spark, likely.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "member"), "text")
    parts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    parts = materialise(spark, parts, "parts")
    salted = pairs.join(parts, "leader").select("leader", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("part"), "member", F.lit(1).alias("role"))
    heads = parts.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("member"), F.lit(0).alias("role"))
    groups = salted.unionAll(heads).join(text, "member")
    star = materialise(spark, sorted_groups(groups, ["leader", "part"], _confirm(width, percent), "a long, b long", order=["role"], target_rows=512), "star")
    comps = connected_components(spark, star)

    # Buckets that still hold several components: pair by pair, in blocks.
    placed = met.where("n > 2").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("component_id", "rep").alias("comp"))
    placed = materialise(spark, placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    placed = materialise(spark, placed.join(materialise(spark, mixed.select("key"), "mixed"), "key"), "open")
    # Buckets that share members form a chain, whose members are dealt into blocks. Two blocks
    # are compared, once, if some bucket has members in both; so no pair of blocks is compared
    # in several buckets, at any size of a chain.
    links = placed.groupBy("key").agg(F.min("rep").alias("b")).join(placed.select("key", F.col("rep").alias("a")), "key").select("a", "b").distinct()
    chains = connected_components(spark, links)
    counted = materialise(spark, chains.groupBy("component_id").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "chains")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    dealt = materialise(spark, chains.join(counted, "component_id").select(F.col("node").alias("rep"), F.col("component_id").alias("chain"), own.alias("own")), "dealt")
    members = materialise(spark, placed.select("key", "rep", "comp").join(dealt, "rep"), "members")
    sets = members.groupBy("key", "chain").agg(F.array_sort(F.collect_set("own")).alias("blocks")).select("chain", "blocks").distinct()
    pair = F.transform(F.col("blocks"), lambda x: F.transform(F.filter("blocks", lambda y: y >= x), lambda y: F.struct(x.alias("i"), y.alias("j"))))
    pairs_ = materialise(spark, sets.select("chain", F.explode(F.flatten(pair)).alias("p")).select("chain", "p.*").distinct(), "block-pairs")
    rows_ = members.select("chain", "own", F.col("rep").alias("member"), "comp").distinct()
    sides = pairs_.select("chain", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("own"))
    cells = rows_.join(sides, ["chain", "own"]).select("chain", "i", "j", "member", "comp")
    rest = materialise(spark, sorted_groups(cells.join(text, "member"), ["chain", "i", "j"], _compare(width, percent), "a long, b long", target_rows=512), "rest")

    final = comps
    if not rest.isEmpty():
        final = connected_components(spark, star.unionAll(rest))
    out = sigs.select("doc_id", "n_shingles", "s1", "s2").join(classes.select("s1", "s2", "rep"), ["s1", "s2"], "left").join(final.select(F.col("node").alias("rep"), "component_id"), "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "rep")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    out = out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    out = materialise(spark, out, "near-duplicates")
    discard(spark, sigs, classes, sizes, met, weight, leaders, pairs, parts, text, star, comps, final, placed, chains, counted, dealt, members, pairs_, rest)
    return out


def _by_rows(spark: SparkSession, docs: DataFrame, width: int, threshold: float, rows: int) -> DataFrame:
    """near_duplicates where some doc_id has rows of different texts: rows are compared under
    ids of their own, and documents are joined by the components that their rows are in."""
    placed = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.monotonically_increasing_id())
    placed = materialise(spark, placed, "rows")
    known = placed.where("doc_id is not null").select(F.col("row").alias("doc_id"), "text")
    found = near_duplicates(spark, known, width, threshold, rows)
    of_rows = found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("together"))
    members = materialise(spark, placed.select("doc_id", "row").join(of_rows, "row"), "members")
    first = members.groupBy("together").agg(F.min("doc_id").alias("first"))
    joined = connected_components(spark, members.join(first, "together").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct())
    out = members.select("doc_id", "n_shingles").join(joined.select(F.col("node").alias("doc_id"), "component_id"), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    lone = signatures(placed.where("doc_id is null").select("doc_id", "text"), width, 2, rows)
    out = out.unionAll(lone.select("doc_id", "n_shingles", F.lit(None).cast("long")))
    out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    out = materialise(spark, out, "near-duplicates")
    discard(spark, placed, found, members, joined)
    return out


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), width=3, threshold=0.85)


SQL = r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s), e AS (SELECT doc_id, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l)"""
SQL = (
    "WITH RECURSIVE "
    + SQL.removeprefix("WITH ")
    + """, r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.node)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) c ON c.node = n.doc_id"""
)
