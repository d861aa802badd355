"""Exact repeats of long strings, by a logarithmic family of suffix arrays.

Units. A text is a string of bytes, or of words ([^\\x20\\x09-\\x0D]+, each as a 64-bit code).
A repeat is a string of window units that starts anywhere else too, in the same text or
another; every unit that such a string covers is reported.

Index. A batch of texts gets a suffix array: its suffixes, sampled at content-defined
places, in the order of their letters. The place of a window is where the least hash of
its strings of gram units lies (the leftmost), so equal windows have their place at the
same offset, and a window belongs to exactly one place. A suffix is stored by its first
gram units; suffixes that agree so far are one entry, with their number. The array of a new batch is merge-scanned against the
array of every level for common prefixes; then it becomes a level of its own, and as long
as the two youngest levels stand for equally many batches they are merged into one.
Arrays are tables in buckets, sorted by letters in each (words by 16 bits of each code), so
neither a scan nor a merge shuffles anything, and a prefix occurs once in an array, so none is
hot. The suffixes that a scan finds tied are ordered further, see below. The tables carry the index's name: an index of the same name goes on where
another left off, as long as the session's catalog knows the tables.

Tied suffixes. The windows of one place form an interval; an interval whose whole text (hull)
occurs twice is repeated throughout, and one suffix stands for all of that hull. The suffixes
left in a tie are put in the order of the letters that follow their prefix, and a scan takes
the length of every suffix's match with its neighbours, the longest that it has with any; a
second scan does the same with the letters before it, read backwards. A window that reaches
beyond either match occurs once, so each interval shrinks to the windows within both, most of
them to none. The order runs over ranges of (prefix, letters, row), so a tie of any size is
spread over tasks; the first and last suffix of a range, whose neighbours lie in other ranges,
keep their intervals.

Verification covers every unit by 64-bit hashes of strings, and pairs are never listed. The two
matches of a suffix may be with different others, so intervals are cut into pieces of some
windows and the texts of pieces are counted: a piece whose hull occurs twice is repeated
throughout, one of which the units that all its windows share (core) occur once cannot match,
and what is then left is judged window by window. All of this is counting by hash.

Null or short texts (below the window) lose nothing. Texts of any length are worked on in
segments. Repeated rows are occurrences of their own and so repeat each other. Rows with
equal doc_id are kept apart by their text. Empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import delete, materialise, shared_dir, sieve, small_batches, table, text_slices
from loomseq.llm.shingles import _powers, mix

WINDOW, GRAM = 400, 64
#: Words of the shortest passage that op9's further columns are about.
PASSAGE = 48
BATCHES = 4
#: Bytes of text that a task works on at a time; a longer text is cut into segments.
SLICE, SEGMENT = 1 << 18, 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Hasher:
    """64-bit hashes of any ranges of a string of units."""

    def __init__(self, units: np.ndarray):
        n = len(units)
        self.up, self.down = _powers(1 << max(19, (n + 1).bit_length()))
        values = _letters()[units] if units.dtype == np.uint8 else units
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:n], out=self.total[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(np.uint64))


def gram_hashes(h: Hasher, n: int, gram: int) -> np.ndarray:
    count = n - gram + 1
    return mix((h.total[gram:] - h.total[:count]) * h.down[:count])


def places(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, Hasher]:
    """The place of the window that starts at each unit, for one string of units."""
    h = Hasher(units)
    g = gram_hashes(h, len(units), gram)
    width = window - gram + 1
    packed = (g & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(g), dtype=np.uint64)
    pad = -len(packed) % width
    blocks = np.concatenate([packed, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(units) - window + 1
    least = np.minimum(after[:n], before[width - 1 : width - 1 + n])
    return (least & np.uint64(0xFFFFFF)).astype(np.int64), h


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first byte, byte after) of the words of UTF-8 bytes, SEGMENT bytes at a time."""
    out = []
    at, n = 0, len(data)
    while at < n:
        stop = min(n, at + SEGMENT)
        if stop < n:
            gaps = np.flatnonzero(_blank(data[at:stop]))
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:
                gaps = np.flatnonzero(_blank(data[stop:]))
                stop = stop + int(gaps[0]) + 1 if len(gaps) else n
        part = data[at:stop]
        word = np.concatenate([[False], ~_blank(part), [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        first, last = edge[::2], edge[1::2]
        out.append((Hasher(part)(first, last), first + at, last + at))
        at = stop
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def units_of(texts: pa.Array, words: bool):
    """(units, first byte, byte after) of each text; bytes need no edges."""
    raw = [t.as_py() if t.is_valid else b"" for t in texts.cast(pa.large_binary())]
    if not words:
        for data in raw:
            yield np.frombuffer(data, dtype=np.uint8), None, None
        return
    begin = np.cumsum([0, *(len(d) + 1 for d in raw)])
    codes, first, last = words_of(np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8))
    edge = np.searchsorted(first, begin)
    for i in range(len(raw)):
        lo, hi = edge[i], edge[i + 1]
        yield codes[lo:hi], first[lo:hi] - begin[i], last[lo:hi] - begin[i]


def _segments(piece: pa.RecordBatch, window: int, words: bool):
    """Texts of a slice in strings of SEGMENT units at most plus an overlap of window - 1:
    lists of (row, offset in its text, units)."""
    held, size = [], 0
    for row, (units, _, _) in enumerate(units_of(piece.column("text"), words)):
        for at in range(0, max(1, len(units) - window + 1), SEGMENT):
            part = units[at : at + SEGMENT + window - 1]
            if len(part) < window:
                continue
            if held and size + len(part) > SEGMENT + window:
                yield held
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield held


def _prefixes(units: np.ndarray, at: np.ndarray, gram: int) -> pa.Array:
    """The gram units from each of at as they stand (words by a quarter of their code, which is
    enough for what is verified later), as binary."""
    rows = units[at[:, None] + np.arange(gram)]
    rows = np.ascontiguousarray(rows if rows.dtype == np.uint8 else (rows >> np.uint64(48)).astype(">u2").view(np.uint8))
    width = rows.shape[1]
    offsets = np.arange(0, len(at) * width + 1, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _suffixes(window: int, gram: int, words: bool):
    """The sampled suffixes of texts, each with the interval of window starts whose place it
    is: start, length and place of the interval are one number, as rows are shuffled."""
    names = ["prefix", "hull", "rid", "packed"]

    def run(batches):
        for piece in text_slices(batches, SLICE):
            rids = piece.column("rid").to_numpy()
            for held in _segments(piece, window, words):
                units = np.concatenate([p for _, _, p in held])
                sizes = np.array([len(p) for _, _, p in held], dtype=np.int64)
                begin = np.cumsum(sizes) - sizes
                place, h = places(units, window, gram)
                valid = np.zeros(len(place), dtype=np.int64)
                valid[begin] += 1
                stop = begin + sizes - window + 1
                np.add.at(valid, stop[stop < len(place)], -1)
                starts = np.flatnonzero(np.cumsum(valid) > 0)
                place = place[starts]
                owner = np.searchsorted(begin, starts, side="right") - 1
                first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
                lo, hi = starts[first], starts[np.append(first[1:], len(starts)) - 1]
                at, owner = place[first], owner[first]
                hull = mix(h(lo, hi + window) + (at - lo).astype(np.uint64))
                shift = np.array([o for _, o, _ in held], dtype=np.int64)[owner] - begin[owner]
                rid = rids[np.array([r for r, _, _ in held])[owner]]
                packed = ((lo + shift) << 20) | ((hi - lo) << 10) | (at - lo)
                columns = [_prefixes(units, at, gram), pa.array(hull.view(np.int64)), pa.array(rid), pa.array(packed)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


class RepeatIndex:
    """The family: levels of suffix arrays whose sizes are numbers of batches; equal sizes
    merge. add() takes a batch, spans() tells what repeats among all texts so far."""

    def __init__(self, spark: SparkSession, window: int = WINDOW, gram: int = GRAM, words: bool = False, name: str | None = None):
        if not 0 < gram <= window or window - gram >= 1 << 10:
            raise ValueError(f"a window must be 0 to {(1 << 10) - 1} units longer than its gram: {window}, {gram}")
        self.spark, self.window, self.gram, self.words = spark, window, gram, words
        self.name = name or f"loomseq_index_{uuid.uuid4().hex}"
        self.piece = max(2, (window - gram) // 9)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        known = sorted(t.name for t in spark.catalog.listTables(pattern=f"{self.name}_*"))
        self.entries = [t for t in known if "_suffixes_" in t]
        self.found = [t for t in known if "_found_" in t]
        levels = [(int(t.split("_")[-2]), t) for t in known if "_level_" in t]
        self.levels = sorted(levels, reverse=True)
        if self.levels:
            self.buckets = int(spark.sql(f"DESCRIBE EXTENDED {self.levels[0][1]}").where("col_name = 'Num Buckets'").first().data_type)

    def _save(self, frame: DataFrame, kind: str, key: str | None = None, sort: str | None = None, split: str | None = None) -> str:
        name = f"{self.name}_{kind}_{uuid.uuid4().hex}"
        out = frame.write.format("parquet").option("path", f"{shared_dir(self.spark)}/{name}")
        out = out.partitionBy(split) if split else out
        out = out.bucketBy(self.buckets, key) if key else out
        out = out.sortBy(sort) if sort else out
        with small_batches(self.spark):
            out.saveAsTable(name)
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, f"{shared_dir(self.spark)}/{name}")

    def _sampled(self, docs: DataFrame) -> DataFrame:
        kind = "prefix binary, hull long, rid long, packed long"
        return docs.select("rid", "text").mapInArrow(_suffixes(self.window, self.gram, self.words), kind)

    def add(self, docs: DataFrame, batches: int = 1, last: bool = False) -> None:
        """Index docs (rid, text), in so many batches one after the other. The array of the
        very last batch is merge-scanned, but merged with no level."""
        batch = F.pmod("rid", F.lit(batches)).cast("int")
        name = self._save(self._sampled(docs).withColumn("batch", batch), "suffixes", split="batch")
        self.entries.append(name)
        for b in range(batches):
            self._admit(self.spark.table(name).where(F.col("batch") == b), last and b == batches - 1)

    def _admit(self, suffixes: DataFrame, last: bool = False) -> None:
        array = suffixes.groupBy("prefix").agg(F.count("*").alias("n"))
        name = self._save(array, "level_1", key="prefix", sort="prefix")
        new = self.spark.table(name)
        met = new.where("n > 1").select("prefix")
        for _, level in self.levels:
            met = met.unionAll(new.join(self.spark.table(level), "prefix").select("prefix"))
        self.found.append(self._save(met.select(F.xxhash64("prefix").alias("print")), "found"))
        self.levels.append((1, name))
        while not last and len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, young), (_, old) = self.levels.pop(), self.levels.pop()
            a, b = self.spark.table(old), self.spark.table(young).select("prefix", F.col("n").alias("m"))
            both = a.join(b, "prefix", "full").select("prefix", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
            name = self._save(both, f"level_{2 * size}", key="prefix", sort="prefix")
            self._drop(young, old)
            self.levels.append((2 * size, name))

    def _union(self, names: list[str], *columns: Column | str) -> DataFrame:
        return functools.reduce(DataFrame.unionAll, [self.spark.table(n).select(*columns) for n in names])

    def spans(self, docs: DataFrame, last: bool = False) -> tuple[DataFrame, DataFrame]:
        """docs (rid, text), all that were added -> (rid, text) of those that share sampled
        suffixes with others, and spans (rid, lo, stop) of repeated units, which may
        overlap. Both hold until close(). If nothing follows (last), the index itself is
        dropped as soon as its shared suffixes are known."""
        spark, window = self.spark, self.window
        keys = spark.table(self._save(self._union(self.found, "print").distinct(), "keys"))
        lo = F.shiftright("packed", 20)
        hi, at = lo + F.shiftright("packed", 10).bitwiseAND(F.lit(1023)), lo + F.col("packed").bitwiseAND(F.lit(1023))
        shared = self._union(self.entries, F.xxhash64("prefix").alias("print"), "hull", "rid", "packed").join(keys, "print")
        shared = shared.select(F.col("print").alias("core"), "hull", "rid", lo.alias("lo"), hi.alias("hi"), at.alias("at"))
        shared = self._save(shared, "shared")
        if last:
            self._drop(*self.entries, *self.found, *(name for _, name in self.levels))
            self.entries, self.found, self.levels = [], [], []

        whole, left = self._judge(shared)
        rids = spark.table(self._save(whole.select("rid").unionAll(left.select("rid")).distinct(), "rids"))
        likely, _ = sieve(spark, docs, rids, "rid")
        hit = likely.join(rids, "rid", "left_semi").dropDuplicates(["rid"])
        texts = spark.table(self._save(hit.select("rid", "text"), "texts", key="rid"))

        left = self._order(_with_text(texts, left, ["core", "lo", "hi", "at"]))
        kind = "core long, hull long, rid long, lo long, hi long, at long"
        pieces = _with_text(texts, left, ["core", "lo", "hi", "at"]).mapInArrow(_pieces(window, self.piece, self.words), kind)
        partly, rest = self._judge(self._save(pieces, "pieces"))
        single = _with_text(texts, rest, ["core", "lo", "hi", "at", "open"]).mapInArrow(_windows(window, self.words), "w long, rid long, lo long, open boolean")
        single = spark.table(self._save(single, "windows"))
        again = spark.table(self._save(single.groupBy("w").count().where("count > 1").select("w"), "again"))
        last = single.where("open").join(again, "w").select("rid", "lo", F.col("lo").alias("hi"))
        spans = whole.unionAll(partly).unionAll(last).select("rid", "lo", (F.col("hi") + window).alias("stop"))
        return texts, spans

    def _order(self, tied: DataFrame) -> DataFrame:
        """Tied suffixes (text, and places: core, lo, hi, at) in order, by the letters after and
        then by those before them: (core, rid, lo, hi, at) of intervals within both matches."""
        kind = "core long, rid long, lo long, hi long, at long"
        name = self._save(tied.mapInArrow(_contexts(self.window, self.gram, self.words), f"{kind}, after binary, before binary"), "tied")
        for letters, rest in (("after", ", before binary"), ("before", "")):
            order = self.spark.table(name).repartitionByRange("core", letters, "rid", "lo").sortWithinPartitions("core", letters, "rid", "lo")
            scanned = order.mapInArrow(_match_lengths(letters, self.window, self.gram, 2 if self.words else 1), kind + rest)
            found = self._save(scanned.where("lo <= hi"), "matched")
            self._drop(name)
            name = found
        return self.spark.table(name)

    def _judge(self, name: str) -> tuple[DataFrame, DataFrame]:
        """Of the table's rows (core, hull, rid, lo, hi, at) those whose hull occurs more than
        once; and one row of each hull of a core with several hulls, open where that hull
        occurs once. Both are written; the table and what was needed between are dropped."""
        rows = self.spark.table(name)
        first = F.min(F.struct("rid", "lo", "hi", "at")).alias("one")
        hulls = self._save(rows.groupBy("core", "hull").agg(F.count("*").alias("n"), first), "hulls")
        counts = self.spark.table(hulls)
        whole = self._save(rows.join(counts.where("n > 1").select("core", "hull"), ["core", "hull"]).select("rid", "lo", "hi"), "whole")
        self._drop(name)
        many = counts.groupBy("core").agg(F.min("hull").alias("a"), F.max("hull").alias("b"), F.min("n").alias("least")).where("a <> b and least = 1")
        left = self._save(counts.join(many.select("core"), "core").select("core", "one.*", (F.col("n") == 1).alias("open")), "left")
        self._drop(hulls)
        return self.spark.table(whole), self.spark.table(left)

    def tidy(self) -> None:
        """Drop what spans() made; the index itself stays."""
        keep = {*self.entries, *self.found, *(name for _, name in self.levels)}
        self._drop(*(t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}_*") if t.name not in keep))

    def close(self) -> None:
        """Drop every table of the index."""
        self.entries, self.found, self.levels = [], [], []
        self.tidy()


def _with_text(texts: DataFrame, places_: DataFrame, columns: list[str]) -> DataFrame:
    lists = places_.groupBy("rid").agg(F.collect_list(F.struct(*columns)).alias("places"))
    return texts.join(lists, "rid")


def _each_list(batches, words: bool):
    """(rid, units, columns of the list of places) of every row."""
    for piece in text_slices(batches, SLICE):
        lists = piece.column("places")
        found = units_of(piece.column("text"), words)
        for i, (rid, (units, _, _)) in enumerate(zip(piece.column("rid").to_pylist(), found, strict=True)):
            yield rid, units, lists[i].values


def _strings(units: np.ndarray, first: np.ndarray, count: np.ndarray, step: int) -> pa.Array:
    """count units from each of first, onwards or (step -1) backwards, as binary; words as in
    _prefixes."""
    edge = np.concatenate([[0], np.cumsum(count)])
    along = np.arange(edge[-1]) - np.repeat(edge[:-1], count)
    data = units[np.repeat(first, count) + step * along]
    size = 1
    if units.dtype != np.uint8:
        data, size = (data >> np.uint64(48)).astype(">u2"), 2
    offsets = (edge * size).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _contexts(window: int, gram: int, words: bool, most: int = 1 << 14):
    """The units that the windows of each place cover after its prefix, and before the place,
    nearest first; at most so many places in a batch."""
    names = ["core", "rid", "lo", "hi", "at", "after", "before"]

    def run(batches):
        for rid, units, s in _each_list(batches, words):
            fields = [s.field(c).to_numpy() for c in ("core", "lo", "hi", "at")]
            for k in range(0, len(s), most):
                core, lo, hi, at = (c[k : k + most] for c in fields)
                after = _strings(units, at + gram, hi + window - at - gram, 1)
                before = _strings(units, at - 1, at - lo, -1)
                columns = [pa.array(c, pa.int64()) for c in (core, np.full(len(lo), rid), lo, hi, at)]
                yield pa.RecordBatch.from_arrays([*columns, after, before], names=names)

    return run


def common_lengths(strings: pa.Array) -> np.ndarray:
    """Bytes that each binary string and the next have in common at their beginning."""
    edge = np.frombuffer(strings.buffers()[1], dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)
    size = np.diff(edge)
    width = int(size.max(initial=0))
    column = np.arange(edge[-1] - edge[0]) - np.repeat(edge[:-1] - edge[0], size)
    table_ = np.zeros((len(size), width + 1), dtype=np.uint8)
    table_[np.repeat(np.arange(len(size)), size), column] = data[edge[0] : edge[-1]]
    other = table_[1:] != table_[:-1]
    other[:, width] = True
    return np.minimum(other.argmax(axis=1), np.minimum(size[1:], size[:-1]))


def _match_lengths(letters: str, window: int, gram: int, size: int):
    """The scan over one range of suffixes in order: intervals shrunk to the windows within the
    longer of a suffix's matches with its two neighbours. The range's first and last rows are
    left as they are. One row is held between batches."""

    def shrunk(rows: pa.RecordBatch, match: np.ndarray) -> pa.RecordBatch:
        lo, hi, at = (rows.column(c).to_numpy() for c in ("lo", "hi", "at"))
        if letters == "after":
            hi = np.minimum(hi, at + gram + match - window)
        else:
            lo = np.maximum(lo, at - match)
        new = {"lo": pa.array(lo), "hi": pa.array(hi)}
        names = [n for n in rows.schema.names if n != letters]
        return pa.RecordBatch.from_arrays([new.get(n, rows.column(n)) for n in names], names=names)

    def run(batches):
        held, match = None, window
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            core = rows.column("core").to_numpy()
            # Suffixes of different prefixes have no match at all.
            following = np.where(core[1:] == core[:-1], common_lengths(rows.column(letters)) // size, -2 * window)
            before = np.concatenate([[match], following])
            yield shrunk(rows.slice(0, len(core) - 1), np.maximum(before[:-1], following))
            held, match = rows.slice(len(core) - 1), int(before[-1])
        if held is not None:
            yield shrunk(held, np.array([window]))

    return run


def _pieces(window: int, width: int, words: bool):
    """Cut intervals of window starts into pieces at multiples of width of the offset of
    the place; pieces of one place and offset are comparable."""

    def run(batches):
        for rid, units, s in _each_list(batches, words):
            lo, hi, at, key = (s.field(c).to_numpy() for c in ("lo", "hi", "at", "core"))
            h = Hasher(units)
            cell_hi, cell_lo = (at - lo) // width, (at - hi) // width
            count = cell_hi - cell_lo + 1
            entry = np.repeat(np.arange(len(lo)), count)
            cell = cell_lo[entry] + (np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count))
            a = at[entry]
            start = np.maximum(lo[entry], a - cell * width - width + 1)
            stop = np.minimum(hi[entry], a - cell * width)
            core = h(a - cell * width, a - cell * width - width + 1 + window)
            core = mix(core + mix(key[entry].view(np.uint64) + cell.astype(np.uint64)))
            hull = mix(h(start, stop + window) + (a - start).astype(np.uint64))
            columns = [core.view(np.int64), hull.view(np.int64), np.full(len(entry), rid), start, stop, a]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["core", "hull", "rid", "lo", "hi", "at"])

    return run


def _windows(window: int, words: bool):
    def run(batches):
        for rid, units, s in _each_list(batches, words):
            lo, hi, core = (s.field(c).to_numpy() for c in ("lo", "hi", "core"))
            open_ = s.field("open").to_numpy(zero_copy_only=False)
            at = s.field("at").to_numpy()
            h = Hasher(units)
            count = hi - lo + 1
            entry = np.repeat(np.arange(len(lo)), count)
            start = lo[entry] + (np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count))
            w = mix(h(start, start + window) + mix(core[entry].view(np.uint64) + (at[entry] - start).astype(np.uint64)))
            columns = [pa.array(w.view(np.int64)), pa.array(np.full(len(w), rid)), pa.array(start), pa.array(open_[entry])]
            yield pa.RecordBatch.from_arrays(columns, names=["w", "rid", "lo", "open"])

    return run


def merge_spans(lo: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [lo, stop)."""
    order = np.argsort(lo, kind="stable")
    lo, stop = lo[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], lo[1:] > stop[:-1]])
    first = np.flatnonzero(new)
    return lo[first], stop[np.append(first[1:], len(lo)) - 1]


def _cut(words: bool):
    def run(batches):
        for piece in text_slices(batches, SLICE):
            out = []
            spans = piece.column("places")
            found = zip(piece.column("rid").to_pylist(), piece.column("text").to_pylist(), units_of(piece.column("text"), words), strict=True)
            for i, (rid, text, (_, first, last)) in enumerate(found):
                data = (text or "").encode()
                s = spans[i].values
                lo, stop = merge_spans(s.field("lo").to_numpy(), s.field("stop").to_numpy())
                if words:
                    lo, stop = first[lo], last[stop - 1]
                edges = [0, *np.stack([lo, stop], 1).ravel().tolist(), len(data)]
                kept = b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                out.append((rid, int((stop - lo).sum()), len(lo), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=CUT)

    return run


CUT = ["rid", "n_removed", "n_spans", "kept_sha256", "kept_text"]


def cut_texts(index: RepeatIndex, docs: DataFrame, columns: list[str] = CUT, last: bool = False) -> DataFrame:
    """For each rid of docs (rid, text) that loses bytes, the columns of CUT, written to the
    shared folder. kept_text drops the rest of a character that was cut."""
    texts, spans = index.spans(docs, last)
    kind = "rid long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    cut = _with_text(texts, spans, ["lo", "stop"]).mapInArrow(_cut(index.words), kind)
    return materialise(index.spark, cut.select(*columns), "cut")


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, words: bool = False, batches: int = BATCHES, columns: list[str] = CUT) -> DataFrame:
    """cut_texts of docs (rid, text) by an index of their own, dropped at the end."""
    index = RepeatIndex(spark, window, gram, words)
    try:
        index.add(docs, batches, last=True)
        return cut_texts(index, docs, columns, last=True)
    finally:
        index.close()


def with_row_ids(docs: DataFrame) -> DataFrame:
    return docs.withColumn("rid", F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, by strings of WINDOW bytes; then, by an index of words, the number
    of runs (n_passages) and bytes (passage_bytes) of passages of PASSAGE words or more that
    occur again, and the text without them. kept_sha256 is of the former, not of this text."""
    docs = with_row_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.select("rid", "text")
    cut = remove_repeats(spark, rows, columns=CUT[:-1])
    passages = remove_repeats(spark, rows, PASSAGE, PASSAGE // 6, words=True, batches=1, columns=["rid", "n_spans", "n_removed", "kept_text"])
    passages = passages.withColumnsRenamed({"n_spans": "n_passages", "n_removed": "passage_bytes"})
    cuts = materialise(spark, cut.join(passages, "rid", "full"), "cuts")
    likely, rest = sieve(spark, docs, cuts.select("rid"), "rid")
    same = rest.select("*", *(F.lit(None).cast(t).alias(c) for c, t in cuts.dtypes if c != "rid"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    counts = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans", "n_passages", "passage_bytes")}
    return likely.join(cuts, "rid", "left").unionByName(same).select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        counts["n_removed"],
        counts["n_spans"],
        F.coalesce("kept_sha256", F.sha2(text, 256)).alias("kept_sha256"),
        counts["n_passages"],
        counts["passage_bytes"],
        F.coalesce("kept_text", "text").alias("text"),
    )
