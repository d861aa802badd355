"""Maps of windows: how many rows hold a window, and the values of these rows' groups.

Windows are moved as numbers (see packed.py), sorted and compressed: a few million windows of a
task are sorted together, bucket by bucket, and every bucket's share becomes one row of bytes. A bucket is merged in one task; there are as many as the text needs.
"""

from __future__ import annotations

import itertools
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomseq.functions.packed import MOST, ROWS, _codes, _parts, _text

#: Letters that are cut into windows at once; windows that are held until they are sorted
#: together; bytes of text for which there is a bucket, and the most buckets.
LETTERS, HELD, BUCKET, BUCKETS = 1 << 20, 1 << 24, 1 << 22, 1 << 16
#: First letters of a window that decide its bucket, and a factor that has no divisor in common
#: with 26: first letters that are neighbours in the alphabet's order come to lie far apart.
FIRST, FACTOR = 6, 190921051


def buckets_for(size: int | None) -> int:
    """Number of buckets for so many bytes of text."""
    return min(max(-(-(size or 0) // BUCKET), 1), BUCKETS)


def _dealt(codes: np.ndarray, k: int, back: bool = False) -> np.ndarray:
    """Numbers of windows with their first letters multiplied, so that equal parts of the range
    hold about as many windows of any text; back: the windows' numbers again."""
    kinds, rest = 26 ** min(k, FIRST), 26 ** max(k - FIRST, 0)
    first = codes // rest
    return first * (pow(FACTOR, -1, kinds) if back else FACTOR % kinds) % kinds * rest + (codes - first * rest)


def _begin(bucket: int, k: int, buckets: int) -> int:
    """The least number (see _dealt) of a bucket."""
    return -(-bucket * 26 ** min(k, FIRST) // buckets) * 26 ** max(k - FIRST, 0)


def _runs(width: int) -> list[tuple[int, int]]:
    """Which bytes of numbers of so many bytes are compressed together: the lowest, the second
    and all others."""
    return [(j, min(to, width)) for j, to in ((0, 1), (1, 2), (2, 8)) if j < width]


def _pack(numbers: list[np.ndarray], names: list) -> bytes:
    """Arrays of whole numbers from 0 on, and names, compressed."""
    codec = pa.Codec("zstd", compression_level=1)
    named = json.dumps(names).encode()
    packed = codec.compress(named, asbytes=True)
    out = [struct.pack("<III", len(numbers), len(named), len(packed)), packed]
    for a in numbers:
        width = max((int(a.max()).bit_length() + 7) // 8, 1)
        planes = np.ascontiguousarray(a, "<i8").view(np.uint8).reshape(-1, 8).T
        out.append(struct.pack("<II", len(a), width))
        for j, to in _runs(width):
            packed = codec.compress(planes[j:to].tobytes(), asbytes=True)
            out += [struct.pack("<I", len(packed)), packed]
    return b"".join(out)


def _unpack(data: bytes) -> tuple[list[np.ndarray], list]:
    codec, numbers = pa.Codec("zstd"), []
    n, size, packed = struct.unpack_from("<III", data)
    names, at = json.loads(codec.decompress(data[12 : 12 + packed], size, asbytes=True)), 12 + packed
    for _ in range(n):
        length, width = struct.unpack_from("<II", data, at)
        at += 8
        total = np.zeros((length, 8), np.uint8)
        for j, to in _runs(width):
            (packed,) = struct.unpack_from("<I", data, at)
            run = codec.decompress(data[at + 4 : at + 4 + packed], length * (to - j), asbytes=True)
            total[:, j:to] = np.frombuffer(run, np.uint8).reshape(to - j, length).T
            at += 4 + packed
        numbers.append(total.view("<i8").ravel())
    return numbers, names


def _heads(a: np.ndarray) -> np.ndarray:
    """Places of a sorted array whose number differs from the one before."""
    return np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)


def _shares(keys: np.ndarray, k: int, buckets: int, names: list) -> Iterator[tuple[int, bytes]]:
    """keys: number (see _dealt) << 20 | group of each row's distinct windows, sorted. By bucket:
    steps between its windows, how many groups each has, these groups, and in how many rows."""
    begins = [_begin(i, k, buckets) for i in range(buckets + 1)]
    places = np.searchsorted(keys, np.array(begins[:-1]) << 20).tolist() + [len(keys)]
    for bucket, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True)):
        if a == b:
            continue
        heads = _heads(keys[a:b])
        code, group = keys[a:b][heads] >> 20, keys[a:b][heads] & (ROWS - 1)
        first = _heads(code)
        used = np.flatnonzero(np.bincount(group))
        steps = np.diff(code[first], prepend=begins[bucket])
        yield bucket, _pack([steps, np.diff(np.append(first, len(code))) - 1, np.searchsorted(used, group), np.diff(np.append(heads, b - a)) - 1], [names[i] for i in used])


def window_shares(df: DataFrame, sequence: str, k: int, groups: list[str], buckets: int) -> DataFrame:
    """bucket, share: the windows of df that window_map merges. A row is counted whole where it
    is, and HELD windows at a time become at most one row of each bucket."""
    if k > MOST:
        raise ValueError(f"windows of more than {MOST} letters have no number")
    rows = df.select(*groups, F.coalesce(sequence, F.lit("")).cast("binary").alias("__seq"))

    def share(batches):
        held, n, names = np.empty(HELD, np.int64), 0, {}

        def out(keys):
            keys.sort()
            found = _shares(keys, k, buckets, list(names))
            while some := list(itertools.islice(found, 256)):
                bucket, data = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "share"])

        for part, letters, lengths in _parts(batches, LETTERS):
            row = np.repeat(np.arange(len(lengths)), lengths)
            codes = _codes(letters, k)
            whole = np.flatnonzero((np.repeat(np.cumsum(lengths), lengths) - np.arange(len(letters)))[: len(codes)] >= k)
            keys = codes[whole] << 20 | row[whole]
            keys.sort()
            keys = keys[_heads(keys)]
            if n + len(keys) > HELD or len(names) + len(lengths) > ROWS:
                yield from out(held[:n])
                n, names = 0, {}
            group = np.array([names.setdefault(x, len(names)) for x in zip(*[c.to_pylist() for c in part.columns[:-1]], strict=True)], np.int64)
            keys = _dealt(keys >> 20, k) << 20 | group[keys & (ROWS - 1)]
            if len(keys) > HELD:
                yield from out(keys)
            else:
                held[n : n + len(keys)] = keys
                n += len(keys)
        yield from out(held[:n])

    return rows.mapInArrow(share, "bucket int, share binary")


def window_map(df: DataFrame, sequence: str, k: int, groups: list[str], buckets: int, sep: str = ";") -> DataFrame:
    """peptide, n_rows (rows of df that hold the window) and, named as the columns of groups
    (texts), the distinct values of these rows in order, joined by sep, without nulls. buckets:
    see buckets_for. Sequences hold the letters A-Z alone."""
    schema = StructType([StructField("peptide", StringType(), False), StructField("n_rows", LongType(), False), *[StructField(g, StringType(), False) for g in groups]])

    def merge(table: pa.Table) -> pa.Table:
        begin = _begin(table.column("bucket")[0].as_py(), k, buckets)
        ids: list[dict] = [{} for _ in groups]
        codes, counts, values = [], [], [[] for _ in groups]
        for data in table.column("share"):
            (steps, more, place, n), names = _unpack(data.as_py())
            codes.append(np.repeat(np.cumsum(steps) + begin, more + 1))
            counts.append(n + 1)
            for i, known in enumerate(ids):
                of = np.array([-1 if x[i] is None else known.setdefault(x[i], len(known)) for x in names])
                values[i].append(of[place])
        code = np.concatenate(codes)
        kinds = np.sort(code)
        kinds = kinds[_heads(kinds)]
        at = np.searchsorted(kinds, code)
        n_rows = np.bincount(at, np.concatenate(counts), len(kinds)).astype(np.int64)
        ends = np.arange(len(kinds) + 1, dtype=np.int32) * k
        columns = [pa.StringArray.from_buffers(len(kinds), pa.py_buffer(ends), pa.py_buffer(_text(_dealt(kinds, k, back=True), k).tobytes())), pa.array(n_rows)]
        for known, found in zip(ids, values, strict=True):
            of, ordered = np.concatenate(found), sorted(known)
            rank = np.argsort(np.array([known[x] for x in ordered], np.int64))
            pair = at[of >= 0] << 32 | rank[of[of >= 0]]
            pair.sort()
            pair = pair[_heads(pair)]
            offsets = np.append(0, np.cumsum(np.bincount(pair >> 32, minlength=len(kinds)))).astype(np.int32)
            columns.append(pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(ordered, pa.string()).take(pa.array(pair & 0xFFFFFFFF))), sep))
        return pa.Table.from_arrays(columns, names=schema.names)

    return window_shares(df, sequence, k, groups, buckets).groupBy("bucket").applyInArrow(merge, schema)
