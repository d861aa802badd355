"""Counts of a text's character n-grams by bucket, made row by row with arrays.

The bucket of an n-gram is the one that HashingTF gives to its letters joined by spaces (the
terms of NGram): murmur3 of the UTF-8 text with seed 42, modulo the buckets.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loomseq.functions.packed import _codes

#: Longest n-grams of the letters A-Z whose buckets are looked up in a table of all of them.
TABLED = 4
#: Rows whose vectors go to Spark at once; one holds at most as many places as there are buckets.
ROWS = 256


def _scrambled(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(0xCC9E2D51)
    return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)


def _word(columns: np.ndarray) -> np.ndarray:
    """The little-endian numbers that up to four columns of bytes make."""
    return sum(c << np.uint32(8 * i) for i, c in enumerate(columns))


def murmur3(columns: np.ndarray, seed: int = 42) -> np.ndarray:
    """32-bit hashes of texts of equal length, given as their columns of bytes."""
    columns, u = columns.astype(np.uint32), np.uint32
    size, whole = len(columns), len(columns) // 4 * 4
    h = np.full(columns.shape[1], seed, u)
    for at in range(0, whole, 4):
        h ^= _scrambled(_word(columns[at : at + 4]))
        h = (h << u(13) | h >> u(19)) * u(5) + u(0xE6546B64)
    if whole < size:
        h ^= _scrambled(_word(columns[whole:]))
    h ^= u(size)
    h = (h ^ h >> u(16)) * u(0x85EBCA6B)
    h = (h ^ h >> u(13)) * u(0xC2B2AE35)
    return h ^ h >> u(16)


def _buckets(columns: np.ndarray, buckets: int) -> np.ndarray:
    return murmur3(columns).view(np.int32).astype(np.int64) % buckets


@lru_cache(maxsize=16)
def _table(n: int, buckets: int) -> np.ndarray:
    """The bucket of every n-gram of the letters A-Z, by its number (see packed.window_code)."""
    codes = np.arange(26**n)
    columns = np.full((2 * n - 1, len(codes)), ord(" "))
    for j in range(n):
        columns[2 * j] = codes // 26 ** (n - 1 - j) % 26 + ord("A")
    return _buckets(columns, buckets)


def gram_buckets(text: str, n: int, buckets: int) -> np.ndarray:
    """The bucket of each n-gram of a text, in no particular order."""
    if n <= TABLED and text.isascii():
        letters = np.frombuffer(text.encode(), np.uint8) - np.uint8(ord("A"))
        if not len(letters) or letters.max() < 26:
            return _table(n, buckets)[_codes(letters, n)]
    by_size = defaultdict(list)
    for i in range(len(text) - n + 1):
        term = " ".join(text[i : i + n]).encode()
        by_size[len(term)].append(term)
    found = [_buckets(np.frombuffer(b"".join(terms), np.uint8).reshape(-1, size).T, buckets) for size, terms in by_size.items()]
    return np.concatenate([np.zeros(0, np.int64), *found])


def _counts(text: str, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    times = np.bincount(np.concatenate([gram_buckets(text, n, buckets) for n in range(1, most + 1)]), minlength=1)
    found = np.flatnonzero(times)
    return found, times[found]


def _vectors(rows: list[tuple[np.ndarray, np.ndarray]], size: int) -> pa.StructArray:
    """Sparse vectors of places and values, as Arrow holds Spark's vectors."""
    ends = pa.array(np.cumsum([0, *[len(found) for found, _ in rows]]), pa.int32())
    places = pa.array(np.concatenate([found for found, _ in rows]), pa.int32())
    values = pa.array(np.concatenate([times for _, times in rows]).astype(np.float64))
    kind, sizes = np.zeros(len(rows), np.int8), np.full(len(rows), size, np.int32)
    fields = [pa.array(kind), pa.array(sizes), pa.ListArray.from_arrays(ends, places), pa.ListArray.from_arrays(ends, values)]
    return pa.StructArray.from_arrays(fields, names=["type", "size", "indices", "values"])


class GramCounts(Transformer):
    """Adds the counts of the n-grams of 1 to most letters by bucket, as HashingTF counts them,
    without making a text of each n-gram."""

    def __init__(self, sequence: str, most: int, buckets: int, out: str):
        super().__init__()
        self.sequence, self.most, self.buckets, self.out = sequence, most, buckets, out

    def _transform(self, df: DataFrame) -> DataFrame:
        most, buckets = self.most, self.buckets
        text = df.select(*[f"`{c}`" for c in df.columns], F.coalesce(self.sequence, F.lit("")).alias("__text"))
        schema = StructType([*df.schema.fields, StructField(self.out, VectorUDT(), False)])

        def count(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    times = [_counts(t, most, buckets) for t in part.column(part.num_columns - 1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], _vectors(times, buckets)], names=schema.names)

        return text.mapInArrow(count, schema)
