"""Word shingles of whole texts as 64-bit hashes, for many texts at a time."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.ones(n + 1, dtype=np.uint64), np.ones(n + 1, dtype=np.uint64)
    up[1:], down[1:] = _BASE, inverse
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) with a blank after each, and the n + 1
    starts."""
    joined = [(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts.cast(pa.large_string())]
    sizes = np.array([len(t) + 1 for t in joined], dtype=np.int64)
    return np.frombuffer(b" ".join([*joined, b""]), dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, docs, starts): the distinct shingles of each text, sorted by text and hash;
    docs are the texts that have any, starts their first index in hashes. Words are
    [^\\x20\\x09-\\x0D]+ after lower-casing A-Z; a text of fewer words than width has its whole
    sequence as one shingle; a text without words has none."""
    data, begin = raw_bytes(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    first, last = edge[::2], edge[1::2]  # data ends with a blank
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _powers(1 << max(20, (n + 1).bit_length()))
    lower = data.astype(np.uint64)
    lower[(data >= 65) & (data <= 90)] += np.uint64(32)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((lower + np.uint64(1)) * up[:n], out=total[1:])
    words = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    doc = np.searchsorted(begin, first, side="right") - 1
    count = np.bincount(doc, minlength=len(begin) - 1)
    runs = []
    owners = []
    if len(words) >= width:
        h = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            h = mix(h * np.uint64(31) + words[k : len(words) - width + 1 + k] + np.uint64(k + 1))
        inside = doc[: len(h)] == doc[width - 1 :]
        runs.append(h[inside])
        owners.append(doc[: len(h)][inside])
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        at = np.searchsorted(doc, few)
        h = count[few].astype(np.uint64) + np.uint64(0x51ED)
        for k in range(width - 1):
            has = count[few] > k
            h[has] = mix(h[has] * np.uint64(31) + words[at[has] + k])
        runs.append(h)
        owners.append(few)
    hashes, owner = np.concatenate(runs), np.concatenate(owners)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return hashes, owner[starts], starts


def set_list(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The shingle set of each text as a sorted array."""
    hashes, docs, starts = shingle_sets(texts, width)
    out = [np.zeros(0, np.uint64)] * len(texts)
    for d, part in zip(docs.tolist(), np.split(hashes, starts[1:]) if len(starts) else [], strict=True):
        out[d] = part
    return out
