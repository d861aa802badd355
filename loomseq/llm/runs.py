"""Maximal periodic runs of words, by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
of at least max(LEAST, 2 q) words that no neighbouring word extends keeping period q.

The words of a batch of documents, with a letter of its own between documents, are one
sequence. Recompression turns it into a run-length grammar: block compression replaces each
maximal block a^k of an equal letter by a letter of its own (k = 1 stays), pair compression
splits the alphabet in two by a hash of the letter and replaces each pair of a left and a
right letter; the two alternate until no letter of a level occurs twice. Both steps look at
neighbours alone, so equal stretches are parsed alike but for a letter at either end of a
level. Grammar.lce answers longest common extensions of many pairs of positions at once: it
climbs while the letters at both places are equal, moving at most one letter or block a level
to reach the next level's letters, and comes down to the first word that differs.

Candidates lie on a harmonic grid: a run of period q and length max(LEAST, 2 q) or more holds
a multiple g of step = max(q, LEAST - q) for which g and g + q both lie in it; so for every q
the pairs (g, g + q) with equal words are all that need an extension, n/q of them, n log n in
all. Extensions to the right (by the grammar) and to the left (by the grammar of the reversed
sequence) give the whole run. A run is found with its smallest period and with multiples of
it; the smallest is kept. Nothing is sampled or capped.

Texts of any length are read whole; memory grows with the longest text and SLICE_BYTES. Null,
empty and blank texts have no words and no runs, collapsed text "". Rows are independent:
ids may be of any type, null or repeated; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import table, text_slices

#: Words of the shortest run.
LEAST = 12
SLICE_BYTES = 1 << 19
WORD = r"[^\x20\x09-\x0D]+"
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _left(letters: np.ndarray, level: int) -> np.ndarray:
    """Half of the alphabet, another one at each level."""
    mixed = (letters.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 0


class Grammar:
    """Levels of the run-length grammar of a sequence of letters 0..n-1. levels[k] holds the
    letters of level k; above[k][i] is the place, at level k + 1, of the letter that i is part
    of; first[k][j] the place at level k of the first part of letter j of level k + 1."""

    def __init__(self, letters: np.ndarray):
        self.levels, self.above, self.first, self.blocks = [letters], [], [], []
        self.n = len(letters)
        while True:
            s = self.levels[-1]
            if len(s) < 2 or len(np.unique(s)) == len(s):
                break
            block = len(self.blocks) % 2 == 0
            if block:
                opens = np.concatenate([[True], s[1:] != s[:-1]])
            else:
                left = _left(s, len(self.blocks))
                paired = left[:-1] & ~left[1:]
                opens = np.ones(len(s), dtype=bool)
                opens[1:] = ~paired
            first = np.flatnonzero(opens)
            size = np.diff(np.append(first, len(s)))
            # A letter alone keeps its number; blocks and pairs get numbers after those in use.
            kind = s[first].copy()
            many = np.flatnonzero(size > 1)
            if len(many):
                second = size[many] if block else s[first[many] + 1]
                base = int(s.max()) + 1
                _, ids = np.unique(kind[many] * (int(second.max()) + 1) + second, return_inverse=True)
                kind[many] = base + ids
            self.above.append(np.cumsum(opens) - 1)
            self.first.append(first)
            self.blocks.append(block)
            self.levels.append(kind)

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from places a[i] and b[i] on; a[i] and b[i] differ."""
        i, j = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        top = np.zeros(len(a), dtype=np.int64)
        live = np.arange(len(a))
        for k in range(len(self.levels)):
            s = self.levels[k]
            end = len(s)
            top[live] = k
            live = live[np.maximum(i[live], j[live]) < end]
            live = live[s[i[live]] == s[j[live]]]
            if not len(live) or k == len(self.above):
                break
            x, y = i[live], j[live]
            above, first = self.above[k], self.first[k]
            ux, uy = above[x], above[y]
            inner = (first[ux] != x) | (first[uy] != y)
            if inner.any():
                # Inside a block or pair at one place at least: move to its end.
                bounds = np.append(first, end)
                rx, ry = bounds[ux + 1] - x, bounds[uy + 1] - y
                if not self.blocks[k]:
                    rx = ry = np.ones_like(rx)
                step = np.where(inner, np.minimum(rx, ry), 0)
                x, y = x + step, y + step
                i[live], j[live] = x, y
                ended = np.maximum(x, y) >= end
                ended |= inner & (rx != ry)
                ended[~ended] = (s[x[~ended]] != s[y[~ended]]) & inner[~ended]
                live = live[~ended]
                x, y = x[~ended], y[~ended]
            i[live], j[live] = above[x], above[y]
        # Down: all pairs that stopped at level k or above stand before a difference there.
        for k in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(top >= k)
            if not len(down):
                continue
            s, bounds = self.levels[k - 1], np.append(self.first[k - 1], len(self.levels[k - 1]))
            ux, uy = i[down], j[down]
            x, y = bounds[ux], bounds[uy]
            inside = np.maximum(x, y) < len(s)
            same = np.zeros(len(down), dtype=bool)
            same[inside] = s[x[inside]] == s[y[inside]]
            near = np.flatnonzero(same)
            # Blocks share the shorter one; different pairs share at most their first letter.
            step = np.minimum(bounds[ux[near] + 1] - x[near], bounds[uy[near] + 1] - y[near]) if self.blocks[k - 1] else 1
            x[near] += step
            y[near] += step
            i[down], j[down] = x, y
        return i - a


def runs_of(letters: np.ndarray, starts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of several documents: letters holds their words,
    longest document first, each followed by a letter that occurs nowhere else; starts holds
    the documents' places."""
    n = len(letters)
    size = np.diff(np.append(starts, n)) - 1
    doc = np.repeat(np.arange(len(starts)), size + 1)
    at, gap = [], []
    q = 1
    while len(size) and size[0] >= max(least, 2 * q):
        # Only the documents long enough for a run of this period; they come first.
        count = int(np.searchsorted(-size, -max(least, 2 * q), side="right"))
        stop = int(starts[count]) if count < len(starts) else n
        step = max(q, least - q)
        g = np.flatnonzero(letters[: stop - q : step] == letters[q:stop:step]) * step
        g = g[doc[g] == doc[g + q]]
        if len(g):
            at.append(g)
            gap.append(np.full(len(g), q))
        q += 1
    if not at:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    a, p = np.concatenate(at), np.concatenate(gap)
    right = Grammar(letters).lce(a, a + p)
    # In the reversed sequence the word at place x stands at n - 1 - x.
    left = Grammar(letters[::-1].copy()).lce(n - 1 - a, n - 1 - a - p)
    start, end = a - left + 1, a + p + right
    keep = end - start >= np.maximum(least, 2 * p)
    start, end, p = start[keep], end[keep], p[keep]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    # Equal stretches: the smallest period comes first.
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], p[new]


def batch_runs(texts: list[bytes], least: int = LEAST) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """(words, runs) of each text; runs are rows of (start, length, period) in words, by start,
    then period."""
    words = [t.split() for t in texts]
    order = np.argsort([-len(w) for w in words], kind="stable")
    flat = [w for k in order for w in words[k]]
    found: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
    if not flat:
        return words, found
    numbers = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    sizes = np.array([len(words[k]) for k in order], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    letters = np.empty(len(flat) + len(order), dtype=np.int64)
    marks = starts + sizes
    inner = np.ones(len(letters), dtype=bool)
    inner[marks] = False
    letters[inner] = numbers
    letters[marks] = int(numbers.max()) + 1 + np.arange(len(order))
    start, end, period = runs_of(letters, starts, least)
    doc = np.searchsorted(starts, start, side="right") - 1
    rows = np.stack([start - starts[doc], end - start, period], axis=1)
    rank = np.lexsort((period, start))
    rows, doc = rows[rank], doc[rank]
    edges = np.searchsorted(doc, np.arange(len(order) + 1))
    for k in range(len(order)):
        if edges[k + 1] > edges[k]:
            found[order[k]] = rows[edges[k] : edges[k + 1]]
    return words, found


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without those that a run contains after its first
    period words."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep, strict=True) if k])


def find_runs(docs: DataFrame, least: int = LEAST, text: bool = True) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), runs_sha256 (of
    the lines start,length,period), collapsed (the text without repeated periods; left out
    where text is false) and collapsed_sha256 of every row of docs (doc_id, text)."""

    def run(batches):
        for piece in text_slices(batches, SLICE_BYTES):
            texts = [t or b"" for t in piece.column("text").cast(pa.binary()).to_pylist()]
            words, found = batch_runs(texts, least)
            lines = [b"".join(b"%d,%d,%d\n" % tuple(r) for r in rows.tolist()) for rows in found]
            kept = [collapse(w, rows) for w, rows in zip(words, found, strict=True)]
            offsets = np.zeros(len(found) + 1, dtype=np.int32)
            np.cumsum([len(r) for r in found], out=offsets[1:])
            flat = np.concatenate(found)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            out = {
                "doc_id": piece.column("doc_id"),
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(offsets), parts),
                "runs_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in lines]),
                "collapsed_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
            }
            if text:
                out["collapsed"] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, runs {RUN}, runs_sha256 string, collapsed_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", collapsed string" if text else ""))


def longest(runs: Column) -> Column:
    """The run of greatest length, then of smallest start and period; null where there is none."""
    key = F.transform(runs, lambda r: F.struct((-r["length"]).alias("k"), r["start"].alias("s"), r["period"].alias("q"), r.alias("run")))
    return F.array_min(key)["run"]


def planted(docs: DataFrame) -> DataFrame:
    """docs in which every tenth text, by a hash of doc_id, repeats a stretch of its own words
    from some word on. Texts with a null doc_id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    # Words are named once: the array is computed before it is taken apart.
    n, a, p = F.size("__w"), F.col("__a"), F.col("__p")
    held = docs.select("doc_id", "text", g.alias("__g"), F.when(h % 10 == 0, words).alias("__w"))
    held = held.withColumn("__a", F.when(n > 0, F.col("__g") % n)).withColumn("__p", 1 + F.floor((n - a) / (3 + F.col("__g") % 8)))
    place = F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)
    again = F.transform(place, lambda i: F.get("__w", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    text = F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text"))
    return held.select("doc_id", text.alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted(table(spark, sf_dir, "documents").select("doc_id", "text")), text=False)
    best = found.withColumn("best", longest(F.col("runs")))
    milli = F.expr("(1000 * best.length) div best.period")
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
