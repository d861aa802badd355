"""Order-preserving packing of documents into token windows by dynamic programming.

The tokens of a partition's documents form one stream, in row order. Windows are
contiguous pieces of that stream, so every token lies in exactly one piece. Cuts are
chosen at ends of documents and of sentences (and, inside a sentence longer than
stride tokens, every stride tokens) so that the sum of padding, of a penalty for every
cut inside a document, and of a cost per window is least:

    best[j] = pen[j] + each + min( min over i, pos[j]-pos[i] <= size, of best[i] + size - (pos[j] - pos[i]),
                                   min over powers of two p of best[at pos[j] - p] )

The first minimum is over a sliding window of the stream and is kept in a monotone
queue, so a transition costs constant time. A window whose length is a power of two is
not padded. Streams are solved in blocks of whole documents of about block_tokens, which
bounds memory; a document is never held twice.

Ids are those of tokenizers' file. Texts of common characters are encoded by the rank file
of the same vocabulary, which a test holds against tokenizers on every text of a table.

Null text counts as empty: its only token is the end mark. Ids of documents may be of any
type. Empty tables give no rows; repeated rows are packed as often as they occur; other
columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from loomseq.llm.common import text_slices

TOKENIZER = "byte_bpe_50k"
WINDOW_TOKENS = 1024
SENTENCE_PENALTY, INNER_PENALTY, EACH_WINDOW = 1, 6, 4
BLOCK_TOKENS = 1 << 19
STRIDE = 32
POWERS = (64, 128, 256, 512, 1024)
SCHEMA = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Outside these characters the two tokenizer libraries may split words by different
#: versions of Unicode, so such texts take the reference library.
_UNUSUAL = re.compile("[^\x00-\x7f¡-ɏ‐-‧€]|[\x0b\x0c\x1c-\x1f]|<\\|")


@functools.lru_cache(maxsize=2)
def tokenizer(folder: str | None, name: str):
    """(encode, ends): texts -> uint32 arrays, the ids of tokenizers' file name; ends[id]
    is true where a token's text ends a sentence. The rank file of the same vocabulary is
    used where both libraries agree, being about four times as fast."""
    import base64
    import os

    import tiktoken
    from tokenizers import Tokenizer

    import public_tokenizers as public

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = (lambda f: f"{folder}/{f}") if folder else public.path
    slow = Tokenizer.from_file(path(f"{name}.json"))
    with open(path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ends = np.zeros(max(ranks.values()) + 64, dtype=bool)
    for token, i in ranks.items():
        ends[i] = token.rstrip()[-1:] in (b".", b"!", b"?") or token.endswith(b"\n")

    def encode(texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            ids = slow.encode(t, add_special_tokens=False).ids if _UNUSUAL.search(t) else fast.encode_ordinary(t)
            out.append(np.array(ids, dtype=np.uint32))
        return out

    return encode, ends


def choose_cuts(pos: list[int], pen: list[int], size: int = WINDOW_TOKENS, each: int = EACH_WINDOW, powers=POWERS) -> list[int]:
    """Indices into pos, ascending, of the cuts of least cost; pos starts with 0 and its
    gaps are size at most. The last position is always a cut."""
    n = len(pos)
    best, back = [0] * n, [0] * n
    at = {p: i for i, p in enumerate(pos)}
    queue: deque = deque([(0, 0)])  # (best + pos, index), values ascend from the left
    powers = [p for p in powers if p <= size]
    for j in range(1, n):
        p = pos[j]
        low = p - size
        while pos[queue[0][1]] < low:
            queue.popleft()
        value, i = queue[0]
        value += size - p
        for step in powers:
            k = at.get(p - step)
            if k is not None and best[k] < value:
                value, i = best[k], k
        value += pen[j] + each
        best[j], back[j] = value, i
        value += p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts = []
    j = n - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, and their penalties."""
    n = len(ids)
    kind = np.full(n + 1, -1, dtype=np.int64)
    kind[1:][ends[ids]] = SENTENCE_PENALTY
    kind[doc_ends] = 0
    kind[0] = 0
    known = np.flatnonzero(kind >= 0)
    gaps = np.diff(known)
    for i in np.flatnonzero(gaps > stride):
        kind[known[i] + stride : known[i + 1] : stride] = INNER_PENALTY
    where = np.flatnonzero(kind >= 0)
    return where, kind[where]


def pack_block(docs: list[pa.Array], arrays: list[np.ndarray], ends: np.ndarray, first_sequence: int, size: int, parts: list) -> int:
    """Append the pieces of one block to parts; returns the number of sequences."""
    ids = np.concatenate(arrays)
    lengths = np.array([len(a) for a in arrays], dtype=np.int64)
    doc_end = np.cumsum(lengths)
    where, pen = candidates(ids, doc_end, ends)
    pos = where.tolist()
    cuts = where[choose_cuts(pos, pen.tolist(), size)]
    edges = np.union1d(cuts, doc_end)
    begin = np.concatenate([[0], edges[:-1]])
    doc = np.searchsorted(doc_end, begin, side="right")
    seq = np.searchsorted(cuts, begin, side="right")
    seq_begin = np.concatenate([[0], cuts[:-1]])[seq]
    raw = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), edges.tolist(), strict=True)]
    doc_begin = (doc_end - lengths)[doc]
    columns = [begin - doc_begin, edges - begin, crc, lengths[doc], first_sequence + seq, begin - seq_begin]
    ids_ = pa.concat_arrays(docs).take(pa.array(doc))
    parts.append(pa.RecordBatch.from_arrays([ids_, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]))
    return len(cuts)


def pack(docs: DataFrame, size: int = WINDOW_TOKENS, block_tokens: int = BLOCK_TOKENS, folder: str | None = None, name: str = TOKENIZER) -> DataFrame:
    """Pieces of all documents (doc_id, text). No shuffle: each partition is packed where
    it is read, and sequence ids carry the partition's number in their upper bits."""

    def run(batches):
        encode, ends = tokenizer(folder, name)
        sequence = TaskContext.get().partitionId() << 36
        held_docs, held, count = [], [], 0
        parts: list[pa.RecordBatch] = []
        for piece in text_slices(batches, 1 << 20):
            arrays = encode([t or "" for t in piece.column("text").to_pylist()])
            for i, a in enumerate(arrays):
                held_docs.append(piece.column("doc_id").slice(i, 1))
                held.append(np.append(a, np.uint32(0)))
                count += len(a) + 1
                if count >= block_tokens:
                    sequence += pack_block(held_docs, held, ends, sequence, size, parts)
                    held_docs, held, count = [], [], 0
                    yield from parts
                    parts.clear()
        if held:
            sequence += pack_block(held_docs, held, ends, sequence, size, parts)
            yield from parts

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(kind))


def in_order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs as they are read; a scan of fewer partitions than cores is dealt by ranges of
    doc_id, so that neighbours stay together."""
    cores = spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartitionByRange(cores, "doc_id").sortWithinPartitions("doc_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(in_order(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
