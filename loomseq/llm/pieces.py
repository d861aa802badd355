"""SentencePiece encoding and decoding by suffix-array matching.

The model's words (a run of blanks and what follows it, up to the next blank) of a batch
are joined to one text, each distinct word once: no piece crosses a word, so the edges in
its other copies are the same. A suffix array of that text, sorted as deep as the longest piece, is searched for every piece of the model
at once; the ranges of suffixes that start with a piece are its occurrences, and each is
an edge of the words' lattices. The edges are sorted by position and relaxed from left to
right, in all words in step.

The model given is a merge model (BPE), whose encoding of every prefix has exactly one
last piece. An edge is relaxed where its piece may follow the last piece at its start:
that is, where undoing the two pieces' merges from the latest back never meets a merge
across their border that would have come first. The result is the library's encoding.
Characters without a piece become byte pieces.

Null text counts as empty and has no ids. Rows are independent; other columns are
ignored.
"""

from __future__ import annotations

import functools
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomseq.llm.common import table, text_slices

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
CACHE_BITS = 21
NEVER = np.int64(1) << 40
#: Stands between words; no text in UTF-8 can hold it.
SEPARATOR = 0xD800


class Model:
    """Pieces, merge order and the rule which pieces may meet."""

    def __init__(self, path: str):
        import sentencepiece as spm

        sp = spm.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size = n
        self.names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]
        score = {i: sp.get_score(i) for i in plain}
        self.bytes_of = {int(self.names[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        by_name = {self.names[i]: i for i in plain}
        # Rank 0: single characters; then merges in the order in which they are made.
        rank = np.zeros(n + 1, dtype=np.int64)
        for r, i in enumerate(sorted((i for i in plain if len(self.names[i]) > 1), key=lambda i: (-score[i], i)), 1):
            rank[i] = r
        self.rank = rank
        pairs: dict[int, int] = {}
        for i in plain:
            s = self.names[i]
            for k in range(1, len(s)):
                a, b = by_name.get(s[:k]), by_name.get(s[k:])
                if a is not None and b is not None:
                    pairs[a * (n + 1) + b] = int(rank[i])
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)
        self.left, self.right = np.arange(n + 1), np.arange(n + 1)
        usable = []
        for i in plain:
            halves = self._last_merge(self.names[i], self.names, by_name, pairs, n)
            if halves is not None:
                self.left[i], self.right[i] = halves
                usable.append(i)
        self.usable = np.array(sorted(usable, key=lambda i: self.names[i]), dtype=np.int64)
        self.depth = max(len(self.names[i]) for i in usable)
        codes = np.zeros((len(self.usable), self.depth), dtype=np.int32)
        for row, i in enumerate(self.usable.tolist()):
            s = self.names[i]
            codes[row, : len(s)] = [ord(c) for c in s]
        self.piece_codes, self.piece_lengths = codes, (codes > 0).sum(1)
        self.chars = np.unique(codes[self.piece_lengths == 1, 0])
        self.cache_keys = np.full(1 << CACHE_BITS, -1, dtype=np.int64)
        self.cache_ok = np.zeros(1 << CACHE_BITS, dtype=bool)
        text = [(bytes([int(s[1:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else s.replace(BLANK, " ").encode()) for i, s in enumerate(self.names)]
        self.text = text

    @staticmethod
    def _last_merge(s: str, names: list[str], by_name: dict, pairs: dict, n: int) -> tuple[int, int] | None:
        """The two halves of the last merge that makes s, or None if s is not made."""
        parts = [by_name.get(c) for c in s]
        if None in parts:
            return None
        halves = (parts[0], parts[0])
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: (pairs.get(parts[k] * (n + 1) + parts[k + 1], NEVER), k))
            a, b = parts[best], parts[best + 1]
            if a * (n + 1) + b not in pairs:
                return None
            halves = (a, b)
            parts[best : best + 2] = [by_name[names[a] + names[b]]]
        return halves

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b may stand after piece a; answers are kept in a bounded cache."""
        key = a * (self.size + 1) + b
        slot = (key * 0x9E3779B1 >> 7) & ((1 << CACHE_BITS) - 1)
        ok = self.cache_ok[slot]
        new = np.flatnonzero(self.cache_keys[slot] != key)
        if len(new):
            distinct, first, flat = np.unique(key[new], return_index=True, return_inverse=True)
            at = new[first]
            answer = self._check(a[at], b[at])
            ok[new] = answer[flat]
            self.cache_keys[slot[at]] = distinct
            self.cache_ok[slot[at]] = answer
        return ok

    def _check(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NEVER)
        ok = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * (self.size + 1) + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)
            bad = merged < limit[live]
            ok[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx > 0) | (ry > 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            first = rx > ry
            a[live[first]] = self.right[x[first]]
            limit[live[first]] = rx[first]
            b[live[~first]] = self.left[y[~first]]
            limit[live[~first]] = ry[~first] + 1
        return ok


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling up to depth, from
    keys of four characters on."""
    found = np.unique(codes)
    rank = np.searchsorted(found, codes).astype(np.int64) + 1
    bits = int(len(found) + 1).bit_length()
    width = 1
    key = rank
    while 2 * width * bits <= 60 and width < depth:
        after = np.zeros(len(key), dtype=np.int64)
        after[:-width] = key[width:]
        key = (key << (width * bits)) | after
        width *= 2
    while width < depth:
        _, rank = np.unique(key, return_inverse=True)
        after = np.zeros(len(rank), dtype=np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (len(rank) + 2) + after
        width *= 2
    return np.argsort(key, kind="stable")


def occurrences(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every piece the range of order whose suffixes start with it, by binary search."""
    depth = pieces.shape[1]
    padded = np.concatenate([codes, np.zeros(depth, dtype=codes.dtype)])
    views = np.lib.stride_tricks.sliding_window_view(padded, depth)
    inside = np.arange(depth)[None, :] < lengths[:, None]

    def search(right: bool) -> np.ndarray:
        lo, hi = np.zeros(len(pieces), dtype=np.int64), np.full(len(pieces), len(order), dtype=np.int64)
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(order) - 1)
            diff = np.where(inside, views[order[mid]] - pieces, 0)
            first = (diff != 0).argmax(1)
            sign = diff[np.arange(len(pieces)), first]
            go = (sign <= 0 if right else sign < 0) & (lo < hi)
            lo, hi = np.where(go, mid + 1, lo), np.where(go | (lo >= hi), hi, mid)
        return lo

    return search(False), search(True)


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words (each starting with its blanks), one after the other, and
    their numbers."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    joined = chr(SEPARATOR).join([*words, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    begin = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_array(codes, model.depth)
    lo, hi = occurrences(codes, order, model.piece_codes, model.piece_lengths)
    count = hi - lo
    piece = np.repeat(np.arange(len(count)), count)
    start = order[np.repeat(lo, count) + np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)]
    token, stop = model.usable[piece], start + model.piece_lengths[piece]
    strange = np.flatnonzero(~np.isin(codes, model.chars) & (codes != SEPARATOR))
    unknown = model.size
    start, stop, token = np.concatenate([start, strange]), np.concatenate([stop, strange + 1]), np.concatenate([token, np.full(len(strange), unknown)])
    word = np.repeat(np.arange(len(words)), sizes + 1)
    base = begin[word]
    offset = stop - base[start]
    by_end = np.argsort(offset, kind="stable")
    start, stop, token, offset = start[by_end], stop[by_end], token[by_end], offset[by_end]
    last = np.full(len(codes) + 1, -1, dtype=np.int64)
    back = np.zeros(len(codes) + 1, dtype=np.int64)
    at_start = start == base[start]
    limits = np.searchsorted(offset, np.arange(1, (int(sizes.max()) if len(sizes) else 0) + 2))
    for p in range(len(limits) - 1):
        s = slice(limits[p], limits[p + 1])
        q, t = start[s], token[s]
        before = last[q]
        free = at_start[s] | (before == unknown) | (t == unknown)
        ok = free.copy()
        pair = np.flatnonzero(~free & (before >= 0))
        if len(pair):
            ok[pair] = model.may_follow(before[pair], t[pair])
        ok &= at_start[s] | (before >= 0)
        last[stop[s][ok]] = t[ok]
        back[stop[s][ok]] = q[ok]
    here = begin + sizes
    live = np.flatnonzero(sizes > 0)
    owners, tokens, starts = [], [], []
    while len(live):
        x = here[live]
        owners.append(live)
        tokens.append(last[x])
        starts.append(back[x])
        here[live] = back[x]
        live = live[here[live] > begin[live]]
    if not owners:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(words), dtype=np.int64)
    owner, token, start = np.concatenate(owners), np.concatenate(tokens), np.concatenate(starts)
    order = np.argsort(start, kind="stable")
    owner, token, start = owner[order], token[order], start[order]
    odd = np.flatnonzero(token == unknown)
    if len(odd):
        times = np.ones(len(token), dtype=np.int64)
        raw = [[model.bytes_of.get(b, model.unknown) for b in chr(c).encode("utf-8", "surrogatepass")] for c in codes[start[odd]].tolist()]
        times[odd] = [len(r) for r in raw]
        owner, token = np.repeat(owner, times), np.repeat(token, times)
        token[token == unknown] = np.concatenate(raw)
    return token.astype(np.uint32), np.bincount(owner, minlength=len(words))


def words_of(text: str) -> list[str]:
    """Words of a text after the model's normalisation (blanks marked, one put first)."""
    if not text:
        return []
    parts = text.replace(BLANK, " ").split(" ")
    if "" not in parts:
        return [BLANK + p for p in parts]
    out, blanks = [], 0
    for p in parts:
        blanks += 1
        if p:
            out.append(BLANK * blanks + p)
            blanks = 0
    return [*out, BLANK * blanks] if blanks else out


@functools.lru_cache(maxsize=2)
def load(folder: str | None, name: str = MODEL) -> Model:
    if folder:
        return Model(f"{folder}/{name}")
    import public_tokenizers

    return Model(public_tokenizers.path(name))


class Encoder:
    """Encodes batches of texts; nothing is kept from one batch to the next."""

    def __init__(self, model: Model):
        self.model = model

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        lists = [words_of(t or "") for t in texts]
        words = list(itertools.chain.from_iterable(lists))
        number: dict[str, int] = {}
        at = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        ids, count = encode_words(self.model, list(number))
        start = np.cumsum(count) - count
        n = count[at]
        stop = np.cumsum(n)
        flat = ids[np.arange(stop[-1] if len(stop) else 0) + np.repeat(start[at] - stop + n, n)]
        edge = np.concatenate([[0], stop])[np.cumsum([len(ws) for ws in lists])]
        return np.split(flat, edge[:-1])


def decode(model: Model, ids: list[int]) -> str:
    """The text of ids, without the blank that encoding puts first."""
    raw = b"".join(map(model.text.__getitem__, ids))
    return raw.removeprefix(b" ").decode("utf-8", "replace")


def encode_decode(docs: DataFrame, folder: str | None = None, name: str = MODEL) -> DataFrame:
    """doc_id, ids and decoded text of docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = load(folder, name)
        encoder = Encoder(model)
        for piece in text_slices(batches, 2 << 20):
            ids = encoder.encode(piece.column("text").to_pylist())
            text = [decode(model, i.tolist()) for i in ids]
            flat = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32), pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), flat, pa.array(text, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digest(docs: DataFrame, folder: str | None = None, name: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids) and round_trip (decoding
    gives the text back, the mark of a blank counting as a blank)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = load(folder, name)
        encoder = Encoder(model)
        for piece in text_slices(batches, 2 << 20):
            texts = piece.column("text").to_pylist()
            ids = encoder.encode(texts)
            same = [decode(model, i.tolist()) == (t or "").replace(BLANK, " ") for i, t in zip(ids, texts, strict=True)]
            columns = [piece.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_ids", "ids_crc32", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, round_trip boolean")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
