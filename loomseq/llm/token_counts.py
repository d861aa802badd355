"""Token counts of every prefix of a text, by prefix dynamic programming.

A byte-level BPE splits a text into words and encodes each word on its own. Within a word
the encoding of every prefix ends in one token t, and what stands before t is the encoding
of the shorter prefix: so

    count[i] = count[i - len(t)] + 1,  last[i] = t

for the one token t that ends at i and that BPE leaves apart from last[i - len(t)]. Whether
BPE leaves two tokens apart depends on these two alone, is found by merging their bytes, and
is remembered. The tokens that end at each i are found by one automaton of all tokens. One pass
over a word gives the counts of all its prefixes.

counts[p], for p from 0 to the text's length in code points, is the number of tokens of the
text cut after p code points, exactly as if that prefix were encoded on its own. Where a cut
changes the split into words (within a run of white space, a contraction or the string of a
special token) the counts follow the split of the cut text. counts need not ascend: a longer
prefix may take fewer tokens. With the stored counts, budgets and truncation are answered by
count_at, longest_within and truncate, which are column expressions; no text is encoded again.

Null text counts as empty: counts is [0]. Texts of any length are read whole; the time grows
with their length. Ids may be of any type, null or repeated: every row is counted on its own.
Empty tables give no rows; other columns are ignored. Special tokens' strings inside a text
are one token, as the library's default has it.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import table, text_slices

TOKENIZER = "byte_bpe_50k"
LIMIT = 512
SLICE_BYTES = 1 << 20
#: Entries that a worker remembers at most; a full memory is emptied.
MOST_WORDS, MOST_PAIRS, LONG_WORD = 300_000, 600_000, 48

#: Outside these characters versions of Unicode may differ, so the library splits the text.
_UNUSUAL = re.compile("[^\x00-\x7f¡-ɏ‐-‧€]|[\x0b\x0c\x1c-\x1f]")
#: Contractions of the pattern whose cut form is two words.
_CUT_IN_TWO = ("'re", "'ve", "'ll")


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary file writes each byte: printable Latin-1
    characters stand for themselves, others for the letters from 256 on, in order."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """counts(text) for one vocabulary file of tokenizers (byte-level BPE)."""

    def __init__(self, path: str, pattern: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.tokens = [raw(t) for t in spec["model"]["vocab"]]
        find = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            find.add_word(t.decode("latin-1"), (len(t), i))
        find.make_automaton()
        self.find = find.iter
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.words = regex.compile(pattern).findall
        self.library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.known: dict[str, bytes] = {}
        self.apart: dict[int, bool] = {}

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether BPE leaves token b whole and apart after token a (after nothing: a is the
        number of tokens). By its definition: the pair of lowest rank merges first, the
        leftmost of equals; no merge may cross the border of the two."""
        if len(self.apart) >= MOST_PAIRS:
            self.apart.clear()
        before, data = b"".join(self.tokens[a : a + 1]), self.tokens[b]
        border, data = len(before), before + data
        parts = [data[i : i + 1] for i in range(len(data))]
        rank, never = self.ranks.get, len(self.ranks)
        ranks = [rank(p, never) for p in zip(parts, parts[1:], strict=False)]
        crossed = False
        while ranks and not crossed:
            lowest = min(ranks)
            if lowest == never:
                break
            i = ranks.index(lowest)
            crossed = i + 1 == border
            border -= i + 1 < border
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), never)
        found = self.apart[a << 20 | b] = not crossed and len(parts) == (2 if before else 1)
        return found

    def chain(self, data: bytes) -> list[int]:
        """Token counts of the prefixes of one word, by number of bytes."""
        apart = self.apart.get
        count, last = [0] * (len(data) + 1), [len(self.tokens)] * (len(data) + 1)
        # The tokens that end at each byte, the longest of a byte first.
        for end, (size, t) in self.find(data.decode("latin-1")):
            i = end + 1
            if not count[i]:
                j = i - size
                pair = last[j] << 20 | t
                ok = apart(pair)
                if ok or ok is None and self.stay_apart(last[j], t):
                    count[i], last[i] = count[j] + 1, t
        if 0 in count[1:]:
            raise ValueError(f"no token ends byte {count.index(0, 1)} of {data!r}")
        return count

    def word(self, w: str) -> bytes:
        """Counts of the prefixes of one word, by number of code points from 1, as 32-bit
        numbers; for words of up to LONG_WORD code points, as 8-bit numbers."""
        data = w.encode()
        count = self.chain(data)
        if w in _CUT_IN_TWO:
            found = [count[1], count[1] + self.chain(data[1:2])[1], count[3]]
        elif len(data) == len(w):
            found = count[1:]
        else:
            found, at = [], 0
            for c in w:
                at += len(c.encode())
                found.append(count[at])
        if len(w) > LONG_WORD:
            return np.array(found, dtype=np.int32).tobytes()
        if len(self.known) >= MOST_WORDS:
            self.known.clear()
        small = self.known[w] = bytes(found)
        return small

    def split(self, text: str) -> list[str]:
        if _UNUSUAL.search(text):
            return [text[a:b] for _, (a, b) in self.library(text)]
        return self.words(text)

    def plain(self, text: str) -> np.ndarray:
        """counts of a text without special tokens."""
        words = self.split(text)
        if not words:
            return np.zeros(1, dtype=np.int32)
        get, learn = self.known.get, self.word
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        if lengths.max() <= LONG_WORD:
            inside = np.frombuffer(b"".join([get(w) or learn(w) for w in words]), dtype=np.uint8).astype(np.int32)
        else:
            each = ((w, get(w) or learn(w)) for w in words)
            inside = np.concatenate([np.frombuffer(v, dtype=np.uint8 if len(w) <= LONG_WORD else np.int32) for w, v in each]).astype(np.int32)
        base = np.zeros(len(words), dtype=np.int32)
        np.cumsum(inside[ends[:-1] - 1], out=base[1:])
        out = np.zeros(len(inside) + 1, dtype=np.int32)
        out[1:] = inside + np.repeat(base, lengths)
        # A run of white space is split before its last character if a word follows; cut
        # after that character, it is one word.
        for i, w in enumerate(words[:-1]):
            if w.isspace() and words[i + 1][0].isspace():
                out[ends[i] + 1] = base[i] + self.chain((w + words[i + 1][0]).encode())[-1]
        return out

    def counts(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of text, by number of code points from 0."""
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts, base, at = [np.zeros(1, dtype=np.int32)], 0, 0
        for hit in self.special.finditer(text):
            # Until its last character the special token's string is ordinary text.
            before = self.plain(text[at : hit.end() - 1])
            parts.append(before[1:] + base)
            base += int(before[hit.start() - at]) + 1
            parts.append(np.array([base], dtype=np.int32))
            at = hit.end()
        parts.append(self.plain(text[at:])[1:] + base)
        return np.concatenate(parts).astype(np.int32)


@functools.lru_cache(maxsize=2)
def counter(folder: str | None, name: str) -> PrefixCounter:
    import public_tokenizers as public

    return PrefixCounter(f"{folder}/{name}.json" if folder else public.path(f"{name}.json"), public.PATTERN)


def prefix_counts(docs: DataFrame, folder: str | None = None, name: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8) and counts array<int> of every row of docs
    (doc_id, text). No shuffle."""

    def run(batches):
        tool = counter(folder, name)
        for piece in text_slices(batches, SLICE_BYTES):
            found = [tool.counts(t or "") for t in piece.column("text").to_pylist()]
            offsets = np.zeros(len(found) + 1, dtype=np.int32)
            np.cumsum([len(c) for c in found], out=offsets[1:])
            n_bytes = pc.fill_null(pc.binary_length(piece.column("text")), 0).cast(pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), n_bytes, lists], names=["doc_id", "n_bytes", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, counts array<int>")


def count_at(counts: Column, chars: Column | int) -> Column:
    """Tokens of the text cut after chars code points (all of it if it is shorter)."""
    at = F.greatest(F.lit(0), F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts) - 1))
    return F.get(counts, at)


def longest_within(counts: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix of at most budget tokens; null if budget is
    negative or null."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    return F.array_max(F.transform(counts, lambda c, i: F.when(c <= limit, i)))


def truncate(text: Column, counts: Column, budget: Column | int) -> Column:
    """The longest prefix of text that takes at most budget tokens."""
    return F.substring(text, F.lit(1), longest_within(counts, budget))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = F.element_at("counts", -1).cast("long")
    return prefix_counts(docs).select("doc_id", "n_bytes", n.alias("n_tokens"), (n > LIMIT).alias("over_limit"))
