"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against
each automaton into phrases, each the longest prefix of what is left that occurs in that
language's text, or one strange letter. The number of phrases, times the logarithm of
the automaton's text length and divided by the text's length, is an entropy; the
language that needs the least wins, ties going to the smaller name.

The walk needs only the automaton's transitions, so they are laid out as one table, with a
flag on a transition that begins a phrase; a last state of each language stands for the
place between two phrases. Texts are cut into runs of STEP letters, and all runs of a
slice walk all tables in lock-step, so Python's work per letter is a share of a vector
operation. Then every run's last phrase is walked on into the next run until both begin a
phrase at the same letter (from there on they agree), over and over until nothing changes;
so phrases cross runs, and their number is that of one walk over the whole text.

Training rows are bounded: up to TRAIN_DOCS rows a language, in the order of a hash, those
of over TRAIN_LENGTH characters last and the shortest of them first, until they hold
TRAIN_LETTERS characters; of a longer row that many. Every language is learnt. Tables are
bounded: languages are parsed in blocks of BLOCK_BYTES bytes of tables, one pass each, and only
the most frequent letters of a large alphabet have columns.
Every whole text is predicted. Null text and text without letters is und, with score 0.
Repeated rows are predicted alike; training on equal ids and texts is the same in any
order. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomseq.llm.common import discard, materialise, stable_bucket, table, text_slices

TRAIN_LETTERS = 30_000
TRAIN_DOCS, TRAIN_LENGTH = 200, 10_000
#: Languages that are fetched together, and bytes of the tables of a block of them.
BLOCK_LANGUAGES, BLOCK_BYTES = 64, 160 << 20
#: Letters with a column of their own: at most DENSE, of larger alphabets the FEW most frequent.
DENSE, FEW = 64, 8
STEP = 512
SLICE = 2 << 20


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and letter-or-not of the basic plane; beyond it letters are looked up."""
    lower = np.arange(1 << 16, dtype=np.int32)
    letter = np.zeros(1 << 16, dtype=bool)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000:
            ch = chr(c)
            letter[c] = ch.isalpha()
            low = ch.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return lower, letter


_TABLES: list = []


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, starts): lower-case letters of all texts, each run of anything else as one
    blank (0); starts has n + 1 entries. A text without letters has no symbols."""
    if not _TABLES:
        _TABLES.extend(_letter_tables())
    lower, letter = _TABLES
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    basic = codes < (1 << 16)
    flag = np.zeros(len(codes), dtype=bool)
    flag[basic] = letter[codes[basic]]
    for i in np.flatnonzero(~basic):
        flag[i] = chr(int(codes[i])).isalpha()
    symbols = codes.copy()
    symbols[basic] = lower[codes[basic]]
    symbols[~flag] = 0
    owner = np.repeat(np.arange(len(texts)), sizes)
    after = np.zeros(len(codes), dtype=bool)
    after[1:] = (symbols[1:] == 0) & (symbols[:-1] == 0) & (owner[1:] == owner[:-1])
    has = np.bincount(owner[flag], minlength=len(texts)) > 0 if len(codes) else np.zeros(len(texts), dtype=bool)
    keep = ~after & has[owner] if len(codes) else after
    count = np.bincount(owner[keep], minlength=len(texts)) if len(codes) else np.zeros(len(texts), dtype=np.int64)
    return symbols[keep], np.concatenate([[0], np.cumsum(count)])


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    move: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(move)
        move.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = new
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(move)
                move.append(dict(move[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return move


def table_bytes(stream: np.ndarray) -> int:
    """Upper bound of the bytes of a language's tables."""
    return (2 * len(stream) + 2) * (dense_letters(len(np.unique(stream))) + 1) * 4 + 3 * len(stream) * 12


def dense_letters(alphabet: int) -> int:
    """Letters of a language that have a column of their own: all of a small alphabet, the most
    frequent ones of a large one."""
    return alphabet if alphabet <= DENSE else FEW


class Parser:
    """Transitions of all languages. A language's most frequent letters have columns in a table
    of its states, a further column stands for letters that it does not have; transitions by
    its other letters are sorted pairs of state and letter, found by binary search."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        streams = [letters([" ".join([*samples[lang], ""])])[0] for lang in self.languages]
        self.alphabet = np.unique(np.concatenate([[0], *streams]))
        strange = len(self.alphabet)  # the place of letters that no language has
        parts, keys, values, restart = [], [], [], []
        self.between, self.row, self.width = [], [], []
        self.code = np.zeros((len(streams), strange + 1), dtype=np.int32)
        base = size = 0
        for k, s in enumerate(streams):
            found, count = np.unique(s, return_counts=True)
            found = found[np.argsort(-count, kind="stable")]
            rank = {c: i for i, c in enumerate(found.tolist())}
            move = automaton([rank[c] for c in s.tolist()])
            dense = dense_letters(len(found))
            # Between phrases, and where a phrase cannot go on, a letter begins the next one;
            # after a letter that does not occur at all the place is between phrases again.
            between = base + len(move)
            begin = np.array([2 * (base + move[0][i]) + 1 for i in range(len(found))] or [0], dtype=np.int32)
            t = np.empty((len(move) + 1, dense + 1), dtype=np.int32)
            t[:, :dense], t[:, dense] = begin[:dense], 2 * between + 1
            far = []
            for state, row in enumerate(move):
                for c, to in row.items():
                    if c < dense:
                        t[state, c] = 2 * (to + base)
                    else:
                        far.append((state + base, c, 2 * (to + base)))
            parts.append(t.ravel())
            if far:
                x = np.array(far, dtype=np.int64)
                keys.append(x[:, 0] << 20 | x[:, 1])
                values.append(x[:, 2].astype(np.int32))
            self.row.append(size - base * (dense + 1))
            self.width.append(dense + 1)
            size += t.size
            self.between.append(between)
            restart.append(begin)
            base = between + 1
            # Letters with a column have its number, those without theirs plus one.
            code = np.full(strange + 1, dense, dtype=np.int32)
            order = np.arange(len(found), dtype=np.int32)
            code[np.searchsorted(self.alphabet, found)] = order + (order >= dense)
            self.code[k] = code
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.table = join(parts, np.int32)
        self.keys, self.values = join(keys, np.int64), join(values, np.int32)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.values = self.keys[order], self.values[order]
        self.restart = join(restart, np.int32)
        self.restart_row = np.cumsum([0, *[len(x) for x in restart]])[:-1]
        self.row, self.width = np.array(self.row, dtype=np.int64), np.array(self.width, dtype=np.int64)
        self.scale = np.log2(np.array([max(2, len(s)) for s in streams])) if streams else np.zeros(0)

    def step(self, lang: np.ndarray, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """2 * next state, + 1 where the letter begins a phrase; lang broadcasts over state
        (2 * state + flag) and code."""
        width = self.width[lang]
        if not len(self.keys):
            return self.table[self.row[lang] + (state >> 1) * width + code]
        out = self.table[self.row[lang] + (state >> 1) * width + np.minimum(code, width - 1)]
        far = code >= width
        if far.any():
            lang = np.broadcast_to(lang, code.shape)[far]
            letter = code[far].astype(np.int64) - 1
            key = (state[far].astype(np.int64) >> 1) << 20 | letter
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[far] = np.where(self.keys[at] == key, self.values[at], self.restart[self.restart_row[lang] + letter])
        return out

    def phrases(self, c: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """[text, language] numbers of phrases; c[language] are codes of letters, text i those
        from starts[i] to starts[i + 1]."""
        size = np.diff(starts)
        runs = -(-size // STEP)
        owner = np.repeat(np.arange(len(size)), runs)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        begin = starts[:-1][owner] + k * STEP
        length = np.minimum(STEP, starts[1:][owner] - begin)
        order = np.argsort(-length, kind="stable")
        after = np.full(len(owner), -1, dtype=np.int64)  # the next run of the same text
        rank = np.empty(len(owner), dtype=np.int64)
        rank[order] = np.arange(len(owner))
        after[rank[:-1]] = np.where(owner[1:] == owner[:-1], rank[1:], -1)
        begin, length, owner = begin[order], length[order], owner[order]
        n, m = len(begin), len(self.languages)
        state = np.tile(2 * np.array(self.between, dtype=np.int32)[:, None], (1, n))
        flags = np.zeros((int(length[0]) if n else 0, m, n), dtype=bool)
        every = np.arange(m)[:, None]
        alive = np.searchsorted(-length, -np.arange(1, STEP + 1), side="right")
        for step in range(len(flags)):
            live = alive[step]
            s = self.step(every, state[:, :live], c[:, begin[:live] + step])
            state[:, :live] = s
            flags[step, :, :live] = s & 1
        lang, run = np.nonzero(np.broadcast_to(after >= 0, (m, n)))
        while len(run):
            into = after[run]
            s, todo = state[lang, run], np.arange(len(run))
            agreed = np.zeros(len(run), dtype=bool)
            for step in range(len(flags)):
                todo = todo[length[into[todo]] > step]
                if not len(todo):
                    break
                i, r = into[todo], lang[todo]
                s[todo] = self.step(r, s[todo], c[r, begin[i] + step])
                new, old = (s[todo] & 1).astype(bool), flags[step, r, i]
                flags[step, r, i] = new
                agreed[todo[new & old]] = True
                todo = todo[~(new & old)]
            # Runs that were walked through without agreeing end in another state.
            changed = ~agreed & (s >> 1 != state[lang, into] >> 1)
            state[lang[changed], into[changed]] = s[changed]
            lang, run = lang[changed], into[changed]
            lang, run = lang[after[run] >= 0], run[after[run] >= 0]
        total = np.zeros((len(size), m), dtype=np.int64)
        count = flags.sum(0)
        for j in range(m):
            total[:, j] = np.bincount(owner, weights=count[j], minlength=len(size))
        return total

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """[text, language] entropies in bits a letter, and numbers of symbols."""
        symbols, starts = letters(texts)
        c = np.searchsorted(self.alphabet, symbols)
        c[c == len(self.alphabet)] = 0
        c = self.code[:, np.where(self.alphabet[c] == symbols, c, len(self.alphabet))]
        size = np.diff(starts)
        return self.phrases(c, starts) * self.scale / np.maximum(size, 1)[:, None], size

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        h, size = self.entropies(texts)
        best = h.argmin(1)
        gain = 2.0 ** -np.clip((h - h.min(1, keepdims=True)) * 8, 0, 500)
        score = 1 / gain.sum(1)
        return [self.languages[b] if n else "und" for b, n in zip(best.tolist(), size.tolist(), strict=True)], np.where(size > 0, score, 0.0).tolist()


class Blocks:
    """Samples of languages in blocks, in the order of names; tables are built block by block."""

    def __init__(self, samples: list[dict[str, list[str]]]):
        self.samples = samples
        self.languages = [lang for block in samples for lang in sorted(block)]


def fit(spark: SparkSession, docs: DataFrame, train_docs: int = TRAIN_DOCS, train_letters: int = TRAIN_LETTERS, train_length: int = TRAIN_LENGTH) -> Parser | Blocks:
    """Learn from docs (doc_id, text, lang); rows without a letter or lang are left out."""
    some = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    some = some.select("doc_id", "lang", F.length("text").alias("n"), F.xxhash64("doc_id", "text", F.lit(5)).alias("h"))
    order = [F.when(F.col("n") > train_length, F.col("n")).otherwise(0), "h", "doc_id"]
    by_lang = Window.partitionBy("lang").orderBy(*order)
    ranked = materialise(spark, some.withColumn("k", F.row_number().over(by_lang)).where(F.col("k") <= train_docs), "ranked")
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
    ids = ranked.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < train_letters)
    ids = materialise(spark, ids.select("doc_id", "lang", "h", "k"), "train-ids")
    langs = sorted(r.lang for r in ids.select("lang").distinct().collect())
    keyed = docs.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text", F.lit(5)).alias("h"))
    blocks: list[dict[str, list[str]]] = []
    for lo in range(0, len(langs), BLOCK_LANGUAGES):
        part = ids.where(F.col("lang").isin(langs[lo : lo + BLOCK_LANGUAGES])).dropDuplicates(["lang", "h"])
        rows = keyed.join(F.broadcast(part.select("lang", "h", "k")), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "k", F.substring("text", 1, train_letters).alias("text")).collect()
        samples: dict[str, list[str]] = {}
        for r in sorted(rows, key=lambda r: (r.lang, r.k)):
            samples.setdefault(r.lang, []).append(r.text)
        room = 0
        for lang in sorted(samples):
            need = table_bytes(letters([" ".join([*samples[lang], ""])])[0])
            if need > room:
                blocks.append({})
                room = BLOCK_BYTES
            blocks[-1][lang] = samples[lang]
            room -= need
    return Blocks(blocks) if len(blocks) > 1 else Parser(blocks[0] if blocks else {})


def predict(docs: DataFrame, parser: Parser | Blocks) -> DataFrame:
    """doc_id, lang_pred, score of docs (doc_id, text)."""
    if isinstance(parser, Blocks):
        return _predict_blocks(docs, parser)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(parser)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for piece in text_slices(batches, SLICE // max(1, -(-len(shared.value.languages) // 8))):
            lang, score = shared.value.predict([t or "" for t in piece.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def _predict_blocks(docs: DataFrame, model: Blocks) -> DataFrame:
    """One pass for each block; a text carries its smallest entropy so far, that language,
    and the sum that its score needs."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text", "lang_pred", "least", "total"]

    def step(shared):
        def run(batches):
            for piece in text_slices(batches, SLICE // max(1, -(-len(shared.value.languages) // 8))):
                h, size = shared.value.entropies([t or "" for t in piece.column("text").to_pylist()])
                at, low = h.argmin(1), h.min(1)
                total = (2.0 ** -np.clip((h - low[:, None]) * 8, 0, 500)).sum(1)
                before = piece.column("least").to_numpy(zero_copy_only=False)
                least = np.minimum(before, low)
                sums = piece.column("total").to_numpy(zero_copy_only=False) * 2.0 ** -np.clip((before - least) * 8, 0, 500) + total * 2.0 ** -np.clip((low - least) * 8, 0, 500)
                sums[size == 0] = 0
                old = piece.column("lang_pred").to_pylist()
                lang = [shared.value.languages[b] if new else o for b, new, o in zip(at.tolist(), (low < before).tolist(), old, strict=True)]
                lang = [x if n else "und" for x, n in zip(lang, size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text"), pa.array(lang, pa.string()), pa.array(least), pa.array(sums)], names=names)

        return run

    out = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang_pred"), F.lit(float("inf")).alias("least"), F.lit(0.0).alias("total"))
    for samples in model.samples:
        shared = spark.sparkContext.broadcast(Parser(samples))
        new = materialise(spark, out.mapInArrow(step(shared), f"doc_id {kind}, text string, lang_pred string, least double, total double"), "languages")
        shared.destroy()
        if samples is not model.samples[0]:
            discard(spark, out)
        out = new
    return out.select("doc_id", "lang_pred", F.when(F.col("total") > 0, 1 / F.col("total")).otherwise(0.0).alias("score"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    parser = fit(spark, docs.where(stable_bucket(F.col("doc_id"), 5) != 0))
    out = predict(docs, parser)
    return out.select("doc_id", (stable_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
