"""Periodic runs, prefix token counts and whitening against brute force, and on nulls, empty
and long texts, ties, repeated rows, empty tables and further columns."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomseq.llm import ann, langid, lattice, minhash, runs, suffix_dedup, token_counts, warc, whitening

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


# Periodic runs


def plain_runs(words, least=12):
    """Every run by comparing words q apart, one start after the other."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_grammar_extensions_equal_a_plain_comparison():
    rng = random.Random(5)
    for _ in range(120):
        letters = np.array([rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(2, 60))] + [99])
        pairs = [(i, j) for i in range(len(letters) - 1) for j in range(len(letters) - 1) if i != j]

        def plain(i, j):
            c = 0
            while max(i, j) + c < len(letters) and letters[i + c] == letters[j + c]:
                c += 1
            return c

        got = runs.Grammar(letters).lce(np.array([i for i, _ in pairs], dtype=np.int64), np.array([j for _, j in pairs], dtype=np.int64))
        assert got.tolist() == [plain(i, j) for i, j in pairs]


def test_runs_of_batches_equal_brute_force():
    rng = random.Random(3)
    for _ in range(250):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            words = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(rng.choice([0, 1, 5, 30, 90]))]
            if words and rng.random() < 0.5:
                a = rng.randrange(len(words))
                p = 1 + (len(words) - a) // rng.randrange(2, 9)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(" ".join(words).encode())
        words, found = runs.batch_runs(texts)
        for w, rows in zip(words, found, strict=True):
            assert [tuple(r) for r in rows.tolist()] == plain_runs(w)


def test_a_word_that_repeats_through_a_long_text():
    _, found = runs.batch_runs([b"a " * 50_000, b"b c " * 20_000, b""])
    assert [f.tolist() for f in found] == [[[0, 50_000, 1]], [[0, 40_000, 2]], []]


def test_op11_equals_brute_force(spark):
    want = {plain_row(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {tuple(r) for r in runs.op11_runs(spark, SF).collect()}
    assert got == want
    assert sum(r[1] > 0 for r in got) > 10


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "x y " * 9), (4, "x y " * 9), (4, "x y " * 9), (5, "a b " * 12), (6, "q" * 300_000)]
    docs = spark.createDataFrame(rows, DOC).withColumns({"runs": F.lit(1), "n_words": F.lit("z"), "collapsed": F.lit(None)})
    got = {(r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in runs.find_runs(docs).collect()}
    twice = ((0, 18, 2),)
    assert got == {(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (None, 18, twice, "x y"), (4, 18, twice, "x y"), (5, 12, ((0, 12, 1),), "a b"), (6, 1, (), "q" * 300_000)}
    assert runs.find_runs(docs).count() == len(rows)
    assert runs.find_runs(docs.where("false")).count() == 0
    assert {tuple(r) for r in runs.planted(docs).collect() if r.doc_id is None} == {(None, "x y " * 9)}


def test_the_longest_run_and_ties(spark):
    text = " ".join(["a b"] * 7 + ["stop"] + ["c d"] * 7)
    row = runs.find_runs(spark.createDataFrame([(1, text)], DOC)).select(runs.longest(F.col("runs")).alias("r")).first().r
    assert (row.start, row.length, row.period) == (0, 14, 2)


# Prefix token counts


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return lambda t: len(tool.encode(t, add_special_tokens=False).ids)


PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "'re", "'s", "'ll", "r", "é", "日本", "\U0001f600", "<|endoftext|>", "<|", "1", "23", "!", "--", "=", "\x1c", "ing", "\r\n", "ſ", "İ", "é", "क्षि", "_", " "]


def test_every_prefix_counts_as_if_encoded_alone(library):
    tool, rng = token_counts.counter(None, "byte_bpe_50k"), random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(22)))
        assert tool.counts(text).tolist() == [library(text[:p]) for p in range(len(text) + 1)], repr(text)


def test_long_words_count_as_the_library_counts(library):
    rng = random.Random(2)
    tool = token_counts.counter(None, "byte_bpe_50k")
    for text in ("-" * 20_000, "".join(rng.choice("abcdefghijkl") for _ in range(40_000)), "あ" * 9000, " " * 20_000 + "x", "x " * 30_000):
        assert tool.counts(text)[-1] == library(text)
        cut = rng.randrange(len(text))
        assert tool.counts(text)[cut] == library(text[:cut])


def test_op12_equals_the_library(spark, library):
    want = {(r.doc_id, len((r.text or "").encode()), library(r.text or ""), library(r.text or "") > 512) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert {tuple(r) for r in token_counts.op12_token_counts(spark, "/root/testdata/sf0.01").collect()} == want


def test_budgets_and_truncation_without_encoding(spark, library):
    text = "The tokenizer   counts  every prefix, doesn't it? <|endoftext|> naïve \U0001f600s"
    rows = [(1, text), (2, None), (3, ""), (None, "a"), (1, text)]
    docs = spark.createDataFrame(rows, DOC).withColumns({"counts": F.lit(1), "n_bytes": F.lit("z")})
    found = token_counts.prefix_counts(docs).cache()
    assert sorted((r.doc_id or 0, len(r.counts), r.counts[-1]) for r in found.collect()) == [(0, 2, 1), (1, len(text) + 1, library(text)), (1, len(text) + 1, library(text)), (2, 1, 0), (3, 1, 0)]
    one = found.where("doc_id = 1").limit(1)
    for budget in (0, 1, 5, 9, 12, 10_000):
        best = max(p for p in range(len(text) + 1) if library(text[:p]) <= budget)
        r = one.select(token_counts.longest_within(F.col("counts"), budget).alias("p"), token_counts.truncate(F.lit(text), F.col("counts"), budget).alias("t")).first()
        assert (r.p, r.t) == (best, text[:best])
    for cut in (0, 3, 17, 10_000):
        assert one.select(token_counts.count_at(F.col("counts"), cut)).first()[0] == library(text[:cut])
    assert one.select(token_counts.longest_within(F.col("counts"), -1)).first()[0] is None
    assert token_counts.prefix_counts(docs.where("false")).count() == 0


# Whitening


def plain_whitening(ids, vectors, k=32):
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1000000
    n, s = len(x), x.sum(0)
    c = x - s / n
    values, u = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)[:k]
    return n, ((n * x - s) ** 2).sum(1), c @ u[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_op13_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [r for r in rows if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    ids = [r.vec_id for r in rows]
    n, deviation, white, explained = plain_whitening(ids, [r.embedding for r in rows])
    got = whitening.op13_whitening(spark, SF).toPandas()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((wide * white).sum(0))
    assert np.abs(wide * sign - white).max() < 1e-9
    assert (got.groupby("vec_id").deviation.first().loc[ids].to_numpy() == deviation).all()
    assert np.abs(got.groupby("component").explained.first().to_numpy() - explained).max() < 1e-12
    assert (got.n == n).all() and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


def test_whitening_of_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.5, 2.0]), (2, [1.5, 2.0]), (None, [3.0, 1.0]), (5, None), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]), (10, [4.0]), (11, [float("-inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"index": F.lit(3), "white": F.lit("z"), "x": F.lit(None)})
    got = whitening.whiten(spark, df).collect()
    assert sorted((r.vec_id or 0, r.dims, r.n) for r in got) == [(0, 2, 4), (1, 2, 4), (2, 2, 4), (2, 2, 4), (9, 1, 2), (10, 1, 2)]
    assert sorted(r.white[0] for r in got if r.dims == 1) == pytest.approx([-1.0, 1.0])
    n, deviation, white, _ = plain_whitening(None, [[1.0, 2.0], [1.5, 2.0], [1.5, 2.0], [3.0, 1.0]])
    assert sorted(r.deviation for r in got if r.dims == 2) == sorted(deviation.tolist())
    assert sorted(abs(r.white[1]) for r in got if r.dims == 2) == pytest.approx(sorted(np.abs(white[:, 1])))
    assert whitening.whiten(spark, df.where("false")).count() == 0


def test_components_without_variance_have_no_coordinates(spark):
    df = spark.createDataFrame([(i, [float(i), 7.0, 2.0 * i]) for i in range(6)], "vec_id long, embedding array<double>")
    got = whitening.whiten(spark, df).collect()
    assert all(r.white[0] is not None and r.white[1:] == [None, None] and r.explained[1:] == [0.0, 0.0] for r in got)
    assert max(r.identity_error for r in got) < 1e-9
    same = whitening.whiten(spark, spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r.deviation, r.white, r.explained) for r in same] == [(0, [None], [0.0])] * 2


def test_blocks_and_splits_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(900, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(7)
    monkeypatch.setattr(whitening, "LEAST_ROWS", 16)
    monkeypatch.setattr(whitening, "SPLIT_BYTES", 4000)
    got = {r.vec_id: r.white for r in whitening.whiten(spark, df, 3).collect()}
    _, _, white, _ = plain_whitening(None, data.tolist(), 3)
    wide = np.array([got[i] for i in range(900)])
    assert np.abs(wide * np.sign((wide * white).sum(0)) - white).max() < 1e-9


# Repeated ids and lengths in earlier operators


def test_pages_fetched_twice_keep_every_payload(spark):
    pages = [(5, "A" * 10), (5, "B" * 10), (9, "A" * 10), (5, "C"), (8, "C"), (9, "D"), (9, "D"), (None, "A" * 10), (3, "D")]
    df = spark.createDataFrame([(i, "u", h, 1, "x") for i, h in pages], "page_id long, url string, html string, payload_digest int, mark string")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/warc-twice"
    warc.write_warc(spark, df, path)
    rows = warc.read_warc(spark, path).where("is_last").collect()
    assert len(rows) == len(pages)
    stored = {r.record_id: bytes(r.chunk).decode() for r in rows if r.record_type == "response"}
    sha = lambda t: warc.base32(hashlib.sha1(t.encode()).digest())
    got = sorted((r.record_id, r.record_type, r.declared_digest) for r in rows)
    want = []
    for i, html in pages:
        top = max(j for j, h in pages if h == html and j is not None)
        several = i is not None and len({h for j, h in pages if j == i}) > 1
        kind = "revisit" if i is not None and i < top else "response"
        want.append((f"<urn:page:{'null' if i is None else i}{':' + sha(html) if several else ''}>", kind, sha(html)))
    assert got == sorted(want)
    for r in rows:
        text = stored[r.refers_to if r.record_type == "revisit" else r.record_id]
        assert sha(text) == r.declared_digest
    ids = spark.createDataFrame([(r.record_id,) for r in rows], "u string").select(warc.page_of(F.col("u")).alias("p")).collect()
    assert sorted((x.p or 0) for x in ids) == sorted((i or 0) for i, _ in pages)


def test_each_length_of_vectors_has_its_own_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=2 if i % 3 == 0 else 5).tolist()) for i in range(0, 400, 10)] + [(1000, [1.0, 2.0, 3.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"leaf": F.lit(1), "role": F.lit("r"), "part": F.lit(None)})
    monkeypatch.setattr(ann, "PART_VALUES", 8)
    monkeypatch.setattr(ann, "TILE", 3)
    got = {}
    for r in ann.nearest(spark, v, v.where("vec_id % 50 = 0"), recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {}
    for q, x in rows:
        if q % 50 == 0:
            near = [(-np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y), j) for j, y in rows if len(y) == len(x) and j != q]
            if near:
                want[q] = [j for _, j in sorted(near)[:5]]
    assert got == want and 1000 not in got


def plain_components(rows, width, percent):
    """doc_id -> smallest doc_id reachable, by comparing all rows."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({" ".join(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({" ".join(w)} if w else set()))
    root = {d: d for d, _ in rows if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            if a is not None and b is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in root}


def test_repeated_ids_lose_no_link(spark):
    rng = random.Random(11)
    a, b, c = (" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, c), (4, c), (5, c + " y"), (6, "x"), (6, None), (7, "x"), (8, ""), (None, a), (9, "q r s t"), (9, "unlike all others here")]
    df = spark.createDataFrame(rows, DOC).withColumns({"row": F.lit(1), "n_shingles": F.lit("z")})
    for _ in range(2):
        got = minhash.near_duplicates(spark, df.repartition(5), width=3, threshold=0.85).collect()
        assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == plain_components(rows, 3, 85)
        assert len(got) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
        assert sorted(r.n_shingles for r in got if r.doc_id == 6) == [0, 1]
        assert [(r.component_id, r.kept, r.n_shingles) for r in got if r.doc_id is None] == [(None, True, 38)]


def test_buckets_of_several_families_lose_no_link(spark):
    """Families of near copies that overlap in buckets, some of them below the threshold."""
    rng = random.Random(13)
    rows = []
    for family in range(4):
        base = [f"f{family}w{rng.randrange(300)}" for _ in range(80)]
        for i in range(18):
            w = list(base)
            for k in rng.sample(range(80), rng.choice([1, 2, 3, 5])):
                w[k] = f"y{family}_{i}_{k}"
            rows.append((family * 100 + i, " ".join(w)))
    got = minhash.near_duplicates(spark, spark.createDataFrame(rows, DOC), width=3, threshold=0.85).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(rows, 3, 85)


# Languages of large alphabets


def plain_phrases(sample, text):
    """Numbers of longest matches of text in sample, one after the other; a letter that does not
    occur is a phrase of its own."""
    n = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += max(size, 1)
        n += 1
    return n


def test_large_alphabets_are_parsed_as_plainly(monkeypatch):
    rng = random.Random(17)
    samples = {f"l{k:02d}": ["".join(chr(0x4E00 + k * 40 + int(rng.random() ** 2 * 900)) for _ in range(700))] for k in range(5)} | {"small": ["abc abd bca " * 20]}
    parser = langid.Parser(samples)
    assert len(parser.keys) > 1000
    texts = ["".join(rng.choice(samples[f"l{k % 5:02d}"][0]) for _ in range(rng.choice([1, 30, 1500]))) + "abc" * (k % 2) for k in range(30)] + ["", "...", "zzz\U00020000"]
    h, size = parser.entropies(texts)
    for i, text in enumerate(texts):
        symbols = langid.letters([text])[0].tolist()
        assert size[i] == len(symbols)
        for j, lang in enumerate(parser.languages):
            sample = "".join(map(chr, langid.letters([samples[lang][0] + " "])[0].tolist()))
            want = plain_phrases(sample, "".join(map(chr, symbols))) * parser.scale[j] / max(1, len(symbols))
            assert h[i, j] == pytest.approx(want)


def test_sixty_four_large_alphabets_stay_small():
    rng = random.Random(19)
    streams = {f"l{k:02d}": ["".join(chr(0x4E00 + rng.randrange(3000) + k * 100) for _ in range(6000))] for k in range(64)}
    parser = langid.Parser(streams)
    used = sum(x.nbytes for x in (parser.table, parser.keys, parser.values, parser.restart, parser.code))
    dense = sum(2 * 6000 * len(set(t[0])) * 4 for t in streams.values())
    assert used < 200 << 20 and used < dense / 20


def test_vectors_of_one_id_have_links_of_their_own(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    near = lambda v: [x + 0.01 * (i + 1) for i, x in enumerate(v)]
    rows = [(5, a), (5, b), (3, a), (8, near(b)), (9, c), (9, near(c)), (2, near(c)), (4, [1.0, 1.0, 1.0]), (4, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, label int, node string, rep int").repartition(4)
    unit = [np.array(x) / np.linalg.norm(x) for _, x in rows]
    links = [sum(j != i and float(unit[i] @ unit[j]) >= 0.98 for j in range(len(rows))) for i in range(len(rows))]
    component = {5: 3, 3: 3, 8: 3, 9: 2, 2: 2, 4: 4}
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(spark, df).collect())
    assert got == sorted((i, n, component[i], i == component[i]) for (i, _), n in zip(rows, links, strict=True))


def test_no_vectors_have_no_neighbours(spark):
    v = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert ann.nearest(spark, v, v).count() == 0 and ann.nearest(spark, v.limit(0), v).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert ann.nearest(spark, one, one).count() == 0
    assert [(r.query_id, r.vec_id) for r in ann.nearest(spark, one, spark.createDataFrame([(7, [1.0, 0.0])], one.schema)).collect()] == [(7, 50)]


# Match lengths of tied suffixes


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_common_lengths_of_neighbours():
    draw = random.Random(11)
    rows = sorted(bytes(draw.choice(b"\x00ab\xff") for _ in range(draw.randrange(0, 9))) for _ in range(200)) + [b"", b"", b"a\x00", b"a"]
    got = suffix_dedup.common_lengths(pa.array(rows, pa.binary()))
    assert got.tolist() == [common(a, b) for a, b in zip(rows, rows[1:], strict=False)]
    part = pa.array([b"zz", *rows], pa.binary()).slice(1, 50)
    assert suffix_dedup.common_lengths(part).tolist() == got.tolist()[:49]
    assert suffix_dedup.common_lengths(pa.array([b"one"], pa.binary())).tolist() == []


@pytest.mark.parametrize("letters", ["after", "before"])
def test_scan_keeps_windows_within_the_longest_match(letters):
    draw, window, gram = random.Random(5), 12, 4
    rows = []
    for i in range(120):
        after, before = draw.randrange(0, 9), draw.randrange(0, 9)
        at = 100 * i + 50
        # An interval lies within window - gram of its place.
        lo, hi = at - before, min(at, at + after + gram - window) if after + gram >= window - before else at - before
        text = bytes(draw.choice(b"ab") for _ in range(8))
        rows.append((draw.randrange(3), i, lo, max(lo, hi), at, text[:after], text[:before]))
    place = 5 if letters == "after" else 6
    rows.sort(key=lambda r: (r[0], r[place]))
    names = ["core", "rid", "lo", "hi", "at", "after", "before"]
    kinds = [pa.int64()] * 5 + [pa.binary()] * 2
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    batches = [whole.slice(0, 1), whole.slice(1, 0), whole.slice(1, 50), whole.slice(51, 1), whole.slice(52)]
    got = [r for b in suffix_dedup._match_lengths(letters, window, gram, 1)(batches) for r in b.to_pylist()]
    assert [r["rid"] for r in got] == [r[1] for r in rows]
    assert letters not in got[0]
    for k, (core, _, lo, hi, at, *_) in enumerate(rows):
        best = max((common(rows[k][place], o[place]) for i, o in enumerate(rows) if i != k and o[0] == core), default=-2 * window)
        if k in (0, len(rows) - 1):
            best = window
        want = (lo, min(hi, at + gram + best - window)) if letters == "after" else (max(lo, at - best), hi)
        assert (got[k]["lo"], got[k]["hi"]) == want


@pytest.mark.parametrize("words", [False, True])
def test_matches_shorter_than_a_window_are_dropped_by_the_scan(spark, words):
    """A passage of all texts inside letters of their own: of its tied suffixes only windows that
    lie in the passage are left, whatever the range that a suffix falls into."""
    draw, window, gram = random.Random(8), 24, 6
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(40))
    rows = [(i, " ".join([*[word() for _ in range(30)], passage, *[word() for _ in range(30)]])) for i in range(60)]
    index = suffix_dedup.RepeatIndex(spark, window, gram, words=words)
    sizes = {}
    plain = index._order

    def order(tied):
        sizes["before"] = tied.selectExpr("sum(aggregate(places, 0L, (s, p) -> s + p.hi - p.lo + 1))").first()[0]
        out = plain(tied)
        sizes["after"] = out.selectExpr("sum(hi - lo + 1)").first()[0]
        return out

    index._order = order
    try:
        docs = spark.createDataFrame(rows, "rid long, text string")
        index.add(docs, 2)
        cut = {r.rid: r.kept_text for r in suffix_dedup.cut_texts(index, docs).collect()}
    finally:
        index.close()
    assert sizes["after"] < sizes["before"]
    assert set(cut) == set(range(60))
    for i, text in rows:
        assert passage not in cut[i]
        assert len(cut[i].split()) >= 58 if words else len(cut[i]) <= len(text) - len(passage)


def test_op9_tells_passages_shorter_than_its_bytes(spark, tmp_path):
    """Passages of 48 to 60 short words repeat in 400 bytes nowhere, a string of 400 letters is no
    passage: the contract's columns and the further ones each follow their own rule."""
    draw = random.Random(8)

    def words(n):
        return [f"{draw.getrandbits(20):05x}" for _ in range(n)]

    short = {n: words(n) for n in (47, 48, 55, 60)}
    texts = [words(30) + p + words(20) for p in short.values() for _ in range(2)] + [words(300), ["q" * 450], words(5) + ["q" * 450]]
    lists = [*texts, [], []]
    rows = [(i, None if i == len(texts) else " ".join(w)) for i, w in enumerate(lists)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffix_dedup.op9_suffix_dedup(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    count = {}
    for w in lists:
        for k in range(len(w) - 47):
            count[tuple(w[k : k + 48])] = count.get(tuple(w[k : k + 48]), 0) + 1
    for (i, text), w in zip(rows, lists, strict=True):
        hit = [k for k in range(len(w) - 47) if count[tuple(w[k : k + 48])] > 1]
        gone = {j for k in hit for j in range(k, k + 48)}
        r = got[i]
        assert (r.n_passages, r.passage_bytes) == (bool(hit), len(" ".join(w[j] for j in sorted(gone))))
        assert (None if text is None else [x for j, x in enumerate(w) if j not in gone]) == (None if r.text is None else r.text.split())
        long = "q" in (text or "")
        assert (r.n_removed > 0, r.n_spans) == (long, int(long))
        assert r.n_bytes == len(text or "")
        assert long or r.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert {i for i, r in got.items() if r.n_passages} == {2, 3, 4, 5, 6, 7}
