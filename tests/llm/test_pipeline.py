"""The corpus pipeline: stages in order, their decisions, and a brute-force check of what
each stage must do to its own input."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from loomseq.llm import toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in P.STAGES:
        out.append(P.materialise(spark, stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == P.COLUMNS
    assert "sequence_id" in stages[-1].columns


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scorer = toxicity.fit(spark, stages[0].select("doc_id", "text"), toxicity.learnable(labels))
    want = {r.doc_id for r in toxicity.score(stages[0].select("doc_id", "text"), scorer).where("predicted = 0").collect()}
    assert {r.doc_id for r in stages[1].collect()} == want
    assert stages[1].count() < stages[0].count()


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    kept = {r.doc_id for r in stages[2].collect()}

    def shingles(t):
        w = t.translate({c: c + 32 for c in range(65, 91)}).split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in before.items()}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = collections.Counter((a, b) for ids in where.values() for k, a in enumerate(ids) for b in ids[k + 1 :])
    root = {i: i for i in before}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert kept == {i for i in before if find(i) == i}


def test_repeats_go_and_clean_documents_stay(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    lists = {i: t.split() for i, t in before.items()}
    n = P.PASSAGE
    count = collections.Counter(tuple(w[k : k + n]) for w in lists.values() for k in range(len(w) - n + 1))
    cut = 0
    for i, w in lists.items():
        mark = [False] * len(w)
        for k in range(len(w) - n + 1):
            if count[tuple(w[k : k + n])] > 1:
                mark[k : k + n] = [True] * n
        if not any(mark):
            assert after[i] == before[i]
        else:
            cut += 1
            assert after.get(i, "").split() == [x for x, m in zip(w, mark, strict=True) if not m]
    assert cut > 3


def test_secrets_are_redacted(stages):
    from loomseq.llm.secrets import find_secrets

    assert stages[4].count() == stages[3].count()
    base = F.size(F.filter("secret_spans", lambda s: s["kind"].isin(1, 2)))
    assert find_secrets(stages[4]).where(base > 0).count() == 0
    assert stages[4].where(F.col("n_chars") != F.length("text")).count() == 0


def test_all_tokens_are_packed(stages):
    p = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert p.where("n <> m").count() == 0
    assert p.count() == stages[4].count()


def test_repeated_rows_survive_once(spark):
    """Documents that are listed twice, or have copies with a null doc_id."""
    texts = [" ".join(f"t{t}w{k}" for k in range(120)) for t in range(5)]
    near = texts[4].replace("t4w7 ", "other ")
    rows = [(7, texts[0]), (7, texts[0]), (None, texts[1]), (3, texts[1]), (None, texts[2]), (None, texts[2])]
    rows += [(9, texts[3]), (8, texts[4]), (8, near), (None, near), (1, ""), (1, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    once = P.materialise(spark, P.stage_near_duplicates(spark, docs, SF), "test-once")
    assert once.columns == P.COLUMNS
    got = collections.Counter((r.doc_id, r.text) for r in once.collect() if r.text)
    eight = {(8, texts[4]), (8, near)} & set(got)
    assert len(eight) == 1
    assert got == collections.Counter([(7, texts[0]), (3, texts[1]), (None, texts[2]), (9, texts[3]), *eight])
    after = P.materialise(spark, P.stage_repeats(spark, once, SF), "test-after")
    assert collections.Counter((r.doc_id, r.text) for r in after.collect() if r.text) == got


ODD_ROWS = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, "plain words of a text that holds nothing odd at all", "en", "a", 51),
    (3, "plain words of a text that holds nothing odd at all", "en", "a", 51),
    (4, " ".join(f"w{k}" for k in range(60_000)), "en", "b", 1),
    (None, "token=abcdefghij and no id", None, None, None),
    (5, "  \n\t ", "de", "c", 5),
]


def odd_documents(spark, rows):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted long, rid string, secret_spans string, clean int, kept_text string, component_id string"
    return spark.createDataFrame([(*r, "x", 7, "x", "x", 1, "x", "x") for r in rows], kind)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_on_odd_rows(spark, name):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns."""
    stage = dict(P.STAGES)[name]
    got = stage(spark, odd_documents(spark, ODD_ROWS), SF)
    if name == "packing":
        tokens = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
        assert {r.doc_id for r in tokens} == {1, 2, 3, 4, 5, None}
        assert all(r.n == (2 * r.t if r.doc_id == 3 else r.t) for r in tokens)
        return
    assert got.columns == P.COLUMNS
    rows = collections.Counter((r.doc_id, r.text) for r in got.collect())
    want = collections.Counter((r[0], r[1]) for r in ODD_ROWS)
    if name == "near_duplicates":
        want[ODD_ROWS[2][:2]] = 1
    if name == "secrets":
        assert rows.pop((None, "[SECRET] and no id")) == 1
        del want[ODD_ROWS[5][:2]]
    assert rows == want


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_on_empty_tables(spark, name):
    stage = dict(P.STAGES)[name]
    assert stage(spark, odd_documents(spark, []), SF).count() == 0


@pytest.mark.parametrize("n", [51, 55, 63, 80, 120])
def test_repeated_passages_of_over_50_words_go(spark, n):
    """A passage in documents that otherwise share nothing, inside a line and glued to a
    bracket; every copy goes and the rest of each document stays."""
    word = lambda t, k: f"{'abcdefgh'[t % 8]}{t}q{k}"
    passage = " ".join(word(99, k) for k in range(n))
    own = [" ".join(word(t, k) for k in range(150)) for t in range(4)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]}\n({passage}).\n{own[3]}", own[0].upper()]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in P.stage_repeats(spark, docs, SF).collect()}
    assert got[2].text == texts[2]
    inner = " ".join(passage.split()[1:-1])
    for i in (0, 1):
        assert inner not in got[i].text and got[i].n_chars == len(got[i].text)
        assert all(part in got[i].text for part in own[2 * i : 2 * i + 2])
