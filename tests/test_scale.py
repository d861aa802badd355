"""Findings of the third round: rules that hold at any size, on small inputs."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomseq.functions import maps as M
from loomseq.functions import packed as P
from loomseq.functions.grams import GramCounts
from loomseq.functions import sequences as S
from loomseq.functions import text as T
from loomseq.operators import joins as J
from loomseq.operators import scoring
from loomseq.plans import ORACLE_SQL, QUERIES
from loomseq.plans.deep_queries import mutation_events
from loomseq.plans.sequence_queries import pairs
from tests.test_deep_operators import events, plain_windows

SF = "/root/testdata/sf0.1"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_islands_do_not_depend_on_the_order_of_ties():
    # Rows equal in (chrom, strand, a, b): the one that opens an island must come first in
    # the running sum, whatever order the threads leave them in.
    sql = f"SELECT sum(hash(chrom, strand, island, a, b, n_merged)) FROM ({ORACLE_SQL['w8_interval_merge'].replace('lineitem', 'rows')})"

    def digest(threads, order):
        c = duckdb.connect()
        c.execute(f"SET threads = {threads}")
        c.execute(f"CREATE TABLE rows AS SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_linestatus FROM '{SF}/lineitem.parquet' ORDER BY {order}")
        return c.execute(sql).fetchone()[0]

    assert len({digest(t, o) for t in (1, 8) for o in ("l_orderkey", "hash(l_orderkey, l_linenumber)", "l_quantity")}) == 1


def test_tasks_are_not_dealt_by_class_alone(spark):
    # Two classes would put all peptides into two tasks.
    peptides = spark.createDataFrame([(k // 2, "I" if k // 2 % 2 else "II") for k in range(80)], "peptide long, mhc string")
    alleles = spark.createDataFrame([("I", "A*1"), ("I", "A*2"), ("II", "D*1")], "mhc string, hla string")
    algorithms = spark.createDataFrame([("I", "x"), ("I", "y"), ("II", "x")], "mhc string, algorithm string")
    t = J.task_product(peptides, alleles, algorithms, ["mhc"])
    assert t.columns == ["mhc", "peptide", "hla", "algorithm"]
    assert t.count() == t.distinct().count() == 20 * 2 * 2 + 20
    plan = plan_of(t)
    assert "SortMergeJoin" not in plan_of(t) and "hashpartitioning(mhc#" not in plan_of(t).partition("BroadcastExchange")[0]


def _texts(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("AB") for _ in range(rng.choice([0, 3, 9, 14, 40, 300]))) for _ in range(60)] + ["Z" * 30, "A" * 9, None]
    rows = [(i, rng.choice(["x", "y", None]), t) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "id long, g string, seq string").repartition(2)


def test_windows_are_counted_before_they_are_shuffled(spark):
    rows, df = _texts(spark)
    n = {}
    for _, g, t in rows:
        for w in [(t or "")[i : i + 9] for i in range(len(t or "") - 8)]:
            n.setdefault((g, w), [0, 0])[1] += 1
        for w in {(t or "")[i : i + 9] for i in range(len(t or "") - 8)}:
            n[g, w][0] += 1
    counted = P.counted_windows(df, "seq", 9, ["g"])
    # No more rows than windows of the batches: repeats are gone before any shuffle.
    assert counted.count() <= 2 * len(n) < sum(v[1] for v in n.values())
    got = counted.groupBy("g", P.window_text(F.col("code"), 9).alias("w")).agg(F.sum("n_rows"), F.sum("n_windows")).collect()
    assert {(r[0], r[1]): [r[2], r[3]] for r in got} == n
    back = counted.where(P.window_code(P.window_text(F.col("code"), 9), 9) != F.col("code"))
    assert back.count() == 0


@pytest.mark.parametrize(("k", "buckets", "held"), [(9, 1, 1 << 24), (9, 50, 700), (4, 7, 90), (9, 3, 40)])
def test_window_maps_equal_plain_loops(spark, monkeypatch, k, buckets, held):
    # Several parts, shares and buckets; rows longer than a share; groups without a name.
    monkeypatch.setattr(M, "HELD", held)
    monkeypatch.setattr(M, "LETTERS", min(held, 200))
    rows = [(g, None if i % 9 == 0 else f"s{i % 90}", t) for i, g, t in _texts(spark)[0]]
    want = {}
    for g, h, t in rows:
        for w in {(t or "")[a : a + k] for a in range(len(t or "") - k + 1)}:
            x = want.setdefault(w, [0, set(), set()])
            x[0] += 1
            x[1].add(g)
            x[2].add(h)
    df = spark.createDataFrame(rows, "g string, h string, seq string").repartition(3)
    got = M.window_map(df, "seq", k, ["g", "h"], buckets).collect()
    text = lambda s: ";".join(sorted(s - {None}))
    assert len(got) == len(want)
    assert {r.peptide: (r.n_rows, r.g, r.h) for r in got} == {w: (n, text(g), text(h)) for w, (n, g, h) in want.items()}


def test_window_maps_move_few_bytes(spark):
    # Rows of a number, a count and two names take some 60 bytes a window before compression.
    rng = random.Random(6)
    words = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(rng.randrange(2, 11))) for _ in range(2000)]
    rows = [(f"src{i % 20}", "en", "".join(rng.choice(words) for _ in range(300))) for i in range(400)]
    df = spark.createDataFrame(rows, "source string, lang string, seq string").coalesce(1)
    shares = M.window_shares(df, "seq", 9, ["source", "lang"], 4)
    assert shares.agg(F.sum(F.length("share"))).first()[0] < 4 * sum(len(t) - 8 for *_, t in rows)
    plan = plan_of(QUERIES["a1_peptide_map"](spark, "/root/testdata/sf0.001"))
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(bucket") == 1


def test_numbers_of_dealt_windows_are_found_again():
    rng = random.Random(7)
    for k in range(1, 10):
        codes = np.array([0, 26**k - 1, *[rng.randrange(26**k) for _ in range(1000)]])
        dealt = M._dealt(codes, k)
        assert 0 <= dealt.min() and dealt.max() < 26**k and (M._dealt(dealt, k, back=True) == codes).all()


def test_window_facts_shuffle_no_window(spark):
    rows, df = _texts(spark)
    f = P.window_facts(df, "seq", [3, 9, 15, 17], "id")
    want = {}
    for i, _, t in rows:
        for k in (3, 9, 15, 17):
            w = [(t or "")[a : a + k] for a in range(len(t or "") - k + 1)]
            if w:
                want[i, k] = (len(w), len(set(w)), min(w), max(w))
    assert {(r.id, r.pep_len): tuple(r)[2:] for r in f.collect()} == want
    assert "Exchange hashpartitioning" not in plan_of(f)


def test_windows_of_mutants_are_not_shuffled(spark):
    rows = [(1, "AAAACDEFGH", "AAAACDKFGH", 6, 7), (2, "ABABABABABAB", "ABABABABAB", 10, 10), (3, "ABC", "ABD", 2, 3)]
    df = spark.createDataFrame(rows, "id long, wt string, mt string, prefix int, mt_end int")
    want = {}
    for i, w, m, p, e in rows:
        s = [a for a in range(len(m) - 3) if (a < e and a + 4 > p if e > p else a < p < a + 4)]
        if s:
            want[i] = (len(s), sum(m[a : a + 4] == w[a : a + 4] for a in s))
    c = S.covered_counts(df, "id", "mt", "wt", 4, chunk=2)
    assert {r.id: (r.n_windows, r.n_same) for r in c.collect()} == want
    assert "Join" not in plan_of(c)


def test_windows_of_mutants_are_summed_up_where_they_are(spark):
    rows = events()
    df = spark.createDataFrame(rows, "event_id long, wt string, mt string, frameshift boolean")
    f = S.mutation_facts(df, [9, 4], 13, chunk=7)
    want = {}
    for e, wt, mt, fs in rows:
        for k in (9, 4) if mt is not None else ():
            if w := plain_windows(e, wt, mt, bool(fs), k, 13):
                _, _, starts, peptides, wild, low, high = zip(*w)
                want[e, k] = (len(w), starts[0], starts[-1], sum(x is not None for x in wild), sum(low), sum(high) - sum(low), hashlib.md5(",".join(peptides).encode()).hexdigest())
    assert {tuple(r)[:2]: tuple(r)[2:] for r in f.collect()} == want and len(want) > 100
    # Windows are no rows, which would have to be collected and sorted again by event.
    for plan in (plan_of(f), plan_of(QUERIES["f13_covering_windows"](spark, "/root/testdata/sf0.001"))):
        assert "Generate" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("k", [4, 9, 12])
def test_windows_of_mutants_are_counted_where_they_are(spark, k):
    rows = events()
    df = spark.createDataFrame(rows, "event_id long, wt string, mt string, frameshift boolean")
    want = {}
    for e, wt, mt, fs in rows:
        if mt is not None and (w := plain_windows(e, wt, mt, bool(fs), k, 13)):
            want[e] = (len(w), len({x[3] for x in w}))
    for chunk in (7, 1 << 16):
        assert {r.event_id: tuple(r)[1:] for r in S.mutation_counts(df, k, 13, chunk).collect()} == want
    # Neither windows nor sequences are moved to the events.
    plan = plan_of(QUERIES["p27_event_steps"](spark, "/root/testdata/sf0.001"))
    assert "count(distinct" not in plan and "event_id#" in plan and "REPARTITION" not in plan
    assert not [line for line in plan.splitlines() if "SortMergeJoin" in line and "mt#" in line]


def test_only_first_letters_of_the_mutant_are_moved(spark):
    # A text whose first 400 characters hold fewer than 40 letters gives its later ones.
    e = mutation_events(spark, "/root/testdata/sf0.001").collect()
    want = {r.doc_id: (r.wt, r.seq[:40]) for r in pairs(spark, "/root/testdata/sf0.001").collect() if len(r.wt) > 60}
    assert {r.event_id: (r.wt, r.mt) for r in e} == {i: (w, w[: len(w) // 3] + s + w[len(w) // 3 + 20 :]) for i, (w, s) in want.items()}


def test_arrays_are_computed_once(spark):
    # From a plain explode Spark infers a filter that holds the array's expression again.
    df = spark.range(4).select(F.sequence(F.lit(1), "id").alias("a"))
    plan = S.each_of(df, F.transform("a", lambda x: x * 7919), "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("7919") == 1


def test_gram_counts_equal_hashed_terms(spark):
    # The same vectors as from a text of each n-gram, without making these texts.
    from pyspark.ml.feature import HashingTF, NGram

    rng = random.Random(7)
    texts = ["".join(rng.choice("ACDEFGHIKLMNPQRSTVWYZ") for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 50, 3000)]
    texts += ["acd", "AC DE", "\u00c4\u20acA\U0001f600BC\u00e4", "[@Z`{", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seq string").repartition(3)
    got = {r.id: r.tf for r in GramCounts("seq", 5, 1 << 10, "tf").transform(df).collect()}
    terms = df.select("id", F.filter(F.split(F.coalesce("seq", F.lit("")), ""), lambda c: c != "").alias("g1"))
    for n in range(2, 6):
        terms = NGram(n=n, inputCol="g1", outputCol=f"g{n}").transform(terms)
    terms = terms.withColumn("grams", F.concat(*[f"g{n}" for n in range(1, 6)]))
    assert got == {r.id: r.tf for r in HashingTF(numFeatures=1 << 10, inputCol="grams", outputCol="tf").transform(terms).collect()}


def test_gram_counts_are_made_once(spark):
    df = spark.createDataFrame([(i, "ACDACD" * 3 if i % 4 else "CADKKW" * 3, int(i % 4 == 0)) for i in range(40)], "id int, seq string, y int")
    _, rows = scoring.ngram_classifier(df, "seq", "y", 3)
    # The fit's passes and the predictions read stored counts, and no text.
    plan = plan_of(rows)
    assert "Scan parquet" in plan and "MapInArrow" not in plan and "Join" not in plan and "seq" not in rows.columns


def test_six_digits_are_written_once(spark):
    # In branches the formatting was run anew for each use of its parts.
    df = spark.range(8).select(F.coalesce(T.six_digits(F.sqrt("id")), F.lit("")).alias("x"))
    code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    assert code.count("new java.util.Formatter(") == 1


def test_six_digits_of_all_sizes(spark):
    rng = random.Random(11)
    values = [rng.choice([-1, 1]) * rng.randint(100000, 999999) * 10.0 ** rng.randint(-300, 300) for _ in range(300)]
    values += [rng.choice([-1, 1]) * rng.uniform(0.1, 1) * 10.0 ** k for k in range(-8, 9) for _ in range(20)] + [-0.0, float("nan"), float("-inf"), None, 5e-324]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").coalesce(1).select(T.six_digits(F.col("x"))).collect()]
    # Python writes as C does; these values are no ties.
    assert got == [None if v is None else "0" if v == 0 else "4.9e-324" if v == 5e-324 else f"{v:.6g}" for v in values]
