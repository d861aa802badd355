"""Facts that the operators must hold, on small tables."""

import pytest
from pyspark.sql import functions as F

from loomseq import sources
from loomseq.functions import sequences as S
from loomseq.functions import text as T
from loomseq.operators import evaluation as E
from loomseq.operators import joins as J
from loomseq.operators import qc, scoring
from loomseq.operators import windows as W


def test_tiles_add_up_and_cross_chunks(spark):
    s = "".join("ACDEFGHIKLMNPQRSTVWY"[(i * i + 3 * i) % 20] for i in range(9000))
    df = spark.createDataFrame([(1, s), (2, "ACD"), (3, "")], "id int, seq string")
    w = S.windows(df, "seq", [3, 9]).collect()
    assert len(w) == (9000 - 2) + (9000 - 8) + 1
    assert all(s[r.pep_start - 1 : r.pep_start - 1 + r.pep_len] == r.peptide for r in w if r.id == 1)
    assert len({(r.id, r.pep_len, r.pep_start) for r in w}) == len(w)


def test_translation(spark):
    r = spark.createDataFrame([("ATGGCCTAA",), ("ATGNNNGC",), ("",)], "dna string").select(S.translate_codons(F.col("dna")).alias("aa"), S.reverse_complement(F.col("dna")).alias("rc")).collect()
    assert [x.aa for x in r] == ["MA", "MX", ""]
    assert r[0].rc == "TTAGGCCAT"


def test_reference_windows_do_not_cross_other_letters(spark):
    ref = spark.createDataFrame([("ACDEFXGHIKL",)], "seq string")
    assert {r.peptide for r in J.reference_windows(ref, "seq", [5]).collect()} == {"ACDEF", "GHIKL"}


def test_hit_rules_fail_on_missing_numbers(spark):
    df = spark.createDataFrame([(100.0, 1e-6, 95.0), (99.9, 1e-6, 95.0), (None, 1e-3, 10.0)], "i double, e double, c double")
    got = [r[0] for r in df.select(qc.reason_text(qc.hit_reasons(F.col("i"), F.col("e"), F.col("c")))).collect()]
    assert got == ["", "identity_not_exact", "identity_not_exact;evalue_too_high;coverage_too_low"]


def test_nan_does_not_pass_a_threshold(spark):
    df = spark.createDataFrame([(float("nan"), 0.0)], "t double, c double")
    r = df.select(qc.expression_reasons(F.col("t"), F.col("c"), 1.0, 1.0, 0.0).alias("r")).first().r
    assert "tumor_low" in r and "fold_low" in r


def test_sequence_reasons_name_letters(spark):
    df = spark.createDataFrame([("ACDEFGHIK*",), ("AC-DEFGHIKLB1",), ("",), ("ACD",)], "s string")
    got = [r[0] for r in df.select(qc.reason_text(qc.sequence_reasons(S.normal_sequence(F.col("s"))))).collect()]
    assert got == ["", "gap;noncanonical:1B", "empty", "too_short"]


def test_subtraction_keeps_evidence(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x", "donor1")], "k string, why string")
    assert {(r.k, r.excluded, r.why) for r in J.subtract(a, b, ["k"], ["why"]).collect()} == {("x", True, "donor1"), ("y", False, None)}


def test_overlap_counts_each_pair_once(spark):
    left = spark.createDataFrame([(1, "c", 0, 1000), (2, "c", 99, 101)], "l int, chrom string, a long, b long")
    right = spark.createDataFrame([(1, "c", 50, 900), (2, "c", 101, 150), (3, "d", 0, 10)], "r int, chrom string, c long, d long")
    got = sorted((x.l, x.r) for x in J.overlap(left, right, ["chrom"], 100, ("a", "b"), ("c", "d")).collect())
    assert got == [(1, 1), (1, 2), (2, 1)]


def test_merged_intervals_are_apart(spark):
    df = spark.createDataFrame([("c", 0, 10), ("c", 7, 20), ("c", 20, 25), ("c", 100, 120)], "chrom string, a long, b long")
    assert sorted((r.a, r.b, r.island) for r in W.merge_intervals(df, ["chrom"], "a", "b").collect()) == [(0, 25, 1), (100, 120, 2)]


def test_cap_marks_only_eligible_rows(spark):
    df = spark.createDataFrame([("g", i, i % 2 == 0) for i in range(10)], "g string, v int, ok boolean")
    r = W.ranked_cap(df, ["g"], ["v"], 3, eligible=F.col("ok")).collect()
    assert sorted(x.v for x in r if x.selected) == [0, 2, 4]
    assert len(r) == 10


def test_samples_are_nested(spark):
    df = spark.range(100).withColumn("s", (F.col("id") % 3).cast("int"))
    rows = W.nested_sample(df, ["s"], F.md5(F.col("id").cast("string")), [0.01, 0.3, 0.6]).collect()
    of = {f: {r.id for r in rows if r.fraction == f} for f in (0.01, 0.3, 0.6)}
    assert of[0.01] < of[0.3] < of[0.6] and len(of[0.01]) == 3


def test_auroc_counts_ties_half(spark):
    df = spark.createDataFrame([("g", 1, 0.9), ("g", 0, 0.5), ("g", 1, 0.5), ("g", 0, 0.1)], "g string, y int, s double")
    assert E.ranking_metrics(df, ["g"], "y", "s").first().auroc == pytest.approx(0.875)


def test_reliability_keeps_empty_bins(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.05)], "y int, s double")
    assert [(r.bin, r.n) for r in E.reliability(df, "y", "s", 4).orderBy("bin").collect()] == [(0, 1), (1, 0), (2, 0), (3, 1)]


def test_strict_alignment_reports_both_sides(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("z",)], "k string")
    r = J.strict_align(a, b, ["k"]).first()
    assert (r.left_only, r.right_only, r.repeated, r.blank) == (1, 1, 1, 0)


def test_failing_scorer_gives_error_rows(spark):
    t = spark.createDataFrame([("", "A", "hydropathy", "I"), ("ACD", "B", "hydropathy", "I"), ("ACD", "B", "nobody", "I")], "peptide string, hla_allele string, algorithm string, mhc_class string")
    got = {(r.hla_allele, r.algorithm): r.status for r in scoring.score_tasks(t).collect()}
    assert got == {("A", "hydropathy"): "error", ("B", "hydropathy"): "ok", ("B", "nobody"): "skipped"}


def test_own_label_does_not_change_a_prediction(spark):
    """A row whose label is turned keeps its score; rows of one group share a fold."""
    rows = [(i, "ACDK"[i % 4] * (3 + i % 5) + "LV" * (i // 4 % 6), int(i % 4 < 2) if i % 7 else i % 2) for i in range(60)]

    def scores(rows):
        df = spark.createDataFrame(rows, "id int, seq string, y int")
        return {r.id: r for r in scoring.out_of_fold(spark, df, "seq", "y", group="seq").collect()}

    base = scores(rows)
    assert len(base) == 60 and all(r.score is not None for r in base.values())
    assert len({(r.seq, r.fold) for r in base.values()}) == len({r.seq for r in base.values()})
    same = [i for i in base if base[i].seq == rows[5][1]]
    turned = scores([(i, s, 1 - y if i in same else y) for i, s, y in rows])
    assert all(turned[i].score == pytest.approx(base[i].score, abs=1e-9) for i in same)
    assert any(abs(turned[i].score - base[i].score) > 1e-9 for i in base if base[i].fold != base[5].fold)


def test_one_group_has_no_out_of_fold_score(spark):
    df = spark.createDataFrame([("ACD", 0), ("ACD", 1)], "seq string, y int")
    assert [(r.score, r.prediction) for r in scoring.out_of_fold(spark, df, "seq", "y", group="seq").collect()] == [(None, None)] * 2


def test_tags_and_names(spark):
    df = spark.createDataFrame([("r1/1|YP:9,7,,9|X:",)], "h string")
    r = df.select(T.tag_list(F.col("h"), "YP").alias("t"), T.tag(F.col("h"), "X").alias("x"), T.fragment_id(F.col("h")).alias("f"), T.base_name(F.lit("T.2-3.p4")).alias("b")).first()
    assert r.t == ["7", "9"] and r.x is None and r.f == "r1" and r.b == "T"


def test_contract_raises(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    with pytest.raises(ValueError, match="negative"):
        qc.require(df, negative=F.col("v") < 0)
    with pytest.raises(ValueError, match="missing"):
        sources.require_columns(df, ["w"])


def test_long_typing_row(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("A\t" + "\t".join(f"A*{i // 100 + 10}:{i % 100:02}" for i in range(150)) + "\nB\n")
    got = sources.hla_typing(spark, str(tmp_path / "t.tsv"))
    assert got.count() == 150 and got.where("gene <> 'A'").count() == 0


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k string, a long, b long")
    assert J.overlap(e, e.select(F.col("k"), F.col("a").alias("c"), F.col("b").alias("d")), ["k"], 10, ("a", "b"), ("c", "d")).count() == 0
    assert W.merge_intervals(e, ["k"], "a", "b").count() == 0
    assert S.windows(e.select(F.col("k").alias("seq"), "a"), "seq", [3]).count() == 0


def test_cap_of_rows_that_repeat_throughout(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), (None, 2), (None, 2)], "g string, v int")
    got = [(r.g, r.selected) for r in W.ranked_cap(df, ["g"], ["v"], 1).collect()]
    assert sorted(got, key=str) == sorted([("a", True), ("a", False), ("a", False), (None, True), (None, False)], key=str)


def test_ranks_and_running_maximum_over_ranges(spark):
    """One group holds nearly all rows, some keys are null or tie; against a plain loop."""
    rows = [("hot" if i % 50 else None if i % 100 else "b", (i * 7919) % 1000, i, i % 13) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, v int, id int, w int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = W.in_ranges(df, ["g"], ["v", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges.select("__part").distinct().count() > 1
    ranked = {r.id: r.n for r in W.source_rank(df, ["g"], ["v", "id"], "n").collect()}
    sums = {r.id: r.s for r in W.running(ranges, ["g"], ["v", "id"], F.col("w"), "s").collect()}
    most = {r.id: r.m for r in W.running(ranges, ["g"], ["v", "id"], F.col("w"), "m", F.max, F.lit(None)).collect()}
    for g in ("hot", "b", None):
        total, top = 0, None
        for n, (_, _, i, w) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])), 1):
            assert ranked[i] == n and sums[i] == total and most[i] == top
            total, top = total + w, w if top is None else max(top, w)


def test_percentile_against_a_loop(spark):
    scores, values = [(i, float(i % 17)) for i in range(60)] + [(99, None)], [float((i * i) % 23) for i in range(200)]
    s = spark.createDataFrame(scores, "id int, s double")
    got = {r.id: r.pct for r in W.percentile_among(s, "s", spark.createDataFrame([(v,) for v in values], "v double"), "v").collect()}
    for i, x in scores:
        want = None if x is None else 100 * (sum(v < x for v in values) + 0.5 * sum(v == x for v in values)) / len(values)
        assert got[i] == (None if want is None else pytest.approx(want))


def test_windows_of_long_sequences_are_distinct(spark, monkeypatch):
    monkeypatch.setattr(S, "DISTINCT_CHUNK", 100)
    long = "".join("ACDEF"[(i * i) % 5] for i in range(950))
    df = spark.createDataFrame([(1, long), (2, "ACDACDACD"), (3, "AC"), (4, "")], "id int, seq string")
    got = S.distinct_windows(df, "seq", 3, "id").collect()
    want = {(i, s[k : k + 3]) for i, s in ((1, long), (2, "ACDACDACD")) for k in range(len(s) - 2)}
    assert len(got) == len(want) and {(r.id, r.peptide) for r in got} == want
    facts = {r.id: r for r in S.window_summary(df, "seq", [3], "id").collect()}
    for i, s in ((1, long), (2, "ACDACDACD")):
        w = [s[k : k + 3] for k in range(len(s) - 2)]
        assert (facts[i].n_windows, facts[i].n_distinct, facts[i].first_pep, facts[i].last_pep) == (len(w), len(set(w)), min(w), max(w))
    assert set(facts) == {1, 2}


def test_support_catalog_rules(spark, tmp_path):
    (tmp_path / "catalog.tsv").write_text("# tool\talleles\nnet\tHLA-A*02:01\t9\nnet\tHLA-A*02:01\t10\nnet\tB0702\n\n-----\nnet\tA*01:01 old\n\tA*03:01\n")
    catalog = sources.allele_support(spark, str(tmp_path / "catalog.tsv"))
    assert {(r.algorithm, tuple(r.lengths) if r.lengths else None) for r in catalog.collect()} == {("net", (9, 10)), ("net", None)}
    rows = [("A" * 9, "A*02:01", "net", "run"), ("A" * 8, "A*02:01", "net", "skipped"), ("A" * 8, "HLA-B*07:02", "net", "run"), ("A" * 9, "A*01:01", "net", "skipped"), ("A" * 9, "A*01:01", "other", "run"), ("A" * 9, None, "net", "skipped")]
    tasks = spark.createDataFrame(rows, "peptide string, hla_allele string, algorithm string, want string")
    got = sources.route_by_support(tasks, catalog).collect()
    assert len(got) == len(rows) and all(r.action == r.want for r in got)


def test_shards_with_another_header_are_refused(spark, tmp_path):
    for name, text in (("a", "x\ty\n1\t2\n"), ("b", "x\ty\n3\t4\n"), ("c", "y\tx\n5\t6\n")):
        (tmp_path / name).write_text(text)
    a, b, c = (str(tmp_path / n) for n in "abc")
    assert sorted(tuple(r) for r in sources.shards(spark, [a, b]).collect()) == [("1", "2"), ("3", "4")]
    with pytest.raises(ValueError, match="headers differ"):
        sources.shards(spark, [a, c])


def test_six_digits(spark):
    values = [0.0, 1.0, 500.0, 123456.0, 1234567.0, 0.0001, 0.00001234567, -2.5, 1e-300, 1.5e300, 100000.4, 999999.6, float("inf"), None]
    want = ["0", "1", "500", "123456", "1.23457e+06", "0.0001", "1.23457e-05", "-2.5", "1e-300", "1.5e+300", "100000", "1e+06", "inf", None]
    assert [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").coalesce(1).select(T.six_digits(F.col("x"))).collect()] == want


def test_features_of_a_known_peptide(spark):
    """Published values of the indices for FLPVLAGLTPSIVPKLVCLLTKKC."""
    s = F.col("s")
    r = spark.createDataFrame([("FLPVLAGLTPSIVPKLVCLLTKKC",), ("",)], "s string").select(S.per_letter(s, S.SOLUBILITY).alias("boman"), S.aliphatic_index(s).alias("aliphatic"), S.isoelectric_point(s).alias("pi"), S.net_charge(s).alias("charge"), S.charge_at(S.letter_counts(s, "KRHDECY"), F.lit(9.0), S.EMBOSS).alias("at9")).collect()
    assert r[0].boman == pytest.approx(-1.2358, abs=1e-4)
    assert r[0].aliphatic == pytest.approx(100 * (1 + 3 * 2.9 + 7 * 3.9) / 24)
    assert r[0].charge == pytest.approx(2.9, abs=0.15)
    assert r[1].boman is None and r[1].aliphatic is None
    back = spark.createDataFrame([("FLPVLAGLTPSIVPKLVCLLTKKC", r[0].pi)], "s string, pi double").select(S.charge_at(S.letter_counts(s, "KRHDECY"), F.col("pi"), S.EMBOSS)).first()[0]
    assert abs(back) < 1e-6


def test_place_in_window_and_ablation(spark):
    cases = [((5, 5, 3, 9), "3"), ((5, 7, 3, 9), "3-5"), ((2, 3, 3, 9), None), ((11, 12, 3, 9), None), ((11, 11, 3, 9), "9")]
    df = spark.createDataFrame([c[0] for c in cases], "a int, b int, s int, k int").coalesce(1)
    assert [r[0] for r in df.select(S.place_in_window(F.col("a"), F.col("b"), F.col("s"), F.col("k"))).collect()] == [c[1] for c in cases]
    assert spark.range(1).select(S.ablated(F.array(*[F.lit(float(i)) for i in range(1, 7)]), 2, 3)).first()[0] == [1, 2, 0, 0, 0, 6]


def test_tokens_have_the_length_of_the_data(spark):
    df = spark.createDataFrame([(1, "ACX", "D"), (2, "A", "")], "id int, p string, h string")
    t = df.select("id", S.encode_tokens(F.array(F.lit(0.5)), F.col("p"), F.col("h"), S.AMINO_ACIDS, 2).alias("x"))
    got = {r.id: r.x for r in S.to_length(t, "x").collect()}
    assert got == {1: [0.5, 1, 2, 0, 0, 0, 3], 2: [0.5, 1, 0, 0, 0, 0, 0]}
    assert all(len(r.x) == 3 for r in S.to_length(t, "x", 3).collect())


def test_bootstrap_covers_and_groups_are_drawn_together(spark):
    rows = [(i, i // 50, float((i * 37) % 11) - 4.5) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, cluster int, d double")
    one = E.bootstrap(df, [], "id", "d", 300).first()
    mean = sum(r[2] for r in rows) / 1000
    spread = (sum((r[2] - mean) ** 2 for r in rows) / 1000) ** 0.5 / 1000**0.5
    assert one.n == 1000 and one.mean == pytest.approx(mean)
    assert one.low == pytest.approx(mean - 1.96 * spread, abs=spread) and one.high == pytest.approx(mean + 1.96 * spread, abs=spread)
    assert one.above_zero > 0.99
    constant = df.withColumn("d", (F.col("cluster") % 2).cast("double"))
    wide, narrow = (E.bootstrap(constant, [], k, "d", 300).first() for k in ("cluster", "id"))
    assert wide.high - wide.low > 3 * (narrow.high - narrow.low)


def test_permutation_p_values(spark):
    df = spark.createDataFrame([(i, 1.0 + (i % 3), 0.001 * (-1) ** i) for i in range(200)], "id int, far double, near double")
    assert E.permutation_test(df, [], "id", F.col("far"), 99).first().p_value == pytest.approx(0.01)
    assert E.permutation_test(df, [], "id", F.col("near"), 99).first().p_value > 0.3


def test_fingerprint_is_of_a_set(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "")], "k int, v string")
    b = spark.createDataFrame([(3, ""), (2, None), (1, "x"), (1, "x")], "k int, v string")
    c = spark.createDataFrame([(3, None), (2, ""), (1, "x")], "k int, v string")
    one, two, other = (tuple(E.fingerprint(d, ["k", "v"]).first()) for d in (a, b, c))
    assert one == two and one[0] == other[0] == 3 and one != other
    assert tuple(E.fingerprint(a.where("false"), ["k"]).first()) == (0, 0, 0)


def test_jobs_are_homogeneous_and_hot_ones_are_dealt(spark):
    rows = [(f"{'ACDEFGHIKL'[i % 10]}{i:07}", "A", "hydropathy") for i in range(1000)] + [("ACD", "B", "length_logistic"), ("ACD", None, "nobody"), (None, "B", "hydropathy")]
    t = spark.createDataFrame(rows, "peptide string, hla_allele string, algorithm string")
    got = scoring.job_chunks(t, 100).collect()
    assert len(got) == len(rows)
    hot = [r.chunk for r in got if r.hla_allele == "A"]
    assert set(hot) == set(range(10)) and max(hot.count(c) for c in range(10)) < 160
    assert {(r.family, r.length, r.chunk) for r in got if r.hla_allele != "A"} == {("linear", 3, 0), ("", 3, 0), ("linear", 0, 0)}


def test_registered_scale_equals_a_loop(spark):
    import pandas as pd

    p = pd.DataFrame({"peptide": ["ACDX", "KKR", "W"]})
    want = [sum(S.HYDROPATHY.get(c, 0.0) for c in x) / len(x) for x in p["peptide"]]
    assert scoring.hydropathy(p).tolist() == pytest.approx(want)


def test_ngram_features_equal_tf_idf(spark):
    """With as many buckets as keep n-grams apart: sorted weights against a plain count."""
    import math
    from collections import Counter

    texts = ["ACCA", "CAD", "A", "DDDD"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seq string")
    got = scoring.ngram_features(df, "seq", 3, 1 << 18).transform(df).collect()
    grams = [Counter(t[k : k + n] for n in (1, 2, 3) for k in range(len(t) - n + 1)) for t in texts]
    found = Counter(g for c in grams for g in c)
    for r in got:
        want = sorted(n * math.log((len(texts) + 1) / (found[g] + 1)) for g, n in grams[r.id].items())
        assert sorted(r.features.values.tolist()) == pytest.approx(want)


def test_ngram_classifier_learns(spark):
    df = spark.createDataFrame([(i, "ACDACD" * 3 if i % 4 else "CADKKW" * 3, int(i % 4 == 0)) for i in range(60)], "id int, seq string, y int")
    for most in (3, 4):
        model, rows = scoring.ngram_classifier(df, "seq", "y", most)
        assert model.transform(rows).where("prediction <> label").count() == 0
