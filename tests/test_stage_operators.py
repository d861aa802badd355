"""Two-stage scoring, support routing, residues, callers, members and duplicate events against
plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from loomseq import sources
from loomseq.operators import stages

KEYS = ["chrom", "pos1", "ref", "alt"]
PREDICTIONS = "at int, peptide string, hla_allele string, algorithm string, mhc_class string, status string, error string, percentile string, extra string"
TASKS = "id int, peptide string, hla_allele string, algorithm string, mhc_class string, status string"


def plain_route(task, rows, limits):
    if not rows:
        return "prediction_missing"
    _, status, error, percentile = max(rows)
    if status == "skipped":
        return "unsupported_allele"
    if status not in ("ok", "partial_ok"):
        return "parse_failed" if "parse" in error.lower() else "task_failed"
    try:
        value = float(percentile)
    except ValueError:
        return "prediction_missing"
    return "stage1_screen_pass" if value < limits[task[4]] else "screened_out_stage1"


def test_stage_one_takes_the_last_prediction(spark):
    draw = random.Random(5)
    tasks = [(i, draw.choice(["PEP", "pep ", "QQQ", "RRR"]), draw.choice(["A1", "A2", "A3"]), "A", draw.choice(["MHC-I", "MHC-II"]), "x") for i in range(60)]
    tasks += [(97, None, "A1", "A", "MHC-I", "x"), (98, " ", "A1", "A", "MHC-I", "x"), tasks[0]]
    rows = []
    for at in range(40):
        rows.append((at, draw.choice(["PEP", " Pep", "QQQ"]), draw.choice(["A1", "A2"]), "A", draw.choice(["MHC-I", "MHC-II"]), draw.choice(["ok", "partial_ok", "failed", "skipped", ""]), draw.choice(["", "cannot PARSE line", "timeout"]), draw.choice(["1.5", "2", "2.5", "", "nan", "-", "10"]), "e"))
    rows += [(80, "RRR", "A1", "A", mhc, "ok", "", "9", "e") for mhc in ("MHC-I", "MHC-II")] + [(81, "rrr", "A1", "A", mhc, "partial_ok", "", "1.5", "e") for mhc in ("MHC-I", "MHC-II")]
    tasks += [(70, "RRR", "A1", "A", "MHC-I", "x"), (71, "RRR", "A1", "A", "MHC-II", "x")]
    rows += [(90, "", "A1", "A", "MHC-I", "ok", "", "0", "e"), (91, None, "A1", "A", "MHC-I", "ok", "", "0", "e"), (92, "PEP", "A1", None, "MHC-I", "ok", "", "0", "e")]
    limits = {"MHC-I": 2.0, "MHC-II": 5.0}
    by_key = {}
    for at, pep, hla, alg, mhc, status, error, pct, _ in rows:
        if pep and pep.strip() and alg:
            by_key.setdefault((pep.strip().upper(), hla, mhc), []).append((at, status, error, "" if pct == "nan" else pct))
    want = sorted((t[0], plain_route(t, by_key.get((t[1].strip().upper(), t[2], t[4])), limits)) for t in tasks if t[1] and t[1].strip())
    p = spark.createDataFrame(rows, PREDICTIONS)
    t = spark.createDataFrame(tasks, TASKS).drop("status").withColumn("note", F.lit("kept"))
    routed = stages.route_stage_one(t, p, limits, ["at"])
    assert sorted((r.id, r.stage_status) for r in routed.collect()) == want
    assert {s for _, s in want} == {"prediction_missing", "unsupported_allele", "parse_failed", "task_failed", "stage1_screen_pass", "screened_out_stage1"}
    assert {r.note for r in routed.collect()} == {"kept"}
    assert stages.unscreened(routed).count() == sum(s not in ("stage1_screen_pass", "screened_out_stage1") for _, s in want)

    passed = {(t[1].strip().upper(), t[2], t[4]) for t in tasks if t[1] and (t[0], "stage1_screen_pass") in want}
    second = stages.stage_two_tasks(routed, {"MHC-I": ["X", "Y", "X"], "MHC-II": []})
    assert sorted(tuple(r) for r in second.collect()) == sorted((pep, hla, a, mhc) for pep, hla, mhc in passed if mhc == "MHC-I" for a in "XY")
    kept = stages.passed_predictions(p, routed).collect()
    assert sorted(r["at"] for r in kept) == sorted(r[0] for r in rows if r[1] and r[3] and (r[1].strip().upper(), r[2], r[4]) in passed)
    assert [f.name for f in stages.passed_predictions(p, routed).schema] == p.columns


def test_stage_one_of_empty_tables(spark):
    p, t = spark.createDataFrame([], PREDICTIONS), spark.createDataFrame([], TASKS).drop("status")
    assert stages.route_stage_one(t, p, {}, ["at"]).count() == 0
    one = spark.createDataFrame([(1, "PEP", "A1", "A", "MHC-I")], "id int, peptide string, hla_allele string, algorithm string, mhc_class string")
    assert [r.stage_status for r in stages.route_stage_one(one, p, {"MHC-I": 2.0}, ["at"]).collect()] == ["prediction_missing"]
    ok = spark.createDataFrame([(1, "PEP", "A1", "A", "MHC-I", "ok", None, "0.1", "")], PREDICTIONS)
    assert [r.stage_status for r in stages.route_stage_one(one, ok, {"MHC-II": 2.0}, ["at"]).collect()] == ["screened_out_stage1"]


def test_second_stage_has_no_join_of_classes(spark):
    routed = spark.createDataFrame([("PEP", "A1", "A", "MHC-I", "stage1_screen_pass")], "peptide string, hla_allele string, algorithm string, mhc_class string, stage_status string")
    plan = stages.stage_two_tasks(routed, {"MHC-I": ["X"]})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_classical_alleles_run_without_an_entry(spark):
    catalog = spark.createDataFrame([("M", "A0201", None), ("L", "A0201", [9])], "algorithm string, allele_key string, lengths array<int>")
    cases = [("M", "HLA-A*02:01", 9, "run"), ("M", "HLA-A*02:01", 16, "skipped"), ("M", "HLA-B*99:01", 8, "run"), ("M", "HLA-E*01:01", 9, "skipped"), ("M", None, 9, "skipped"), ("L", "HLA-A*02:01", 9, "run"), ("L", "HLA-A*02:01", 10, "skipped"), ("L", "HLA-B*99:01", 9, "skipped"), ("Z", "HLA-E*01:01", 30, "run")]
    rows = spark.createDataFrame([(i, "A" * n, hla, a) for i, (a, hla, n, _) in enumerate(cases)], "id int, peptide string, hla_allele string, algorithm string")
    got = {r.id: r.action for r in sources.route_by_support(rows, catalog, {"M": (r"^[ABC]\d", 8, 15)}).collect()}
    assert [got[i] for i in range(len(cases))] == [c[3] for c in cases]


def test_residues_inside_peptides(spark):
    draw = random.Random(3)
    residues = [(f"p{draw.randrange(4)}", draw.randrange(1, 400)) for _ in range(150)]
    residues += residues[:20] + [("p1", None), (None, 7)]
    peptides = [(i, f"p{draw.randrange(5)}", draw.randrange(1, 390), draw.choice([0, 1, 8, 25, 130])) for i in range(300)]
    peptides += [(900, None, 7, 9), (901, "p1", None, 9), (902, "p1", 7, None), (903, "p1", 7, -3)]
    want = {}
    for i, parent, start, n in peptides:
        places = sorted({at for p, at in residues if p is not None and p == parent and at is not None and start is not None and n is not None and start <= at <= start + n - 1})
        want[i] = ",".join(map(str, places))
    df = spark.createDataFrame(peptides, "peptide_id int, parent_id string, peptide_start int, peptide_length int").withColumn("positions", F.lit("old"))
    got = stages.residue_overlap(df, spark.createDataFrame(residues, "parent_id string, aa_position int")).collect()
    assert {r.peptide_id: r.positions for r in got} == want
    assert all(r.overlaps == bool(want[r.peptide_id]) for r in got) and len(got) == len(peptides)


def test_consensus_needs_the_first_caller(spark):
    rows = [("1", 5, "A", "T", c) for c in ("b", "c", "b")] + [("1", 6, "A", "T", c) for c in ("a", "c")] + [("1", 6, "A", "G", "a"), ("1", 7, None, "G", "a"), ("1", 7, None, "G", "b"), ("1", 8, "A", "G", "zz"), ("1", 9, "A", "G", "c"), ("1", 9, "A", "G", "zz"), ("1", 6, "A", "T", "a")]
    df = spark.createDataFrame(rows, "chrom string, pos1 int, ref string, alt string, caller string")
    found = stages.caller_consensus(df, ["a", "b", "c"])
    got = {(r.pos1, r.alt): (r.callers, r.shared, r.only) for r in found.collect()}
    assert got == {(5, "T"): ("b,c", False, None), (6, "T"): ("a,c", True, None), (6, "G"): ("a", False, "a"), (7, "G"): ("a,b", True, None), (9, "G"): ("c", False, "c")}
    assert sorted((r.pos1, r.alt) for r in stages.shared_records(df, found, "a").collect()) == [(6, "T"), (6, "T"), (7, "G")]


def test_ensemble_of_members(spark):
    rows = [(1, 0, 0.5, "ok"), (1, 1, 1.0, "ok"), (2, 0, float("nan"), "no_hla"), (2, 1, None, "no_hla"), (3, 0, 0.25, "ok"), (3, 1, 0.75, None)]
    df = spark.createDataFrame(rows, "k int, member int, score double, status string")
    mean = stages.ensemble_mean(df, ["k"])
    assert {r.k: (r.score, r.status, r.n_members, r.consistent) for r in mean.collect()} == {1: (0.75, "ok", 2, True), 2: (None, "no_hla", 2, True), 3: (0.5, None, 2, False)}
    with pytest.raises(ValueError, match="inconsistent_status"):
        stages.require_ensemble(mean, 2)
    good = stages.ensemble_mean(df.where("k < 3"), ["k"])
    assert stages.require_ensemble(good, 2).count() == 2
    with pytest.raises(ValueError, match="incomplete_members"):
        stages.require_ensemble(good, 3)


def test_duplicate_events_take_cautious_evidence(spark):
    kind = "k int, ref_reads int, alt_reads int, qual double, mapping_quality double, filters string, record_id string"
    rows = [(1, 9, 3, 30.0, 60.0, "PASS", "r1"), (2, 9, 3, 30.0, 60.0, "q10", "r1"), (2, 9, 3, 30.0, 60.0, "q10", "r1"), (3, 9, 3, 30.0, None, "PASS", "r1"), (3, 12, 2, 20.0, 50.0, "q10", "r2"), (4, 0, 0, None, None, "q20", None), (4, 0, 0, None, None, "q10", None), (5, None, 5, 1.0, 1.0, "q", "r"), (5, 5, None, 1.0, 1.0, "q", "r")]
    got = {r.k: tuple(r)[1:] for r in stages.collapse_events(spark.createDataFrame(rows, kind), ["k"]).collect()}
    assert got[1] == (1, 9, 3, 12, 0.25, 30.0, 60.0, "PASS", "r1", "unique")
    assert got[2] == (2, 9, 3, 12, 0.25, 30.0, 60.0, "q10", "r1", "collapsed_duplicate_exact_event")
    assert got[3] == (2, 12, 2, 14, 2 / 14, 20.0, 50.0, "mixed_filter_status", "collapsed_duplicate_exact_event", "conflicting_duplicate_not_evaluable")
    assert got[4] == (2, 0, 0, 0, 0.0, None, None, "q10;q20", "", "conflicting_duplicate_not_evaluable")
    assert got[5][-1] == "conflicting_duplicate_not_evaluable"
