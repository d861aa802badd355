"""Mutation windows, contexts, curves, attribution, contracts, labels, templates, lists and
percentiles against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomseq import sinks
from loomseq.functions import sequences as S
from loomseq.operators import evaluation as E
from loomseq.operators import joins as J
from loomseq.operators import qc
from loomseq.operators import windows as W
from loomseq.storage import release, stored

BAD = set("*X?U")


def plain_region(wt, mt, frameshift):
    if wt is None:
        return 0, len(mt)
    p = 0
    while p < min(len(wt), len(mt)) and wt[p] == mt[p]:
        p += 1
    if frameshift:
        return p, len(mt)
    a, b = len(wt), len(mt)
    while a > p and b > p and wt[a - 1] == mt[b - 1]:
        a, b = a - 1, b - 1
    return p, b


def plain_windows(event, wt, mt, frameshift, k, width):
    first, last = plain_region(wt, mt, frameshift)
    out = []
    for s in range(len(mt) - k + 1):
        e = s + k
        if not (s < first < e if first == last else s < last and e > first):
            continue
        pep, wild = mt[s:e], None
        if BAD & set(pep):
            continue
        if not frameshift and wt is not None and len(wt) >= e:
            wild = wt[s:e]
            if BAD & set(wild) or wild == pep:
                continue
        low = max((i + 1 for i, c in enumerate(mt) if c in BAD and i < s), default=0)
        high = min((i for i, c in enumerate(mt) if c in BAD and i >= e), default=len(mt))
        target = min(max(width, k), high - low)
        anchor = (s + e - 1) // 2 if frameshift else (first + last - 1) // 2 if last > first else first
        begin = min(max(anchor - target // 2, low, e - target), s, high - target)
        out.append((event, k, s, pep, wild, begin, begin + target))
    return out


def events():
    rng = random.Random(8)
    letters = "ACDEFGHIKLMNPQRSTVWY" + "X*U?"
    rows = []
    for i in range(150):
        n = rng.choice([0, 5, 12, 40, 90])
        wt = "".join(rng.choice(letters if rng.random() < 0.1 else letters[:20]) for _ in range(n))
        a = rng.randrange(n + 1)
        kind = rng.randrange(5)
        mt = wt[:a] + {0: "W" + wt[a + 1 :], 1: "KKLM" + wt[a:], 2: wt[a + 3 :], 3: "".join(rng.choice(letters[:21]) for _ in range(30)), 4: wt[a:]}[kind]
        rows.append((i, None if i % 11 == 0 else wt, mt, kind == 3))
    return [*rows, (900, "ACD", None, False), (901, None, "", None), (902, "A" * 6000, "A" * 3000 + "C" + "A" * 3000, None)]


def test_mutation_windows_and_extensions_equal_plain_loops(spark):
    rows = events()
    df = spark.createDataFrame(rows, "event_id long, wt string, mt string, frameshift boolean")
    got = {tuple(r) for r in S.mutation_windows(df, [9, 4], 13, chunk=7).collect()}
    want = {w for e, wt, mt, fs in rows if mt is not None for k in (9, 4) for w in plain_windows(e, wt, mt, bool(fs), k, 13)}
    assert got == want and len(want) > 500
    counts = {}
    for e, k, *_ in got:
        counts[e, k] = counts.get((e, k), 0) + 1
    # One substitution deep inside a long sequence is covered by k windows of length k.
    assert counts[902, 9] == 9 and counts[902, 4] == 4


def test_invalid_places_and_binary_search(spark):
    texts = ["", "X", "AX?B*", "ABC", "XX", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(S.invalid_places(F.col("t"))).collect()] == [[i for i, c in enumerate(t) if c in BAD] if t is not None else None for t in texts]
    a = spark.createDataFrame([([1, 3, 3, 7], x) for x in (0, 1, 3, 5, 7, 9)] + [([], 1)], "a array<int>, x int")
    assert [tuple(r) for r in a.select(S.count_below(F.col("a"), F.col("x")), S.count_below(F.col("a"), F.col("x"), equal=True)).collect()] == [(0, 0), (0, 1), (1, 3), (3, 3), (3, 4), (4, 4), (0, 0)]


def test_event_contexts(spark):
    rows = [("A" * 10 + "C" + "A" * 19, 10, 11, False), ("A" * 30, 2, 30, True), ("A" * 30, 29, 29, False), ("A" * 7, 3, 4, False)]
    df = spark.createDataFrame(rows, "s string, a int, b int, f boolean")
    got = [tuple(r.c) for r in df.select(S.event_context(F.col("s"), F.col("a"), F.col("b"), F.col("f"), 9).alias("c")).collect()]
    assert got == [(6, 15), (0, 9), (21, 30), (0, 7)]
    assert tuple(df.select(S.event_context(F.col("s"), F.col("a"), F.col("b"), F.col("f"), 0).alias("c")).first().c) == (0, 30)


def plain_auc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y != 1]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


def scored(spark, n=600):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", None, "b"]), "lone" if i == 0 else rng.choice("xy"), int(rng.random() < 0.3), rng.randrange(20) / 20) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, g string, h string, y int, s double")


def test_metrics_of_several_columns_keep_null_apart_from_all(spark):
    rows, df = scored(spark)
    got = {(r.grouped_by, r.value): r for r in E.grouped_metrics(df, ["g", "h"], "y", "s").collect()}
    assert set(got) == {("g", "a"), ("g", "b"), ("g", None), ("h", "x"), ("h", "y"), ("all", None)}
    for (by, value), r in got.items():
        mine = [(y, s) for _, g, h, y, s in rows if by == "all" or (g if by == "g" else h) == value]
        assert r.n == len(mine) and r.auroc == pytest.approx(plain_auc(mine))
        assert r.tp == sum(y == 1 and s >= 0.5 for y, s in mine)
        recall, precision, area = 0.0, 1.0, 0.0
        for cut in sorted({s for _, s in mine}, reverse=True):
            above = [y for y, s in mine if s >= cut]
            new = sum(above) / sum(y for y, _ in mine), sum(above) / len(above)
            area += (new[0] - recall) * (new[1] + precision) / 2
            recall, precision = new
        assert r.pr_area == pytest.approx(area)


def test_curves_sort_no_whole_group(spark):
    _, df = scored(spark)
    for frame in (E.precision_recall(df, ["g"], "y", "s"), E.top_precision(df, ["g"], "y", "s", ["id"]), E.ranking_metrics(df, [], "y", "s")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        sorts = [x.split("windowspecdefinition")[1].split("ROWS")[0] for x in plan.splitlines() if "windowspecdefinition" in x and " s#" in x.split("windowspecdefinition")[1]]
        assert sorts and all("__part" in x for x in sorts)
    assert E.precision_recall(df.where("y = 0"), ["g"], "y", "s").where("recall is not null or step_area is not null").count() == 0


def test_attribution_drops(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.5), [rng.random() for _ in range(3)]) for _ in range(80)]
    coef = [2.0, -1.0, 0.0]
    df = spark.createDataFrame(rows, "y int, x array<double>")
    got = {r.feature: r for r in E.attribution(df, "x", coef, "y").collect()}
    total = lambda x, skip: round(sum(a * c for i, (a, c) in enumerate(zip(x, coef, strict=True)) if i != skip), 9)
    full = plain_auc([(y, total(x, None)) for y, x in rows])
    for f in range(3):
        r = got[f + 1]
        assert r.drop == pytest.approx(full - plain_auc([(y, total(x, f)) for y, x in rows]), abs=1e-9)
        parts = [(y, x[f] * coef[f]) for y, x in rows]
        assert r.mean_positive == pytest.approx(sum(v for y, v in parts if y) / sum(y for y, _ in parts))
        assert r.mean_abs == pytest.approx(sum(abs(v) for _, v in parts) / len(parts))
    assert got[3].drop == 0


def test_nothing_is_published_where_a_rule_is_broken(spark, tmp_path):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    good = [(i, "ACDEFGHIK", sha("ACDEFGHIK"), "MHC-I", "pass", "xACDEFGHIKx", True) for i in range(20)]
    schema = "id int, peptide string, digest string, mhc_class string, status string, extension string, known boolean"
    rules = qc.final_rules(F.col("peptide"), F.col("digest"), F.col("mhc_class"), {"MHC-I": [9]}, F.col("status"), ["pass"], F.col("extension"), F.col("known"))
    path = f"file://{tmp_path}/final"
    broken = {"digest": (2, "zz"), "length": (3, "MHC-II"), "status": (4, None), "extension": (5, None), "orphan": (6, None)}
    for name, (at, value) in broken.items():
        row = list(good[0])
        row[at], row[0] = value, 99
        with pytest.raises(ValueError, match=rf"{name}.*1.*99"):
            sinks.publish(spark.createDataFrame([*good, tuple(row)], schema), path, ["id"], **rules)
        assert list(tmp_path.iterdir()) == []
    assert sinks.publish(spark.createDataFrame(good, schema), path, ["id"], **rules).count() == 20
    assert [p.name for p in tmp_path.iterdir()] == ["final"]
    with pytest.raises(ValueError, match="exists"):
        sinks.publish(spark.createDataFrame(good, schema), path, ["id"], **rules)
    assert sinks.publish(spark.createDataFrame([], schema), f"{path}-empty", ["id"], **rules).count() == 0


def test_event_ladder_takes_the_first_failing_step(spark):
    events_ = spark.createDataFrame([(i, "sub" if i else "odd") for i in range(8)] + [(8, None)], "event_id int, kind string")
    contexts = spark.createDataFrame([(0, "A", "C", False), (2, "A", None, False), (3, "AAA", "AAA", True), (4, "A", "CC", True), (5, "A", "CCCCC", True), (6, "A", "CCCCC", True), (7, None, "CCCCC", None)], "event_id int, wt string, mt string, rebuilt boolean")
    windows = spark.createDataFrame([(6, "a"), (6, "a"), (7, "b"), (0, "z")], "event_id int, peptide string")
    got = {r.event_id: (r.status, r.n_windows, r.n_peptides) for r in qc.event_ladder(events_, contexts, windows, ["sub"], 4).collect()}
    assert got == {0: ("unsupported", 1, 1), 1: ("missing_context", 0, 0), 2: ("missing_context", 0, 0), 3: ("region_error", 0, 0), 4: ("window_error", 0, 0), 5: ("no_window", 0, 0), 6: ("rebuilt", 2, 1), 7: ("ok", 1, 1), 8: ("unsupported", 0, 0)}


def test_labels_once_and_removals(spark):
    rows = [("a", 0, "s1", 1), ("a", 1, "s2", 2), ("b", 1, "s2", 5), ("b", 1, "s1", 3), ("c", 0, "s1", 4), (None, 1, "s1", 6)]
    once = qc.labelled_once(spark.createDataFrame(rows, "k string, y int, source string, n int"), "k", "y", ["source", "n"])
    assert {(r.k, r.y, r.n_rows, r.conflict, r.first.source, r.first.n) for r in once.collect()} == {("a", 0, 2, True, "s1", 1), ("b", 1, 2, False, "s1", 3), ("c", 0, 1, False, "s1", 4), (None, 1, 1, False, "s1", 6)}
    assert {r.stage: r.n for r in qc.removal_counts(once).collect()} == {"rows": 6, "keys": 4, "conflict_keys": 1, "conflict_rows": 2, "duplicate_rows": 1, "kept": 3}
    assert {r.n for r in qc.removal_counts(once.where("false")).collect()} == {0}


def test_templates_of_wild_types(spark):
    tasks = spark.createDataFrame([("I", "MMM", "A1", "x"), ("I", "MMM", "A2", "x"), ("I", "MMM", "A1", "x"), ("II", "MMM", "D", "x")], "mhc_class string, peptide string, hla_allele string, algorithm string")
    pairs = spark.createDataFrame([("I", "WWW", "MMM"), ("I", "WWW", "MMM"), ("I", "VVV", "NNN"), ("I", "WWWW", "MMM")], "mhc_class string, wt string, mt string")
    w = J.wild_tasks(tasks, pairs)
    assert sorted(map(str, (tuple(r) for r in w.collect()))) == sorted(map(str, [("I", "WWW", "MMM", "A1", "x"), ("I", "WWW", "MMM", "A2", "x"), ("I", "VVV", "NNN", None, None)]))
    assert [tuple(r) for r in J.templates_missing(w).collect()] == [("I", 2, 1)]


def test_lists_keep_their_separators(spark):
    names = spark.createDataFrame([("E1", "one"), ("E2", "t|wo")], "name string, value string")
    texts = ["E1.3|E2,E9|| E1 ", "|,|", "", None, "NA", "nan|E1", "E2", " E7.1 ,x", ",E1,"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: (r.a, r.b) for r in J.lookup_list(J.lookup_list(df, "id", "t", names, "a"), "id", "t", names, "b", keep_unknown=True).collect()}
    assert got == {0: ("one|t|wo,||one", "one|t|wo,E9||one"), 1: ("|,|", "|,|"), 2: ("", ""), 3: ("", ""), 4: ("", ""), 5: ("|one", "|one"), 6: ("t|wo", "t|wo"), 7: (",", " E7.1 ,x"), 8: (",one,", ",one,")}


def test_percentiles_at_two_resolutions(spark):
    rng = random.Random(6)
    values = [round(rng.gauss(0, 1), 2) for _ in range(4000)]
    reference = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    asked = sorted({rng.choice(values) for _ in range(80)} | {-9.0, 9.0, 0.005})
    scores = spark.createDataFrame([(x,) for x in asked] + [(None,)], "x double")

    def rank(x):
        left, equal = sum(v < x for v in values), sum(v == x for v in values)
        return (left + ((equal + 1) / 2 if equal else 0)) / len(values)

    for coarse, fine in ((10_000, 10_000), (100, 50)):
        q = W.quantile_table(reference, "v", 0.05, coarse, fine)
        row = q.first()
        assert len(row.coarse) <= coarse and len(row.fine) <= fine and row.n == 4000
        got = {r.x: r.share for r in W.two_resolution_share(scores, "x", q).collect()}
        assert got.pop(None) is None
        for x in asked:
            error = 1 / coarse if x > row.edge else row.n_tail / row.n / fine
            assert abs(got[x] - rank(x)) <= (1e-12 if coarse >= 4000 else error + 1e-12), x
    empty = W.quantile_table(reference.where("false"), "v", 0.05, 10, 10)
    assert {r.share for r in W.two_resolution_share(scores, "x", empty).collect()} == {None}


def test_islands_over_many_ranges_equal_a_plain_merge(spark):
    rng = random.Random(5)
    rows = []
    for g in ("a", "a", "a", "b", None):
        at = 0
        for _ in range(150):
            at += rng.randrange(12)
            rows.append((g, at, at + rng.randrange(9)))
    rows += [("a", 300, 900), ("a", 300, 900), ("c", 5, None), ("c", None, 5), ("d", 7, 7)]
    df = spark.createDataFrame(rows, "g string, s long, e long").withColumn("n_merged", F.lit("x"))
    want = []
    for g in {r[0] for r in rows}:
        islands = []
        for s, e in sorted((s, e) for k, s, e in rows if k == g and s is not None and e is not None):
            if islands and s <= islands[-1][1]:
                islands[-1][1] = max(islands[-1][1], e)
                islands[-1][2] += 1
            else:
                islands.append([s, e, 1])
        want += [(g, i + 1, *x) for i, x in enumerate(islands)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = W.merge_intervals(df, ["g"], "s", "e").select("g", "island", "s", "e", "n_merged").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_stored_tables_go_when_they_are_released(spark):
    release(spark)
    df = stored(spark, spark.range(10), "kept")
    place = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    assert df.count() == 10 and files.exists(place)
    assert release(spark) == 1 and not files.exists(place)
    assert release(spark) == 0


def test_rows_that_touch_regions_stay_as_often_as_they_are_given(spark):
    rng = random.Random(8)
    left = [("c1", s, s + rng.randrange(1, 60), k) for k in range(60) for s in [rng.randrange(900)]]
    left += [left[0]] * 3 + [("c1", 0, 1000, None)] * 2 + [("c2", 5, 9, 1), (None, 5, 9, 1), ("c1", None, 9, 1)]
    right = [("c1", s, s + 15) for s in range(0, 900, 70)] + [("c1", 0, 15), ("c3", 5, 9), (None, 5, 9)]
    a = spark.createDataFrame(left, "chrom string, a long, b long, tag int")
    b = spark.createDataFrame(right, "chrom string, c long, d long")
    got = J.overlap(a, b, ["chrom"], 40, ("a", "b"), ("c", "d"), "left_semi")
    assert got.columns == a.columns
    want = [r for r in left if any(None not in (r[0], r[1]) and r[0] == x and r[1] < d and c < r[2] for x, c, d in right)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    pairs = J.overlap(a, b, ["chrom"], 40, ("a", "b"), ("c", "d"))
    assert pairs.count() == sum(r[0] == x and None not in (r[0], r[1]) and r[1] < d and c < r[2] for r in left for x, c, d in right)
