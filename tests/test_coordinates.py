"""Chains, projections, junctions, coding changes and selections against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from loomseq import sources
from loomseq.functions import coordinates as C
from loomseq.operators import evidence as V
from loomseq.operators import windows as W

BLOCKS = "array<struct<chrom:string,strand:string,start0:bigint,end0:bigint>>"


def chain(rng, strand, n):
    at, out = rng.randrange(50), []
    for _ in range(n):
        m = rng.randrange(1, 9)
        out.append(("chr1", strand, at, at + m))
        at += m + rng.choice([0, 1, 3, 20])
    return out[::-1] if strand == "-" else out


def bases(blocks):
    """Genomic place of each base, in transcript order."""
    return [p for _, s, a, b in blocks for p in (range(b - 1, a - 1, -1) if s == "-" else range(a, b))]


def test_projection_both_ways_on_both_strands(spark):
    rng = random.Random(1)
    rows = []
    for k in range(120):
        c = chain(rng, rng.choice("+-"), rng.randrange(1, 5))
        n = len(bases(c))
        a = rng.randrange(n + 2)
        rows.append((k, c, a, a + rng.randrange(-1, n + 2)))
    df = spark.createDataFrame(rows, f"k int, blocks {BLOCKS}, a bigint, b bigint")
    p = df.withColumn("p", C.to_genome(F.col("blocks"), F.col("a"), F.col("b")))
    back = F.transform("p.segments", lambda s: C.to_transcript(C.placed(F.col("blocks")), s))
    seen = set()
    for r in p.withColumn("back", back).collect():
        every = bases([tuple(b) for b in r.blocks])
        if r.b < r.a:
            assert r.p.reason == "end_before_start" and r.p.segments is None
        elif r.b > len(every):
            assert r.p.reason == "outside_blocks" and r.p.segments is None
        else:
            got = bases([(s.chrom, s.strand, s.start0, s.end0) for s in r.p.segments])
            assert got == every[r.a : r.b] and r.p.reason is None
            assert [(s.tx_start0, s.tx_end0) for s in r.p.segments] == [tuple(x) for x in r.back]
        seen.add(r.p.reason)
    assert seen == {None, "end_before_start", "outside_blocks"}
    empty = spark.createDataFrame([(None, 1, 2), ([], 0, 0), ([("c", "+", 0, 5)], None, 2)], f"blocks {BLOCKS}, a bigint, b bigint")
    assert [(r.p.segments, r.p.reason) for r in empty.select(C.to_genome(F.col("blocks"), F.col("a"), F.col("b")).alias("p")).collect()] == [(None, "missing_input"), ([], None), (None, "missing_input")]


def test_a_codon_split_by_a_junction_on_minus(spark):
    blocks = [("chr2", "-", 200, 204), ("chr2", "-", 100, 110)]
    df = spark.createDataFrame([(blocks,)], f"blocks {BLOCKS}")
    r = df.select(C.codon_footprint(F.col("blocks"), F.lit(2), F.lit(1)).alias("p")).select("p", C.crossed_junctions(F.col("p.segments")).alias("j")).first()
    assert [(s.start0, s.end0) for s in r.p.segments] == [(200, 201), (108, 110)]
    assert [j.id for j in r.j] == ["chr2:110-200:-"]


def test_junctions_of_operation_strings(spark):
    rows = [("5S10M3N2D4N6M", "+"), ("5S10M3N2D4N6M", "-"), ("20M2I5D", "+"), ("", "+"), ("3=2N1X9H1P5N", "+")]
    df = spark.createDataFrame(rows, "ops string, strand string")
    got = df.select(C.alignment_junctions(F.lit("chr1"), F.col("strand"), F.lit(100), F.col("ops")).alias("j")).collect()
    assert [[(x.start0, x.end0, x.ord) for x in r.j] for r in got] == [[(110, 113, 1), (115, 119, 2)], [(115, 119, 1), (110, 113, 2)], [], [], [(103, 105, 1), (106, 111, 2)]]
    loci = spark.createDataFrame([("1:5-9:-:MAPQ60:3M2N1M;chr2:1-2:+:MAPQ0:1M",), ("chrUn:5-9:-:MAPQx:3M",), ("nothing",), (None,)], "t string")
    assert [tuple(r.l) if r.l else None for r in loci.select(C.alignment_locus(F.col("t")).alias("l")).collect()] == [("chr1", 5, 9, "-", 60, "3M2N1M"), (None, 5, 9, "-", 0, "3M"), None, None]


@pytest.mark.parametrize("strand", ["+", "-"])
def test_six_ways_to_lie_in_a_chain(spark, strand):
    """A reference of two coding blocks; candidates that share its frame, are moved, hang over,
    skip bases between blocks, lie elsewhere, or are missing."""
    flip = (lambda c: [("chr1", "-", 1000 - b, 1000 - a) for a, b in c]) if strand == "-" else (lambda c: [("chr1", "+", a, b) for a, b in c])
    reference = flip([(100, 130), (200, 230)])
    cases = [
        (flip([(103, 130), (200, 203)]), 3, "coordinate_frame_concordant"),
        (flip([(104, 113)]), 3, "coordinate_overlap_frame_discordant"),
        (flip([(125, 135)]), 25, "partial_coordinate_overlap"),
        (flip([(103, 124), (203, 209)]), 3, "junction_chain_incompatible"),
        (flip([(140, 149)]), 3, "no_coordinate_overlap"),
        ([], 0, "not_evaluable_reference_or_coordinate_mismatch"),
        (None, 0, "not_evaluable_reference_or_coordinate_mismatch"),
        ([("chr1", "+" if strand == "-" else "-", 100, 109)], 0, "not_evaluable_reference_or_coordinate_mismatch"),
        ([("chr9", strand, 103, 112)], 3, "no_coordinate_overlap"),
    ]
    df = spark.createDataFrame([(c, s, reference) for c, s, _ in cases], f"c {BLOCKS}, s bigint, r {BLOCKS}")
    assert [r[0] for r in df.select(C.chain_status(F.col("c"), F.col("s"), F.col("r"))).collect()] == [w for _, _, w in cases]


def test_chain_pairs_come_once_and_evidence_takes_the_first_status(spark):
    candidates = spark.createDataFrame([(1, [("chr1", "+", 95, 101), ("chr1", "+", 190, 193)], 0), (2, [("chr1", "+", 5000, 5003)], 0)], f"candidate_id long, blocks {BLOCKS}, cds_start0 long")
    references = spark.createDataFrame([(7, [("chr1", "+", 95, 101), ("chr1", "+", 190, 199)]), (8, [("chr1", "+", 96, 193)]), (9, [("chr1", "-", 95, 193)])], f"reference_id long, blocks {BLOCKS}")
    m = V.chain_matches(candidates, references, 10)
    assert sorted(tuple(r) for r in m.collect()) == [(1, 7, "coordinate_frame_concordant"), (1, 8, "partial_coordinate_overlap")]
    assert sorted(tuple(r) for r in V.chain_evidence(candidates, m).collect()) == [(1, "coordinate_frame_concordant", 2, 1, "7"), (2, "no_coordinate_overlap", 0, 0, "")]


def write(spark, tmp_path, name, rows):
    path = tmp_path / name
    path.write_text("\n".join("\t".join(map(str, r)) for r in rows) + "\n")
    return f"file://{path}"


def test_junction_files_and_support(spark, tmp_path):
    good = [("chr1", 111, 113, 1, 1, 1, 2, 5, 30), ("chr1", 111, 113, 0, 0, 0, 7, 0, 9), ("chr1", 116, 119, 1, 1, 0, 1, 0, 8), ("GL1", 5, 9, 1, 1, 1, 1, 1, 1)]
    normal = [("chr1", 111, 113, 2, 1, 1, 50, 0, 1)]
    need = spark.createDataFrame([("p", 1, "chr1", 110, 113, "+", "a"), ("p", 2, "chr1", 115, 119, "+", "b"), ("q", 1, "chr1", 110, 113, "+", "a")], "k string, ord int, chrom string, start0 long, end0 long, strand string, id string")
    t, n = (sources.checked_junctions(spark, write(spark, tmp_path, f"{i}.tab", r)) for i, r in enumerate((good, normal)))
    s = V.junction_support(need, t, n)
    got = {(r.k, r.ord): (r.tumor_unique_reads, r.tumor_unknown_unique_reads, r.normal_unique_reads, r.tumor_max_overhang) for r in s.collect()}
    assert got == {("p", 1): (2, 7, 0, 30), ("p", 2): (1, 0, 0, 8), ("q", 1): (2, 7, 0, 30)}
    parents = spark.createDataFrame([("p", "pass"), ("q", "pass"), ("r", "pass"), ("s", "ambiguous")], "k string, status string")
    out = {r.k: (r.n_required, r.min_tumor_unique, r.n_low, r.junction_ids, r.junction_status) for r in V.parent_junctions(parents, s, "k").collect()}
    assert out == {"p": (2, 1, 1, "a;b", "low_support"), "q": (1, 2, 0, "a", "supported"), "r": (0, None, 0, "", "intronless"), "s": (0, None, 0, "", "ambiguous")}
    with pytest.raises(ValueError, match="more than once.*chr1:110:113:\\+"):
        sources.checked_junctions(spark, write(spark, tmp_path, "twice.tab", [*good, good[0]]))
    with pytest.raises(ValueError, match="two ways"):
        sources.checked_junctions(spark, write(spark, tmp_path, "mixed.tab", [*good[:3], ("2", 1, 3, 1, 1, 1, 1, 1, 1)]))


def test_block_rows_must_keep_their_contract(spark):
    schema = "k string, ord int, chrom string, strand string, start0 long, end0 long, status string, build string, n_blocks int"
    rows = [("a", 2, "chr1", "+", 50, 60, "pass", "b38", 2), ("a", 1, "chr1", "+", 10, 20, "pass", "b38", 2), ("a", 3, "chr1", "+", 70, 80, "fail", "b37", 2)]
    got = sources.checked_chains(spark.createDataFrame(rows, schema), "k", "ord", "b38").collect()
    assert [(r.k, [(b.start0, b.end0) for b in r.blocks]) for r in got] == [("a", [(10, 20), (50, 60)])]
    for bad, what in (((*rows[0][:7], "b37", 2), "build"), ((*rows[0][:8], 3), "number of blocks"), (("a", 1, *rows[0][2:]), "order"), (("a", 2, "chr2", *rows[0][3:]), "chromosome")):
        with pytest.raises(ValueError, match=what):
            sources.checked_chains(spark.createDataFrame([bad, *rows[1:]], schema), "k", "ord", "b38")


def test_coding_changes_to_verdicts(spark):
    plus, minus = [("chr1", "+", 100, 104), ("chr1", "+", 200, 208)], [("chr1", "-", 200, 208), ("chr1", "-", 100, 104)]
    # TTA -> TTG stays L; GAA -> GTA changes E to V at base 4, the first of the second block.
    reference, candidate = "TTAGAAACC", "TTGGTAACC"
    rows = [("plus", plus, reference, candidate, "LVT"), ("minus", minus, reference, candidate, "LVT"), ("same", plus, reference, "TTGGAAACC", "LET"), ("short", plus, reference, "TTA", "L"), ("outside", plus[:1], reference, candidate, "LVT"), ("wrong", plus, reference, candidate, "LLL")]
    parents = spark.createDataFrame(rows, f"parent_id string, blocks {BLOCKS}, reference_cds string, candidate_cds string, protein string")
    assert [tuple(r.s) for r in parents.where("parent_id = 'plus'").select(C.coding_changes(F.col("reference_cds"), F.col("candidate_cds"))["n_synonymous"].alias("n")).select(F.struct("n").alias("s")).collect()] == [(1,)]
    need = V.required_changes(parents)
    assert {(r.parent_id, r.offset0, r.aa_position, r.ref_aa + r.alt_aa, r.chrom, r.pos1, r.ref, r.alt) for r in need.collect()} == {("plus", 4, 2, "EV", "chr1", 201, "A", "T"), ("wrong", 4, 2, "EV", "chr1", 201, "A", "T"), ("minus", 4, 2, "EV", "chr1", 204, "T", "A"), ("outside", 4, 2, "EV", None, None, None, None)}
    calls = spark.createDataFrame([("chr1", 201, "A", "T", 50.0, 10, 8, "PASS"), ("chr1", 204, "T", "A", 50.0, 10, 1, "PASS")], "chrom string, pos1 long, ref string, alt string, qual double, ref_reads long, alt_reads long, filters string")
    none = calls.select("chrom", "pos1", "ref", "alt").where("false")
    verdicts = lambda sites: {r.parent_id: r.verdict for r in V.rescue(parents, V.change_events(need, calls, sites, 20, 10, 3, 0.1)).collect()}
    assert verdicts(none) == {"plus": "rescued", "minus": "insufficient_support", "same": "reference_concordant", "short": "not_evaluable", "outside": "not_evaluable", "wrong": "not_evaluable"}
    known = spark.createDataFrame([("chr1", 201, "A", "T"), ("chr1", 201, "A", "T"), ("chr1", 204, "T", "C")], none.schema)
    assert verdicts(known)["plus"] == "known_editing_excluded" and verdicts(known)["minus"] == "insufficient_support"


# Distributed selection


def selection_rows(spark, n=120_000):
    """One group with three quarters of all rows, a null group, many ties."""
    return spark.range(n).select("id", F.when(F.col("id") % 4 < 3, "big").when(F.col("id") % 8 == 3, "small").alias("g"), (F.col("id") * 7919 % 500).alias("score"), (F.col("id") % 5 == 0).alias("out"))


def expected(rows, cap, left):
    place, chosen = {}, {}
    for r in sorted((r for r in rows if left(r)), key=lambda r: (str(r.g), -r.score, r.id)):
        place[r.g] = place.get(r.g, 0) + 1
        if place[r.g] <= cap:
            chosen[r.id] = place[r.g]
    return chosen


def test_a_cap_beyond_the_limited_rank_sorts_no_whole_group(spark):
    df = selection_rows(spark)
    rows = df.collect()
    order = [F.desc("score"), "id"]
    for cap in (0, 1, 50_000, 10**9):
        got = W.ranked_cap(df, ["g"], order, cap, eligible=~F.col("out"))
        want = set(expected(rows, cap, lambda r: not r.out))
        assert {r.id for r in got.where("selected").collect()} == want and got.count() == len(rows)
    plan = W.ranked_cap(df, ["g"], order, 50_000)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition" in line]
    ranks = [line for line in windows if "score" in line]
    assert ranks and all("__part" in line.split("windowspecdefinition")[1].split("score")[0] for line in ranks)
    assert W.ranked_cap(df.where("false"), ["g"], order, 5).count() == 0


def test_first_ranked_and_refill_equal_plain_ranks(spark):
    df = selection_rows(spark, 20_000)
    rows = df.collect()
    order = [F.desc("score"), "id"]
    first = W.first_ranked(df, ["g"], order, 3000, eligible=~F.col("out"))
    assert {r.id: r.place for r in first.collect()} == expected(rows, 3000, lambda r: not r.out)
    initial, final = expected(rows, 3000, lambda r: True), expected(rows, 3000, lambda r: not r.out)
    want = {r.id: "excluded" if r.out else "retained" if r.id in initial else "refilled" if r.id in final else "deferred" for r in rows}
    got = {r.id: r.routing for r in W.refill(df, ["g"], order, 3000, F.col("out")).collect()}
    assert got == want and set(want.values()) == {"excluded", "retained", "refilled", "deferred"}


def test_equal_keys_are_split_among_ranges(spark):
    df = spark.range(50_000).select("id", F.lit(1).alias("g"), F.lit(2.5).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = W._selection_ranges(df, ["g"], ["score"], {"e": F.lit(True)})
        assert ranges.select("__part").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert W.ranked_cap(df, ["g"], ["score"], 20_001).where("selected").count() == 20_001


def test_distinct_windows_take_linear_time(spark):
    import time

    from loomseq.functions import sequences as S

    def seconds(n):
        letters = f"array_join(transform(sequence(1, {n}), i -> substr('ACDEFGHIKLMNPQRSTVWY', cast(pmod(hash(i * 31 + id), 20) + 1 as int), 1)), '')"
        df = spark.range(8).select("id", F.expr(letters).alias("seq")).repartition(8).cache()
        df.count()
        times = []
        for _ in range(3):
            start = time.time()
            S.distinct_windows(df, "seq", 9, "id").write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        return min(times)

    seconds(500)
    assert seconds(30_000) < 8 * seconds(7500) + 1
