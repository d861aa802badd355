"""Queries of block chains, projections, junctions and coding changes. The lines of an order
are the blocks of a chain, one after the other with gaps; every second order lies on -."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq import sources
from loomseq.functions import coordinates as C
from loomseq.functions import sequences as S
from loomseq.operators import evidence as V
from loomseq.plans.registry import query, table
from loomseq.plans.sequence_queries import _AMINO
from loomseq.plans.source_queries import lines
from loomseq.storage import stored

_ORDER = "PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_ROWS = f"(SELECT l_orderkey AS o, l_quantity::BIGINT AS len, (l_suppkey % 3) * 7 AS gap, l_returnflag AS flag, l_linenumber AS line, 'chr' || (l_orderkey % 5 + 1) AS chrom, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_orderkey * 20 AS base, row_number() OVER ({_ORDER}) AS ord FROM lineitem)"
_GENOMIC = f"(SELECT *, base + (sum(len + gap) OVER (PARTITION BY o ORDER BY ord) - len - gap)::BIGINT AS s FROM {_ROWS})"
#: o, chrom, strand, t (place in transcript order), s, e, off (transcript place of the first base).
BLOCKS = f"(SELECT o, chrom, strand, len, s, s + len AS e, row_number() OVER w AS t, (sum(len) OVER w - len)::BIGINT AS off FROM {_GENOMIC} WINDOW w AS (PARTITION BY o ORDER BY CASE WHEN strand = '+' THEN ord ELSE -ord END ROWS UNBOUNDED PRECEDING))"


def _segments(start: int, end: int) -> str:
    """Segments of a transcript interval and how much of it they cover."""
    return f"""(SELECT *, (sum(b - a) OVER (PARTITION BY o))::BIGINT AS covered, CASE WHEN strand = '-' THEN e - (b - off) ELSE s + a - off END AS gs, CASE WHEN strand = '-' THEN e - (a - off) ELSE s + b - off END AS ge
FROM (SELECT *, greatest({start}, off) AS a, least({end}, off + len) AS b FROM {BLOCKS}) WHERE a < b)"""


def rows_of_orders(spark, sf_dir):
    """o, chrom, strand, base and rows (len, gap, flag, line), in order."""
    fields = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_quantity").cast("bigint").alias("len"), (F.col("l_suppkey") % 3 * 7).alias("gap"), F.col("l_returnflag").alias("flag"))
    o = F.col("l_orderkey")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(fields)).alias("rows"))
    return rows.select(o.alias("o"), F.concat(F.lit("chr"), o % 5 + 1).alias("chrom"), F.when(o % 2 == 0, "+").otherwise("-").alias("strand"), (o * 20).alias("base"), "rows")


def chains(spark, sf_dir):
    """o, chrom, strand, blocks in transcript order."""
    def blocks(rows):
        begin = lambda i: F.col("base") + F.aggregate(F.slice(rows, F.lit(1), i), F.lit(0).cast("bigint"), lambda a, r: a + r["len"] + r["gap"])
        return F.transform(rows, lambda r, i: C.block(F.col("chrom"), F.col("strand"), begin(i), begin(i) + r["len"]))

    return rows_of_orders(spark, sf_dir).select("o", "chrom", "strand", C.transcript_order(blocks(F.col("rows")), F.col("strand")).alias("blocks"))


@query("f8_projection", f"SELECT o, t - min(t) OVER (PARTITION BY o) AS segment, gs AS start0, ge AS end0, NULL::VARCHAR AS reason FROM {_segments(10, 40)} WHERE covered = 30 UNION ALL SELECT o, NULL, NULL, NULL, 'outside_blocks' FROM {BLOCKS} GROUP BY o HAVING sum(len) < 40")
def f8_projection(spark, sf_dir):
    p = chains(spark, sf_dir).select("o", C.to_genome(F.col("blocks"), F.lit(10), F.lit(40)).alias("p"))
    each = p.select("o", "p.reason", F.posexplode_outer("p.segments").alias("segment", "s"))
    return each.select("o", F.col("segment").cast("bigint").alias("segment"), "s.start0", "s.end0", "reason")


@query("f8_round_trip", f"SELECT o, count(*) AS n_segments, min(off) AS first, max(off + len) AS last FROM {BLOCKS} GROUP BY o")
def f8_round_trip(spark, sf_dir):
    # Every block, taken as a segment of the genome, is mapped back to the transcript.
    back = lambda b: F.transform(b, lambda x: C.to_transcript(C.placed(b), x))
    found = chains(spark, sf_dir).select("o", back(F.col("blocks")).alias("m"))
    return found.select("o", F.size("m").cast("bigint").alias("n_segments"), F.array_min(F.transform("m", lambda x: x["start0"])).alias("first"), F.array_max(F.transform("m", lambda x: x["end0"])).alias("last"))


@query("w11_footprint_junctions", f"SELECT o, string_agg(id, ';' ORDER BY t) FILTER (id IS NOT NULL) AS crossed, count(id) AS n_crossed FROM (SELECT *, CASE WHEN greatest(ps, gs) > least(pe, ge) THEN chrom || ':' || least(pe, ge) || '-' || greatest(ps, gs) || ':' || strand END AS id FROM (SELECT *, lag(gs) OVER (PARTITION BY o ORDER BY t) AS ps, lag(ge) OVER (PARTITION BY o ORDER BY t) AS pe FROM {_segments(3, 30)} WHERE covered = 27)) GROUP BY o")
def w11_footprint(spark, sf_dir):
    f = chains(spark, sf_dir).select("o", C.codon_footprint(F.col("blocks"), F.lit(2), F.lit(9))["segments"].alias("s")).where("s is not null")
    found = f.select("o", F.transform(C.crossed_junctions(F.col("s")), lambda j: j["id"]).alias("ids"))
    return found.select("o", F.when(F.size("ids") > 0, F.array_join("ids", ";")).alias("crossed"), F.size("ids").cast("bigint").alias("n_crossed"))


_LETTER = "CASE WHEN line % 7 = 0 THEN 'S' WHEN flag = 'A' THEN 'M' WHEN flag = 'R' THEN 'D' ELSE 'N' END"
_OPS = f"(SELECT *, base + (sum(CASE WHEN op = 'S' THEN 0 ELSE len END) OVER (PARTITION BY o ORDER BY ord))::BIGINT AS e FROM (SELECT *, {_LETTER} AS op FROM {_ROWS}))"
JUNCTIONS = f"(SELECT o, chrom, strand, e - len AS start0, e AS end0, row_number() OVER (PARTITION BY o ORDER BY CASE WHEN strand = '+' THEN ord ELSE -ord END) AS ord, chrom || ':' || (e - len) || '-' || e || ':' || strand AS id FROM {_OPS} WHERE op = 'N')"


def required_junctions(spark, sf_dir):
    letter = lambda r: F.when(r["l_linenumber"] % 7 == 0, "S").when(r["flag"] == "A", "M").when(r["flag"] == "R", "D").otherwise("N")
    ops = F.array_join(F.transform("rows", lambda r: F.concat(r["len"].cast("string"), letter(r))), "")
    r = rows_of_orders(spark, sf_dir).select("o", "chrom", "strand", "base", ops.alias("operations"))
    text = F.concat("chrom", F.lit(":"), "base", F.lit("-"), F.col("base") + 1, F.lit(":"), "strand", F.lit(":MAPQ60:"), "operations")
    at = r.select("o", C.alignment_locus(text).alias("a"))
    j = C.alignment_junctions(F.col("a.chrom"), F.col("a.strand"), F.col("a.start0"), F.col("a.operations"))
    return S.each_of(at, j, "j").select("o", "j.*")


@query("w10_operation_junctions", f"SELECT o, ord::INTEGER AS ord, start0, end0, id FROM {JUNCTIONS}")
def w10_operations(spark, sf_dir):
    return required_junctions(spark, sf_dir).select("o", "ord", "start0", "end0", "id")


def _support_sql(keep: str) -> str:
    return f"(SELECT chrom, start0, end0, CASE WHEN start0 % 4 = 1 THEN '.' ELSE strand END AS strand, max(o % 5) AS u, max(end0 % 3) AS m FROM {JUNCTIONS} WHERE {keep} GROUP BY ALL)"


_LOOKUP = "LEFT JOIN {t} {n} ON {n}.chrom = j.chrom AND {n}.start0 = j.start0 AND {n}.end0 = j.end0 AND {n}.strand = {s}"
_KEPT = {"tumor": "start0 % 3 <> 0", "normal": "end0 % 3 = 0"}
SUPPORTED = f"(SELECT j.*, coalesce(a.u, 0) AS tu, coalesce(b.u, 0) AS tx, coalesce(c.u, 0) AS nu, coalesce(d.m, 0) AS nxm FROM {JUNCTIONS} j " + " ".join(_LOOKUP.format(t=_support_sql(_KEPT[k]), n=n, s=s) for k, n, s in (("tumor", "a", "j.strand"), ("tumor", "b", "'.'"), ("normal", "c", "j.strand"), ("normal", "d", "'.'"))) + ")"


def supported_junctions(spark, sf_dir):
    """Required junctions with their reads; the reads' tables go through junction files."""
    need = stored(spark, required_junctions(spark, sf_dir), "junctions")

    def reads(name):
        strand = F.when(F.col("start0") % 4 == 1, ".").otherwise(F.col("strand"))
        rows = need.where(_KEPT[name].replace("<>", "!=")).groupBy("chrom", "start0", "end0", strand.alias("strand")).agg(F.max(F.col("o") % 5).alias("u"), F.max(F.col("end0") % 3).alias("m"))
        code = F.when(F.col("strand") == "+", 1).when(F.col("strand") == "-", 2).otherwise(0)
        one = F.lit(1)
        path = lines(spark, rows.withColumn("s1", F.col("start0") + 1), f"sj-{name}", "chrom", "s1", "end0", code, one, one, "u", "m", F.lit(9))
        return sources.checked_junctions(spark, path)

    return V.junction_support(need, reads("tumor"), reads("normal"))


@query("j14_junction_lookup", f"SELECT o, ord::INTEGER AS ord, id, tu AS tumor_unique, tx AS tumor_unknown_unique, nu AS normal_unique, nxm AS normal_unknown_multi FROM {SUPPORTED}")
def j14_lookup(spark, sf_dir):
    s = supported_junctions(spark, sf_dir)
    return s.select("o", "ord", "id", F.col("tumor_unique_reads").alias("tumor_unique"), F.col("tumor_unknown_unique_reads").alias("tumor_unknown_unique"), F.col("normal_unique_reads").alias("normal_unique"), F.col("normal_unknown_multi_reads").alias("normal_unknown_multi"))


@query("p15_parent_support", f"SELECT p.o, coalesce(n, 0) AS n_required, least AS min_tumor_unique, coalesce(low, 0) AS n_low, coalesce(ids, '') AS junction_ids, CASE WHEN p.o % 11 = 0 THEN 'ambiguous' WHEN n IS NULL THEN 'intronless' WHEN low = 0 THEN 'supported' ELSE 'low_support' END AS junction_status FROM (SELECT DISTINCT l_orderkey AS o FROM lineitem) p LEFT JOIN (SELECT o, count(*) AS n, min(tu) AS least, count(*) FILTER (tu < 2) AS low, string_agg(id, ';' ORDER BY ord) AS ids FROM {SUPPORTED} GROUP BY o) s ON s.o = p.o")
def p15_support(spark, sf_dir):
    o = F.col("l_orderkey")
    p = table(spark, sf_dir, "lineitem").select(o.alias("o"), F.when(o % 11 == 0, "ambiguous").otherwise("pass").alias("status")).distinct()
    found = V.parent_junctions(p, supported_junctions(spark, sf_dir), "o")
    return found.select("o", "n_required", "min_tumor_unique", "n_low", "junction_ids", "junction_status")


# References: the chains themselves (o % 4 = 0), moved by one base (1), without their first
# block (2), and with three more bases at the end of the first block (3).
_REF = f"(SELECT o AS r, chrom, strand, t, s, e, (sum(e - s) OVER (PARTITION BY o ORDER BY t) - (e - s))::BIGINT AS off FROM (SELECT o, chrom, strand, t, s + CASE WHEN o % 4 = 1 THEN 1 WHEN o % 4 = 3 AND t = 1 AND strand = '-' THEN -3 ELSE 0 END AS s, e + CASE WHEN o % 4 = 1 THEN 1 WHEN o % 4 = 3 AND t = 1 AND strand = '+' THEN 3 ELSE 0 END AS e FROM {BLOCKS}) WHERE NOT (o % 4 = 2 AND t = 1))"
_CAND = f"(SELECT o, chrom, strand, t, a AS want, gs, ge FROM {_segments(9, 36)} WHERE covered = 27)"
WIDTH = 64
_MATCHES = f"""(SELECT o, r, CASE WHEN NOT touch THEN 'no_coordinate_overlap' WHEN bad = 1 THEN 'partial_coordinate_overlap' WHEN bad = 2 THEN 'coordinate_overlap_frame_discordant' WHEN broken THEN 'junction_chain_incompatible' WHEN first_off % 3 <> 0 THEN 'coordinate_overlap_frame_discordant' ELSE 'coordinate_frame_concordant' END AS status FROM (
SELECT o, r, bool_or(touch) AS touch, arg_min(code, t) FILTER (code > 0) AS bad, bool_or(coalesce(mapped <> before_end, false)) AS broken, arg_min(mapped, t) AS first_off FROM (
SELECT *, CASE WHEN mapped IS NULL THEN 1 WHEN (mapped - want) % 3 <> 0 THEN 2 ELSE 0 END AS code, lag(mapped + ge - gs) OVER (PARTITION BY o, r ORDER BY t) AS before_end FROM (
SELECT p.o, p.r, c.t, c.want, c.gs, c.ge, coalesce(bool_or(greatest(c.gs, x.s) < least(c.ge, x.e)), false) AS touch, min(CASE WHEN c.gs >= x.s AND c.ge <= x.e THEN x.off + CASE WHEN x.strand = '-' THEN x.e - c.ge ELSE c.gs - x.s END END) AS mapped
FROM (SELECT DISTINCT c.o, x.r FROM {_CAND} c JOIN {_REF} x ON x.chrom = c.chrom AND x.strand = c.strand AND c.gs // {WIDTH} <= (x.e - 1) // {WIDTH} AND x.s // {WIDTH} <= (c.ge - 1) // {WIDTH}) p JOIN {_CAND} c ON c.o = p.o JOIN {_REF} x ON x.r = p.r GROUP BY p.o, p.r, c.t, c.want, c.gs, c.ge)) GROUP BY o, r))"""


def chain_pairs(spark, sf_dir):
    every = chains(spark, sf_dir)
    foot = every.select(F.col("o").alias("candidate_id"), C.codon_footprint(F.col("blocks"), F.lit(4), F.lit(9))["segments"].alias("s")).where("s is not null")
    cand = foot.select("candidate_id", F.transform("s", lambda x: C.block(x["chrom"], x["strand"], x["start0"], x["end0"])).alias("blocks"), F.lit(9).cast("bigint").alias("cds_start0"))
    kind = F.col("o") % 4
    move = F.when(kind == 1, 1).otherwise(0)
    longer = lambda i, strand: F.when((kind == 3) & (i == 0) & (F.col("strand") == strand), 3).otherwise(0)
    moved = F.transform("blocks", lambda b, i: C.block(b["chrom"], b["strand"], b["start0"] + move - longer(i, "-"), b["end0"] + move + longer(i, "+")))
    ref = every.select(F.col("o").alias("reference_id"), F.when(kind == 2, F.slice(moved, F.lit(2), F.greatest(F.size(moved) - 1, F.lit(0)))).otherwise(moved).alias("blocks")).where("size(blocks) > 0")
    return cand, V.chain_matches(cand, ref, WIDTH)


@query("j12_chain_frames", f"SELECT o AS candidate_id, r AS reference_id, status FROM {_MATCHES}")
def j12_chains(spark, sf_dir):
    return chain_pairs(spark, sf_dir)[1]


_PLACES = ", ".join(f"'{s}'" for s in C.CHAIN_STATUS)


@query("a15_chain_evidence", f"SELECT c.o AS candidate_id, coalesce(m.status, 'no_coordinate_overlap') AS status, coalesce(n, 0) AS n_overlaps, coalesce(k, 0) AS n_concordant, coalesce(ids, '') AS matched FROM (SELECT DISTINCT o FROM {_CAND}) c LEFT JOIN (SELECT o, arg_min(status, list_position([{_PLACES}], status)) AS status, count(*) FILTER (status <> 'no_coordinate_overlap') AS n, count(*) FILTER (status = 'coordinate_frame_concordant') AS k, string_agg(r::VARCHAR, ';' ORDER BY r::VARCHAR) FILTER (status = 'coordinate_frame_concordant') AS ids FROM {_MATCHES} GROUP BY o) m ON m.o = c.o")
def a15_chains(spark, sf_dir):
    return V.chain_evidence(*chain_pairs(spark, sf_dir))


# Coding sequences of up to 60 bases over each chain; every 17th base or so is changed.
_SIZE = "(least(sum(len), 60)::BIGINT // 3) * 3"
_BASE = "substr('ACGT', ((o * 7 + i * i * 3 + i) % 4 + {k}) % 4 + 1, 1)"
_CHANGED = "CASE WHEN (i * 5 + o) % 17 = 0 THEN 1 ELSE 0 END"
_CDS = f"(SELECT o, n, (SELECT string_agg({_BASE.format(k='0')}, '' ORDER BY i) FROM (SELECT unnest(generate_series(0, n - 1)) AS i)) AS ref_cds, (SELECT string_agg({_BASE.format(k=_CHANGED)}, '' ORDER BY i) FROM (SELECT unnest(generate_series(0, n - 1)) AS i)) AS alt_cds FROM (SELECT o, {_SIZE} AS n FROM {BLOCKS} GROUP BY o))"
_AA = lambda d: _AMINO.replace("dna", d).replace("i * 3", "(c + 1) * 3")
_NEED = f"""(SELECT q.o, i AS offset0, c + 1 AS aa_position, chrom, CASE WHEN strand = '-' THEN e - (i - off) ELSE s + i - off + 1 END AS pos1, CASE WHEN strand = '-' THEN translate(rb, 'ACGT', 'TGCA') ELSE rb END AS ref, CASE WHEN strand = '-' THEN translate(ab, 'ACGT', 'TGCA') ELSE ab END AS alt FROM (
SELECT o, i, i // 3 AS c, substr(ref_cds, i + 1, 1) AS rb, substr(alt_cds, i + 1, 1) AS ab, ra, aa FROM (SELECT *, {_AA('ref_cds')} AS ra, {_AA('alt_cds')} AS aa FROM (SELECT *, i // 3 AS c FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM {_CDS})))) q JOIN {BLOCKS} b ON b.o = q.o AND i >= off AND i < off + len WHERE rb <> ab AND ra <> aa)"""
_CALLS = f"(SELECT chrom, pos1, ref, alt, max(pos1 % 50) AS qual, max(pos1 % 13) AS rr, max(pos1 % 11) AS ar FROM {_NEED} WHERE pos1 % 3 <> 0 GROUP BY ALL)"
_EVENTS = f"""(SELECT n.*, CASE WHEN k.pos1 IS NOT NULL THEN 'known_editing' WHEN v.pos1 IS NULL THEN 'missing' WHEN qual >= 10 AND rr + ar >= 5 AND ar >= 2 AND (CASE WHEN rr + ar > 0 THEN ar / (rr + ar) ELSE 0 END) >= 0.1 THEN 'supported' ELSE 'weak' END AS event
FROM {_NEED} n LEFT JOIN {_CALLS} v USING (chrom, pos1, ref, alt) LEFT JOIN (SELECT DISTINCT chrom, pos1, ref, alt FROM {_NEED} WHERE pos1 % 19 = 0) k USING (chrom, pos1, ref, alt))"""


def coding_parents(spark, sf_dir):
    """parent_id, blocks, reference_cds, candidate_cds, protein."""
    n = F.floor(F.least(F.aggregate("blocks", F.lit(0).cast("bigint"), lambda a, b: a + b["end0"] - b["start0"]), F.lit(60)) / 3) * 3
    # The bases of an order depend on o % 4, its changes on o % 17 too: 4 and 68 sequences of 60
    # bases, of which the first n are taken.
    base = lambda o, i, k: "ACGT"[((o * 7 + i * i * 3 + i) % 4 + k) % 4]
    whole = lambda o, every: "".join(base(o, i, int(every and (i * 5 + o) % 17 == 0)) for i in range(60))
    cds = lambda m, every: F.substring(F.get(F.array(*[F.lit(whole(o, every)) for o in range(m)]), (F.col("o") % m).cast("int")), F.lit(1), F.col("n").cast("int"))
    c = chains(spark, sf_dir).withColumn("n", n)
    c = c.select("o", "blocks", cds(4, False).alias("reference_cds"), cds(68, True).alias("candidate_cds"))
    protein = S.translate_codons(F.when(F.col("o") % 6 == 0, F.col("reference_cds")).otherwise(F.col("candidate_cds")))
    return c.select(F.col("o").alias("parent_id"), "blocks", "reference_cds", "candidate_cds", protein.alias("protein"))


def coding_events(spark, sf_dir):
    parents = coding_parents(spark, sf_dir)
    # Changes are matched with calls and sites that are made from them: made once for the three.
    need = stored(spark, V.required_changes(parents), "changes")
    key = ["chrom", "pos1", "ref", "alt"]
    p = F.col("pos1")
    calls = need.where(p % 3 != 0).groupBy(*key).agg(F.max(p % 50).alias("qual"), F.max(p % 13).alias("ref_reads"), F.max(p % 11).alias("alt_reads")).withColumn("filters", F.lit("PASS"))
    return parents, V.change_events(need, calls, need.where(p % 19 == 0).select(*key), 10, 5, 2, 0.1)


@query("f20_required_changes", f"SELECT o AS parent_id, offset0, aa_position, chrom, pos1, ref, alt FROM {_NEED}")
def f20_changes(spark, sf_dir):
    n = V.required_changes(coding_parents(spark, sf_dir))
    return n.select("parent_id", F.col("offset0").cast("bigint").alias("offset0"), F.col("aa_position").cast("bigint").alias("aa_position"), "chrom", "pos1", "ref", "alt")


@query("j15_change_events", f"SELECT o AS parent_id, offset0, chrom, pos1, ref, alt, event FROM {_EVENTS}")
def j15_events(spark, sf_dir):
    return coding_events(spark, sf_dir)[1].select("parent_id", F.col("offset0").cast("bigint").alias("offset0"), "chrom", "pos1", "ref", "alt", "event")


@query(
    "f21_rescue_verdicts",
    f"""SELECT c.o AS parent_id, coalesce(k, 0) AS n_required, coalesce(good, 0) AS n_supported, CASE WHEN c.o % 6 = 0 OR k IS NULL THEN 'reference_concordant' WHEN edited > 0 THEN 'known_editing_excluded' WHEN weak > 0 THEN 'insufficient_support' ELSE 'rescued' END AS verdict
FROM {_CDS} c LEFT JOIN (SELECT o, count(*) AS k, count(*) FILTER (event = 'supported') AS good, count(*) FILTER (event = 'known_editing') AS edited, count(*) FILTER (event IN ('weak', 'missing')) AS weak FROM {_EVENTS} GROUP BY o) s ON s.o = c.o""",
)
def f21_verdicts(spark, sf_dir):
    return V.rescue(*coding_events(spark, sf_dir))


@query("s22_checked_chains", f"SELECT o, count(*)::INTEGER AS n_blocks, min(s) AS first_start, max(e) AS last_end FROM {BLOCKS} GROUP BY o")
def s22_checked(spark, sf_dir):
    each = chains(spark, sf_dir).select("o", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("ord", "b"))
    rows = each.select("o", "n_blocks", "ord", "b.*", F.lit("pass").alias("status"), F.lit("b38").alias("build"))
    failed = rows.withColumns({"status": F.lit("fail"), "start0": F.lit(-1).cast("bigint")})
    c = sources.checked_chains(rows.unionByName(failed), "o", "ord", "b38")
    at = lambda f: F.transform("blocks", f)
    return c.select("o", F.size("blocks").alias("n_blocks"), F.array_min(at(lambda b: b["start0"])).alias("first_start"), F.array_max(at(lambda b: b["end0"])).alias("last_end"))
