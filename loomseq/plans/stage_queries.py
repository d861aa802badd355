"""Queries of scoring in two stages, support routing, residues inside peptides, and evidence of
several callers and members. Line items stand for predictions, calls and members."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq import sources
from loomseq.operators import stages
from loomseq.plans.registry import query, table

LIMITS = {"MHC-I": 20.0, "MHC-II": 30.0}
SECOND = {"MHC-I": ["N1", "N2", "N3"], "MHC-II": ["M1", "M2"]}
ORDER = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_tax"]

_TASKS = "(SELECT 'P' || p_partkey AS peptide, 'A*' || unnest([0, 1, 2, 3, 4]) AS hla_allele, 'A' AS algorithm, CASE p_partkey % 2 WHEN 0 THEN 'MHC-I' ELSE 'MHC-II' END AS mhc_class FROM part WHERE p_partkey % 17 <> 0)"
_PREDICTED = """(SELECT *, 'P' || l_partkey AS peptide, 'A*' || (l_suppkey % 5) AS hla_allele, CASE l_partkey % 2 WHEN 0 THEN 'MHC-I' ELSE 'MHC-II' END AS mhc_class,
CASE l_linenumber % 7 WHEN 0 THEN 'skipped' WHEN 1 THEN 'failed' WHEN 2 THEN 'failed' WHEN 3 THEN 'partial_ok' ELSE 'ok' END AS status,
CASE l_linenumber % 7 WHEN 1 THEN 'Parse error' WHEN 2 THEN 'timeout' ELSE '' END AS error,
CASE WHEN l_suppkey % 11 = 0 THEN '' ELSE l_quantity::BIGINT::VARCHAR END AS percentile FROM lineitem WHERE l_returnflag = 'A')"""
_LAST = f"(SELECT * FROM {_PREDICTED} QUALIFY row_number() OVER (PARTITION BY peptide, hla_allele ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_tax DESC, status DESC, error DESC, percentile DESC) = 1)"
_NUMBER = "CASE WHEN p.status IN ('ok', 'partial_ok') THEN try_cast(nullif(p.percentile, '') AS DOUBLE) END"
_ROUTED = f"""(SELECT t.*, {_NUMBER} AS percentile, coalesce(p.status, '') AS prediction_status, coalesce(p.error, '') AS error,
CASE WHEN p.status IS NULL THEN 'prediction_missing' WHEN p.status = 'skipped' THEN 'unsupported_allele' WHEN p.status = 'failed' AND p.error LIKE 'Parse%' THEN 'parse_failed' WHEN p.status = 'failed' THEN 'task_failed' WHEN p.percentile = '' THEN 'prediction_missing' WHEN {_NUMBER} < CASE t.mhc_class WHEN 'MHC-I' THEN 20 ELSE 30 END THEN 'stage1_screen_pass' ELSE 'screened_out_stage1' END AS stage_status
FROM {_TASKS} t LEFT JOIN {_LAST} p ON p.peptide = t.peptide AND p.hla_allele = t.hla_allele)"""


def mhc_class(key):
    return F.when(F.col(key) % 2 == 0, "MHC-I").otherwise("MHC-II").alias("mhc_class")


def predicted(spark, sf_dir):
    """Predictions of which keys repeat; peptides are spelt in lower case and padded."""
    n = F.col("l_linenumber") % 7
    status = F.when(n == 0, "skipped").when(n.isin(1, 2), "failed").when(n == 3, "partial_ok").otherwise("ok")
    error = F.when(n == 1, "Parse error").when(n == 2, "timeout")
    percentile = F.when(F.col("l_suppkey") % 11 == 0, "").otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    l = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'")
    return l.select(*ORDER, F.concat(F.lit(" p"), "l_partkey").alias("peptide"), F.concat(F.lit("A*"), F.col("l_suppkey") % 5).alias("hla_allele"), F.lit("A").alias("algorithm"), mhc_class("l_partkey"), status.alias("status"), error.alias("error"), percentile.alias("percentile"))


def routed(spark, sf_dir):
    alleles = F.explode(F.array(*[F.lit(f"A*{i}") for i in range(5)])).alias("hla_allele")
    tasks = table(spark, sf_dir, "part").where("p_partkey % 17 <> 0").select(F.concat(F.lit("P"), "p_partkey").alias("peptide"), alleles, F.lit("A").alias("algorithm"), mhc_class("p_partkey"))
    return stages.route_stage_one(tasks, predicted(spark, sf_dir), LIMITS, ORDER)


@query("p16_stage_one", f"SELECT peptide, hla_allele, algorithm, mhc_class, percentile, stage_status, prediction_status, error FROM {_ROUTED}")
def p16_stage_one(spark, sf_dir):
    return routed(spark, sf_dir)


@query("p16_unscreened", f"SELECT stage_status, mhc_class, count(*) AS n FROM {_ROUTED} WHERE stage_status NOT IN ('stage1_screen_pass', 'screened_out_stage1') GROUP BY ALL")
def p16_unscreened(spark, sf_dir):
    return stages.unscreened(routed(spark, sf_dir)).groupBy("stage_status", "mhc_class").agg(F.count("*").alias("n"))


@query("j18_second_stage", f"SELECT peptide, hla_allele, unnest(CASE mhc_class WHEN 'MHC-I' THEN ['N1', 'N2', 'N3'] ELSE ['M1', 'M2'] END) AS algorithm, mhc_class FROM {_ROUTED} WHERE stage_status = 'stage1_screen_pass'")
def j18_second_stage(spark, sf_dir):
    return stages.stage_two_tasks(routed(spark, sf_dir), SECOND)


@query("j18_passed_predictions", f"SELECT l_orderkey, l_linenumber, upper(p.peptide) AS peptide, p.hla_allele, p.status FROM {_PREDICTED} p SEMI JOIN (SELECT peptide, hla_allele FROM {_ROUTED} WHERE stage_status = 'stage1_screen_pass') k ON k.peptide = p.peptide AND k.hla_allele = p.hla_allele")
def j18_passed(spark, sf_dir):
    kept = stages.passed_predictions(predicted(spark, sf_dir), routed(spark, sf_dir))
    return kept.select("l_orderkey", "l_linenumber", F.upper(F.trim("peptide")).alias("peptide"), "hla_allele", "status")


@query(
    "p17_classical_routing",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN 'run'
WHEN l_returnflag = 'A' THEN CASE WHEN n BETWEEN 8 AND 15 AND (l_suppkey % 3 = 0 AND l_suppkey % 5 < 3 OR l_suppkey % 3 < 2) THEN 'run' ELSE 'skipped' END
WHEN l_suppkey % 3 = 0 AND (l_suppkey % 5 < 2 OR l_suppkey % 5 = 2 AND n IN (8, 10)) THEN 'run' ELSE 'skipped' END AS action
FROM (SELECT *, l_quantity::BIGINT % 12 + 6 AS n FROM lineitem)""",
)
def p17_classical(spark, sf_dir):
    r = table(spark, sf_dir, "region").where("r_regionkey < 3")
    lengths = F.when((F.col("algorithm") == "R") & (F.col("r_regionkey") == 2), F.array(F.lit(8), F.lit(10)))
    catalog = r.select(F.concat(F.lit("A0"), "r_regionkey", F.lit("01")).alias("allele_key"), F.explode(F.array(F.lit("A"), F.lit("R"))).alias("algorithm"), "r_regionkey").select("algorithm", "allele_key", lengths.alias("lengths"))
    k = F.col("l_suppkey") % 3
    gene = F.when(k == 0, "A").when(k == 1, "B").otherwise("E")
    l = table(spark, sf_dir, "lineitem")
    n = (F.col("l_quantity").cast("bigint") % 12 + 6).cast("int")
    tasks = l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.repeat(F.lit("A"), n).alias("peptide"), F.concat(F.lit("HLA-"), gene, F.lit("*0"), F.col("l_suppkey") % 5, F.lit(":01")).alias("hla_allele"), F.col("l_returnflag").alias("algorithm"))
    acts = sources.route_by_support(tasks, catalog, {"A": (r"^[ABC]\d", 8, 15)})
    return acts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "action")


_PEPTIDES = "(SELECT o_orderkey AS peptide_id, o_custkey % 90 AS parent_id, o_orderkey % 980 + 1 AS s, 8 + o_orderkey % 18 AS n FROM orders)"


@query(
    "j16_residue_lists",
    f"SELECT peptide_id, parent_id, count(aa) > 0 AS overlaps, coalesce(string_agg(aa::VARCHAR, ',' ORDER BY aa), '') AS positions FROM {_PEPTIDES} LEFT JOIN (SELECT DISTINCT l_suppkey % 90 AS parent, l_partkey % 997 AS aa FROM lineitem WHERE l_linenumber = 1) r ON parent = parent_id AND aa BETWEEN s AND s + n - 1 GROUP BY peptide_id, parent_id",
)
def j16_lists(spark, sf_dir):
    k = F.col("o_orderkey")
    peptides = table(spark, sf_dir, "orders").select(k.alias("peptide_id"), (F.col("o_custkey") % 90).alias("parent_id"), (k % 980 + 1).alias("peptide_start"), (k % 18 + 8).alias("peptide_length"))
    residues = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select((F.col("l_suppkey") % 90).alias("parent_id"), (F.col("l_partkey") % 997).alias("aa_position"))
    return stages.residue_overlap(peptides, residues).select("peptide_id", "parent_id", "overlaps", "positions")


_CALLS = "(SELECT *, 'chr' || (l_suppkey % 7) AS chrom, l_partkey AS pos1, l_returnflag AS ref, l_linestatus AS alt, ['mutect', 'strelka', 'vardict', 'other'][l_linenumber % 4 + 1] AS caller FROM lineitem)"
_SEEN = f"(SELECT chrom, pos1, ref, alt, list_filter(['mutect', 'strelka', 'vardict'], lambda c: list_contains(list(caller), c)) AS seen FROM {_CALLS} WHERE caller <> 'other' GROUP BY ALL)"
CALLERS = ["mutect", "strelka", "vardict"]


def calls(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    caller = F.element_at(F.array(*[F.lit(c) for c in [*CALLERS, "other"]]), F.col("l_linenumber").cast("int") % 4 + 1)
    return l.select("l_orderkey", "l_linenumber", F.concat(F.lit("chr"), F.col("l_suppkey") % 7).alias("chrom"), F.col("l_partkey").alias("pos1"), F.col("l_returnflag").alias("ref"), F.col("l_linestatus").alias("alt"), caller.alias("caller"))


@query("j19_allele_consensus", f"SELECT chrom, pos1, ref, alt, array_to_string(seen, ',') AS callers, len(seen) >= 2 AND seen[1] = 'mutect' AS shared, CASE WHEN len(seen) = 1 THEN seen[1] END AS only FROM {_SEEN}")
def j19_alleles(spark, sf_dir):
    return stages.caller_consensus(calls(spark, sf_dir), CALLERS)


@query("j19_shared_records", f"SELECT l_orderkey, l_linenumber, chrom, pos1, ref, alt FROM {_CALLS} SEMI JOIN (SELECT * FROM {_SEEN} WHERE len(seen) >= 2 AND seen[1] = 'mutect') USING (chrom, pos1, ref, alt) WHERE caller = 'mutect'")
def j19_records(spark, sf_dir):
    c = calls(spark, sf_dir)
    return stages.shared_records(c, stages.caller_consensus(c, CALLERS), "mutect").drop("caller")


@query(
    "a27_member_mean",
    "SELECT k, round(avg(s), 6) AS score, CASE WHEN count(DISTINCT st) = 1 THEN min(st) END AS status, count(DISTINCT l_linenumber) AS n_members, count(DISTINCT st) = 1 AS consistent FROM (SELECT l_partkey AS k, l_linenumber, CASE WHEN l_discount <= 0.09 THEN l_quantity END AS s, CASE WHEN l_tax > 0.07 THEN 'no_hla' ELSE 'ok' END AS st FROM lineitem) GROUP BY k",
)
def a27_members(spark, sf_dir):
    score = F.when(F.col("l_discount") <= 0.09, F.col("l_quantity")).otherwise(F.lit(float("nan")))
    m = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("member"), score.alias("score"), F.when(F.col("l_tax") > 0.07, "no_hla").otherwise("ok").alias("status"))
    return stages.ensemble_mean(m, ["k"]).withColumn("score", F.round("score", 6))


@query(
    "a16_cautious_events",
    """SELECT l_partkey, l_suppkey, n_rows, ref_reads, alt_reads, ref_reads + alt_reads AS depth, round(alt_reads / (ref_reads + alt_reads)::DOUBLE, 9) AS alt_share, qual, mapping_quality,
CASE WHEN len(f) = 1 THEN f[1] WHEN list_contains(f, 'PASS') THEN 'mixed_filter_status' ELSE array_to_string(f, ';') END AS filters, CASE WHEN a = b THEN a ELSE 'collapsed_duplicate_exact_event' END AS record_id,
CASE WHEN n_rows = 1 THEN 'unique' WHEN n = 1 THEN 'collapsed_duplicate_exact_event' ELSE 'conflicting_duplicate_not_evaluable' END AS duplicate_status
FROM (SELECT l_partkey, l_suppkey, count(*) AS n_rows, max(r) AS ref_reads, min(l_linenumber) AS alt_reads, min(l_discount) AS qual, min(l_tax) AS mapping_quality, list_sort(list_distinct(list(fl))) AS f, min(id) AS a, max(id) AS b, count(DISTINCT (r, l_linenumber, l_discount, l_tax, fl)) AS n
FROM (SELECT *, l_quantity::BIGINT AS r, CASE l_linenumber % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'q10' WHEN 2 THEN 'q20' ELSE '' END AS fl, 'r' || (l_linenumber % 2) AS id FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 4)) GROUP BY l_partkey, l_suppkey)""",
)
def a16_cautious(spark, sf_dir):
    """Line items with those of one number repeated, so that there are equal duplicates too."""
    l = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber") % 4
    rows = l.unionAll(l.where("l_linenumber = 4")).select("l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("ref_reads"), F.col("l_linenumber").alias("alt_reads"), F.col("l_discount").alias("qual"), F.col("l_tax").alias("mapping_quality"), F.when(n == 0, "PASS").when(n == 1, "q10").when(n == 2, "q20").alias("filters"), F.concat(F.lit("r"), F.col("l_linenumber") % 2).alias("record_id"))
    return stages.collapse_events(rows, ["l_partkey", "l_suppkey"]).withColumn("alt_share", F.round("alt_share", 9))
