"""Queries of the quality-control rules. Line items stand for search hits and variant
calls, orders for expression values, document texts for sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq.functions import sequences as S
from loomseq.operators import qc
from loomseq.plans.registry import query, table

HITS = "(SELECT *, l_quantity * 2 AS pident, l_discount * 2e-4 AS evalue, 100 - l_tax * 200 AS qcov FROM lineitem)"


def hits(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.withColumns({"pident": F.col("l_quantity") * 2, "evalue": F.col("l_discount") * 2e-4, "qcov": 100 - F.col("l_tax") * 200})


_HIT = "list_filter([CASE WHEN pident <> 100 THEN 'identity_not_exact' END, CASE WHEN evalue > 1e-5 THEN 'evalue_too_high' END, CASE WHEN qcov < 90 THEN 'coverage_too_low' END], lambda x: x IS NOT NULL)"


@query("p1_hit_qc", f"SELECT l_orderkey, l_linenumber, array_to_string(r, ';') AS reasons, CASE WHEN len(r) = 0 THEN 'pass' ELSE 'excluded' END AS status FROM (SELECT *, {_HIT} AS r FROM {HITS})")
def p1(spark, sf_dir):
    h = hits(spark, sf_dir).withColumn("r", qc.hit_reasons(F.col("pident"), F.col("evalue"), F.col("qcov")))
    return h.select("l_orderkey", "l_linenumber", qc.reason_text(F.col("r")).alias("reasons"), qc.status(F.col("r")).alias("status"))


@query(
    "a12_stage_counts",
    f"""SELECT stage, n FROM (SELECT count(*) AS n_input, count(*) FILTER (pident = 100) AS n_identity, count(*) FILTER (pident = 100 AND evalue <= 1e-5) AS n_evalue, count(*) FILTER (pident = 100 AND evalue <= 1e-5 AND qcov >= 90) AS n_coverage FROM {HITS}) UNPIVOT (n FOR stage IN (n_input, n_identity, n_evalue, n_coverage))""",
)
def a12(spark, sf_dir):
    a, b, c = F.col("pident") == 100, F.col("evalue") <= 1e-5, F.col("qcov") >= 90
    return qc.stage_counts(hits(spark, sf_dir), n_input=F.lit(True), n_identity=a, n_evalue=a & b, n_coverage=a & b & c)


_SEQ = "regexp_replace(upper(trim(regexp_replace(coalesce(text, ''), '[^A-Za-z .*-]', '', 'g'))), '\\*$', '')"


@query(
    "p2_sequence_qc",
    f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN s = '' THEN 'empty' END, CASE WHEN contains(s, '*') THEN 'internal_stop' END, CASE WHEN contains(s, '-') THEN 'gap' END,
CASE WHEN o <> '' THEN 'noncanonical:' || o END, CASE WHEN s <> '' AND length(s) < 8 THEN 'too_short' END], lambda x: x IS NOT NULL), ';') AS reasons
FROM (SELECT doc_id, s, array_to_string(list_sort(list_distinct(string_split(regexp_replace(s, '[ACDEFGHIKLMNPQRSTVWY*-]', '', 'g'), ''))), '') AS o FROM (SELECT doc_id, {_SEQ} AS s FROM documents))""",
)
def p2(spark, sf_dir):
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z .*-]", "")
    d = table(spark, sf_dir, "documents").select("doc_id", S.normal_sequence(clean).alias("s"))
    return d.select("doc_id", qc.reason_text(qc.sequence_reasons(F.col("s"))).alias("reasons"))


_CLASS = "CASE WHEN event_id % 7 = 0 THEN 'not_evaluated' WHEN len(t) = 0 THEN 'unresolved' WHEN len(list_intersect(t, ['click', 'view'])) = 0 THEN 'not_contaminant' WHEN len(list_intersect(t, ['click', 'view'])) = len(t) THEN 'exclusive_contaminant' ELSE 'mixed' END"
_TAXA = f"(SELECT event_id, user_id, {_CLASS} AS status FROM (SELECT event_id, user_id, list_distinct(list_filter([event_type, CASE WHEN value > 50 THEN 'other' END], lambda x: x IS NOT NULL AND event_id % 11 <> 0)) AS t FROM events))"


def classed(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.when(F.col("event_id") % 11 == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(F.array(F.col("event_type"), F.when(F.col("value") > 50, "other")))))
    black = F.array(F.lit("click"), F.lit("view"))
    return e.select("event_id", "user_id", qc.blacklist_class(t, black, F.col("event_id") % 7 != 0).alias("status"))


@query("p3_blacklist_class", f"SELECT event_id, status FROM {_TAXA}")
def p3(spark, sf_dir):
    return classed(spark, sf_dir).select("event_id", "status")


@query(
    "p4_peptide_verdict",
    f"""SELECT user_id, CASE WHEN len(s) = 1 AND list_contains(s, 'exclusive_contaminant') THEN 'contaminant_only' WHEN list_contains(s, 'exclusive_contaminant') OR list_contains(s, 'mixed') THEN 'retained_with_flag' ELSE 'retained' END AS verdict, array_to_string(s, ';') AS statuses
FROM (SELECT user_id, list_sort(list_distinct(list(status))) AS s FROM {_TAXA} GROUP BY user_id)""",
)
def p4(spark, sf_dir):
    s = F.array_sort(F.collect_set("status"))
    g = classed(spark, sf_dir).groupBy("user_id").agg(s.alias("s"))
    return g.select("user_id", qc.peptide_verdict(F.col("s")).alias("verdict"), F.array_join("s", ";").alias("statuses"))


EXPRESSION = "(SELECT o_custkey, sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END) / 1e5 AS tumor, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) / 1e5 AS ctrl FROM orders GROUP BY o_custkey)"


def expression(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    side = lambda c: F.sum(F.when(c, F.col("o_totalprice"))) / 1e5
    return o.groupBy("o_custkey").agg(side(F.col("o_orderstatus") != "F").alias("tumor"), side(F.col("o_orderstatus") == "F").alias("ctrl"))


@query(
    "p5_expression_gate",
    f"""SELECT o_custkey, array_to_string(list_filter([CASE WHEN coalesce(tumor < 4, true) THEN 'tumor_low' END, CASE WHEN coalesce(ctrl > 8, true) THEN 'control_high' END, CASE WHEN coalesce(log2((tumor + 1) / (ctrl + 1)) < 0.25, true) THEN 'fold_low' END], lambda x: x IS NOT NULL), ';') AS reasons FROM {EXPRESSION}""",
)
def p5(spark, sf_dir):
    e = expression(spark, sf_dir)
    return e.select("o_custkey", qc.reason_text(qc.expression_reasons(F.col("tumor"), F.col("ctrl"), 4.0, 8.0, 0.25)).alias("reasons"))


@query(
    "p6_parent_admission",
    f"""SELECT c_custkey, array_to_string(list_filter([CASE WHEN n.n_nationkey IS NULL OR n.n_regionkey > 2 THEN 'not_in_kept_list' END, CASE WHEN e.o_custkey IS NULL THEN 'source_join_failure' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'class_not_accepted' END, CASE WHEN coalesce(e.tumor < 4, true) THEN 'tumor_low' END], lambda x: x IS NOT NULL), ';') AS reasons
FROM customer LEFT JOIN nation n ON n.n_nationkey = c_nationkey LEFT JOIN {EXPRESSION} e ON e.o_custkey = c_custkey""",
)
def p6(spark, sf_dir):
    kept = table(spark, sf_dir, "nation").where("n_regionkey <= 2").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("kept"))
    e = expression(spark, sf_dir).select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("found"), "tumor")
    c = table(spark, sf_dir, "customer").join(kept, "c_nationkey", "left").join(e, "c_custkey", "left")
    r = qc.reasons(("not_in_kept_list", F.col("kept").isNull()), ("source_join_failure", F.col("found").isNull()), ("class_not_accepted", ~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), ("tumor_low", F.col("tumor") < 4))
    return c.select("c_custkey", qc.reason_text(r).alias("reasons"))


@query(
    "p7_aberrant_annotation",
    f"SELECT o_custkey, CASE WHEN tumor IS NULL THEN 'control_only' WHEN ctrl IS NULL THEN 'tumor_only' WHEN tumor >= ctrl THEN 'up' ELSE 'down' END AS nc_class, round(log2((coalesce(tumor, 0) + 1) / (coalesce(ctrl, 0) + 1)), 6) AS fold, coalesce(tumor, 0) >= 4 AND log2((coalesce(tumor, 0) + 1) / (coalesce(ctrl, 0) + 1)) >= 1 AS is_aberrant FROM {EXPRESSION}",
)
def p7(spark, sf_dir):
    t, c = F.coalesce("tumor", F.lit(0.0)), F.coalesce("ctrl", F.lit(0.0))
    kind = qc.ladder((F.col("tumor").isNull(), "control_only"), (F.col("ctrl").isNull(), "tumor_only"), (F.col("tumor") >= F.col("ctrl"), "up"), otherwise="down")
    fold = qc.log2_fold(t, c)
    return expression(spark, sf_dir).select("o_custkey", kind.alias("nc_class"), F.round(fold, 6).alias("fold"), ((t >= 4) & (fold >= 1)).alias("is_aberrant"))


CALLS = "(SELECT *, l_quantity AS qual, l_suppkey % 40 AS ref_n, l_partkey % 12 AS alt_n, CASE WHEN l_returnflag = 'R' THEN 'q10' ELSE 'PASS' END AS flt FROM lineitem)"


def calls(spark, sf_dir):
    flt = F.when(F.col("l_returnflag") == "R", "q10").otherwise("PASS")
    return table(spark, sf_dir, "lineitem").withColumns({"qual": F.col("l_quantity"), "ref_n": F.col("l_suppkey") % 40, "alt_n": F.col("l_partkey") % 12, "flt": flt})


_VAR = "list_filter([CASE WHEN qual < 20 THEN 'low_quality' END, CASE WHEN ref_n + alt_n < 10 THEN 'low_depth' END, CASE WHEN alt_n < t THEN 'low_alt' END, CASE WHEN (CASE WHEN ref_n + alt_n > 0 THEN alt_n / (ref_n + alt_n)::DOUBLE ELSE 0 END) < 0.1 THEN 'low_share' END, CASE WHEN flt NOT IN ('PASS', '.') THEN 'filtered' END], lambda x: x IS NOT NULL)"


@query("p8_variant_evidence", f"SELECT l_orderkey, l_linenumber, array_to_string({_VAR}, ';') AS reasons FROM (SELECT *, 3 AS t FROM {CALLS})")
def p8(spark, sf_dir):
    r = qc.variant_reasons(F.col("qual"), F.col("ref_n"), F.col("alt_n"), F.col("flt"), 20.0, 10, F.lit(3), 0.1)
    return calls(spark, sf_dir).select("l_orderkey", "l_linenumber", qc.reason_text(r).alias("reasons"))


@query("a11_threshold_sweep", f"SELECT t AS min_alt, count(*) FILTER (len({_VAR}) = 0) AS n_pass, count(*) AS n_all FROM (SELECT *, unnest([2, 3, 5]) AS t FROM {CALLS}) GROUP BY t")
def a11(spark, sf_dir):
    swept = calls(spark, sf_dir).withColumn("min_alt", F.explode(F.array(F.lit(2), F.lit(3), F.lit(5))))
    r = qc.variant_reasons(F.col("qual"), F.col("ref_n"), F.col("alt_n"), F.col("flt"), 20.0, 10, F.col("min_alt"), 0.1)
    return swept.groupBy("min_alt").agg(F.count_if(F.size(r) == 0).alias("n_pass"), F.count("*").alias("n_all"))


@query("p9_length_filter", "SELECT p_partkey, length(p_name) AS n FROM part WHERE length(p_name) BETWEEN 1 AND 99")
def p9(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.length("p_name").alias("n")).where(F.col("n").between(1, 99))


@query("p10_novel_intervals", "SELECT 'chr' || l_suppkey AS chrom, l_partkey - 1 AS start0, l_partkey + l_quantity::BIGINT AS end0, l_orderkey || '.' || l_linenumber AS name FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def p10(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "N"))
    return l.select(F.concat(F.lit("chr"), "l_suppkey").alias("chrom"), (F.col("l_partkey") - 1).alias("start0"), (F.col("l_partkey") + F.col("l_quantity").cast("bigint")).alias("end0"), F.concat_ws(".", "l_orderkey", "l_linenumber").alias("name"))


@query(
    "p11_transcript_keep",
    "SELECT l_orderkey, bool_and(CASE WHEN l_returnflag <> 'N' THEN CASE WHEN l_orderkey % 2 = 0 THEN l_linestatus = 'F' ELSE l_linestatus IN ('F', 'O') END END) AND count(*) FILTER (l_returnflag <> 'N') > 0 AS keep FROM lineitem GROUP BY l_orderkey",
)
def p11(spark, sf_dir):
    annotated = F.col("l_returnflag") != "N"
    allowed = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_linestatus") == "F").otherwise(F.col("l_linestatus").isin("F", "O"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.bool_and(F.when(annotated, allowed)) & (F.count_if(annotated) > 0)).alias("keep"))


@query("p12_context_rules", "SELECT l_orderkey, l_linenumber, c, regexp_matches(c, '^\\||\\|$|\\|\\||Intergenic') AS dropped FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN '|' || l_shipmode2 WHEN 1 THEN l_shipmode2 || '||x' WHEN 2 THEN 'Intergenic|' || l_shipmode2 ELSE l_shipmode2 || '|y' END AS c FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode2 FROM lineitem))")
def p12(spark, sf_dir):
    x = F.concat("l_returnflag", "l_linestatus")
    k = F.col("l_linenumber") % 4
    c = F.when(k == 0, F.concat(F.lit("|"), x)).when(k == 1, F.concat(x, F.lit("||x"))).when(k == 2, F.concat(F.lit("Intergenic|"), x)).otherwise(F.concat(x, F.lit("|y")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c.alias("c")).withColumn("dropped", F.col("c").rlike(r"^\||\|$|\|\||Intergenic"))


@query("p13_mapping_status", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 5 THEN 'ambiguous' WHEN l_tax > 0.06 THEN 'translation_mismatch' WHEN l_discount > 0.07 THEN 'coordinate_mismatch' ELSE 'pass' END AS mapping FROM lineitem")
def p13(spark, sf_dir):
    m = qc.ladder((F.col("l_linenumber") > 5, "ambiguous"), (F.col("l_tax") > 0.06, "translation_mismatch"), (F.col("l_discount") > 0.07, "coordinate_mismatch"), otherwise="pass")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", m.alias("mapping"))


@query(
    "p14_coordinate_ladder",
    "SELECT l_orderkey, l_linenumber, coalesce(r[1], 'pass') AS status, array_to_string(list_sort(list_distinct(r)), ';') AS reasons FROM (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_quantity > 45 THEN 'no_blocks' END, CASE WHEN l_tax > 0.06 THEN 'frame_error' END, CASE WHEN l_discount > 0.08 THEN 'build_mismatch' END], lambda x: x IS NOT NULL) AS r FROM lineitem)",
)
def p14(spark, sf_dir):
    r = qc.reasons(("no_blocks", F.col("l_quantity") > 45), ("frame_error", F.col("l_tax") > 0.06), ("build_mismatch", F.col("l_discount") > 0.08))
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r.alias("r"))
    return l.select("l_orderkey", "l_linenumber", F.coalesce(F.get("r", F.lit(0)), F.lit("pass")).alias("status"), F.array_join(F.array_sort(F.array_distinct("r")), ";").alias("reasons"))


@query("p18_supported_kinds", "SELECT event_id, event_type IN ('click', 'purchase') AS supported FROM events")
def p18(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").isin("click", "purchase").alias("supported"))


@query("p19_control_class", "SELECT event_id, CASE WHEN event_type = 'view' THEN 'context_control' WHEN value IS NOT NULL AND value < 50 THEN 'matched_wild_type' ELSE 'not_evaluable' END AS control FROM events")
def p19(spark, sf_dir):
    c = qc.ladder((F.col("event_type") == "view", "context_control"), (F.col("value").isNotNull() & (F.col("value") < 50), "matched_wild_type"), otherwise="not_evaluable")
    return table(spark, sf_dir, "events").select("event_id", c.alias("control"))


_TIERS = [("High", 7, 0.02, 0.02), ("Moderate", 5, 0.04, 0.04), ("Weak", 3, 0.06, 0.06)]
_TIER_SQL = "CASE " + " ".join(f"WHEN l_quantity > {q * 5} AND l_tax < {t} AND l_discount < {d} THEN '{n}'" for n, q, t, d in _TIERS) + " ELSE 'Subthreshold' END"


def tiers():
    return qc.tier([(n, (F.col("l_quantity") > q * 5) & (F.col("l_tax") < t) & (F.col("l_discount") < d)) for n, q, t, d in _TIERS])


@query("p20_tier_ladder", f"SELECT l_orderkey, l_linenumber, {_TIER_SQL} AS tier FROM lineitem")
def p20(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", tiers().alias("tier"))


@query("o2_tier_order", f"SELECT tier, list_position(['High', 'Moderate', 'Weak', 'Subthreshold'], tier)::BIGINT AS place, count(*) AS n FROM (SELECT {_TIER_SQL} AS tier FROM lineitem) GROUP BY tier")
def o2(spark, sf_dir):
    order = F.array(*[F.lit(x) for x in ("High", "Moderate", "Weak", "Subthreshold")])
    t = table(spark, sf_dir, "lineitem").select(tiers().alias("tier")).groupBy("tier").agg(F.count("*").alias("n"))
    return t.select("tier", F.array_position(order, F.col("tier")).alias("place"), "n").orderBy("place")


@query("p21_class_router", "SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '#[12]') THEN 'MHC-I' WHEN p_size <= 11 THEN 'MHC-I' ELSE 'MHC-II' END AS mhc_class FROM part")
def p21(spark, sf_dir):
    c = qc.ladder((F.col("p_brand").rlike("#[12]"), "MHC-I"), (F.col("p_size") <= 11, "MHC-I"), otherwise="MHC-II")
    return table(spark, sf_dir, "part").select("p_partkey", c.alias("mhc_class"))


@query(
    "p22_input_flags",
    """SELECT doc_id, array_to_string(list_filter([CASE WHEN coalesce(text, '') = '' THEN 'missing_peptide' END, CASE WHEN coalesce(lang, '') = '' THEN 'missing_hla' END, CASE WHEN regexp_matches(coalesce(text, ''), '[^A-Za-z .,\n]') THEN 'noncanonical' END, CASE WHEN n > 1 THEN 'duplicate_pair' END], lambda x: x IS NOT NULL), ';') AS flags
FROM (SELECT *, count(*) OVER (PARTITION BY md5(coalesce(text, '')), lang) AS n FROM documents)""",
)
def p22(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = F.coalesce("text", F.lit(""))
    d = d.select("doc_id", "lang", F.md5(t).alias("digest"), (t == "").alias("missing"), t.rlike("[^A-Za-z .,\n]").alias("odd"))
    d = qc.flag_duplicates(d, ["digest", "lang"])
    r = qc.reasons(("missing_peptide", F.col("missing")), ("missing_hla", F.coalesce("lang", F.lit("")) == ""), ("noncanonical", F.col("odd")), ("duplicate_pair", F.col("is_duplicate")))
    return d.select("doc_id", qc.reason_text(r).alias("flags"))


@query("p26_contract_checks", "SELECT rule, n FROM (SELECT count(*) FILTER (o_totalprice < 0) AS negative_price, count(*) FILTER (c_custkey IS NULL) AS orphan_customer, count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) AS unknown_status FROM orders LEFT JOIN customer ON c_custkey = o_custkey) UNPIVOT (n FOR rule IN (negative_price, orphan_customer, unknown_status))")
def p26(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("known"))
    o = table(spark, sf_dir, "orders").join(c, "o_custkey", "left")
    return qc.violations(o, negative_price=F.col("o_totalprice") < 0, orphan_customer=F.col("known").isNull(), unknown_status=~F.col("o_orderstatus").isin("F", "O", "P"))


@query(
    "p27_event_ladder",
    "SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'region_error' WHEN count(*) FILTER (value IS NOT NULL) = 0 THEN 'missing_context' WHEN count(*) FILTER (value > 50) = 0 THEN 'no_window' ELSE 'ok' END AS status, count(*) AS n_events, count(*) FILTER (value > 50) AS n_windows FROM events GROUP BY user_id",
)
def p27(spark, sf_dir):
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count("value").alias("values"), F.count("*").alias("n_events"), F.count_if(F.col("value") > 50).alias("n_windows"))
    s = qc.ladder((F.col("errors") > 0, "region_error"), (F.col("values") == 0, "missing_context"), (F.col("n_windows") == 0, "no_window"), otherwise="ok")
    return g.select("user_id", s.alias("status"), "n_events", "n_windows")


@query("p28_alignment_flags", "SELECT l_orderkey, l_linenumber, l_partkey & 2308 = 0 AND l_quantity >= 20 AS mapped_primary, l_partkey & 2052 = 0 AS mapped, l_partkey & 4 <> 0 AS unmapped FROM lineitem")
def p28(spark, sf_dir):
    flag = F.col("l_partkey")
    has = lambda m: flag.bitwiseAND(F.lit(m).cast("bigint"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((has(2308) == 0) & (F.col("l_quantity") >= 20)).alias("mapped_primary"), (has(2052) == 0).alias("mapped"), (has(4) != 0).alias("unmapped"))


@query("p29_tagged_reads", "SELECT user_id, count(*) AS n_total, count(*) FILTER (event_id % 2 = 1) AS n_paired, count(*) FILTER (event_id % 2 = 0) AS n_single, min(event_id || '|' || user_id || '|' || event_type) AS first_header FROM events WHERE value > 10 GROUP BY user_id")
def p29(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("value > 10")
    odd = F.col("event_id") % 2 == 1
    return e.groupBy("user_id").agg(F.count("*").alias("n_total"), F.count_if(odd).alias("n_paired"), F.count_if(~odd).alias("n_single"), F.min(F.concat_ws("|", "event_id", "user_id", "event_type")).alias("first_header"))
