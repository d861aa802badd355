"""Queries of the joins. Document windows stand for candidate peptides, benchmark windows
for the reference proteome, two halves of the sources for tumor and normal."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq.functions import packed as P
from loomseq.functions import sequences as S
from loomseq.operators import joins as J
from loomseq.plans.qc_queries import EXPRESSION, expression
from loomseq.plans.registry import query, table
from loomseq.plans.sequence_queries import PARENTS, parents

WIN = f"(SELECT doc_id, source, lang, unnest(list_transform(generate_series(1, length(seq) - 8), lambda p: substr(seq, p::BIGINT, 9))) AS pep FROM {PARENTS})"
REF = "(SELECT DISTINCT unnest(list_transform(generate_series(1, length(part) - 8), lambda p: substr(part, p::BIGINT, 9))) AS pep FROM (SELECT unnest(regexp_split_to_array(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '[^ACDEFGHIKLMNPQRSTVWY]+')) AS part FROM benchmark))"
TUMOR = "(right(source, 1) IN ('0', '2', '4', '6', '8'))"


def win(spark, sf_dir):
    return S.windows(parents(spark, sf_dir), "seq", [9])


def is_tumor():
    return F.right("source", F.lit(1)).isin("0", "2", "4", "6", "8")


def reference(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(S.letters_only(F.col("text")).alias("seq"))


@query("j4_reference_match", f"SELECT lang, count(*) AS n_windows, count(DISTINCT w.pep) AS n_distinct, count(r.pep) AS n_matched, count(*) - count(r.pep) AS n_kept FROM {WIN} w LEFT JOIN {REF} r ON r.pep = w.pep GROUP BY lang")
def j4(spark, sf_dir):
    # Windows are counted as numbers before they are shuffled, so a frequent one is a small row.
    w = P.counted_windows(parents(spark, sf_dir), "seq", 9, ["lang"], "key").repartition("key")
    keys = w.groupBy("lang", "key").agg(F.sum("n_windows").alias("n"))
    known = J.reference_windows(reference(spark, sf_dir), "seq", [9]).select(P.window_code(F.col("peptide"), 9).alias("key"))
    m = J.subtract(keys, known, ["key"])
    hit = F.sum(F.when(F.col("excluded"), F.col("n")).otherwise(0))
    return m.groupBy("lang").agg(F.sum("n").alias("n_windows"), F.count("*").alias("n_distinct"), hit.alias("n_matched"), (F.sum("n") - hit).alias("n_kept"))


@query(
    "j3_peptide_subtraction",
    f"""SELECT t.lang, count(*) AS n_keys, count(n.pep) AS n_excluded, coalesce(sum(n.parents), 0)::BIGINT AS normal_parents, min(CASE WHEN n.pep IS NULL THEN t.pep END) AS first_kept
FROM (SELECT DISTINCT lang, pep FROM {WIN} WHERE {TUMOR}) t LEFT JOIN (SELECT lang, pep, count(DISTINCT doc_id) AS parents FROM {WIN} WHERE NOT {TUMOR} GROUP BY ALL) n ON n.lang = t.lang AND n.pep = t.pep GROUP BY t.lang""",
)
def j3(spark, sf_dir):
    # One tiling and one exchange: a key's tumor and normal parents are counted together.
    p = parents(spark, sf_dir).select("lang", is_tumor().alias("tumor"), "seq")
    w = P.counted_windows(p, "seq", 9, ["lang", "tumor"]).repartition("code")
    n = lambda c: F.sum(F.when(c, F.col("n_rows")).otherwise(0))
    keys = w.groupBy("lang", "code").agg(n(F.col("tumor")).alias("here"), n(~F.col("tumor")).alias("parents")).where("here > 0")
    out = F.col("parents") > 0
    g = keys.groupBy("lang").agg(F.count("*").alias("n_keys"), F.count_if(out).alias("n_excluded"), F.sum("parents").alias("normal_parents"), F.min(F.when(~out, F.col("code"))).alias("first"))
    return g.select("lang", "n_keys", "n_excluded", "normal_parents", P.window_text(F.col("first"), 9).alias("first_kept"))


@query("j2_exact_parents", f"SELECT doc_id, sha256(seq) IN (SELECT sha256(seq) FROM {PARENTS} WHERE NOT {TUMOR}) AS excluded FROM {PARENTS} WHERE {TUMOR}")
def j2(spark, sf_dir):
    p = parents(spark, sf_dir).select("doc_id", "source", F.sha2("seq", 256).alias("parent_sha"))
    normal = p.where(~is_tumor()).select("parent_sha").distinct()
    return J.subtract(p.where(is_tumor()), normal, ["parent_sha"]).select("doc_id", "excluded")


@query("j1_catalog_consistency", "SELECT l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct(list(t))), ',') AS matched FROM (SELECT l_orderkey, l_linenumber, l_partkey, unnest(list_distinct([p_size % 5, l_suppkey % 5])) AS t FROM lineitem JOIN part ON p_partkey = l_partkey) JOIN (SELECT p_partkey, p_size % 5 AS tax FROM part WHERE p_size % 2 = 0) ON p_partkey = l_partkey AND tax = t GROUP BY ALL")
def j1(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    taxa = F.array_distinct(F.array((F.col("p_size") % 5).cast("bigint"), F.col("l_suppkey") % 5))
    l = table(spark, sf_dir, "lineitem").join(p.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
    h = l.select(F.struct("l_orderkey", "l_linenumber").alias("row_id"), "l_partkey", taxa.alias("taxa"))
    catalog = p.where("p_size % 2 = 0").select("p_partkey", (F.col("p_size") % 5).cast("bigint").alias("tax"))
    m = J.consistent_hits(h, catalog, "l_partkey", "taxa")
    return m.select("row_id.l_orderkey", "row_id.l_linenumber", F.array_join("matched_taxa", ",").alias("matched")).distinct()


@query("j5_external_match", "SELECT l_orderkey, l_linenumber, a.n IS NOT NULL AS in_index, coalesce(b.n, 0) AS n_evidence, CASE WHEN a.n IS NOT NULL OR b.n IS NOT NULL THEN 'excluded' ELSE 'retained' END AS routing FROM lineitem LEFT JOIN (SELECT p_partkey AS k, 1 AS n FROM part WHERE p_size < 20) a ON a.k = l_partkey LEFT JOIN (SELECT ps AS k, count(*) AS n FROM (SELECT s_suppkey % 50 AS ps FROM supplier WHERE s_acctbal > 0) GROUP BY ps) b ON b.k = l_partkey % 100")
def j5(spark, sf_dir):
    a = table(spark, sf_dir, "part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"), F.lit(1).alias("a"))
    b = table(spark, sf_dir, "supplier").where("s_acctbal > 0").groupBy((F.col("s_suppkey") % 50).alias("k")).agg(F.count("*").alias("n_evidence"))
    l = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_partkey") % 100)
    x = J.subtract(l, a, ["l_partkey"]).withColumnRenamed("excluded", "in_index")
    x = J.subtract(x, b, ["k"], ["n_evidence"])
    return x.select("l_orderkey", "l_linenumber", "in_index", F.coalesce("n_evidence", F.lit(0)).alias("n_evidence"), F.when(F.col("in_index") | F.col("excluded"), "excluded").otherwise("retained").alias("routing"))


@query("j6_expression_join", f"SELECT o_custkey, round(tumor, 3) AS tumor, round(ctrl, 3) AS ctrl FROM {EXPRESSION} WHERE tumor IS NOT NULL AND ctrl IS NOT NULL")
def j6(spark, sf_dir):
    e = expression(spark, sf_dir)
    t, c = (e.where(f"{x} is not null").select("o_custkey", F.round(x, 3).alias(x)) for x in ("tumor", "ctrl"))
    return t.join(c, "o_custkey")


@query("j7_kept_records", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def j7(spark, sf_dir):
    kept = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(kept, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@query("j8_removal_causes", "SELECT o_orderkey, concat_ws(';', CASE WHEN c.c_custkey IS NOT NULL THEN 'customer' END, CASE WHEN l.k IS NOT NULL THEN 'returned' END) AS cause FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) c ON c.c_custkey = o_custkey LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') l ON l.k = o_orderkey")
def j8(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.lit("customer").alias("a"))
    r = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("returned").alias("b")).distinct()
    return table(spark, sf_dir, "orders").join(c, "o_custkey", "left").join(r, "o_orderkey", "left").select("o_orderkey", F.concat_ws(";", "a", "b").alias("cause"))


@query("j9_denormalise", "SELECT l_orderkey, l_linenumber, p_brand, s_name, n_name FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey")
def j9(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = table(spark, sf_dir, "supplier").join(n, "s_nationkey", "left").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name")
    s = J.keep_first(s, ["l_suppkey"], ["s_name"])
    return table(spark, sf_dir, "lineitem").join(p, "l_partkey").join(s, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "p_brand", "s_name", "n_name")


TASKS = "(SELECT DISTINCT p_partkey, 'A*' || r_regionkey AS hla, flag AS algorithm, CASE WHEN p_size <= 25 THEN 'MHC-I' ELSE 'MHC-II' END AS mhc FROM part, region, (SELECT unnest(['A', 'N', 'R']) AS flag) WHERE (p_size <= 25) = (r_regionkey < 3) AND (flag <> 'N' OR p_size <= 25))"


def tasks(spark, sf_dir):
    mhc = F.when(F.col("p_size") <= 25, "MHC-I").otherwise("MHC-II").alias("mhc")
    peptides = table(spark, sf_dir, "part").select("p_partkey", mhc)
    alleles = table(spark, sf_dir, "region").select(F.when(F.col("r_regionkey") < 3, "MHC-I").otherwise("MHC-II").alias("mhc"), F.concat(F.lit("A*"), "r_regionkey").alias("hla"))
    algorithms = spark.createDataFrame([("MHC-I", x) for x in "ANR"] + [("MHC-II", x) for x in "AR"], "mhc string, algorithm string")
    return J.task_product(peptides, alleles, algorithms, ["mhc"])


@query("j10_task_product", f"SELECT p_partkey, hla, algorithm, mhc FROM {TASKS}")
def j10(spark, sf_dir):
    return tasks(spark, sf_dir).select("p_partkey", "hla", "algorithm", "mhc")


@query("j10_chain_pairs", "SELECT a.n_regionkey AS sample, a.x || '-' || b.x AS hla_allele FROM (SELECT n_regionkey, CASE n_nationkey % 2 WHEN 0 THEN 'DP' ELSE 'DQ' END AS l, 'A' || n_nationkey AS x FROM nation WHERE n_nationkey % 4 < 2) a JOIN (SELECT n_regionkey, CASE n_nationkey % 2 WHEN 0 THEN 'DP' ELSE 'DQ' END AS l, 'B' || n_nationkey AS x FROM nation WHERE n_nationkey % 4 >= 2) b ON a.n_regionkey = b.n_regionkey AND a.l = b.l")
def j10b(spark, sf_dir):
    k = F.col("n_nationkey") % 4
    gene = F.when(k == 0, "DPA1").when(k == 1, "DQA1").when(k == 2, "DPB1").otherwise("DQB1")
    a = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("sample"), gene.alias("gene"), F.concat(F.when(k < 2, "A").otherwise("B"), "n_nationkey").alias("allele"))
    return J.chain_pairs(a, ["DPA1", "DQA1"], ["DPB1", "DQB1"])


PREDICTIONS = "(SELECT * EXCLUDE rn FROM (SELECT l_partkey AS p_partkey, 'A*' || (l_suppkey % 5) AS hla, l_returnflag AS algorithm, CASE WHEN l_discount > 0.08 THEN 'error' WHEN l_discount > 0.07 THEN 'partial_ok' ELSE 'ok' END AS status, l_extendedprice AS ic50, l_tax * 100 AS pct, row_number() OVER (PARTITION BY l_partkey, l_suppkey % 5, l_returnflag ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_tax, l_discount) AS rn FROM lineitem) WHERE rn = 1)"


def predictions(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.concat(F.lit("A*"), F.col("l_suppkey") % 5).alias("hla"), F.col("l_returnflag").alias("algorithm"), F.when(F.col("l_discount") > 0.08, "error").when(F.col("l_discount") > 0.07, "partial_ok").otherwise("ok").alias("status"), F.col("l_extendedprice").alias("ic50"), (F.col("l_tax") * 100).alias("pct"), "l_orderkey", "l_linenumber", "l_tax", "l_discount")
    first = J.keep_first(l, ["p_partkey", "hla", "algorithm"], ["l_orderkey", "l_linenumber", "ic50", "l_tax", "l_discount"])
    return first.drop("l_orderkey", "l_linenumber", "l_tax", "l_discount")


@query("j11_attach_predictions", f"SELECT t.p_partkey, t.hla, t.algorithm, coalesce(p.status, 'missing') AS status, p.ic50 FROM {TASKS} t LEFT JOIN {PREDICTIONS} p USING (p_partkey, hla, algorithm)")
def j11(spark, sf_dir):
    t = tasks(spark, sf_dir).join(predictions(spark, sf_dir), ["p_partkey", "hla", "algorithm"], "left")
    return t.select("p_partkey", "hla", "algorithm", F.coalesce("status", F.lit("missing")).alias("status"), "ic50")


ROUTE = "CASE WHEN p.status IS NULL THEN 'missing' WHEN p.status = 'partial_ok' THEN 'unsupported' WHEN p.status = 'error' THEN 'task_failed' WHEN p.pct < 4 THEN 'pass' ELSE 'screened_out' END"


def routed(spark, sf_dir):
    t = tasks(spark, sf_dir).where("algorithm = 'A'").join(predictions(spark, sf_dir), ["p_partkey", "hla", "algorithm"], "left")
    s = F.col("status")
    route = F.when(s.isNull(), "missing").when(s == "partial_ok", "unsupported").when(s == "error", "task_failed").when(F.col("pct") < 4, "pass").otherwise("screened_out")
    return t.withColumn("route", route)


@query("p16_stage_routing", f"SELECT t.p_partkey, t.hla, {ROUTE} AS route FROM {TASKS} t LEFT JOIN {PREDICTIONS} p USING (p_partkey, hla, algorithm) WHERE t.algorithm = 'A'")
def p16(spark, sf_dir):
    return routed(spark, sf_dir).select("p_partkey", "hla", "route")


@query("j18_stage_two_tasks", f"SELECT DISTINCT x.p_partkey, x.hla, a.algorithm FROM (SELECT t.p_partkey, t.hla, t.mhc, {ROUTE} AS route FROM {TASKS} t LEFT JOIN {PREDICTIONS} p USING (p_partkey, hla, algorithm) WHERE t.algorithm = 'A') x JOIN (SELECT 'MHC-I' AS mhc, unnest(['A', 'N', 'R']) AS algorithm UNION ALL SELECT 'MHC-II', unnest(['A', 'R'])) a USING (mhc) WHERE x.route = 'pass'")
def j18(spark, sf_dir):
    algorithms = spark.createDataFrame([("MHC-I", x) for x in "ANR"] + [("MHC-II", x) for x in "AR"], "mhc string, algorithm string")
    passed = routed(spark, sf_dir).where("route = 'pass'").select("p_partkey", "hla", "mhc")
    return passed.join(algorithms, "mhc").select("p_partkey", "hla", "algorithm").distinct()


@query("p17_support_router", f"SELECT t.p_partkey, t.hla, t.algorithm, CASE WHEN c.hla IS NULL OR NOT c.known THEN 'run' WHEN c.supported THEN 'run' ELSE 'skipped' END AS action FROM {TASKS} t LEFT JOIN (SELECT 'A*' || r_regionkey AS hla, r_regionkey <> 2 AS known, r_regionkey % 2 = 0 AS supported FROM region WHERE r_regionkey < 4) c USING (hla)")
def p17(spark, sf_dir):
    c = table(spark, sf_dir, "region").where("r_regionkey < 4").select(F.concat(F.lit("A*"), "r_regionkey").alias("hla"), (F.col("r_regionkey") != 2).alias("known"), (F.col("r_regionkey") % 2 == 0).alias("supported"))
    t = tasks(spark, sf_dir).join(c, "hla", "left")
    run = ~F.coalesce("known", F.lit(False)) | F.coalesce("supported", F.lit(False))
    return t.select("p_partkey", "hla", "algorithm", F.when(run, "run").otherwise("skipped").alias("action"))


@query("j17_wild_templates", "SELECT w.p_partkey AS wt, t.hla, t.flag FROM (SELECT p_partkey, p_size FROM part WHERE p_partkey % 2 = 1) w JOIN (SELECT DISTINCT p_partkey - 1 AS k, 'A*' || (l_suppkey % 5) AS hla, l_returnflag AS flag FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_partkey % 2 = 0) t ON t.k = w.p_partkey GROUP BY ALL")
def j17(spark, sf_dir):
    mt = table(spark, sf_dir, "lineitem").where("l_partkey % 2 = 0").select((F.col("l_partkey") - 1).alias("wt"), F.concat(F.lit("A*"), F.col("l_suppkey") % 5).alias("hla"), F.col("l_returnflag").alias("flag")).distinct()
    wt = table(spark, sf_dir, "part").where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("wt"))
    return wt.join(mt, "wt")


@query("j19_caller_consensus", "SELECT user_id, v, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS callers, count(DISTINCT event_type) >= 2 AND bool_or(event_type = 'click') AS consensus FROM (SELECT user_id, floor(value)::BIGINT AS v, event_type FROM events WHERE value IS NOT NULL) GROUP BY user_id, v")
def j19(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("value is not null").withColumn("v", F.floor("value"))
    s = F.array_sort(F.collect_set("event_type"))
    g = e.groupBy("user_id", "v").agg(s.alias("s"))
    return g.select("user_id", "v", F.array_join("s", ",").alias("callers"), ((F.size("s") >= 2) & F.array_contains("s", "click")).alias("consensus"))


@query("j20_strict_alignment", "SELECT count(*) FILTER (b IS NULL) AS left_only, count(*) FILTER (a IS NULL) AS right_only, count(*) FILTER (a > 1 OR b > 1) AS repeated, count(*) FILTER (k IS NULL) AS blank FROM (SELECT coalesce(x.k, y.k) AS k, a, b FROM (SELECT o_orderkey AS k, count(*) AS a FROM orders GROUP BY 1) x FULL JOIN (SELECT l_orderkey AS k, count(*) AS b FROM lineitem GROUP BY 1) y ON x.k = y.k)")
def j20(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return J.strict_align(o, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


@query("j21_evidence_star", "SELECT o_orderkey, c_name, n_name, coalesce(l.n, 0) AS n_lines, l.peak FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_extendedprice) AS peak FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey")
def j21(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = table(spark, sf_dir, "customer").join(n, "c_nationkey", "left").select(F.col("c_custkey").alias("o_custkey"), "c_name", "n_name")
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("peak"))
    return table(spark, sf_dir, "orders").join(c, "o_custkey", "left").join(l, "o_orderkey", "left").select("o_orderkey", "c_name", "n_name", F.coalesce("n", F.lit(0)).alias("n_lines"), "peak")


@query("j22_scored_once", "SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(l_quantity - 25) / 10)), 9) AS score FROM lineitem")
def j22(spark, sf_dir):
    score = F.round(S.sigmoid((F.col("l_quantity") - 25) / 10), 9)
    return J.scored_once(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_quantity"], lambda d: d.withColumn("score", score)).select("l_orderkey", "l_linenumber", "score")


@query("j23_leakage_quarantine", "SELECT doc_id FROM documents WHERE md5(coalesce(text, '')) NOT IN (SELECT md5(coalesce(text, '')) FROM documents WHERE source IN ('src1', 'src2')) AND source NOT IN ('src1', 'src2')")
def j23(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    held = F.col("source").isin("src1", "src2")
    return d.where(~held).join(d.where(held).select("digest"), "digest", "left_anti").select("doc_id")


@query("j24_dedup_annotation", "SELECT p_partkey, coalesce(n, 0) AS n_lines, coalesce(s, 'none') AS segment, coalesce(m, 0.0) AS best FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) a ON a.l_partkey = p_partkey LEFT JOIN (SELECT s_suppkey, s_name AS s FROM supplier) b ON b.s_suppkey = p_partkey LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) c ON c.l_partkey = p_partkey")
def j24(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    a = l.groupBy("p_partkey").agg(F.count("*").alias("n_lines"), F.max(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("best"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("segment"))
    out = table(spark, sf_dir, "part").select("p_partkey").join(a, "p_partkey", "left").join(b, "p_partkey", "left")
    return out.select("p_partkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("segment", F.lit("none")).alias("segment"), F.coalesce("best", F.lit(0.0)).alias("best"))


@query("j25_list_lookup", "SELECT user_id, array_to_string(list_transform(list_sort(list_distinct(list(event_type))), lambda e: CASE e WHEN 'click' THEN 'C' WHEN 'view' THEN 'V' ELSE e END), '|') AS codes FROM events GROUP BY user_id")
def j25(spark, sf_dir):
    names = F.create_map(F.lit("click"), F.lit("C"), F.lit("view"), F.lit("V"))
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "|").alias("kinds"))
    return g.select("user_id", F.array_join(F.transform(F.split("kinds", r"\|"), lambda e: F.coalesce(F.try_element_at(names, e), e)), "|").alias("codes"))


@query("j26_incremental_scoring", f"SELECT t.p_partkey, t.hla, t.algorithm FROM {TASKS} t WHERE NOT EXISTS (SELECT 1 FROM {PREDICTIONS} p WHERE p.p_partkey = t.p_partkey AND p.hla = t.hla AND p.algorithm = t.algorithm AND p.status <> 'error')")
def j26(spark, sf_dir):
    return J.reusable(tasks(spark, sf_dir), predictions(spark, sf_dir), ["p_partkey", "hla", "algorithm"]).select("p_partkey", "hla", "algorithm")


@query("j27_score_attach", "SELECT o_orderkey, a.s AS mt_score, b.s AS wt_score FROM orders LEFT JOIN (SELECT l_orderkey, l_extendedprice AS s FROM lineitem WHERE l_returnflag = 'R' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) = 1) a ON a.l_orderkey = o_orderkey LEFT JOIN (SELECT l_orderkey, l_extendedprice AS s FROM lineitem WHERE l_returnflag = 'N' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) = 1) b ON b.l_orderkey = o_orderkey")
def j27(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    first = lambda flag, name: J.keep_first(l.where(F.col("l_returnflag") == flag), ["l_orderkey"], ["l_linenumber", "l_extendedprice"]).select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias(name))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(first("R", "mt_score"), "o_orderkey", "left").join(first("N", "wt_score"), "o_orderkey", "left")


SPANS = "(SELECT l_orderkey, l_linenumber, l_suppkey % 7 AS chrom, l_partkey * 40 AS a, l_partkey * 40 + l_quantity::BIGINT AS b, l_linestatus AS strand FROM lineitem)"
TARGETS = "(SELECT p_partkey, p_partkey % 7 AS chrom, p_partkey * 37 AS c, p_partkey * 37 + p_size AS d, CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'O' END AS strand FROM part)"


def spans(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 7).alias("chrom"), (F.col("l_partkey") * 40).alias("a"), (F.col("l_partkey") * 40 + F.col("l_quantity").cast("bigint")).alias("b"), F.col("l_linestatus").alias("strand"))


def targets(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 7).alias("chrom"), (F.col("p_partkey") * 37).alias("c"), (F.col("p_partkey") * 37 + F.col("p_size")).alias("d"), F.when(F.col("p_size") % 2 == 0, "F").otherwise("O").alias("strand"))


@query("j13_interval_intersect", f"SELECT l_orderkey, l_linenumber, p_partkey, least(b, d) - greatest(a, c) AS n_shared FROM {SPANS} JOIN {TARGETS} USING (chrom, strand) WHERE a < d AND c < b")
def j13(spark, sf_dir):
    m = J.overlap(spans(spark, sf_dir), targets(spark, sf_dir), ["chrom", "strand"], 100, ("a", "b"), ("c", "d"))
    return m.select("l_orderkey", "l_linenumber", "p_partkey", (F.least("b", "d") - F.greatest("a", "c")).alias("n_shared"))


@query(
    "j12_frame_overlap",
    f"SELECT l_orderkey, l_linenumber, p_partkey, CASE WHEN least(b, d) - greatest(a, c) < b - a THEN 'partial_overlap' WHEN l_linenumber > 6 THEN 'incompatible_chain' WHEN (a - c) % 3 = 0 THEN 'same_frame' ELSE 'discordant_frame' END AS frame FROM {SPANS} JOIN {TARGETS} USING (chrom, strand) WHERE a < d AND c < b",
)
def j12(spark, sf_dir):
    m = J.overlap(spans(spark, sf_dir), targets(spark, sf_dir), ["chrom", "strand"], 100, ("a", "b"), ("c", "d"))
    f = J.frame_class(F.least("b", "d") - F.greatest("a", "c"), F.col("b") - F.col("a"), F.col("a") - F.col("c"), F.col("l_linenumber") <= 6)
    return m.select("l_orderkey", "l_linenumber", "p_partkey", f.alias("frame"))


@query("j28_region_filter", f"SELECT l_orderkey, l_linenumber FROM {SPANS} s WHERE EXISTS (SELECT 1 FROM {TARGETS} t WHERE t.chrom = s.chrom AND t.strand = s.strand AND a < d AND c < b)")
def j28(spark, sf_dir):
    return J.overlap(spans(spark, sf_dir), targets(spark, sf_dir), ["chrom", "strand"], 100, ("a", "b"), ("c", "d"), "left_semi").select("l_orderkey", "l_linenumber")


@query(
    "j14_junction_support",
    "SELECT p_partkey, coalesce(t.n, 0) AS tumor_exact, coalesce(u.n, 0) AS tumor_unstranded, coalesce(m.n, 0) AS normal_exact FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'N' GROUP BY 1) t ON t.l_partkey = p_partkey LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'N' GROUP BY 1) u ON u.l_partkey = p_partkey LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag <> 'N' GROUP BY 1) m ON m.l_partkey = p_partkey",
)
def j14(spark, sf_dir):
    tumor, exact = F.col("l_linestatus") == "F", F.col("l_returnflag") != "N"
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_if(tumor & exact).alias("x"), F.count_if(tumor & ~exact).alias("y"), F.count_if(~tumor & exact).alias("z"))
    zero = lambda c, n: F.coalesce(c, F.lit(0)).alias(n)
    return table(spark, sf_dir, "part").join(s, "p_partkey", "left").select("p_partkey", zero("x", "tumor_exact"), zero("y", "tumor_unstranded"), zero("z", "normal_exact"))


@query("j15_variant_triple", "SELECT p_partkey, v.k IS NOT NULL AS observed, s.k IS NOT NULL AS editing_site FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS k, l_linenumber AS pos FROM lineitem WHERE l_tax > 0.05) v ON v.k = p_partkey AND v.pos = p_size % 7 + 1 LEFT JOIN (SELECT DISTINCT l_partkey AS k, l_linenumber AS pos FROM lineitem WHERE l_discount > 0.08) s ON s.k = p_partkey AND s.pos = p_size % 7 + 1")
def j15(spark, sf_dir):
    need = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 7 + 1).alias("pos"))
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_linenumber").alias("pos"), "l_tax", "l_discount")
    v = J.subtract(need, l.where("l_tax > 0.05").select("p_partkey", "pos").distinct(), ["p_partkey", "pos"]).withColumnRenamed("excluded", "observed")
    return J.subtract(v, l.where("l_discount > 0.08").select("p_partkey", "pos").distinct(), ["p_partkey", "pos"]).select("p_partkey", "observed", F.col("excluded").alias("editing_site"))


@query("j16_residue_overlap", "SELECT l_partkey, count(*) AS n_windows, count(*) FILTER (p BETWEEN s AND s + 8) AS n_over FROM (SELECT l_partkey, l_suppkey % 30 AS s, p_size % 30 AS p FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY 1")
def j16(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 30).alias("p"))
    m = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_suppkey") % 30).alias("s")).join(p, "l_partkey")
    return m.groupBy("l_partkey").agg(F.count("*").alias("n_windows"), F.count_if(F.col("p").between(F.col("s"), F.col("s") + 8)).alias("n_over"))


@query("p25_final_routing", "SELECT o_orderkey, CASE WHEN e AND c THEN 'excluded_both' WHEN e THEN 'excluded_exact' WHEN c THEN 'excluded_coordinate' WHEN rn <= 50 THEN 'retained' ELSE 'deferred_by_cap' END AS routing FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, e OR c ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM (SELECT *, o_custkey % 3 = 0 AS e, o_orderstatus = 'F' AS c FROM orders))")
def p25(spark, sf_dir):
    from loomseq.operators.windows import ranked_cap

    o = table(spark, sf_dir, "orders").withColumns({"e": F.col("o_custkey") % 3 == 0, "c": F.col("o_orderstatus") == "F"})
    r = ranked_cap(o, ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 50, eligible=~(F.col("e") | F.col("c")))
    e, c = F.col("e"), F.col("c")
    routing = F.when(e & c, "excluded_both").when(e, "excluded_exact").when(c, "excluded_coordinate").when(F.col("selected"), "retained").otherwise("deferred_by_cap")
    return r.select("o_orderkey", routing.alias("routing"))
