"""Queries of the aggregations, windows, set operations and metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomseq.functions import maps as M
from loomseq.functions import sequences as S
from loomseq.functions import text as T
from loomseq.operators import evaluation as E
from loomseq.operators import joins as J
from loomseq.operators import qc
from loomseq.operators import windows as W
from loomseq.plans.join_queries import PREDICTIONS, SPANS, WIN, predictions, spans, win
from loomseq.plans.qc_queries import _TIER_SQL, tiers
from loomseq.plans.registry import query, table
from loomseq.plans.sequence_queries import parents


@query("a1_peptide_map", f"SELECT pep AS peptide, count(DISTINCT doc_id) AS n_parents, array_to_string(list_sort(list_distinct(list(source))), ';') AS sources, array_to_string(list_sort(list_distinct(list(lang))), ';') AS langs FROM {WIN} GROUP BY pep")
def a1(spark, sf_dir):
    # Windows are counted by source and lang where they are and moved as compressed numbers; the
    # size of the text only decides into how many buckets.
    size = table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text"))).first()[0]
    w = M.window_map(parents(spark, sf_dir), "seq", 9, ["source", "lang"], M.buckets_for(size))
    return w.select("peptide", F.col("n_rows").alias("n_parents"), F.col("source").alias("sources"), F.col("lang").alias("langs"))


@query("a2_position_lists", "SELECT item_id, pep AS peptide, array_to_string(list_sort(list_distinct(list(p))), ',') AS positions FROM (SELECT item_id, p, substr(seq, p, 9) AS pep FROM (SELECT item_id, seq, unnest(generate_series(1, length(seq) - 8)) AS p FROM (SELECT item_id, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS seq FROM benchmark))) GROUP BY ALL")
def a2(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", S.letters_only(F.col("text")).alias("seq"))
    g = S.windows(b, "seq", [9]).groupBy("item_id", "peptide").agg(F.array_sort(F.collect_set("pep_start")).alias("p"))
    return g.select("item_id", "peptide", F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("positions"))


@query("a3_source_groups", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_fragments, max(l_quantity) AS max_cover, min(l_discount) AS min_e, round(count(DISTINCT l_orderkey) * 1e6 / (SELECT count(DISTINCT l_orderkey) FROM lineitem), 6) AS per_million, round((count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) + 1.0) / (count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_orderkey END) + 1.0), 6) AS enrichment FROM lineitem GROUP BY l_suppkey")
def a3(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    total = l.agg(F.countDistinct("l_orderkey").alias("total"))
    of = lambda s: F.countDistinct(F.when(F.col("l_linestatus") == s, F.col("l_orderkey")))
    g = l.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("n_fragments"), F.max("l_quantity").alias("max_cover"), F.min("l_discount").alias("min_e"), F.round((of("F") + 1) / (of("O") + 1), 6).alias("enrichment"))
    return g.crossJoin(F.broadcast(total)).select("l_suppkey", "n_fragments", "max_cover", "min_e", F.round(F.col("n_fragments") * 1e6 / F.col("total"), 6).alias("per_million"), "enrichment")


@query("a4_best_and_median", f"SELECT p_partkey, hla, min(v) AS best, arg_min(algorithm, {{'v': v, 'p': list_position(['R', 'A', 'N'], algorithm)}}) FILTER (v IS NOT NULL) AS best_method, median(v) AS median, count(v) AS n_values FROM (SELECT *, CASE WHEN algorithm IN ('A', 'R') THEN ic50 END AS v FROM {PREDICTIONS}) GROUP BY p_partkey, hla")
def a4(spark, sf_dir):
    return E.best_and_median(predictions(spark, sf_dir), ["p_partkey", "hla"], "ic50", "algorithm", ["R", "A", "N"], only=["A", "R"])


@query("a5_wide_scores", f"SELECT p_partkey, hla, max(ic50) FILTER (algorithm = 'A') AS a_ic50, max(pct) FILTER (algorithm = 'A') AS a_pct, max(ic50) FILTER (algorithm = 'N') AS n_ic50, max(ic50) FILTER (algorithm = 'R') AS r_ic50 FROM {PREDICTIONS} GROUP BY p_partkey, hla")
def a5(spark, sf_dir):
    p = predictions(spark, sf_dir).groupBy("p_partkey", "hla").pivot("algorithm", ["A", "N", "R"]).agg(F.first("ic50").alias("ic50"), F.first("pct").alias("pct"))
    return p.select("p_partkey", "hla", F.col("A_ic50").alias("a_ic50"), F.col("A_pct").alias("a_pct"), F.col("N_ic50").alias("n_ic50"), F.col("R_ic50").alias("r_ic50"))


@query("a6_fold_changes", f"SELECT p_partkey, hla, round(max(CASE WHEN algorithm = 'N' AND ic50 > 0 THEN w / ic50 END), 6) AS n_fold, round(median(CASE WHEN ic50 > 0 THEN w / ic50 END), 6) AS median_fold FROM (SELECT m.*, x.ic50 AS w FROM {PREDICTIONS} m LEFT JOIN {PREDICTIONS} x ON x.p_partkey = m.p_partkey + 1 AND x.hla = m.hla AND x.algorithm = m.algorithm) GROUP BY p_partkey, hla")
def a6(spark, sf_dir):
    m = predictions(spark, sf_dir)
    w = m.select((F.col("p_partkey") - 1).alias("p_partkey"), "hla", "algorithm", F.col("ic50").alias("w"))
    fold = F.when(F.col("ic50") > 0, F.col("w") / F.col("ic50"))
    g = m.join(w, ["p_partkey", "hla", "algorithm"], "left").groupBy("p_partkey", "hla")
    return g.agg(F.round(F.max(F.when(F.col("algorithm") == "N", fold)), 6).alias("n_fold"), F.round(F.median(fold), 6).alias("median_fold"))


_QC = f"(SELECT algorithm, count(*) AS requested, count(*) FILTER (status <> 'error') AS usable, count(*) FILTER (status = 'ok' AND pct > 0) AS complete, array_to_string(list_sort(list_distinct(list(hla) FILTER (status = 'error'))), ';') AS failed_alleles FROM {PREDICTIONS} GROUP BY GROUPING SETS ((algorithm), ()))"


@query("a7_prediction_qc", f"SELECT coalesce(algorithm, 'overall') AS algorithm, requested, usable, complete, round(usable / requested::DOUBLE, 6) AS success, round(complete / nullif(usable, 0)::DOUBLE, 6) AS completeness, coalesce(failed_alleles, '') AS failed_alleles FROM {_QC}")
def a7(spark, sf_dir):
    p = predictions(spark, sf_dir)
    g = p.rollup("algorithm").agg(F.count("*").alias("requested"), F.count_if(F.col("status") != "error").alias("usable"), F.count_if((F.col("status") == "ok") & (F.col("pct") > 0)).alias("complete"), T.list_text(F.collect_set(F.when(F.col("status") == "error", F.col("hla")))).alias("failed_alleles"))
    return g.select(F.coalesce("algorithm", F.lit("overall")).alias("algorithm"), "requested", "usable", "complete", F.round(F.col("usable") / F.col("requested"), 6).alias("success"), F.round(F.col("complete") / F.nullif(F.col("usable"), F.lit(0)), 6).alias("completeness"), "failed_alleles")


@query("a8_hash_dedup", "SELECT md5(coalesce(text, '')) AS digest, arg_min(doc_id, {'s': CASE WHEN source = 'src0' THEN 0 ELSE 1 END, 'd': doc_id}) AS kept, count(*) AS n, array_to_string(list_sort(list(doc_id))[1:10], ',') AS first_ids FROM documents GROUP BY 1")
def a8(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source") == "src0", 0).otherwise(1).alias("s"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    # Ten ids at most per group and map task: a group of any size stays small.
    w = Window.partitionBy("digest").orderBy("doc_id")
    first = d.withColumn("k", F.row_number().over(w)).where("k <= 10").groupBy("digest").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("first_ids"))
    g = d.groupBy("digest").agg(F.min_by("doc_id", F.struct("s", "doc_id")).alias("kept"), F.count("*").alias("n"))
    return g.join(first, "digest")


@query("a9_collapsed_rows", "SELECT l_orderkey, array_to_string(list_transform(list_sort(list({'o': l_linenumber, 'p': l_partkey, 'v': CASE WHEN l_tax > 0.05 THEN '' ELSE l_returnflag END})), lambda x: x.v), '|') AS flags FROM lineitem GROUP BY l_orderkey")
def a9(spark, sf_dir):
    v = F.when(F.col("l_tax") > 0.05, F.lit(None)).otherwise(F.col("l_returnflag"))
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", F.coalesce(v, F.lit("")).alias("v"))))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(rows, lambda x: x["v"]), "|").alias("flags"))


@query("a10_junction_summary", "SELECT l_orderkey, min(l_quantity) AS least, bool_and(l_quantity >= 2) AS all_supported, bool_or(l_quantity >= 45) AS any_strong, array_to_string(list_sort(list_distinct(list(l_linenumber))), ',') AS ids FROM lineitem GROUP BY l_orderkey")
def a10(spark, sf_dir):
    q = F.col("l_quantity")
    ids = F.array_join(F.transform(F.array_sort(F.collect_set("l_linenumber")), lambda x: x.cast("string")), ",")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(q).alias("least"), F.bool_and(q >= 2).alias("all_supported"), F.bool_or(q >= 45).alias("any_strong"), ids.alias("ids"))


@query("p15_junction_verdict", "SELECT o_orderkey, CASE WHEN l.least IS NULL THEN 'intronless' WHEN l.least >= 2 THEN 'supported' ELSE 'low_support' END AS verdict FROM orders LEFT JOIN (SELECT l_orderkey, min(l_quantity) AS least FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey")
def p15(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_quantity").alias("least"))
    v = qc.ladder((F.col("least").isNull(), "intronless"), (F.col("least") >= 2, "supported"), otherwise="low_support")
    return table(spark, sf_dir, "orders").join(l, "o_orderkey", "left").select("o_orderkey", v.alias("verdict"))


@query("a13_first_window", "SELECT l_partkey, l_returnflag, min(l_suppkey) AS first_start FROM lineitem GROUP BY ALL")
def a13(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_returnflag").agg(F.min("l_suppkey").alias("first_start"))


@query("w7_relative_position", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey - min(l_suppkey) OVER (PARTITION BY l_partkey, l_returnflag) AS relative FROM lineitem")
def w7(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return W.beside_first(l, ["l_partkey", "l_returnflag"], "l_suppkey", "relative").select("l_orderkey", "l_linenumber", "l_partkey", "relative")


@query("a14_peptide_table", "SELECT l_partkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ';') AS kinds, array_to_string(list_sort(list_distinct(list(l_orderkey))), ';') AS events FROM lineitem GROUP BY l_partkey")
def a14(spark, sf_dir):
    ids = F.array_join(F.transform(F.array_sort(F.collect_set("l_orderkey")), lambda x: x.cast("string")), ";")
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(T.list_text(F.collect_set("l_returnflag")).alias("kinds"), ids.alias("events"))


@query("a15_priority_status", "SELECT l_orderkey, arg_min(s, list_position(['R', 'N', 'A'], s)) AS status, count(*) AS n FROM (SELECT l_orderkey, l_returnflag AS s FROM lineitem) GROUP BY l_orderkey")
def a15(spark, sf_dir):
    place = F.array_position(F.array(F.lit("R"), F.lit("N"), F.lit("A")), F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_returnflag", place).alias("status"), F.count("*").alias("n"))


@query("a16_event_collapse", "SELECT l_orderkey, l_linenumber, max(l_quantity) AS ref_n, min(l_discount) AS alt_n, min(l_tax) AS qual, count(DISTINCT (l_quantity, l_discount)) > 1 AS conflict, array_to_string(list_sort(list_distinct(list(l_linestatus))), ';') AS filters FROM lineitem GROUP BY ALL")
def a16(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("ref_n"), F.min("l_discount").alias("alt_n"), F.min("l_tax").alias("qual"), (F.countDistinct(F.struct("l_quantity", "l_discount")) > 1).alias("conflict"), T.list_text(F.collect_set("l_linestatus")).alias("filters"))


LABELLED = "(SELECT l.doc_id, toxic, quality, source, lang, (length(coalesce(text, '')) % 101) / 101.0::DOUBLE AS score FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


def labelled(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", ((F.length(F.coalesce("text", F.lit(""))) % 101) / 101.0).alias("score"))
    return table(spark, sf_dir, "labels").join(d, "doc_id").select("doc_id", "toxic", "quality", "source", "lang", "score")


@query("a17_label_conflicts", "SELECT doc_id, min(toxic) AS label FROM (SELECT l_partkey AS doc_id, (l_linenumber % 2)::INTEGER AS toxic FROM lineitem WHERE l_tax > 0.06) GROUP BY doc_id HAVING count(DISTINCT toxic) = 1")
def a17(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_tax > 0.06").select(F.col("l_partkey").alias("doc_id"), (F.col("l_linenumber") % 2).cast("int").alias("toxic"))
    seen = rows.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1, toxic)")).alias("mask"))
    return seen.where("mask <> 3").select("doc_id", F.when(F.col("mask") == 1, 0).otherwise(1).alias("label"))


_METRICS = "count(*) AS n, count(*) FILTER (y AND s) AS tp, count(*) FILTER (NOT y AND s) AS fp, count(*) FILTER (NOT y AND NOT s) AS tn, count(*) FILTER (y AND NOT s) AS fn"


@query("a18_binary_metrics", f"SELECT lang, n, tp, fp, tn, fn, round(b, 9) AS brier, round((tp + tn) / n::DOUBLE, 9) AS accuracy, round(tp / nullif(tp + fp, 0)::DOUBLE, 9) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 9) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 9) AS f1 FROM (SELECT lang, {_METRICS}, avg((score - toxic) ** 2) AS b FROM (SELECT *, toxic = 1 AS y, score >= 0.5 AS s FROM {LABELLED}) GROUP BY lang)")
def a18(spark, sf_dir):
    m = E.binary_metrics(labelled(spark, sf_dir), ["lang"], "toxic", "score")
    return m.select("lang", "n", "tp", "fp", "tn", "fn", *[F.round(c, 9).alias(c) for c in ("brier", "accuracy", "precision", "recall", "f1")])


_BINS = f"(SELECT least(floor(score * 10), 9)::INTEGER AS bin, count(*) AS n, avg(score) AS ms, avg(toxic::DOUBLE) AS rate FROM {LABELLED} GROUP BY 1)"


@query("a19_reliability_bins", f"SELECT b::INTEGER AS bin, coalesce(n, 0) AS n, round(ms, 9) AS mean_score, round(rate, 9) AS rate FROM (SELECT unnest(generate_series(0, 9)) AS b) LEFT JOIN {_BINS} ON bin = b")
def a19(spark, sf_dir):
    r = E.reliability(labelled(spark, sf_dir), "toxic", "score", 10)
    return r.select("bin", "n", F.round("mean_score", 9).alias("mean_score"), F.round("rate", 9).alias("rate"))


@query("a19_calibration_error", f"SELECT round(sum(n * abs(ms - rate)) / sum(n), 9) AS ece FROM {_BINS}")
def a19b(spark, sf_dir):
    return E.calibration_error(labelled(spark, sf_dir), "toxic", "score", 10).select(F.round("ece", 9).alias("ece"))


_RANKED = "(SELECT {g}, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (SELECT {g}, score, count(*) FILTER (toxic = 1) AS pos, count(*) FILTER (toxic <> 1) AS neg FROM {t} GROUP BY {g}, score) WINDOW w AS (PARTITION BY {g} ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"


@query("a20_ranking_metrics", f"SELECT lang, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg, round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(neg * (tp - pos / 2.0))::DOUBLE / (sum(pos) * sum(neg))::DOUBLE END, 9) AS auroc, round(CASE WHEN sum(pos) > 0 THEN sum(pos * tp / (tp + fp)::DOUBLE) / sum(pos) END, 9) AS average_precision FROM {_RANKED.format(g='lang', t=LABELLED)} GROUP BY lang")
def a20(spark, sf_dir):
    m = E.ranking_metrics(labelled(spark, sf_dir), ["lang"], "toxic", "score")
    return m.select("lang", "n_pos", "n_neg", F.round("auroc", 9).alias("auroc"), F.round("average_precision", 9).alias("average_precision"))


@query("a21_grouped_metrics", f"SELECT CASE WHEN grouping(lang) = 0 THEN lang ELSE '*' END AS lang, CASE WHEN grouping(source) = 0 THEN source ELSE '*' END AS source, count(*) AS n, count(*) FILTER (toxic = 1) AS n_pos, round(avg(score), 9) AS mean_score FROM {LABELLED} GROUP BY GROUPING SETS ((lang), (source)) HAVING count(*) >= 2")
def a21(spark, sf_dir):
    return spark.sql("SELECT CASE WHEN grouping(lang) = 0 THEN lang ELSE '*' END AS lang, CASE WHEN grouping(source) = 0 THEN source ELSE '*' END AS source, count(*) AS n, count_if(toxic = 1) AS n_pos, round(avg(score), 9) AS mean_score FROM {rows} GROUP BY GROUPING SETS ((lang), (source)) HAVING count(*) >= 2", rows=labelled(spark, sf_dir))


def _unit_sql(key, seed):
    x = f"(({key} * {E._A} + {seed * 7_919}) % {E._PRIME})"
    y = f"(({x} + (r + 1) * {E._B}) % {E._PRIME})"
    return f"((({y} * {y} % {E._PRIME}) * {E._C} + {x}) % {E._PRIME}) / {E._PRIME}.0"


_REPLICATES = "(SELECT unnest(generate_series(0, 99)) AS r)"


def _bootstrap_sql(key, value):
    w = "CASE WHEN u < 0.36787944 THEN 0 WHEN u < 0.73575888 THEN 1 WHEN u < 0.91969860 THEN 2 WHEN u < 0.98101184 THEN 3 WHEN u < 0.99634015 THEN 4 ELSE 5 END"
    return f"""SELECT lang, any_value(n) AS n, round(any_value(mean), 9) AS mean, round(quantile_cont(m, 0.025), 9) AS low, round(quantile_cont(m, 0.975), 9) AS high, round(avg((m > 0)::INT), 9) AS above_zero FROM (
SELECT lang, r, count(*) AS n, avg(v) AS mean, sum(w * v) / nullif(sum(w), 0) AS m FROM (SELECT lang, r, v, {w} AS w FROM (SELECT lang, r, {value} AS v, {_unit_sql(key, 1)} AS u FROM {LABELLED}, {_REPLICATES})) GROUP BY lang, r) GROUP BY lang"""


_SOURCE_NUMBER = "regexp_extract(source, '[0-9]+$')::BIGINT"


def _rounded(df):
    return df.select("lang", "n", *[F.round(c, 9).alias(c) for c in ("mean", "low", "high", "above_zero")])


@query("a22_bootstrap_interval", _bootstrap_sql("doc_id", "score"))
def a22(spark, sf_dir):
    return _rounded(E.bootstrap(labelled(spark, sf_dir), ["lang"], "doc_id", "score", 100))


@query("a22_paired_difference", _bootstrap_sql("doc_id", "(score - (toxic * 0.5 + 0.2))"))
def a22_paired(spark, sf_dir):
    return _rounded(E.bootstrap(labelled(spark, sf_dir), ["lang"], "doc_id", F.col("score") - (F.col("toxic") * 0.5 + 0.2), 100))


@query("a22_grouped_interval", _bootstrap_sql(_SOURCE_NUMBER, "score"))
def a22_grouped(spark, sf_dir):
    x = labelled(spark, sf_dir).withColumn("source_number", F.regexp_extract("source", "([0-9]+)$", 1).cast("bigint"))
    return _rounded(E.bootstrap(x, ["lang"], "source_number", "score", 100))


@query(
    "a22_permutation",
    f"""SELECT lang, n, round(any_value(d / n), 9) AS mean_difference, round((1 + count(*) FILTER (abs(t) >= abs(d) - 1e-9)) / 101.0, 9) AS p_value FROM (
SELECT lang, r, count(*) AS n, sum(v) AS d, sum(CASE WHEN u < 0.5 THEN v ELSE -v END) AS t FROM (SELECT lang, r, score - 0.45 AS v, {_unit_sql("doc_id", 2)} AS u FROM {LABELLED}, {_REPLICATES}) GROUP BY lang, r) GROUP BY lang, n""",
)
def a22_permutation(spark, sf_dir):
    p = E.permutation_test(labelled(spark, sf_dir), ["lang"], "doc_id", F.col("score") - 0.45, 100)
    return p.select("lang", "n", F.round("mean_difference", 9).alias("mean_difference"), F.round("p_value", 9).alias("p_value"))


@query("a23_learning_curve", "SELECT c, round(sum((x - px) * (y + py) / 2) / nullif(max(x) - min(x), 0), 6) AS area FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM (SELECT l_returnflag AS c, l_linenumber::DOUBLE AS x, avg(l_discount) AS y FROM lineitem GROUP BY 1, 2) WINDOW w AS (PARTITION BY c ORDER BY x)) GROUP BY c")
def a23(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("c"), F.col("l_linenumber").cast("double").alias("x")).agg(F.avg("l_discount").alias("y"))
    w = Window.partitionBy("c").orderBy("x")
    p = p.withColumns({"px": F.lag("x").over(w), "py": F.lag("y").over(w)})
    width = F.nullif(F.max("x") - F.min("x"), F.lit(0.0))
    return p.groupBy("c").agg(F.round(F.sum((F.col("x") - F.col("px")) * (F.col("y") + F.col("py")) / 2) / width, 6).alias("area"))


@query("a24_standardise", "SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(-1.5, least(1.5, (l_quantity - m) / CASE WHEN s > 0 THEN s ELSE 1 END)), 6) AS z FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)")
def a24(spark, sf_dir):
    z = E.standardise(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_quantity"], 1.5)
    return z.select("l_orderkey", "l_linenumber", "l_partkey", F.round("z_l_quantity", 6).alias("z"))


@query("a25_class_weights", f"SELECT lang, toxic, count(*) AS n, round((SELECT count(*) FROM {LABELLED}) / (2.0 * count(*)), 9) AS weight FROM {LABELLED} GROUP BY lang, toxic")
def a25(spark, sf_dir):
    x = labelled(spark, sf_dir)
    total = x.agg(F.count("*").alias("total"))
    g = x.groupBy("lang", "toxic").agg(F.count("*").alias("n"))
    return g.crossJoin(F.broadcast(total)).select("lang", "toxic", "n", F.round(F.col("total") / (2.0 * F.col("n")), 9).alias("weight"))


@query("a26_feature_attribution", "SELECT i AS feature, round(avg(v), 6) AS mean_contribution, round(avg(abs(v)), 6) AS mean_abs FROM (SELECT i, embedding[i]::DOUBLE * ((i * 7) % 11 - 5) AS v FROM (SELECT embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)) GROUP BY i")
def a26(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("p", "x"))
    i = (F.col("p") + 1).cast("bigint")
    v = F.col("x").cast("double") * ((i * 7) % 11 - 5)
    return e.groupBy(i.alias("feature")).agg(F.round(F.avg(v), 6).alias("mean_contribution"), F.round(F.avg(F.abs(v)), 6).alias("mean_abs"))


@query("w18_contribution_rank", "SELECT feature, mean_abs, row_number() OVER (ORDER BY mean_abs DESC, feature) AS place FROM (SELECT i AS feature, round(avg(abs(x)), 6) AS mean_abs FROM (SELECT i, embedding[i]::DOUBLE AS x FROM (SELECT embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)) GROUP BY i)")
def w18(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("p", "x"))
    # One row per feature is left before the ranking.
    g = e.groupBy((F.col("p") + 1).cast("bigint").alias("feature")).agg(F.round(F.avg(F.abs(F.col("x").cast("double"))), 6).alias("mean_abs"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "feature")))


@query("a27_ensemble_mean", "SELECT l_partkey, l_suppkey, round(avg(l_extendedprice), 6) AS score, count(DISTINCT l_returnflag) = 1 AS same_status FROM lineitem GROUP BY ALL")
def a27(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.round(F.avg("l_extendedprice"), 6).alias("score"), (F.countDistinct("l_returnflag") == 1).alias("same_status"))


@query("a28_supporting_windows", "SELECT l_orderkey, l_linenumber, l_suppkey, count(*) OVER (PARTITION BY l_partkey) AS n_support FROM lineitem")
def a28(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    n = l.groupBy("l_partkey").agg(F.count("*").alias("n_support"))
    return l.join(n, "l_partkey").select("l_orderkey", "l_linenumber", "l_suppkey", "n_support")


@query("a29_split_summary", f"SELECT CASE WHEN grouping(toxic) = 0 THEN toxic::VARCHAR ELSE '*' END AS label, CASE WHEN grouping(source) = 0 THEN source ELSE '*' END AS source, count(*) AS n_rows, count(DISTINCT score) AS n_scores FROM {LABELLED} GROUP BY GROUPING SETS ((toxic), (source), ())")
def a29(spark, sf_dir):
    return spark.sql("SELECT CASE WHEN grouping(toxic) = 0 THEN cast(toxic AS string) ELSE '*' END AS label, CASE WHEN grouping(source) = 0 THEN source ELSE '*' END AS source, count(*) AS n_rows, count(DISTINCT score) AS n_scores FROM {rows} GROUP BY GROUPING SETS ((toxic), (source), ())", rows=labelled(spark, sf_dir))


@query("a30_fingerprint", "SELECT count(*) AS n, bit_xor(h) AS x, sum(h % 1073741824)::BIGINT AS s FROM (SELECT ('0x' || substr(md5(t), 1, 15))::BIGINT AS h FROM (SELECT DISTINCT '=' || p_partkey || '|=' || p_name AS t FROM part))")
def a30(spark, sf_dir):
    return E.fingerprint(table(spark, sf_dir, "part"), ["p_partkey", "p_name"])


@query("w1_ranked_cap", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, e AND rn <= 40 AS selected FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, e ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM (SELECT *, l_discount < 0.05 AS e FROM lineitem))")
def w1(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    r = W.ranked_cap(l, ["l_returnflag"], order, 40, eligible=F.col("l_discount") < 0.05)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "selected")


@query("w2_source_rank", "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_extendedprice DESC, l_discount, l_tax, coalesce(nullif(l_linenumber, 3), -1) DESC, l_returnflag, l_linestatus DESC, l_orderkey, l_partkey, l_shipdate) AS source_rank FROM lineitem")
def w2(spark, sf_dir):
    order = [F.desc("l_quantity"), F.desc("l_extendedprice"), F.asc("l_discount"), F.asc("l_tax"), F.desc(F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(3)), F.lit(-1))), F.asc("l_returnflag"), F.desc("l_linestatus"), F.asc("l_orderkey"), F.asc("l_partkey"), F.asc("l_shipdate")]
    return W.source_rank(table(spark, sf_dir, "lineitem"), ["l_suppkey"], order).select("l_orderkey", "l_linenumber", "l_partkey", "source_rank")


@query("w3_keep_first", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def w3(spark, sf_dir):
    return J.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("w4_best_quality", f"SELECT p_partkey, hla, algorithm, status FROM {PREDICTIONS} QUALIFY row_number() OVER (PARTITION BY p_partkey, hla ORDER BY (status = 'ok')::INT DESC, (ic50 IS NOT NULL)::INT DESC, (pct > 0)::INT DESC, algorithm) = 1")
def w4(spark, sf_dir):
    order = [F.desc((F.col("status") == "ok").cast("int")), F.desc(F.col("ic50").isNotNull().cast("int")), F.desc((F.col("pct") > 0).cast("int")), F.asc("algorithm")]
    return J.keep_first(predictions(spark, sf_dir), ["p_partkey", "hla"], order).select("p_partkey", "hla", "algorithm", "status")


@query("w5_best_alignment", "SELECT o_custkey, max(o_totalprice) FILTER (rn = 1) AS best, max(o_totalprice) FILTER (rn = 2) AS second, CASE WHEN max(o_totalprice) FILTER (rn = 1) < 200000 THEN 'novel' WHEN coalesce(max(o_totalprice) FILTER (rn = 1) - max(o_totalprice) FILTER (rn = 2) < 20000, false) THEN 'ambig' ELSE 'ok' END AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 2 GROUP BY o_custkey")
def w5(spark, sf_dir):
    return W.best_two(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", ["o_orderkey"], 20_000, 200_000).select("o_custkey", "best", "second", "verdict")


@query("w6_event_ids", "SELECT event_id AS src, CASE WHEN n = 1 THEN b ELSE b || '|dup' || n END AS event_id FROM (SELECT event_id, user_id || ':' || event_type AS b, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)")
def w6(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("src"), F.concat_ws(":", "user_id", "event_type").alias("base"))
    return W.suffixed_ids(e, "base", ["src"]).select("src", "event_id")


@query("w8_interval_merge", f"SELECT chrom, strand, isl::BIGINT AS island, min(a) AS a, max(b) AS b, count(*) AS n_merged FROM (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY a, b, new DESC ROWS UNBOUNDED PRECEDING) AS isl FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY chrom, strand ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM {SPANS})) GROUP BY ALL")
def w8(spark, sf_dir):
    return W.merge_intervals(spans(spark, sf_dir), ["chrom", "strand"], "a", "b").withColumn("island", F.col("island").cast("bigint"))


@query("w9_block_offsets", "SELECT l_orderkey, l_linenumber, l_partkey, (sum(l_quantity::BIGINT) OVER w - l_quantity::BIGINT)::BIGINT AS offset0, ((sum(l_quantity::BIGINT) OVER w - l_quantity::BIGINT) % 3)::BIGINT AS phase FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING)")
def w9(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("len", F.col("l_quantity").cast("bigint"))
    o = W.running_offset(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "len", "offset0")
    return o.select("l_orderkey", "l_linenumber", "l_partkey", "offset0", (F.col("offset0") % 3).alias("phase"))


@query("w10_alignment_junctions", "SELECT l_orderkey, l_linenumber, l_partkey, e - n AS start0, e AS end0 FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN l_quantity::BIGINT END AS n, (sum(l_quantity::BIGINT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING))::BIGINT AS e FROM lineitem) WHERE l_returnflag = 'N'")
def w10(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("len", F.col("l_quantity").cast("bigint"))
    o = W.running_offset(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "len", "start0")
    return o.where("l_returnflag = 'N'").select("l_orderkey", "l_linenumber", "l_partkey", "start0", (F.col("start0") + F.col("len")).alias("end0"))


@query("w11_crossed_junctions", "SELECT l_orderkey, l_linenumber, p AS from_block, l_partkey AS to_block FROM (SELECT *, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS p FROM lineitem) WHERE p IS NOT NULL")
def w11(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    l = table(spark, sf_dir, "lineitem").withColumn("from_block", F.lag("l_partkey").over(w)).where("from_block is not null")
    return l.select("l_orderkey", "l_linenumber", "from_block", F.col("l_partkey").alias("to_block"))


@query("w12_top_precision", f"SELECT lang, max(np)::BIGINT AS n_pos, round(max(CASE WHEN rn = np THEN tp / rn::DOUBLE END), 9) AS ppv_at_n_pos, round(avg(tp / rn::DOUBLE), 9) AS mean_ppv FROM (SELECT *, row_number() OVER w AS rn, sum(toxic) OVER (PARTITION BY lang ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING) AS tp, sum(toxic) OVER (PARTITION BY lang) AS np FROM {LABELLED} WINDOW w AS (PARTITION BY lang ORDER BY score DESC, doc_id)) WHERE rn <= np GROUP BY lang")
def w12(spark, sf_dir):
    m = E.top_precision(labelled(spark, sf_dir), ["lang"], "toxic", "score", ["doc_id"])
    return m.select("lang", F.col("n_pos").cast("bigint").alias("n_pos"), F.round("ppv_at_n_pos", 9).alias("ppv_at_n_pos"), F.round("mean_ppv", 9).alias("mean_ppv"))


@query("w13_record_ids", "SELECT doc_id, 'prot_' || lpad((row_number() OVER (PARTITION BY source ORDER BY doc_id))::VARCHAR, 8, '0') AS record_id FROM documents")
def w13(spark, sf_dir):
    d = W.source_rank(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"], "n")
    return d.select("doc_id", F.concat(F.lit("prot_"), F.lpad(F.col("n").cast("string"), 8, "0")).alias("record_id"))


@query("w14_nested_sample", "SELECT lang, fraction, count(*) AS n, min(doc_id) AS first_id, sum(doc_id)::BIGINT AS total FROM (SELECT *, unnest([0.1, 0.25, 0.5])::DOUBLE AS fraction FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR)) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents)) WHERE rn <= greatest(ceil(n * fraction), 1) GROUP BY ALL")
def w14(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    s = W.nested_sample(d, ["lang"], F.md5(F.col("doc_id").cast("string")), [0.1, 0.25, 0.5])
    return s.groupBy("lang", "fraction").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.sum("doc_id").alias("total"))


@query("w15_refill", "SELECT o_orderkey, place FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_totalprice DESC, o_orderkey) AS place FROM orders WHERE o_custkey % 3 <> 0) WHERE place <= 30")
def w15(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0")
    origin = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    r = W.first_ranked(o, ["o_orderpriority"], [origin, F.desc("o_totalprice"), F.asc("o_orderkey")], 30)
    return r.select("o_orderkey", "place")


@query("w16_folds", "SELECT l_orderkey, l_linenumber, l_partkey, least(floor((rn - 1) / greatest(floor(n / 5), 1)), 4)::INTEGER AS fold FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)")
def w16(spark, sf_dir):
    f = W.folds(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 5)
    return f.select("l_orderkey", "l_linenumber", "l_partkey", "fold")


@query("w17_reference_percentile", "SELECT s.s_suppkey, round(100.0 * (count(*) FILTER (c_acctbal < s_acctbal) + 0.5 * count(*) FILTER (c_acctbal = s_acctbal)) / count(*), 6) AS pct FROM supplier s, customer GROUP BY s.s_suppkey")
def w17(spark, sf_dir):
    x = W.percentile_among(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", table(spark, sf_dir, "customer"), "c_acctbal")
    return x.select("s_suppkey", F.round("pct", 6).alias("pct"))


@query("o1_top_sorted", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o1(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("o3_output_order", f"SELECT tier, l_returnflag, count(*) AS n, min(l_orderkey) AS first_order FROM (SELECT *, {_TIER_SQL} AS tier FROM lineitem) GROUP BY ALL")
def o3(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").withColumn("tier", tiers()).groupBy("tier", "l_returnflag").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first_order"))
    return g.orderBy("tier", "l_returnflag")


@query("u1_outcome_union", "SELECT o_orderkey, 'pass' AS outcome, o_totalprice, NULL::VARCHAR AS reason FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'excluded', NULL, 'finished' FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'skipped', o_totalprice, 'pending' FROM orders WHERE o_orderstatus = 'P'")
def u1(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ok = o.where("o_orderstatus = 'O'").select("o_orderkey", F.lit("pass").alias("outcome"), "o_totalprice")
    out = o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("excluded").alias("outcome"), F.lit("finished").alias("reason"))
    skipped = o.where("o_orderstatus = 'P'").select("o_orderkey", F.lit("skipped").alias("outcome"), "o_totalprice", F.lit("pending").alias("reason"))
    return ok.unionByName(out, allowMissingColumns=True).unionByName(skipped, allowMissingColumns=True)


@query("u2_key_space", "SELECT count(*) FILTER (a AND b) AS shared, count(*) FILTER (a AND NOT b) AS missing, count(*) FILTER (NOT a AND b) AS extra, array_to_string(list_sort(list(k) FILTER (a AND NOT b))[1:10], ',') AS examples FROM (SELECT coalesce(x.k, y.k) AS k, x.k IS NOT NULL AS a, y.k IS NOT NULL AS b FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_tax > 0.075) x FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_discount > 0.095) y ON x.k = y.k)")
def u2(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    x = l.where("l_tax > 0.075").select(F.col("l_partkey").alias("k")).distinct().withColumn("a", F.lit(True))
    y = l.where("l_discount > 0.095").select(F.col("l_partkey").alias("k")).distinct().withColumn("b", F.lit(True))
    both = x.join(y, "k", "full").select("k", F.coalesce("a", F.lit(False)).alias("a"), F.coalesce("b", F.lit(False)).alias("b"))
    counts = both.agg(F.count_if(F.col("a") & F.col("b")).alias("shared"), F.count_if(F.col("a") & ~F.col("b")).alias("missing"), F.count_if(~F.col("a") & F.col("b")).alias("extra"))
    ten = both.where("a and not b").orderBy("k").limit(10).agg(F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda v: v.cast("string")), ",").alias("examples"))
    return counts.crossJoin(F.broadcast(ten))


@query("u3_distinct_tasks", "SELECT DISTINCT l_partkey, l_suppkey % 5 AS allele, l_returnflag AS algorithm FROM lineitem")
def u3(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_suppkey") % 5).alias("allele"), F.col("l_returnflag").alias("algorithm")).distinct()


@query("u4_overlap_counts", "SELECT (SELECT count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT p_partkey FROM part WHERE p_size > 25)) AS n_shared, (SELECT count(*) FROM (SELECT p_partkey FROM part WHERE p_size > 25 EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')) AS n_only")
def u4(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")).distinct().withColumn("hit", F.lit(1))
    b = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("k")).distinct()
    return b.join(a, "k", "left").agg(F.count("hit").alias("n_shared"), F.count_if(F.col("hit").isNull()).alias("n_only"))


@query("u5_partition_law", "SELECT count(*) AS n_all, count(*) FILTER (s = 'O') AS retained, count(*) FILTER (s = 'F') AS excluded, count(*) FILTER (s = 'P') AS deferred, true AS holds FROM (SELECT o_orderstatus AS s FROM orders)")
def u5(spark, sf_dir):
    s = F.col("o_orderstatus")
    c = table(spark, sf_dir, "orders").agg(F.count("*").alias("n_all"), F.count_if(s == "O").alias("retained"), F.count_if(s == "F").alias("excluded"), F.count_if(s == "P").alias("deferred"))
    return c.withColumn("holds", F.col("retained") + F.col("excluded") + F.col("deferred") == F.col("n_all"))


