"""Queries of the scorers, classifiers and streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq.operators import scoring
from loomseq.plans.join_queries import TASKS, tasks
from loomseq.plans.registry import query, table
from loomseq.plans.sequence_queries import PARENTS, parents
from loomseq.storage import shared_path
from loomseq.streaming.incremental import score_stream


@query(
    "f14_deletion_windows",
    f"""SELECT event, start, peptide, choice, CASE WHEN choice = 'left' THEN l ELSE r END AS wt_peptide FROM (
SELECT *, coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY event ORDER BY start ROWS UNBOUNDED PRECEDING), 'left') AS choice FROM (
SELECT *, CASE WHEN nl > nr THEN 'left' WHEN nr > nl THEN 'right' END AS c FROM (
SELECT *, len(list_filter(generate_series(1, 9), lambda i: substr(peptide, i::BIGINT, 1) = substr(l, i::BIGINT, 1))) AS nl, len(list_filter(generate_series(1, 9), lambda i: substr(peptide, i::BIGINT, 1) = substr(r, i::BIGINT, 1))) AS nr FROM (
SELECT event, start, substr(mt, start, 9) AS peptide, substr(seq, start, 9) AS l, substr(seq, start + 3, 9) AS r FROM (
SELECT doc_id AS event, seq, left(seq, p - 1) || substr(seq, p + 3) AS mt, unnest(generate_series(greatest(1, p - 8), p - 1)) AS start FROM (
SELECT doc_id, seq, (length(seq) // 2)::BIGINT AS p FROM {PARENTS}) WHERE p > 1 AND length(seq) >= p + 11)))))""",
)
def f14(spark, sf_dir):
    p = parents(spark, sf_dir).select(F.col("doc_id").alias("event"), F.col("seq").alias("wt"), F.floor(F.length("seq") / 2).cast("int").alias("position"), F.lit(3).alias("removed"))
    return scoring.deletion_windows(p, 9)


@query("ud1_scored_tasks", "SELECT p_name AS peptide, p_brand AS hla_allele, a AS algorithm, 'MHC-I' AS mhc_class, round(1 / (1 + exp(-(length(p_name) - 9))), 9) AS score, CASE WHEN a = 'unknown' THEN 'skipped' ELSE 'ok' END AS status FROM (SELECT DISTINCT p_name, p_brand FROM part), (SELECT 'length_logistic' AS a)")
def ud1(spark, sf_dir):
    t = table(spark, sf_dir, "part").select(F.col("p_name").alias("peptide"), F.col("p_brand").alias("hla_allele"), F.lit("length_logistic").alias("algorithm"), F.lit("MHC-I").alias("mhc_class")).distinct()
    return scoring.score_tasks(t).select("peptide", "hla_allele", "algorithm", "mhc_class", F.round("score", 9).alias("score"), "status")


@query("ud2_job_groups", "SELECT 'linear' AS family, p_brand AS hla_allele, length(p_name) AS length, count(*) AS n_tasks, ceil(count(*) / 20)::INTEGER AS chunks, ceil(count(*) / 20) >= count(DISTINCT p_brand) AS in_chunks FROM (SELECT p_partkey, p_brand, p_name FROM part UNION ALL SELECT p_partkey, p_brand, p_name FROM part) GROUP BY p_brand, length(p_name)")
def ud2(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("peptide"), F.col("p_brand").alias("hla_allele"), F.explode(F.array(F.lit("hydropathy"), F.lit("length_logistic"))).alias("algorithm"))
    g = scoring.job_chunks(p, 20).groupBy("family", "hla_allele", "length", "chunks")
    return g.agg(F.count("*").alias("n_tasks"), (F.max("chunk") < F.col("chunks")).alias("in_chunks")).select("family", "hla_allele", "length", "n_tasks", "chunks", "in_chunks")


@query("ud3_linear_model", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN t IS NOT NULL THEN round(1 / (1 + exp(-greatest(-30, least(30, -1 + 0.05 * l_quantity + 4 * t)))), 9) END AS score, CASE WHEN t IS NOT NULL THEN 'ok' ELSE 'missing' END AS status FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_tax END AS t FROM lineitem)")
def ud3(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("t", F.when(F.col("l_returnflag") != "N", F.col("l_tax")))
    m = scoring.linear_model(l, {"l_quantity": 0.05, "t": 4.0}, -1.0)
    return m.select("l_orderkey", "l_linenumber", "l_partkey", F.round("score", 9).alias("score"), "status")


def _labelled(spark, sf_dir):
    l = table(spark, sf_dir, "labels").where("quality is not null")
    return parents(spark, sf_dir).join(l, "doc_id")


@query("ud4_baseline_classifier")
def ud4(spark, sf_dir):
    model, rows = scoring.composition_classifier(_labelled(spark, sf_dir), "seq", "quality")
    return model.transform(rows).select("doc_id", "quality", F.col("prediction").cast("int").alias("predicted"))


@query("ud4_ngram3_classifier")
def ud4_ngram3(spark, sf_dir):
    model, rows = scoring.ngram_classifier(_labelled(spark, sf_dir), "seq", "quality", 3)
    return model.transform(rows).select("doc_id", "quality", F.col("prediction").cast("int").alias("predicted"))


@query("ud4_ngram4_classifier")
def ud4_ngram4(spark, sf_dir):
    model, rows = scoring.ngram_classifier(_labelled(spark, sf_dir), "seq", "quality", 4)
    return model.transform(rows).select("doc_id", "quality", F.col("prediction").cast("int").alias("predicted"))


@query("ud5_cross_validation")
def ud5(spark, sf_dir):
    scored = scoring.out_of_fold(spark, _labelled(spark, sf_dir), "seq", "quality", group="seq")
    return scored.select("doc_id", "fold", "score", F.col("prediction").cast("int").alias("predicted"))


@query("streaming_incremental_scores", "SELECT DISTINCT user_id, event_type, length(event_type)::DOUBLE AS score, 'ok' AS status FROM events")
def stream(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    path, store = shared_path(spark, "stream-in"), shared_path(spark, "scores")
    e.select("user_id", "event_type").repartition(4, "user_id").write.parquet(path)
    source = spark.readStream.schema("user_id bigint, event_type string").option("maxFilesPerTrigger", 2).parquet(path)
    scored = lambda t: t.withColumns({"score": F.length("event_type").cast("double"), "status": F.lit("ok")})
    schema = "user_id bigint, event_type string, score double, status string"
    score_stream(source, ["user_id", "event_type"], store, shared_path(spark, "stream-state"), scored, schema).awaitTermination()
    return spark.read.schema(schema).parquet(store).select("user_id", "event_type", "score", "status")


@query("e2_two_stage_counts", f"SELECT mhc, algorithm, count(*) AS n FROM {TASKS} GROUP BY ALL")
def e2(spark, sf_dir):
    return tasks(spark, sf_dir).groupBy("mhc", "algorithm").agg(F.count("*").alias("n"))
