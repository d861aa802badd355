"""Queries of the readers and writers: rows of the test tables are written in a format to
the shared folder, scanned back and compared with the columns that they came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq import sinks, sources
from loomseq.functions import sequences as S
from loomseq.plans.registry import query, table
from loomseq.plans.sequence_queries import PARENTS, parents
from loomseq.storage import shared_path


def lines(spark, df, tag, *columns, sep="\t"):
    """The path of a folder with df's columns as lines."""
    path = shared_path(spark, tag)
    df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in columns]).alias("value")).write.text(path)
    return path


@query("s1_fasta_scan", f"SELECT 'doc' || doc_id AS record_id, lang || '|len=' || length(seq) AS description, length(seq) AS n, md5(seq) AS digest FROM {PARENTS}")
def s1(spark, sf_dir):
    path = shared_path(spark, "fasta")
    p = parents(spark, sf_dir)
    sinks.write_fasta(p, path, F.concat(F.lit("doc"), "doc_id"), F.concat("lang", F.lit("|len="), F.length("seq")), F.col("seq"))
    f = sources.fasta(spark, path)
    return f.select("record_id", "description", F.length("sequence").alias("n"), F.md5("sequence").alias("digest"))


@query("k2_k6_kept_records", f"SELECT 'doc' || doc_id AS record_id, md5(seq) AS digest FROM {PARENTS} WHERE lang = 'fr'")
def k6(spark, sf_dir):
    path = shared_path(spark, "fasta")
    p = parents(spark, sf_dir)
    sinks.write_fasta(p, path, F.concat(F.lit("doc"), "doc_id"), F.col("lang"), F.col("seq"))
    kept = p.where("lang = 'fr'").select(F.concat(F.lit("doc"), "doc_id").alias("record_id"))
    return sinks.kept_records(sources.fasta(spark, path), kept, "record_id").select("record_id", F.md5("sequence").alias("digest"))


@query("s2_hit_scan", "SELECT l_orderkey::VARCHAR AS qseqid, l_linenumber AS qlen, l_partkey::VARCHAR AS sseqid, l_quantity * 2 AS pident, l_discount AS evalue, l_extendedprice AS bitscore FROM lineitem")
def s2(spark, sf_dir):
    z = F.lit(0)
    l = table(spark, sf_dir, "lineitem").withColumn("pident", F.col("l_quantity") * 2)
    path = lines(spark, l, "hits", "l_orderkey", "l_linenumber", "l_partkey", F.lit("AAA"), F.lit("AAC"), F.lit("t"), "pident", z, z, z, z, z, z, z, "l_discount", "l_extendedprice", "l_tax", "l_tax")
    return sources.hits(spark, path).select("qseqid", "qlen", "sseqid", "pident", "evalue", "bitscore")


@query("s3_layout_normaliser", "SELECT l_orderkey, l_linenumber, l_partkey, 'ref|' || l_partkey || '|' AS sseqid, CASE WHEN l_quantity = 50 THEN 'S' ELSE 'Q' END AS qseq, l_tax AS qcovs FROM lineitem")
def s3(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").cast("string").alias("sseqid"), F.lit("Q").alias("qseq"), F.lit("S").alias("sseq"), (F.col("l_quantity") * 2).alias("pident"), F.col("l_tax").alias("qcovhsp"))
    return sources.normalise_hits(l).select("l_orderkey", "l_linenumber", "l_partkey", "sseqid", "qseq", "qcovs")


@query("s4_column_fallback", "SELECT event_id, event_type AS filled, CASE WHEN event_id % 2 = 0 THEN '' ELSE event_type END AS kept FROM events")
def s4(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.lit("").alias("filled"), F.when(F.col("event_id") % 2 == 0, "").otherwise(F.col("event_type")).alias("kept"))
    e = sources.fill_if_column_empty(e, "filled", F.col("event_type"))
    return sources.fill_if_column_empty(e, "kept", F.lit("x")).select("event_id", "filled", "kept")


@query("s5_s6_catalogs", "SELECT p_partkey::VARCHAR AS prot_id, p_size::VARCHAR AS tax_id FROM part WHERE p_size IN (SELECT p_size FROM part WHERE p_size % 4 = 0)")
def s5(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    catalog = sources.delimited(spark, lines(spark, p, "catalog", "p_partkey", "p_size"), "prot_id string, tax_id string")
    verdict = F.when(F.col("p_size") % 4 == 0, " Contaminant").otherwise("clean")
    black = sources.delimited(spark, lines(spark, p.withColumn("v", verdict), "blacklist", "p_size", "v"), "tax_id string, verdict string")
    return catalog.join(sources.contaminants(black), "tax_id", "left_semi").select("prot_id", "tax_id")


@query("s7_variant_scan", "SELECT 'chr' || l_suppkey AS chrom, l_partkey AS pos, unnest(['G', 'T']) AS alt, CASE WHEN l_tax > 0.05 THEN NULL ELSE l_quantity END AS qual, l_orderkey::VARCHAR AS ord, l_linenumber AS ref_depth, unnest([l_linenumber + 1, l_linenumber + 2]) AS alt_depth FROM lineitem")
def s7(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    l = l.withColumns({"c": F.concat(F.lit("chr"), "l_suppkey"), "q": F.when(F.col("l_tax") > 0.05, ".").otherwise(F.col("l_quantity").cast("string")), "i": F.concat(F.lit("DB;ORD="), "l_orderkey"), "s": F.concat(F.lit("0/1:"), "l_linenumber", F.lit(","), F.col("l_linenumber") + 1, F.lit(","), F.col("l_linenumber") + 2)})
    path = lines(spark, l, "vcf", "c", "l_partkey", F.lit("."), F.lit("A"), F.lit("G,T"), "q", F.lit("PASS"), "i", F.lit("GT:AD"), "s")
    v = sources.variants(spark, path)
    return v.select("chrom", "pos", "alt", "qual", F.col("info")["ORD"].alias("ord"), "ref_depth", "alt_depth")


@query("s8_gene_model", "SELECT 'chr' || l_suppkey AS chrom, l_partkey - 1 AS start0, l_partkey + 10 AS end0, 'g' || l_orderkey AS gene_id, 't' || l_linenumber AS transcript_id, NULL::VARCHAR AS gene_name FROM lineitem")
def s8(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    a = F.concat(F.lit('gene_id "g'), "l_orderkey", F.lit('"; transcript_id "t'), "l_linenumber", F.lit('";'))
    l = l.withColumns({"c": F.concat(F.lit("chr"), "l_suppkey"), "e": F.col("l_partkey") + 10, "a": a})
    g = sources.gene_model(spark, lines(spark, l, "gtf", "c", F.lit("src"), F.lit("exon"), "l_partkey", "e", F.lit("."), F.lit("+"), F.lit("."), "a"))
    return g.select("chrom", "start0", "end0", "gene_id", "transcript_id", "gene_name")


@query("s9_pairwise_scan", "SELECT l_orderkey::VARCHAR AS query, l_partkey::VARCHAR AS target, round(l_linenumber / 10.0, 6) AS identity, round(l_quantity / 100.0, 6) AS coverage FROM lineitem")
def s9(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("bigint"))
    z = F.lit(0)
    p = sources.pairwise(spark, lines(spark, l, "paf", "l_orderkey", F.lit(100), z, "q", F.lit("+"), "l_partkey", F.lit(100), z, z, "l_linenumber", F.lit(10), F.lit(60)))
    return p.select("query", "target", F.round("identity", 6).alias("identity"), F.round("coverage", 6).alias("coverage"))


@query("s10_junction_scan", "SELECT 'chr' || (l_suppkey % 30) AS chrom, l_partkey - 1 AS start0, l_partkey + 50 AS end0, CASE l_linenumber % 3 WHEN 1 THEN '+' WHEN 2 THEN '-' ELSE '.' END AS strand, l_quantity::BIGINT AS unique_reads FROM lineitem WHERE l_suppkey % 30 <> 7")
def s10(spark, sf_dir):
    k = F.col("l_suppkey") % 30
    l = table(spark, sf_dir, "lineitem").withColumns({"c": F.when(k == 7, "GL000.1").otherwise(F.concat(F.lit("chr"), k)), "e": F.col("l_partkey") + 50, "s": F.col("l_linenumber") % 3, "u": F.col("l_quantity").cast("bigint")})
    z = F.lit(1)
    return sources.junctions(spark, lines(spark, l, "sj", "c", "l_partkey", "e", "s", z, z, "u", z, z)).select("chrom", "start0", "end0", "strand", "unique_reads")


@query("s11_block_chains", "SELECT 'p' || p_partkey AS name, 2 AS n_blocks, p_partkey + 0 AS first_start, p_partkey + 100 + p_size AS last_end FROM part")
def s11(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumns({"nm": F.concat(F.lit("p"), "p_partkey"), "e": F.col("p_partkey") + 200, "sz": F.concat(F.lit("50,"), "p_size", F.lit(","))})
    z = F.lit(0)
    b = sources.bed12(spark, lines(spark, p, "bed", F.lit("chr1"), "p_partkey", "e", "nm", z, F.lit("+"), z, z, z, F.lit(2), "sz", F.lit("0,100,")))
    blocks = F.col("blocks")
    return b.select("name", F.size(blocks).alias("n_blocks"), blocks[0]["start0"].alias("first_start"), blocks[1]["end0"].alias("last_end"))


@query("s12_quantification", "SELECT p_name || p_partkey AS Name, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_retailprice END AS TPM FROM part")
def s12(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumns({"Name": F.concat("p_name", F.col("p_partkey").cast("string")), "TPM": F.when(F.col("p_size") % 5 == 0, "NA").otherwise(F.col("p_retailprice").cast("string"))})
    path = shared_path(spark, "quant")
    sinks.write_tsv(p, path, ["Name", "TPM"])
    return sources.quantification(spark, path)


@query("s15_hla_typing", "SELECT DISTINCT 'A' AS gene, 'A*' || lpad((p_size % 90)::VARCHAR, 2, '0') || ':01' AS allele FROM part")
def s15(spark, sf_dir):
    n = F.lpad((F.col("p_size") % 90).cast("string"), 2, "0")
    p = table(spark, sf_dir, "part").withColumn("x", F.concat(F.lit("HLA-A*"), n, F.lit(":01:02")))
    a = sources.hla_typing(spark, lines(spark, p, "hla", F.lit("A"), "x", F.lit("")))
    other = sources.hla_typing(spark, lines(spark, p, "hla", F.lit("DRA"), "x"), genes="^(A|B|C)$")
    return a.unionByName(other)


@query("s16_alias_table", "SELECT k AS key, max(v) AS seq FROM (SELECT unnest(['HLA-' || p_size, 'A' || p_size, p_brand]) AS k, p_name AS v FROM part) GROUP BY k")
def s16(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("HLA-"), "p_size").alias("a"), F.concat(F.lit("A"), "p_size").alias("b"), F.col("p_brand").alias("c"), F.col("p_name").alias("seq"))
    return sources.aliases_long(p, ["a", "b", "c"], "seq")


@query("s17_k1_gzip_table", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders")
def s17(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("priority", F.when(F.col("o_custkey") % 2 != 0, F.col("o_orderpriority")))
    path = shared_path(spark, "gz")
    sinks.write_tsv(o, path, ["o_orderkey", "o_orderstatus", "priority"], compression="gzip")
    return sources.delimited(spark, path, "o_orderkey string, o_orderstatus string, priority string", header=True).withColumn("priority", F.nullif(F.col("priority"), F.lit("")))


@query("s20_by_suffix", "SELECT n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def s20(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ID"), F.col("n_name").alias("Label"))
    a, b = shared_path(spark, "csv"), shared_path(spark, "tsv")
    n.write.option("header", True).csv(a)
    sinks.write_tsv(n, b, ["ID", "Label"])
    schema = "ID int, Label string"
    read = [sources.rename_ignoring_case(sources.by_suffix(spark, p, schema, x), {"id": [], "name": ["label"]}) for p, x in ((a, "csv"), (b, "tsv"))]
    return sources.concatenated(read)


@query("s22_chain_builder", "SELECT l_orderkey, count(*)::INTEGER AS n_blocks, arg_min(l_partkey, (l_linenumber, l_partkey)) AS first_block, arg_max(l_partkey, (l_linenumber, l_partkey)) AS last_block FROM lineitem GROUP BY l_orderkey")
def s22(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("o", F.struct("l_linenumber", "l_partkey"))
    c = sources.block_chains(l, "l_orderkey", "o", "l_partkey", "l_suppkey")
    return c.select("l_orderkey", F.size("blocks").alias("n_blocks"), F.col("blocks")[0]["start0"].alias("first_block"), F.element_at("blocks", -1)["start0"].alias("last_block"))


@query("k3_class_split", "SELECT mktsegment, count(*) AS n FROM (SELECT c_mktsegment AS mktsegment FROM customer) GROUP BY 1")
def k3(spark, sf_dir):
    path = shared_path(spark, "classes")
    sinks.write_by_class(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("mktsegment")), path, "mktsegment")
    return spark.read.parquet(path).groupBy("mktsegment").agg(F.count("*").alias("n"))


@query("k5_stage_table", "SELECT 'n_rows' AS stage, count(*) AS n FROM documents UNION ALL SELECT 'n_french', count(*) FILTER (lang = 'fr') FROM documents")
def k5(spark, sf_dir):
    from loomseq.operators.qc import stage_counts

    path = shared_path(spark, "counts")
    sinks.write_tsv(stage_counts(table(spark, sf_dir, "documents"), n_rows=F.lit(True), n_french=F.col("lang") == "fr"), path, ["stage", "n"])
    return sources.delimited(spark, path, "stage string, n bigint", header=True)


@query("f8_genomic_segments", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey + greatest(10 - o, 0) AS seg_start, l_suppkey + least(40 - o, q) AS seg_end FROM (SELECT *, l_quantity::BIGINT AS q, (sum(l_quantity::BIGINT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) - l_quantity::BIGINT)::BIGINT AS o FROM lineitem) WHERE o < 40 AND o + q > 10")
def f8(spark, sf_dir):
    from loomseq.operators.windows import running_offset

    l = table(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("bigint"))
    o = running_offset(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "q", "o").where("o < 40 and o + q > 10")
    return o.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") + F.greatest(10 - F.col("o"), F.lit(0))).alias("seg_start"), (F.col("l_suppkey") + F.least(40 - F.col("o"), F.col("q"))).alias("seg_end"))


@query("f12_covering_flags", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN b > a THEN s <= b AND s + 8 > a ELSE s <= a AND s + 8 > a END AS covers FROM (SELECT *, l_suppkey % 30 + 1 AS s, l_partkey % 25 AS a, l_partkey % 25 + l_linenumber % 2 AS b FROM lineitem)")
def f12(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey % 30 + 1 as s", "l_partkey % 25 as a", "l_partkey % 25 + l_linenumber % 2 as b")
    return l.select("l_orderkey", "l_linenumber", "l_partkey", S.covers_change(F.col("s"), F.lit(9), F.col("a"), F.col("b")).alias("covers"))


@query("f15_event_context", f"SELECT doc_id, substr(seq, lo, hi - lo + 1) AS context FROM (SELECT doc_id, seq, greatest(1, p - 13) AS lo, least(length(seq), p + 13) AS hi FROM (SELECT doc_id, seq, (length(seq) // 3 + 1)::BIGINT AS p FROM {PARENTS}))")
def f15(spark, sf_dir):
    p = parents(spark, sf_dir).withColumn("p", F.floor(F.length("seq") / 3).cast("int") + 1)
    lo, hi = F.greatest(F.lit(1), F.col("p") - 13), F.least(F.length("seq"), F.col("p") + 13)
    return p.select("doc_id", S.ascii_part(F.col("seq"), lo, hi - lo + 1).alias("context"))


@query("f21_rescue_ladder", "SELECT l_partkey, CASE WHEN max(l_discount) > 0.095 THEN 'editing' WHEN count(DISTINCT l_returnflag) > 2 THEN 'complex' WHEN sum(l_quantity) < 200 THEN 'insufficient' ELSE 'rescued' END AS verdict FROM lineitem GROUP BY l_partkey")
def f21(spark, sf_dir):
    from loomseq.operators.qc import ladder

    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max("l_discount").alias("d"), F.countDistinct("l_returnflag").alias("k"), F.sum("l_quantity").alias("q"))
    return g.select("l_partkey", ladder((F.col("d") > 0.095, "editing"), (F.col("k") > 2, "complex"), (F.col("q") < 200, "insufficient"), otherwise="rescued").alias("verdict"))


@query("s13_peak_annotation", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax > 0.05 OR l_partkey = l_suppkey THEN 'g' || l_partkey ELSE 'g' || l_partkey || ',g' || l_suppkey END AS gene FROM lineitem")
def s13(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    other = F.when(F.col("l_tax") > 0.05, F.col("l_partkey")).otherwise(F.col("l_suppkey"))
    l = l.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("exon (g"), "l_partkey", F.lit(", 2)")).alias("a"), F.concat(F.lit("intron (g"), other, F.lit(", 1)")).alias("b"))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", sources.annotated_gene(F.col("a"), F.col("b")).alias("gene"))


@query("s18_editing_sites", "SELECT l_suppkey AS chrom, l_partkey AS pos, min(l_returnflag) AS alt FROM lineitem GROUP BY 1, 2")
def s18(spark, sf_dir):
    path = lines(spark, table(spark, sf_dir, "lineitem"), "sites", "l_suppkey", "l_partkey", "l_returnflag")
    sites = sources.delimited(spark, path, "chrom bigint, pos bigint, alt string").dropDuplicates()
    return sites.groupBy("chrom", "pos").agg(F.min("alt").alias("alt"))


@query("s21_task_contract", "SELECT p_name AS peptide, p_brand AS hla_allele, 'x' AS algorithm, 'MHC-I' AS mhc_class, count(*) AS n FROM part GROUP BY ALL")
def s21(spark, sf_dir):
    path = lines(spark, table(spark, sf_dir, "part"), "tasks", "p_name", "p_brand", F.lit("x"), F.lit("MHC-I"))
    t = sources.delimited(spark, path, ", ".join(f"{c} string" for c in sources.TASK_COLUMNS))
    return sources.require_columns(t, sources.TASK_COLUMNS).groupBy(*sources.TASK_COLUMNS).agg(F.count("*").alias("n"))


@query("s14_overlap_table", "SELECT 'b' || l_orderkey AS name, 'g' || l_partkey AS gene_id, least(l_suppkey + 60, l_partkey + 50) - greatest(l_suppkey, l_partkey - 1) AS overlap, count(*) AS n FROM lineitem WHERE least(l_suppkey + 60, l_partkey + 50) > greatest(l_suppkey, l_partkey - 1) GROUP BY ALL")
def s14(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumns({"e": F.col("l_suppkey") + 60, "ge": F.col("l_partkey") + 50, "nm": F.concat(F.lit("b"), "l_orderkey"), "a": F.concat(F.lit('gene_id "g'), "l_partkey", F.lit('"; transcript_id "t";'))})
    z, c, dot = F.lit(0), F.lit("chr1"), F.lit(".")
    path = lines(spark, l, "overlaps", c, "l_suppkey", "e", "nm", z, F.lit("+"), z, z, z, F.lit(1), F.lit("60,"), F.lit("0,"), c, dot, F.lit("exon"), "l_partkey", "ge", dot, F.lit("-"), dot, "a")
    return sources.interval_overlaps(spark, path).groupBy("name", "gene_id", "overlap").agg(F.count("*").alias("n"))


@query("s16_allele_sequences", "SELECT 'A*' || lpad((p_size % 90)::VARCHAR, 2, '0') || ':01' AS allele, arg_min('S' || replace(p_type, ' ', ''), p_partkey) AS sequence FROM part GROUP BY p_size % 90")
def s16_fasta(spark, sf_dir):
    path = shared_path(spark, "alleles")
    p = table(spark, sf_dir, "part").repartitionByRange(8, "p_partkey").sortWithinPartitions("p_partkey")
    name = F.concat(F.lit("A*"), F.lpad((F.col("p_size") % 90).cast("string"), 2, "0"), F.lit(":01:"), F.lpad((F.col("p_partkey") % 90).cast("string"), 2, "0"))
    sinks.write_fasta(p, path, F.concat(F.lit("HLA:"), "p_partkey"), F.concat(name, F.lit(" 181 bp")), F.concat(F.lit("S"), F.replace("p_type", F.lit(" "), F.lit(""))))
    return sources.allele_sequences(spark, path)


@query("s16_pseudo_sequences", "SELECT k AS key, arg_max(v, o) AS seq FROM (SELECT unnest(['HLA-' || p_size, 'A' || p_size, p_brand]) AS k, p_name || p_partkey AS v, p_partkey AS o FROM part) GROUP BY k")
def s16_pseudo(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("HLA-"), "p_size").alias("a"), F.concat(F.lit("A"), "p_size").alias("b"), F.col("p_brand").alias("c"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("seq"))
    return sources.pseudo_sequences(p, ["a", "b", "c"], "seq", F.col("p_partkey"))


@query(
    "s19_allele_support",
    """SELECT l_partkey, l_linenumber, a AS algorithm, CASE WHEN a = 'N' THEN 'run' WHEN l_suppkey % 5 = 4 THEN 'skipped' WHEN l_suppkey % 5 = 3 AND l_linenumber + 7 NOT IN (8, 10) THEN 'skipped' ELSE 'run' END AS action, count(*) AS n
FROM (SELECT *, l_returnflag AS a FROM lineitem) GROUP BY ALL""",
)
def s19(spark, sf_dir):
    r = table(spark, sf_dir, "region").where("r_regionkey < 4").select("r_regionkey", F.explode(F.array(F.lit("A"), F.lit("R"))).alias("a"))
    r = r.withColumn("len", F.explode(F.when(F.col("r_regionkey") == 3, F.array(F.lit("8"), F.lit("10"))).otherwise(F.array(F.lit("")))))
    r = r.withColumn("x", F.concat(F.lit(" HLA-A*0"), "r_regionkey", F.lit(":01")))
    odd = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in ("# N\tA*04:01", "A\t-----", "A\tA*04:01 old", "\tA*04:01", "R\t")])).alias("value"))
    path = shared_path(spark, "support")
    r.select(F.concat_ws("\t", "a", "x", "len").alias("value")).unionAll(odd).write.text(path)
    l = table(spark, sf_dir, "lineitem")
    tasks = l.select("l_partkey", "l_linenumber", F.repeat(F.lit("A"), F.col("l_linenumber") + 7).alias("peptide"), F.concat(F.lit("HLA-A*0"), F.col("l_suppkey") % 5, F.lit(":01")).alias("hla_allele"), F.col("l_returnflag").alias("algorithm"))
    routed = sources.route_by_support(tasks, sources.allele_support(spark, path))
    return routed.groupBy("l_partkey", "l_linenumber", "algorithm", "action").agg(F.count("*").alias("n"))


@query("k4_shards", "SELECT n_nationkey::VARCHAR AS id, n_name AS name, true AS other_refused FROM nation")
def k4(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    paths = [shared_path(spark, "shard") for _ in range(3)]
    sinks.write_tsv(n.where("id % 2 = 0"), paths[0], ["id", "name"])
    sinks.write_tsv(n.where("id % 2 = 1"), paths[1], ["id", "name"])
    sinks.write_tsv(n, paths[2], ["name", "id"])
    try:
        sources.shards(spark, paths)
        refused = False
    except ValueError:
        refused = True
    return sources.shards(spark, paths[:2]).withColumn("other_refused", F.lit(refused))


_SIX = ("sqrt(l_extendedprice) * 100000", "l_discount / 7", "-(l_tax + 0.0123) / 100003", "l_quantity")


@query("f26_six_digits", "SELECT l_orderkey::VARCHAR AS l_orderkey, l_linenumber::VARCHAR AS l_linenumber, " + ", ".join(f"printf('%.6g', {x}) AS v{i}" for i, x in enumerate(_SIX)) + " FROM lineitem")
def f26(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", *[f"{x} as v{i}" for i, x in enumerate(_SIX)])
    path = shared_path(spark, "six")
    names = ["l_orderkey", "l_linenumber", "v0", "v1", "v2", "v3"]
    sinks.write_tsv(l, path, names)
    return sources.delimited(spark, path, ", ".join(f"{c} string" for c in names), header=True)
