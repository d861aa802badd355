"""Readers of sequence, hit, variant, gene-model, interval, typing and score tables.

Schemas are explicit; nothing is inferred. Blank and marker texts become null at the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.functions.text import blank_to_null, gtf_attribute, hla_two_field, info_map, support_key, tolerant_double, tolerant_long
from loomseq.operators.evidence import repeated
from loomseq.storage import stored

HIT_COLUMNS = "qseqid string, qlen int, sseqid string, qseq string, sseq string, stitle string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, qcovhsp double, qcovs double"
TASK_COLUMNS = ["peptide", "hla_allele", "algorithm", "mhc_class"]


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}; there are {df.columns}")
    return df


def delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = False, comment: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    return (reader.option("comment", comment) if comment else reader).csv(path)


def by_suffix(spark: SparkSession, path: str, schema: str, suffix: str) -> DataFrame:
    """Comma-separated for .csv, tab-separated for .tsv and .txt, each with a header."""
    return delimited(spark, path, schema, {"csv": ",", "tsv": "\t", "txt": "\t"}[suffix], header=True)


def rename_ignoring_case(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns renamed to the key whose alias they match, whatever their case."""
    of = {a.lower(): name for name, names in aliases.items() for a in [name, *names]}
    return df.select(*[F.col(f"`{c}`").alias(of.get(c.lower(), c)) for c in df.columns])


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """record_id (first word of the header), description, sequence. Files are split between
    tasks at record starts, a line feed before >."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("r"))
    lines = F.split("r", "\r?\n", 2)
    rows = raw.where("trim(r) <> ''").select(F.regexp_extract(lines[0], r"^(\S*)", 1).alias("record_id"), F.regexp_extract(lines[0], r"^\S*\s+(.*)$", 1).alias("description"), F.regexp_replace(F.coalesce(F.get(lines, F.lit(1)), F.lit("")), r"\s+", "").alias("sequence"))
    return rows


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Headerless search hits with a row id that keeps the order within a file."""
    return delimited(spark, path, HIT_COLUMNS).withColumn("row_id", F.monotonically_increasing_id())


def normalise_hits(df: DataFrame) -> DataFrame:
    """Another search layout as the canonical one: coverage of the alignment stands for that
    of the query where it is missing, the subject part for an identical query part, and
    bare accessions are wrapped as ref|x|."""
    cover = F.col("qcovs") if "qcovs" in df.columns else F.col("qcovhsp")
    wrapped = F.when(F.col("sseqid").contains("|"), F.col("sseqid")).otherwise(F.concat(F.lit("ref|"), "sseqid", F.lit("|")))
    return df.withColumns({"qcovs": cover, "qseq": F.when(F.col("pident") == 100, F.col("sseq")).otherwise(F.col("qseq")), "sseqid": wrapped})


def fill_if_column_empty(df: DataFrame, column: str, fallback: Column) -> DataFrame:
    """fallback where the whole column is blank; single blanks stay. The check is one row."""
    flag = df.agg(F.coalesce(F.bool_and(F.coalesce(F.col(column), F.lit("")) == ""), F.lit(True)).alias("__all"))
    return df.crossJoin(F.broadcast(flag)).withColumn(column, F.when(F.col("__all"), fallback).otherwise(F.col(column))).drop("__all")


def contaminants(df: DataFrame, verdict: str = "verdict") -> DataFrame:
    return df.where(F.lower(F.trim(verdict)) == "contaminant").select("tax_id").distinct()


def variants(spark: SparkSession, path: str) -> DataFrame:
    """One row per alternative allele of variant-call lines: chrom, pos, ref, alt, qual,
    filter, info map, format map and the allele's depths."""
    raw = delimited(spark, path, "chrom string, pos string, id string, ref string, alts string, qual string, filter string, info string, format string, sample string", comment="#")
    base = raw.select("chrom", tolerant_long(F.col("pos")).alias("pos"), "ref", F.posexplode(F.split("alts", ",")).alias("k", "alt"), tolerant_double(F.col("qual")).alias("qual"), "filter", info_map(F.col("info")).alias("info"), F.map_from_arrays(F.split("format", ":"), F.split("sample", ":")).alias("fmt"))
    depths = F.split(F.try_element_at("fmt", F.lit("AD")), ",")
    return base.withColumns({"ref_depth": F.get(depths, F.lit(0)).try_cast("int"), "alt_depth": F.get(depths, F.col("k") + 1).try_cast("int")}).drop("k")


def gene_model(spark: SparkSession, path: str) -> DataFrame:
    """Features with half-open starts and the ids in their attributes."""
    g = delimited(spark, path, "chrom string, source string, feature string, start1 bigint, end1 bigint, score string, strand string, frame string, attributes string", comment="#")
    return g.select("chrom", "feature", (F.col("start1") - 1).alias("start0"), F.col("end1").alias("end0"), "strand", *[gtf_attribute(F.col("attributes"), k).alias(k) for k in ("gene_id", "transcript_id", "gene_name")])


def pairwise(spark: SparkSession, path: str) -> DataFrame:
    """Pairwise alignments with identity and coverage of the query."""
    p = delimited(spark, path, "query string, qlen bigint, qstart bigint, qend bigint, strand string, target string, tlen bigint, tstart bigint, tend bigint, matches bigint, block bigint, mapq int")
    ratio = lambda a, b: F.when(b > 0, a / b)
    return p.withColumns({"identity": ratio(F.col("matches"), F.col("block")), "coverage": ratio(F.col("qend") - F.col("qstart"), F.col("qlen"))})


def junctions(spark: SparkSession, path: str, contigs: str = r"^(chr)?([0-9]+|[XYM]|MT)$") -> DataFrame:
    """Splice junctions: 0-based starts, strand codes 1 and 2 as + and -, others as ., only
    main contigs."""
    j = delimited(spark, path, "chrom string, start1 bigint, end0 bigint, strand_code int, motif int, annotated int, unique_reads bigint, multi_reads bigint, max_overhang int")
    strand = F.when(F.col("strand_code") == 1, "+").when(F.col("strand_code") == 2, "-").otherwise(".")
    return j.where(F.col("chrom").rlike(contigs)).select("chrom", (F.col("start1") - 1).alias("start0"), "end0", strand.alias("strand"), "unique_reads", "multi_reads", "max_overhang", "annotated", "motif")


def checked_junctions(spark: SparkSession, path: str) -> DataFrame:
    """junctions of a file that holds each (chrom, start0, end0, strand) once and names its
    chromosomes in one way, with or without chr; else an error that names the first keys."""
    found = junctions(spark, path)
    key = ["chrom", "start0", "end0", "strand"]
    twice = repeated(found, key)
    if twice:
        raise ValueError(f"junctions occur more than once: {twice}")
    styles = found.agg(F.count_if(F.lower("chrom").startswith("chr")).alias("chr"), F.count("*").alias("n")).first()
    if 0 < styles.chr < styles.n:
        raise ValueError(f"chromosomes are named in two ways: {styles.chr} of {styles.n} rows with chr")
    return found


def bed12(spark: SparkSession, path: str) -> DataFrame:
    """Absolute blocks of BED12 records, in order, as array<struct<start0, end0>>."""
    b = delimited(spark, path, "chrom string, start0 bigint, end0 bigint, name string, score string, strand string, thick0 bigint, thick1 bigint, rgb string, n int, sizes string, offsets string")
    ints = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    zipped = F.arrays_zip(ints("sizes").alias("size"), ints("offsets").alias("off"))
    blocks = F.transform(zipped, lambda z: F.struct((F.col("start0") + z["off"]).alias("start0"), (F.col("start0") + z["off"] + z["size"]).alias("end0")))
    return b.select("name", "chrom", "strand", blocks.alias("blocks"))


def block_chains(rows: DataFrame, key: str, order: str, start: str, end: str) -> DataFrame:
    """One ordered chain for each id."""
    blocks = F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), F.col(start).alias("start0"), F.col(end).alias("end0"))))
    return rows.groupBy(key).agg(blocks.alias("blocks"))


def checked_chains(rows: DataFrame, key: str, order: str, build: str) -> DataFrame:
    """Chains (key, blocks of chrom, strand, start0, end0) from ordered block rows with columns
    status, build and n_blocks. Only rows whose status is pass count. An error names the first
    keys with rows of another build, with another number of blocks than n_blocks says, with a
    place in the order taken twice, or on more than one chromosome or strand."""
    good = rows.where("status = 'pass'")
    blocks = F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), "chrom", "strand", "start0", "end0")))
    facts = good.groupBy(key).agg(blocks.alias("b"), F.min("n_blocks").alias("least"), F.max("n_blocks").alias("most"), F.count_if(~F.col("build").eqNullSafe(F.lit(build))).alias("other"), F.countDistinct(order).alias("places"), F.countDistinct("chrom", "strand").alias("sides"))
    # Every rule and the chains themselves read the facts: brought together once.
    facts = stored(rows.sparkSession, facts, "chains")
    n = F.size("b")
    rules = {"build": F.col("other") > 0, "number of blocks": ~F.coalesce((F.col("least") == n) & (F.col("most") == n), F.lit(False)), "order": F.col("places") != n, "chromosome or strand": F.col("sides") != 1}
    counts = facts.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()]).first()
    rules = {name: rule for name, rule in rules.items() if counts[name]}
    broken = {name: [r[0] for r in facts.where(rule).select(F.col(key).cast("string")).orderBy(key).limit(5).collect()] for name, rule in rules.items()}
    if any(broken.values()):
        raise ValueError(f"block rows break their contract: { {k: v for k, v in broken.items() if v} }")
    return facts.select(key, F.transform("b", lambda x: F.struct(x["chrom"].alias("chrom"), x["strand"].alias("strand"), x["start0"].alias("start0"), x["end0"].alias("end0"))).alias("blocks"))


def quantification(spark: SparkSession, path: str) -> DataFrame:
    q = delimited(spark, path, "Name string, TPM string", header=True)
    return q.select("Name", tolerant_double(F.col("TPM")).alias("TPM"))


def hla_typing(spark: SparkSession, path: str, genes: str = r"^(A|B|C|D[PQR][AB][1-9]?)$") -> DataFrame:
    """Long alleles of gene rows (gene, then alleles separated by tabs), two fields."""
    t = spark.read.text(path).select(F.split("value", "\t").alias("v"))
    rows = t.select(F.upper(F.trim(F.col("v")[0])).alias("gene"), F.explode(F.slice("v", 2, F.size("v"))).alias("raw"))
    return rows.where(F.col("gene").rlike(genes) & blank_to_null(F.col("raw")).isNotNull()).select("gene", hla_two_field(F.col("raw")).alias("allele")).distinct()


def aliases_long(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(key, value) of rows with several alias columns; the last row of a key is not
    special, the largest value wins."""
    return df.select(F.explode(F.array(*keys)).alias("key"), value).where("key is not null").groupBy("key").agg(F.max(value).alias(value))


def concatenated(parts: list[DataFrame]) -> DataFrame:
    """Shards with the same header as one table; a shard with another one is an error."""
    first = parts[0].columns
    for p in parts[1:]:
        if p.columns != first:
            raise ValueError(f"headers differ: {p.columns} and {first}")
    return reduce(DataFrame.unionByName, parts)


def shards(spark: SparkSession, paths: list[str], sep: str = "\t") -> DataFrame:
    """Delimited shards that carry a header, all columns as text, as one table after a
    check of their headers."""
    return concatenated([spark.read.option("sep", sep).option("header", True).csv(p) for p in paths])


OVERLAP_COLUMNS = "chrom string, start0 bigint, end0 bigint, name string, score string, strand string, thick0 bigint, thick1 bigint, rgb string, n int, sizes string, offsets string, g_chrom string, g_source string, g_feature string, g_start1 bigint, g_end1 bigint, g_score string, g_strand string, g_frame string, g_attributes string"


def interval_overlaps(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of a BED12 record and a gene-model feature that it overlaps, with the length of
    the overlap; pairs that do not touch are left out."""
    t = delimited(spark, path, OVERLAP_COLUMNS)
    length = F.least("end0", "g_end1") - F.greatest(F.col("start0"), F.col("g_start1") - 1)
    ids = [gtf_attribute(F.col("g_attributes"), k).alias(k) for k in ("gene_id", "transcript_id")]
    return t.select("name", "chrom", "start0", "end0", "strand", F.col("g_feature").alias("feature"), F.col("g_strand").alias("feature_strand"), *ids, length.alias("overlap")).where((F.col("chrom") == F.col("g_chrom")) & (F.col("overlap") > 0))


def allele_sequences(spark: SparkSession, path: str) -> DataFrame:
    """allele (two fields), sequence of an HLA FASTA whose descriptions name the allele; of
    several records of an allele the first of the file is kept."""
    order = F.struct(F.input_file_name(), F.expr("input_file_block_start()"), F.monotonically_increasing_id())
    f = fasta(spark, path).withColumn("__order", order).where("description <> ''")
    name = hla_two_field(F.regexp_extract("description", r"^(\S+)", 1))
    return f.withColumn("allele", name).groupBy("allele").agg(F.min_by("sequence", "__order").alias("sequence"))


def pseudo_sequences(df: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    """(key, value) of rows with several alias columns; of a key's rows the last in the order
    wins."""
    long = df.select(F.explode(F.array(*keys)).alias("key"), value, order.alias("__order")).where("key is not null")
    return long.groupBy("key").agg(F.max_by(value, "__order").alias(value))


def allele_support(spark: SparkSession, path: str) -> DataFrame:
    """algorithm, allele_key and lengths (null: any) of a support catalog of lines algorithm,
    allele, length. Blank and comment lines, rules of dashes and alleles with blanks are no
    entries."""
    t = delimited(spark, path, "algorithm string, allele string, length string")
    allele = F.trim(F.coalesce("allele", F.lit("")))
    ok = (allele != "") & ~allele.rlike(r"^[#-]|\s") & ~F.trim(F.coalesce("algorithm", F.lit(""))).rlike(r"^(#.*)?$")
    rows = t.where(ok).select(F.trim("algorithm").alias("algorithm"), support_key(allele).alias("allele_key"), tolerant_long(F.col("length")).cast("int").alias("length"))
    lengths = F.array_sort(F.collect_set("length"))
    return rows.where("allele_key <> ''").groupBy("algorithm", "allele_key").agg(F.when(F.bool_and(F.col("length").isNotNull()), lengths).alias("lengths"))


def route_by_support(tasks: DataFrame, catalog: DataFrame, classical: dict[str, tuple[str, int | None, int | None]] | None = None) -> DataFrame:
    """tasks (peptide, hla_allele, algorithm, ...) with action: run, or skipped where the
    catalog knows the algorithm but not the allele, or not for the peptide's length. An
    algorithm without entries is unknown, and runs.

    classical names algorithms that find the closest model of an unlisted allele themselves:
    (pattern of the allele's support_key, shortest and longest peptide or None). Of these a
    peptide outside the lengths is skipped, a listed allele runs at any length inside them, and
    an unlisted one runs if its key matches the pattern."""
    known = catalog.select("algorithm").distinct().withColumn("__known", F.lit(True))
    key = support_key(F.col("hla_allele")).alias("allele_key")
    found = tasks.select("*", key).join(known, "algorithm", "left").join(catalog.withColumn("__listed", F.lit(True)), ["algorithm", "allele_key"], "left")
    size = F.length("peptide")
    listed = F.coalesce(F.col("__listed"), F.lit(False))
    fits = listed & F.coalesce(F.array_contains("lengths", size), F.lit(True))
    for name, (pattern, shortest, longest) in (classical or {}).items():
        inside = F.lit(True)
        if shortest is not None:
            inside = inside & (size >= shortest)
        if longest is not None:
            inside = inside & (size <= longest)
        nearest = F.coalesce(F.col("allele_key").rlike(pattern), F.lit(False))
        fits = F.when(F.col("algorithm") == name, inside & (listed | nearest)).otherwise(fits)
    run = F.col("__known").isNull() | F.coalesce(fits, F.lit(False))
    return found.select(*tasks.columns, F.when(run, "run").otherwise("skipped").alias("action"))


def annotated_gene(first: Column, second: Column) -> Column:
    """Gene id in brackets of two annotation texts; both, joined by a comma, where they
    differ."""
    ids = [F.regexp_extract(c, r"\(([^,)]+)", 1) for c in (first, second)]
    return F.when((ids[0] == ids[1]) | (ids[1] == ""), ids[0]).otherwise(F.concat_ws(",", *ids))
