"""Joins: subtraction of known keys, consistency checks, task products, first-of-group
attachment, and interval overlap by bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomseq.functions.sequences import windows


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def subtract(candidates: DataFrame, known: DataFrame, keys: list[str], evidence: list[str] | None = None) -> DataFrame:
    """candidates with the column excluded (the key occurs in known) and known's evidence
    columns. known must hold a key once. Nothing is dropped, so what was excluded and why
    stays visible; filter on excluded for either side."""
    marked = known.select(*keys, *(evidence or [])).withColumn("__known", F.lit(True))
    out = candidates.join(marked, keys, "left")
    return out.withColumn("excluded", F.col("__known").isNotNull()).drop("__known")


def reference_windows(reference: DataFrame, sequence: str, lengths: list[int], alphabet: str = "ACDEFGHIKLMNPQRSTVWY") -> DataFrame:
    """Distinct windows of a reference; none crosses a letter outside the alphabet."""
    parts = reference.select(F.explode(F.split(F.col(sequence), f"[^{alphabet}]+")).alias("part")).where("part <> ''")
    return windows(parts.distinct(), "part", lengths).select("peptide").distinct()


def consistent_hits(hits: DataFrame, catalog: DataFrame, accession: str, taxa: str) -> DataFrame:
    """Hits of which some (accession, taxon) pair is in the catalog, with the matched taxa.
    hits holds an array of taxa and a unique column row_id."""
    pairs = hits.select("row_id", F.col(accession).alias("__acc"), F.explode(taxa).alias("__tax"))
    known = catalog.select(F.col(catalog.columns[0]).alias("__acc"), F.col(catalog.columns[1]).alias("__tax")).distinct()
    matched = pairs.join(known, ["__acc", "__tax"]).groupBy("row_id").agg(F.array_sort(F.collect_set("__tax")).alias("matched_taxa"))
    return hits.join(matched, "row_id")


def task_product(peptides: DataFrame, alleles: DataFrame, algorithms: DataFrame, on: list[str]) -> DataFrame:
    """Distinct scoring tasks: each peptide with each allele of its own sample or class and
    each algorithm of that class. alleles and algorithms are equi-joined on `on`, so this
    is no product of unrelated rows. Classes are few and hold most peptides each, so a shuffle
    by class would put them into as many tasks: the algorithms, a short list, are broadcast, and
    so are the alleles where they are joined by class alone. Each side is made distinct before
    the join, so its product is, and no task holds its share of the product at once."""
    few = alleles.join(F.broadcast(algorithms.distinct()), [c for c in on if c in algorithms.columns]).distinct()
    return peptides.distinct().join(F.broadcast(few) if set(on) <= set(algorithms.columns) else few, on)


def chain_pairs(alleles: DataFrame, alpha: list[str], beta: list[str], sample: str = "sample") -> DataFrame:
    """Class-II pairs: every alpha allele with every beta allele of the same locus and
    sample; a chain without its partner gives none."""
    a = alleles.where(F.col("gene").isin(alpha)).select(sample, F.substring("gene", 1, 2).alias("locus"), F.col("allele").alias("a"))
    b = alleles.where(F.col("gene").isin(beta)).select(sample, F.substring("gene", 1, 2).alias("locus"), F.col("allele").alias("b"))
    return a.join(b, [sample, "locus"]).select(sample, F.concat_ws("-", "a", "b").alias("hla_allele"))


def strict_align(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row of counts: keys on one side only, blank and repeated keys. All must be 0 for
    the two tables to line up."""
    sides = [t.groupBy(*keys).agg(F.count("*").alias(f"n_{n}")) for t, n in ((left, "left"), (right, "right"))]
    both = sides[0].join(sides[1], keys, "full")
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "")
    return both.agg(
        F.count_if(F.col("n_right").isNull()).alias("left_only"),
        F.count_if(F.col("n_left").isNull()).alias("right_only"),
        F.count_if((F.col("n_left") > 1) | (F.col("n_right") > 1)).alias("repeated"),
        F.count_if(blank).alias("blank"),
    )


def overlap(left: DataFrame, right: DataFrame, on: list[str], bin_width: int, left_span: tuple[str, str], right_span: tuple[str, str], how: str = "inner") -> DataFrame:
    """Pairs of half-open intervals that overlap and agree in `on`. Both sides are filed
    under the bins that they touch; a pair is taken in the first bin that the two share,
    so it comes once without a later distinct. how: inner or left_semi, which keeps each row of
    left that meets anything as often as left holds it."""
    (a, b), (c, d) = left_span, right_span
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bin_width), F.floor((F.greatest(F.col(e), F.col(s) + 1) - 1) / bin_width)))
    x = left.withColumn("__bin", bins(a, b))
    y = right.withColumn("__bin", bins(c, d))
    first = F.floor(F.greatest(F.col(a), F.col(c)) / bin_width) == F.col("l.__bin")
    meets = (F.col(a) < F.col(d)) & (F.col(c) < F.col(b)) & first
    keys = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*on, "__bin"]]
    cond = meets
    for k in keys:
        cond = cond & k
    out = x.alias("l").join(y.alias("r"), cond, how)
    if how == "left_semi":
        # A row comes once for each bin that it meets something in, and so do all of its copies.
        copies = (F.count("*") / F.size(F.collect_set("__bin"))).cast("int")
        met = out.groupBy(*left.columns).agg(copies.alias("__copies"))
        return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*left.columns)
    return out.select("l.*", *[f"r.{k}" for k in right.columns if k not in on]).drop("__bin")


def frame_class(cover: Column, length: Column, shift: Column, same_gaps: Column) -> Column:
    """How a block chain lies in a reference chain: none, partial overlap, incompatible
    chain, and for contained chains in frame or discordant frame."""
    return F.when(cover == 0, "no_overlap").when(cover < length, "partial_overlap").when(~same_gaps, "incompatible_chain").when(shift % 3 == 0, "same_frame").otherwise("discordant_frame")


def reusable(tasks: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks that still need a score: those without a stored result free of errors."""
    done = stored.where("status <> 'error'").select(*keys).distinct()
    return tasks.join(done, keys, "left_anti")


def scored_once(df: DataFrame, keys: list[str], scorer) -> DataFrame:
    """Score each distinct key once and join the scores back. scorer: DataFrame of keys ->
    DataFrame of keys and score columns."""
    return df.join(scorer(df.select(*keys).distinct()), keys, "left")


def wild_tasks(mutant_tasks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Tasks of wild-type peptides: each pair (mhc_class, wt, mt) of one length takes the alleles
    and algorithms of its mutant's tasks (mhc_class, peptide, hla_allele, algorithm). A pair
    whose mutant has no task stays, with null allele and algorithm, so that templates_missing
    can count it."""
    known = pairs.where("length(wt) = length(mt)").select("mhc_class", "wt", "mt").distinct()
    tasks = mutant_tasks.select("mhc_class", F.col("peptide").alias("mt"), "hla_allele", "algorithm").distinct()
    return known.join(tasks, ["mhc_class", "mt"], "left").select("mhc_class", F.col("wt").alias("peptide"), F.col("mt").alias("template"), "hla_allele", "algorithm")


def templates_missing(tasks: DataFrame) -> DataFrame:
    """For each class: the distinct tasks of wild_tasks, and the pairs without a template."""
    found = F.col("hla_allele").isNotNull()
    task = F.when(found, F.struct("peptide", "hla_allele", "algorithm"))
    return tasks.groupBy("mhc_class").agg(F.countDistinct(task).alias("n_tasks"), F.count_if(~found).alias("n_missing"))


#: Texts that mean no entry (fixed values).
NO_ENTRY = ("", "na", "nan", "none")


def lookup_list(df: DataFrame, key: str, text: str, names: DataFrame, out: str, keep_unknown: bool = False) -> DataFrame:
    """df with out: text in which every entry between | and , is replaced by its value in names
    (name, value; a name once, of any number). The separators, single or in a row, stay byte for
    byte where they are. Entries are looked up trimmed and without a version (.N); unknown ones
    become empty, or stay as they are; blank ones and NO_ENTRY become empty. A text that is null
    or NO_ENTRY gives an empty one. key must be unique in df; only it and the entries are
    shuffled."""
    whole = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    tokens = df.where(~whole.isin(*NO_ENTRY)).select(key, F.posexplode(F.regexp_extract_all(text, F.lit("[|,]+|[^|,]+"), F.lit(0))).alias("__at", "__token"))
    mark = F.col("__token").rlike("^[|,]+$")
    # Separators need no partner: they would all meet in one task of the join.
    kept = tokens.where(mark).select(key, "__at", F.col("__token").alias("__value"))
    entry = F.trim("__token")
    asked = tokens.where(~mark).withColumn("__name", F.when(~F.lower(entry).isin(*NO_ENTRY), F.regexp_replace(entry, r"[.][0-9]+$", "")))
    known = names.select(F.col("name").alias("__name"), F.col("value").alias("__found"))
    unknown = F.when(F.col("__name").isNotNull(), F.col("__token")).otherwise("") if keep_unknown else F.lit("")
    found = asked.where("__name is not null").join(known, "__name", "left").select(key, "__at", F.coalesce("__found", unknown).alias("__value"))
    blank = asked.where("__name is null").select(key, "__at", F.lit("").alias("__value"))
    parts = F.array_sort(F.collect_list(F.struct("__at", "__value")))
    joined = kept.unionAll(found).unionAll(blank).groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["__value"]), "").alias("__out"))
    columns = [c for c in df.columns if c != out]
    return df.join(joined, key, "left").select(*columns, F.coalesce("__out", F.lit("")).alias(out))
