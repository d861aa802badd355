"""Evidence of parents: splice junctions against the reads of a tumor and a normal sample,
footprints against reference chains, and coding changes against calls and editing sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomseq.functions.coordinates import CHAIN_STATUS, chain_bins, chain_status, coding_changes, genomic_change
from loomseq.functions.sequences import each_of, translate_codons
from loomseq.operators.qc import ladder, variant_reasons

READS = ("unique_reads", "multi_reads", "max_overhang", "annotated")


def junction_support(required: DataFrame, tumor: DataFrame, normal: DataFrame) -> DataFrame:
    """required (chrom, start0, end0, strand, ...) with the READS of the same junction on its
    own strand (tumor_*, normal_*) and where the strand is unknown (tumor_unknown_*,
    normal_unknown_*); 0 where there are none. The four lookups are one join: a place's reads
    of both samples and all strands, six facts at most, meet in one row first. tumor and
    normal must hold a junction once (see sources.checked_junctions); a repeated one fails."""
    place = ["chrom", "start0", "end0"]
    side = lambda df, name: df.select(*place, F.concat(F.lit(name), "strand").alias("side"), F.struct(*READS).alias("reads"))
    both = side(tumor, "tumor").unionAll(side(normal, "normal"))
    facts = both.groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct("side", "reads"))).alias("__facts"))
    found = required.join(facts, place, "left")
    out = {}
    for name in ("tumor", "normal"):
        for prefix, strand in ((name, F.col("strand")), (f"{name}_unknown", F.lit("."))):
            reads = F.try_element_at("__facts", F.concat(F.lit(name), strand))
            out |= {f"{prefix}_{c}": F.coalesce(reads[c], F.lit(0)) for c in READS}
    return found.withColumns(out).select(*required.columns, *out)


def parent_junctions(parents: DataFrame, supported: DataFrame, key: str, least: int = 2) -> DataFrame:
    """parents with n_required, min_tumor_unique, n_low, junction_ids (transcript order, ;) and
    junction_status: the parent's own status where that is not pass, intronless, supported
    (every junction has least unique reads) or low_support. parents: key, status; supported:
    junction_support with key, ord and id."""
    enough = F.col("tumor_unique_reads") >= least
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "id"))), lambda x: x["id"]), ";")
    facts = supported.groupBy(key).agg(F.count("*").alias("n_required"), F.min("tumor_unique_reads").alias("min_tumor_unique"), F.count_if(~enough).alias("n_low"), ids.alias("junction_ids"))
    both = parents.join(facts, key, "left")
    none = F.col("n_required").isNull()
    verdict = F.when(F.col("status") != "pass", F.col("status")).when(none, "intronless").when(F.col("n_low") == 0, "supported").otherwise("low_support")
    return both.select(*parents.columns, F.coalesce("n_required", F.lit(0)).alias("n_required"), "min_tumor_unique", F.coalesce("n_low", F.lit(0)).alias("n_low"), F.coalesce("junction_ids", F.lit("")).alias("junction_ids"), verdict.alias("junction_status"))


def chain_matches(candidates: DataFrame, references: DataFrame, width: int = 100_000) -> DataFrame:
    """Pairs of a candidate footprint (candidate_id, blocks, cds_start0) and a reference chain
    (reference_id, blocks) that share a bin of one strand, with their chain_status. Chains are
    filed under the bins that their blocks touch; a pair is taken in the first bin that both
    have, so it comes once without a distinct."""
    def filed(df: DataFrame, name: str) -> DataFrame:
        one = F.get("blocks", F.lit(0))
        rows = df.select(*df.columns, one["chrom"].alias("chrom"), one["strand"].alias("strand"), chain_bins(F.col("blocks"), width).alias("bins")).withColumnRenamed("blocks", f"{name}_blocks")
        return each_of(rows, F.col("bins"), "bin").withColumnRenamed("bins", f"{name}_bins")

    met = filed(candidates, "c").join(filed(references, "r"), ["chrom", "strand", "bin"])
    met = met.where(F.col("bin") == F.array_min(F.array_intersect("c_bins", "r_bins")))
    return met.select("candidate_id", "reference_id", chain_status(F.col("c_blocks"), F.col("cds_start0"), F.col("r_blocks")).alias("status"))


def chain_evidence(candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """One row for each candidate_id: status (the first of CHAIN_STATUS that occurs),
    n_overlaps, n_concordant, and the ids of concordant references, sorted, ; between."""
    place = F.array_position(F.array(*[F.lit(s) for s in CHAIN_STATUS]), F.col("status"))
    same = F.col("status") == CHAIN_STATUS[0]
    ids = F.array_join(F.array_sort(F.collect_set(F.when(same, F.col("reference_id").cast("string")))), ";")
    best = matches.groupBy("candidate_id").agg(F.min_by("status", place).alias("status"), F.count_if(F.col("status") != CHAIN_STATUS[-1]).alias("n_overlaps"), F.count_if(same).alias("n_concordant"), ids.alias("matched"))
    both = candidates.select("candidate_id").distinct().join(best, "candidate_id", "left")
    return both.select("candidate_id", F.coalesce("status", F.lit(CHAIN_STATUS[-1])).alias("status"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_overlaps", "n_concordant")], F.coalesce("matched", F.lit("")).alias("matched"))


def required_changes(parents: DataFrame) -> DataFrame:
    """One row for each base change that a parent (parent_id, blocks, reference_cds,
    candidate_cds) needs: parent_id, offset0, aa_position, ref_aa, alt_aa, chrom, pos1, ref,
    alt; the last four null where the base cannot be projected. Changes inside synonymous
    codons are not needed."""
    each = each_of(parents, coding_changes(F.col("reference_cds"), F.col("candidate_cds"))["changes"], "c")
    each = each.withColumn("g", genomic_change(F.col("blocks"), F.col("c")))
    return each.select("parent_id", "c.offset0", "c.aa_position", "c.ref_aa", "c.alt_aa", "g.chrom", "g.pos1", "g.ref", "g.alt")


def change_events(changes: DataFrame, calls: DataFrame, sites: DataFrame, least_qual: float, least_depth: int, least_alt: int, least_share: float) -> DataFrame:
    """changes with event: known_editing, complex, missing, weak or supported. calls (chrom,
    pos1, ref, alt, qual, ref_reads, alt_reads, filters) must hold a key once; sites (chrom,
    pos1, ref, alt) may repeat. Matches are exact in all four; a known editing site overrides
    the reads."""
    key = ["chrom", "pos1", "ref", "alt"]
    reasons = variant_reasons(F.col("qual"), F.col("ref_reads"), F.col("alt_reads"), F.col("filters"), least_qual, least_depth, F.lit(least_alt), least_share)
    judged = calls.select(*key, (F.size(reasons) == 0).alias("__good"), (F.length("ref") + F.length("alt") != 2).alias("__complex"))
    known = sites.select(*key).distinct().withColumn("__edited", F.lit(True))
    both = changes.join(judged, key, "left").join(known, key, "left")
    event = F.when(F.col("__edited"), "known_editing").when(F.col("chrom").isNull() | F.coalesce("__complex", F.lit(False)), "complex").when(F.col("__good").isNull(), "missing").when(F.col("__good"), "supported").otherwise("weak")
    return both.select(*changes.columns, event.alias("event"))


def rescue(parents: DataFrame, events: DataFrame) -> DataFrame:
    """Verdict for each parent (parent_id, reference_cds, candidate_cds, protein):
    reference_concordant where the reference already translates to the protein, not_evaluable
    where lengths differ, else by its events in this order: known_editing_excluded,
    not_evaluable (a complex one), insufficient_support, rescued - if the candidate translates
    to the protein."""
    counted = events.groupBy("parent_id").agg(F.count("*").alias("n"), *[F.count_if(F.col("event") == e).alias(e) for e in ("known_editing", "complex", "missing", "weak", "supported")])
    names = ["n", "known_editing", "complex", "missing", "weak", "supported"]
    both = parents.join(counted, "parent_id", "left").na.fill(0, names)
    same = translate_codons(F.col("reference_cds")) == F.col("protein")
    gives = translate_codons(F.col("candidate_cds")) == F.col("protein")
    verdict = ladder(
        (F.coalesce(same, F.lit(False)), "reference_concordant"),
        (F.coalesce(F.length("reference_cds") != F.length("candidate_cds"), F.lit(True)), "not_evaluable"),
        (F.col("known_editing") > 0, "known_editing_excluded"),
        (F.col("complex") > 0, "not_evaluable"),
        (F.col("missing") + F.col("weak") > 0, "insufficient_support"),
        (F.coalesce(gives, F.lit(False)), "rescued"),
        otherwise="not_evaluable",
    )
    return both.select("parent_id", F.col("n").alias("n_required"), F.col("supported").alias("n_supported"), verdict.alias("verdict"))


def repeated(df: DataFrame, key: list[str], most: int = 10) -> list[str]:
    """Up to most keys that occur more than once, as text."""
    twice = df.groupBy(*key).count().where("count > 1").select(F.concat_ws(":", *key).alias("k"))
    return [r.k for r in twice.orderBy("k").limit(most).collect()]
