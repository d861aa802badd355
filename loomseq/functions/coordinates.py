"""Column expressions on chains of genomic blocks: projection between transcript and genome,
codon footprints, splice junctions of alignments and footprints, and how one chain lies in
another.

A chain is array<struct<chrom, strand, start0, end0>> in transcript order (on - the last
genomic block comes first); places are 0-based and half-open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomseq.functions.sequences import let

#: How a candidate chain lies in a reference chain, in order of priority (fixed values).
CHAIN_STATUS = (
    "coordinate_frame_concordant",
    "coordinate_overlap_frame_discordant",
    "junction_chain_incompatible",
    "partial_coordinate_overlap",
    "ambiguous_candidate_mapping",
    "not_evaluable_candidate_coordinate_qc",
    "not_evaluable_reference_or_coordinate_mismatch",
    "no_coordinate_overlap",
)
#: Alignment operations that move along the reference; N alone makes a junction (fixed values).
OPERATION, ADVANCE = r"[0-9]+[MIDNSHP=X]", ("M", "D", "=", "X", "N")


def block(chrom: Column, strand: Column, start0: Column, end0: Column) -> Column:
    return F.struct(chrom.alias("chrom"), strand.alias("strand"), start0.cast("bigint").alias("start0"), end0.cast("bigint").alias("end0"))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _length(b: Column) -> Column:
    return b["end0"] - b["start0"]


def transcript_order(blocks: Column, strand: Column) -> Column:
    """Blocks of any order by genomic start and end; reversed on -."""
    key = F.transform(blocks, lambda b: F.struct(b["start0"].alias("s"), b["end0"].alias("e"), b.alias("b")))
    plain = F.transform(F.array_sort(key), lambda k: k["b"])
    return F.when(strand == "-", F.reverse(plain)).otherwise(plain)


def placed(blocks: Column) -> Column:
    """The blocks with offset, the transcript place of their first base: prefix sums."""
    lengths = F.transform(blocks, _length)
    return let(lengths, lambda n: F.transform(blocks, lambda b, i: F.struct(b.alias("b"), _total(F.slice(n, F.lit(1), i)).alias("offset"))))


def to_genome(blocks: Column, start0: Column, end0: Column) -> Column:
    """struct<segments, reason> of a transcript interval: array<struct<tx_start0, tx_end0,
    chrom, strand, start0, end0>> in transcript order, or null segments with a reason:
    missing_input, end_before_start, outside_blocks."""

    def cut(p: Column) -> Column:
        b = p["b"]
        first = F.greatest(start0, p["offset"])
        last = F.least(end0, p["offset"] + _length(b))
        back = b["strand"] == "-"
        low = F.when(back, b["end0"] - (last - p["offset"])).otherwise(b["start0"] + first - p["offset"])
        high = F.when(back, b["end0"] - (first - p["offset"])).otherwise(b["start0"] + last - p["offset"])
        return F.struct(first.cast("bigint").alias("tx_start0"), last.cast("bigint").alias("tx_end0"), b["chrom"].alias("chrom"), b["strand"].alias("strand"), low.cast("bigint").alias("start0"), high.cast("bigint").alias("end0"))

    def judge(segments: Column) -> Column:
        covered = _total(F.transform(segments, lambda s: s["tx_end0"] - s["tx_start0"]))
        reason = F.when(blocks.isNull() | start0.isNull() | end0.isNull(), "missing_input").when(end0 < start0, "end_before_start").when(covered != end0 - start0, "outside_blocks")
        return F.struct(F.when(reason.isNull(), segments).alias("segments"), reason.alias("reason"))

    return let(F.filter(F.transform(placed(blocks), cut), lambda s: s["tx_start0"] < s["tx_end0"]), judge)


def to_transcript(where: Column, segment: Column) -> Column:
    """struct<start0, end0> of a genomic segment in the chain whose placed blocks are where;
    null unless one block holds all of it."""
    holds = F.filter(where, lambda p: (p["b"]["chrom"] == segment["chrom"]) & (segment["start0"] >= p["b"]["start0"]) & (segment["end0"] <= p["b"]["end0"]))

    def place(p: Column) -> Column:
        begin = p["offset"] + F.when(p["b"]["strand"] == "-", p["b"]["end0"] - segment["end0"]).otherwise(segment["start0"] - p["b"]["start0"])
        return F.when(p.isNotNull(), F.struct(begin.alias("start0"), (begin + _length(segment)).alias("end0")))

    return let(F.get(holds, F.lit(0)), place)


def codon_footprint(blocks: Column, first: Column, length: Column) -> Column:
    """to_genome of the codons of a window: length residues from the 1-based residue first of
    the coding chain."""
    return to_genome(blocks, ((first - 1) * 3).cast("bigint"), ((first - 1 + length) * 3).cast("bigint"))


def junction_id(chrom: Column, start0: Column, end0: Column, strand: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start0, F.lit("-"), end0, F.lit(":"), strand)


def crossed_junctions(segments: Column) -> Column:
    """array<struct<start0, end0, id>>: the gaps between neighbouring segments of one
    chromosome, in transcript order; segments that touch have none. Null for null."""

    def gap(now: Column, i: Column) -> Column:
        before = F.get(segments, i)
        low, high = F.least(before["end0"], now["end0"]), F.greatest(before["start0"], now["start0"])
        made = F.struct(low.alias("start0"), high.alias("end0"), junction_id(now["chrom"], low, high, now["strand"]).alias("id"))
        return F.when((before["chrom"] == now["chrom"]) & (high > low), made)

    rest = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    return F.filter(F.transform(rest, gap), lambda g: g.isNotNull())


def alignment_junctions(chrom: Column, strand: Column, start0: Column, operations: Column) -> Column:
    """array<struct<chrom, strand, start0, end0, ord, id>> of an alignment's operation string,
    by a fold over its operations: M, D, =, X and N move on, N makes a junction of what it
    skips. In transcript order, so reversed on -; ord counts from 1."""
    kind = "struct<pos:bigint,found:array<struct<start0:bigint,end0:bigint>>>"
    zero = F.struct(start0.cast("bigint").alias("pos"), F.array().cast("array<struct<start0:bigint,end0:bigint>>").alias("found")).cast(kind)

    def step(acc: Column, op: Column) -> Column:
        n, letter = F.substring(op, F.lit(1), F.length(op) - 1).cast("bigint"), F.right(op, F.lit(1))
        end = acc["pos"] + F.when(letter.isin(*ADVANCE), n).otherwise(0)
        made = F.array(F.struct(acc["pos"].alias("start0"), end.alias("end0")))
        return F.struct(end.alias("pos"), F.when(letter == "N", F.concat(acc["found"], made)).otherwise(acc["found"]).alias("found")).cast(kind)

    found = F.aggregate(F.regexp_extract_all(operations, F.lit(OPERATION), F.lit(0)), zero, step, lambda acc: acc["found"])
    ordered = let(found, lambda f: F.when(strand == "-", F.reverse(f)).otherwise(f))
    return F.transform(ordered, lambda j, i: F.struct(chrom.alias("chrom"), strand.alias("strand"), j["start0"].alias("start0"), j["end0"].alias("end0"), (i + 1).alias("ord"), junction_id(chrom, j["start0"], j["end0"], strand).alias("id")))


def alignment_locus(text: Column) -> Column:
    """struct<chrom, start0, end0, strand, mapq, operations> of the first of the loci
    chrom:start-end:strand:MAPQn:operations that ; separates; null where it differs."""
    one = F.split_part(F.trim(text), F.lit(";"), F.lit(1))
    p = r"^([^:]+):([0-9]+)-([0-9]+):([+-]):MAPQ([^:]*):(.*)$"
    part = lambda k: F.regexp_extract(one, p, k)
    made = F.struct(canonical_chromosome(part(1)).alias("chrom"), part(2).try_cast("bigint").alias("start0"), part(3).try_cast("bigint").alias("end0"), part(4).alias("strand"), F.coalesce(part(5).try_cast("int"), F.lit(0)).alias("mapq"), part(6).alias("operations"))
    return F.when(one.rlike(p), made)


def canonical_chromosome(name: Column) -> Column:
    """chr1 to chr22, chrX, chrY, chrM of a name with or without chr; null for others."""
    bare = F.upper(F.regexp_replace(F.trim(name), "^(?i)chr", ""))
    number = F.when(bare == "MT", "M").otherwise(bare)
    return F.when(number.rlike("^([1-9]|1[0-9]|2[0-2]|X|Y|M)$"), F.concat(F.lit("chr"), number))


def chain_status(candidate: Column, cds_start0: Column, reference: Column) -> Column:
    """One of CHAIN_STATUS for a candidate footprint (whose first base is base cds_start0 of
    its own coding chain) against a reference coding chain. Each candidate block is mapped to
    offsets of the reference; the first block that is not covered (partial) or whose frame
    differs (discordant) decides; then offsets must follow each other without a gap, and start
    on a codon."""
    concordant, discordant, incompatible, partial = CHAIN_STATUS[:4]
    not_evaluable, apart = CHAIN_STATUS[6:]
    touches = F.exists(candidate, lambda c: F.exists(reference, lambda r: (c["chrom"] == r["chrom"]) & (F.greatest(c["start0"], r["start0"]) < F.least(c["end0"], r["end0"]))))

    def judge(mapped: Column) -> Column:
        codes = F.transform(mapped, lambda m: F.when(m["off"].isNull(), 1).when((m["off"]["start0"] - m["want"]) % 3 != 0, 2).otherwise(0))
        first = F.get(F.filter(codes, lambda c: c > 0), F.lit(0))
        broken = F.exists(F.transform(mapped, lambda m, i: (i > 0) & (m["off"]["start0"] != F.get(mapped, i - 1)["off"]["end0"])), lambda x: x)
        return F.when(first == 1, partial).when(first == 2, discordant).when(broken, incompatible).when(F.get(mapped, F.lit(0))["off"]["start0"] % 3 != 0, discordant).otherwise(concordant)

    lengths = F.transform(candidate, _length)
    mapped = let(F.struct(placed(reference).alias("w"), lengths.alias("n")), lambda k: F.transform(candidate, lambda c, i: F.struct(to_transcript(k["w"], c).alias("off"), (cds_start0 + _total(F.slice(k["n"], F.lit(1), i))).alias("want"))))
    missing = candidate.isNull() | reference.isNull() | (F.size(candidate) == 0) | (F.size(reference) == 0)
    return F.when(missing, not_evaluable).when(F.get(candidate, F.lit(0))["strand"] != F.get(reference, F.lit(0))["strand"], not_evaluable).when(~touches, apart).otherwise(let(mapped, judge))


def chain_bins(blocks: Column, width: int) -> Column:
    """The distinct bins that the blocks touch, ascending."""
    each = F.transform(blocks, lambda b: F.sequence(F.floor(b["start0"] / width), F.floor((F.greatest(b["end0"], b["start0"] + 1) - 1) / width)))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def coding_changes(reference: Column, candidate: Column) -> Column:
    """struct<changes, n_synonymous> of two coding sequences of one length: the bases that
    differ in codons that translate differently, as array<struct<offset0, aa_position, ref_aa,
    alt_aa, ref_base, alt_base>>, and the number of differing bases in other codons. Null
    where lengths differ."""
    from loomseq.functions.sequences import codon_amino, codons

    def codon(pair: Column, i: Column) -> Column:
        r, a = pair["r"], pair["a"]
        bases = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.struct((i * 3 + k).alias("offset0"), (i + 1).alias("aa_position"), codon_amino(r).alias("ref_aa"), codon_amino(a).alias("alt_aa"), r.substr(k + 1, F.lit(1)).alias("ref_base"), a.substr(k + 1, F.lit(1)).alias("alt_base")))
        return F.filter(bases, lambda b: b["ref_base"] != b["alt_base"])

    zipped = F.zip_with(codons(F.upper(reference)), codons(F.upper(candidate)), lambda r, a: F.struct(r.alias("r"), a.alias("a")))
    # Only codons that differ are looked into.
    where = F.filter(F.transform(zipped, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: x["p"]["r"] != x["p"]["a"])

    def split(all_: Column) -> Column:
        telling = F.filter(all_, lambda b: b["ref_aa"] != b["alt_aa"])
        return F.struct(telling.alias("changes"), (F.size(all_) - F.size(telling)).alias("n_synonymous"))

    found = let(F.flatten(F.transform(where, lambda x: codon(x["p"], x["i"]))), split)
    return F.when(F.length(reference) == F.length(candidate), found)


def genomic_change(blocks: Column, change: Column) -> Column:
    """struct<chrom, pos1, ref, alt> of one coding change: projected to the genome, bases
    complemented on -; null where the base lies outside the blocks."""
    at = to_genome(blocks, change["offset0"].cast("bigint"), change["offset0"].cast("bigint") + 1)

    def make(p: Column) -> Column:
        s = F.get(p["segments"], F.lit(0))
        base = lambda b: F.when(s["strand"] == "-", F.translate(b, "ACGT", "TGCA")).otherwise(b)
        return F.when(s.isNotNull(), F.struct(s["chrom"].alias("chrom"), (s["start0"] + 1).alias("pos1"), base(change["ref_base"]).alias("ref"), base(change["alt_base"]).alias("alt")))

    return let(at, make)
