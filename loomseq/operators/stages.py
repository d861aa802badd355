"""Scoring in two stages, evidence that several members or callers give for one key, and the
overlap of peptides with changed residues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomseq.functions.text import tolerant_double
from loomseq.operators.qc import ladder, require

TASK = ("peptide", "hla_allele", "algorithm", "mhc_class")
#: Outcomes of the first stage (fixed values); the first two are screened, others are not.
PASS, OUT = "stage1_screen_pass", "screened_out_stage1"
MISSING, UNSUPPORTED, PARSE, FAILED = "prediction_missing", "unsupported_allele", "parse_failed", "task_failed"


def task_columns() -> list[Column]:
    """The columns of TASK trimmed, null as empty, the peptide in upper case."""
    clean = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return [(F.upper(clean(c)) if c == "peptide" else clean(c)).alias(c) for c in TASK]


def last_predictions(predictions: DataFrame, order: list[str]) -> DataFrame:
    """The last prediction of every key of TASK, in the order of the columns order (ties: the
    greatest status, error and percentile); keys with a blank part are left out. An aggregate:
    a key that very many rows repeat is reduced before the shuffle."""
    facts = [F.trim(F.coalesce(F.col("status"), F.lit(""))).alias("status"), F.coalesce("error", F.lit("")).alias("error"), F.col("percentile").cast("string").alias("percentile")]
    keyed = predictions.select(*task_columns(), F.struct(*facts).alias("__facts"), F.struct(*order).alias("__order"))
    for c in TASK:
        keyed = keyed.where(F.col(c) != "")
    return keyed.groupBy(*TASK).agg(F.max(F.struct("__order", "__facts"))["__facts"].alias("prediction"))


def route_stage_one(tasks: DataFrame, predictions: DataFrame, limits: dict[str, float], order: list[str]) -> DataFrame:
    """tasks (TASK and others) with percentile, stage_status, prediction_status and error of
    their last prediction (TASK, status, error, percentile, and the columns of order).

    stage_status: prediction_missing (none, or one without a number), unsupported_allele
    (skipped), parse_failed or task_failed (any status but ok and partial_ok, by whether the
    error speaks of parsing), stage1_screen_pass (percentile below the limit of the class) or
    screened_out_stage1; a class without a limit has no passes. Tasks with a blank peptide are
    left out; repeated tasks are routed each."""
    others = [F.col(c) for c in tasks.columns if c not in TASK]
    rows = tasks.select(*task_columns(), *others).where("peptide <> ''")
    found = rows.join(last_predictions(predictions, order), list(TASK), "left")
    p = F.col("prediction")
    usable = p["status"].isin("ok", "partial_ok")
    value = F.when(usable, tolerant_double(p["percentile"]))
    limit = F.lit(None).cast("double")
    for name, least in limits.items():
        limit = F.when(F.col("mhc_class") == name, F.lit(float(least))).otherwise(limit)
    status = ladder(
        (p.isNull(), MISSING),
        (p["status"] == "skipped", UNSUPPORTED),
        (~usable & F.lower(p["error"]).contains("parse"), PARSE),
        (~usable, FAILED),
        (value.isNull(), MISSING),
        (value < limit, PASS),
        otherwise=OUT,
    )
    blank = lambda c: F.coalesce(c, F.lit(""))
    return found.select(*TASK, *others, value.alias("percentile"), status.alias("stage_status"), blank(p["status"]).alias("prediction_status"), blank(p["error"]).alias("error"))


def unscreened(routed: DataFrame) -> DataFrame:
    """Routed tasks that the first stage could not judge."""
    return routed.where(~F.col("stage_status").isin(PASS, OUT))


def stage_two_tasks(routed: DataFrame, algorithms: dict[str, list[str]]) -> DataFrame:
    """Distinct TASK rows of the second stage: each pass with every algorithm of its class. The
    algorithms are a literal of the plan, so two classes of any size cause no join."""
    choice = F.array().cast("array<string>")
    for name, listed in algorithms.items():
        choice = F.when(F.col("mhc_class") == name, F.array(*[F.lit(a) for a in listed]).cast("array<string>")).otherwise(choice)
    passed = routed.where(F.col("stage_status") == PASS).select("peptide", "hla_allele", "mhc_class").distinct()
    return passed.select("peptide", "hla_allele", F.explode(F.array_distinct(choice)).alias("algorithm"), "mhc_class")


def passed_predictions(predictions: DataFrame, routed: DataFrame) -> DataFrame:
    """Every row of predictions, as it stands, whose key passed the first stage."""
    keys = routed.where(F.col("stage_status") == PASS).select(*[F.col(c).alias(f"__{c}") for c in TASK]).distinct()
    on = F.lit(True)
    for c, clean in zip(TASK, task_columns(), strict=True):
        on = on & (clean == F.col(f"__{c}"))
    return predictions.join(keys, on, "left_semi")


def residue_overlap(peptides: DataFrame, residues: DataFrame, key: str = "peptide_id", width: int = 64) -> DataFrame:
    """peptides (key, parent_id, peptide_start, peptide_length and others) with overlaps (whether
    a residue of the parent lies in it) and positions (those, ascending, commas between). residues:
    parent_id, aa_position; repeated ones count once. key must be unique. A null parent, start or
    length overlaps with nothing.

    Residues are filed in bins of width positions, so a parent of any number of residues is many
    small rows, and a peptide meets those of the bins that it touches."""
    last = F.col("peptide_start") + F.col("peptide_length") - 1
    bin_of = lambda c: F.floor(c / width)
    filed = residues.where("parent_id is not null and aa_position is not null").groupBy("parent_id", bin_of(F.col("aa_position")).alias("__bin")).agg(F.collect_set("aa_position").alias("__places"))
    touched = F.when(F.col("peptide_length") > 0, F.sequence(bin_of(F.col("peptide_start")), bin_of(last)))
    asked = peptides.select(key, "parent_id", F.col("peptide_start").alias("__first"), last.alias("__last"), F.explode(touched).alias("__bin"))
    inside = F.filter("__places", lambda x: x.between(F.col("__first"), F.col("__last")))
    met = asked.join(filed, ["parent_id", "__bin"]).select(key, F.explode(inside).alias("__at"))
    each = met.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("__at")), lambda x: x.cast("string")), ",").alias("positions"))
    columns = [c for c in peptides.columns if c not in ("overlaps", "positions")]
    out = peptides.select(*columns).join(each, key, "left")
    return out.select(*columns, F.col("positions").isNotNull().alias("overlaps"), F.coalesce("positions", F.lit("")).alias("positions"))


def caller_consensus(calls: DataFrame, callers: list[str], keys: tuple[str, ...] = ("chrom", "pos1", "ref", "alt"), least: int = 2) -> DataFrame:
    """One row for each key of calls (keys, caller): callers (in the order of callers, commas
    between), shared (least callers at least, the first of them included: its records stand for
    the key) and only (the caller, where it is the only one, else null). Alleles are compared
    exactly; rows of other callers and repeated rows change nothing; null alleles are equal."""
    seen = calls.where(F.col("caller").isin(*callers)).groupBy(*keys).agg(F.collect_set("caller").alias("__seen"))
    listed = F.filter(F.array(*[F.lit(c) for c in callers]), lambda c: F.array_contains("__seen", c))
    n = F.size("__seen")
    return seen.select(*keys, F.array_join(listed, ",").alias("callers"), ((n >= least) & F.array_contains("__seen", callers[0])).alias("shared"), F.when(n == 1, F.element_at(listed, 1)).alias("only"))


def shared_records(calls: DataFrame, consensus: DataFrame, first: str, keys: tuple[str, ...] = ("chrom", "pos1", "ref", "alt")) -> DataFrame:
    """The first caller's records of the shared keys, as they stand."""
    marked = consensus.where("shared").select(*[F.col(k).alias(f"__{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return calls.where(F.col("caller") == first).join(marked, on, "left_semi")


def ensemble_mean(members: DataFrame, keys: list[str], score: str = "score", status: str = "status", member: str = "member") -> DataFrame:
    """One row for each key: the mean score of its members (null and NaN scores do not count;
    none left: null), the members' status (null where they differ), n_members (distinct) and
    consistent (one status in all rows, null among them a status of its own)."""
    value = F.col(score).cast("double")
    state = F.collect_set(F.struct(status))
    grouped = members.groupBy(*keys).agg(F.avg(F.when(~F.isnan(value), value)).alias(score), state.alias("__state"), F.countDistinct(member).alias("n_members"))
    same = F.size("__state") == 1
    return grouped.select(*keys, score, F.when(same, F.element_at("__state", 1)[status]).alias(status), "n_members", same.alias("consistent"))


def require_ensemble(ensemble: DataFrame, n_members: int) -> DataFrame:
    """ensemble_mean's rows; raises where a key's members disagree in status or are not all
    there."""
    require(ensemble, inconsistent_status=~F.col("consistent"), incomplete_members=F.col("n_members") != n_members)
    return ensemble


def collapse_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each exact event, by its most cautious evidence: the most ref_reads, the fewest
    alt_reads, the least qual and mapping_quality, depth and share of these; filters (one of
    them; mixed_filter_status where PASS is among several; else all, sorted, ; between); record_id
    (the rows' own, or collapsed_duplicate_exact_event) and duplicate_status: unique,
    collapsed_duplicate_exact_event, or conflicting_duplicate_not_evaluable where rows differ in
    evidence. All of it is associative, so the order of rows does not matter. Null numbers are
    passed over, null filters and ids are empty. Evidence is compared by 64-bit hashes."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    # Null must not be skipped by the hash: it is a text that no value has.
    evidence = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("ref_reads", "alt_reads", "qual", "mapping_quality")] + [text("filters")]
    grouped = events.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.max("ref_reads").alias("ref_reads"),
        F.min("alt_reads").alias("alt_reads"),
        F.min("qual").alias("qual"),
        F.min("mapping_quality").alias("mapping_quality"),
        F.array_sort(F.collect_set(text("filters"))).alias("__filters"),
        F.min(text("record_id")).alias("__low"),
        F.max(text("record_id")).alias("__high"),
        # Two digests of the evidence, not a set of it: a key of any number of rows stays small.
        F.min(F.xxhash64(*evidence)).alias("__a"),
        F.max(F.xxhash64(*evidence)).alias("__b"),
    )
    depth = F.col("ref_reads") + F.col("alt_reads")
    one = F.size("__filters") == 1
    filters = F.when(one, F.element_at("__filters", 1)).when(F.array_contains("__filters", "PASS"), "mixed_filter_status").otherwise(F.array_join("__filters", ";"))
    state = F.when(F.col("n_rows") == 1, "unique").when(F.col("__a") == F.col("__b"), "collapsed_duplicate_exact_event").otherwise("conflicting_duplicate_not_evaluable")
    return grouped.select(
        *keys, "n_rows", "ref_reads", "alt_reads", depth.alias("depth"), F.when(depth > 0, F.col("alt_reads") / depth).otherwise(0.0).alias("alt_share"), "qual", "mapping_quality",
        filters.alias("filters"), F.when(F.col("__low") == F.col("__high"), F.col("__low")).otherwise("collapsed_duplicate_exact_event").alias("record_id"), state.alias("duplicate_status"),
    )
