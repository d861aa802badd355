"""Reason-coded quality control: rows are never dropped silently, they get reasons.

A reason array lists the names of the rules that a row breaks; an empty one means pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(*rules: tuple[str, Column]) -> Column:
    """Names of the rules whose condition is true or unknown."""
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules]))


def status(found: Column, passed: str = "pass", failed: str = "excluded") -> Column:
    return F.when(F.size(found) == 0, passed).otherwise(failed)


def reason_text(found: Column) -> Column:
    return F.array_join(found, ";")


def ladder(*steps: tuple[Column, str], otherwise: str) -> Column:
    """The name of the first step that holds."""
    out = None
    for holds, name in steps:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out.otherwise(otherwise)


def hit_reasons(identity: Column, evalue: Column, coverage: Column, exact: float = 100.0, most_e: float = 1e-5, least_cover: float = 90.0) -> Column:
    """Identity must equal exact; numbers that are missing break their rule."""
    return reasons(("identity_not_exact", identity != exact), ("evalue_too_high", evalue > most_e), ("coverage_too_low", coverage < least_cover))


def sequence_reasons(sequence: Column, least: int = 8) -> Column:
    """For a normalised sequence: empty, inner stop, gap, other letters (named), length."""
    other = F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace(sequence, "[ACDEFGHIKLMNPQRSTVWY*-]", ""), ""))), "")
    found = F.array(
        F.when(sequence == "", "empty"),
        F.when(sequence.contains("*"), "internal_stop"),
        F.when(sequence.contains("-"), "gap"),
        F.when(other != "", F.concat(F.lit("noncanonical:"), other)),
        F.when((sequence != "") & (F.length(sequence) < least), "too_short"),
    )
    return F.array_compact(found)


def blacklist_class(taxa: Column, blacklist: Column, evaluated: Column) -> Column:
    """How a set of taxa stands to a blacklist (two arrays of text)."""
    bad = F.size(F.array_intersect(taxa, blacklist))
    return ladder((~F.coalesce(evaluated, F.lit(False)), "not_evaluated"), (F.size(taxa) == 0, "unresolved"), (bad == 0, "not_contaminant"), (bad == F.size(taxa), "exclusive_contaminant"), otherwise="mixed")


def peptide_verdict(statuses: Column) -> Column:
    """Verdict on a peptide from the distinct statuses of its parents."""
    return ladder((F.size(statuses) == 0, "not_evaluated"), ((F.size(statuses) == 1) & F.array_contains(statuses, "exclusive_contaminant"), "contaminant_only"), (F.array_contains(statuses, "exclusive_contaminant") | F.array_contains(statuses, "mixed"), "retained_with_flag"), otherwise="retained")


def log2_fold(tumor: Column, control: Column, pseudo: float = 1.0) -> Column:
    return F.log2((tumor + pseudo) / (control + pseudo))


def expression_reasons(tumor: Column, control: Column, least_tumor: float, most_control: float, least_fold: float) -> Column:
    """NaN counts as missing, and missing values break their rule."""
    t, c = (F.when(~F.isnan(x), x) for x in (tumor, control))
    return reasons(("tumor_low", t < least_tumor), ("control_high", c > most_control), ("fold_low", log2_fold(t, c) < least_fold))


def variant_reasons(qual: Column, ref: Column, alt: Column, filters: Column, least_qual: float, least_depth: int, least_alt: Column, least_share: float) -> Column:
    """Depth is ref + alt reads; the share is alt over depth."""
    depth = ref + alt
    return reasons(("low_quality", qual < least_qual), ("low_depth", depth < least_depth), ("low_alt", alt < least_alt), ("low_share", F.when(depth > 0, alt / depth).otherwise(0.0) < least_share), ("filtered", ~filters.isin("PASS", ".")))


def tier(rules: list[tuple[str, Column]], otherwise: str = "Subthreshold") -> Column:
    """First tier, from the strictest, whose conditions all hold; missing values hold none."""
    return ladder(*[(F.coalesce(holds, F.lit(False)), name) for name, holds in rules], otherwise=otherwise)


def flag_duplicates(df: DataFrame, keys: list[str], out: str = "is_duplicate") -> DataFrame:
    """Mark every row whose keys occur more than once. The counts are a separate, partly
    aggregated table, so a frequent key meets in no single window."""
    seen = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.alias("a").join(seen.alias("b"), cond, "left").select("a.*", F.col("__n").isNotNull().alias(out))


def stage_counts(df: DataFrame, **stages: Column) -> DataFrame:
    """(stage, n) for named conditions, in one pass."""
    one = df.agg(*[F.count_if(c).alias(n) for n, c in stages.items()])
    return one.unpivot([], list(stages), "stage", "n")


def violations(df: DataFrame, **rules: Column) -> DataFrame:
    """(rule, n): how many rows break each rule of a contract."""
    return stage_counts(df, **rules).withColumnRenamed("stage", "rule")


def require(df: DataFrame, **rules: Column) -> None:
    """Raise where a rule of a contract is broken by any row."""
    broken = {r["rule"]: r["n"] for r in violations(df, **rules).collect() if r["n"]}
    if broken:
        raise ValueError(f"contract broken: {broken}")


def final_rules(peptide: Column, digest: Column, mhc_class: Column, lengths: dict[str, list[int]], state: Column, states: list[str], extension: Column, parent_known: Column) -> dict[str, Column]:
    """What no row of a final table may show, as rules that are true where broken: a digest that
    is not that of the peptide, a length outside its class's set (or another class), an unknown
    status, an extension that does not hold its window, a parent that does not exist."""
    fits = F.lit(False)
    for name, allowed in lengths.items():
        fits = fits | ((mhc_class == name) & F.length(peptide).isin(*allowed))
    return {
        "digest": ~digest.eqNullSafe(F.sha2(F.upper(peptide), 256)),
        "length": ~F.coalesce(fits, F.lit(False)),
        "status": ~F.coalesce(state.isin(*states), F.lit(False)),
        "extension": ~F.coalesce(F.contains(extension, peptide), F.lit(False)),
        "orphan": ~F.coalesce(parent_known, F.lit(False)),
    }


def event_ladder(events: DataFrame, contexts: DataFrame, windows: DataFrame, kinds: list[str], least: int) -> DataFrame:
    """One row for each event (event_id, kind): status, n_windows and n_peptides. The first step
    that fails decides: unsupported (kind), missing_context (no row, or no sequence, in
    contexts: event_id, wt, mt, rebuilt), region_error (the two sequences do not differ),
    window_error (a sequence shorter than least), no_window; then rebuilt, where the context was
    made anew, or ok. Counts of windows (event_id, peptide) come from one aggregation, unless
    they are given (event_id, n_windows, n_peptides). Sequences are not moved, only what the
    steps ask of them."""
    counts = windows if "n_windows" in windows.columns else windows.groupBy("event_id").agg(F.count("*").alias("n_windows"), F.countDistinct("peptide").alias("n_peptides"))
    asked = contexts.select("event_id", F.col("mt").isNull().alias("missing"), F.coalesce(F.col("wt") == F.col("mt"), F.lit(False)).alias("same"), (F.length("mt") < least).alias("short"), "rebuilt")
    both = events.join(asked, "event_id", "left").join(counts, "event_id", "left")
    n = F.coalesce("n_windows", F.lit(0))
    status_ = ladder(
        (~F.coalesce(F.col("kind").isin(*kinds), F.lit(False)), "unsupported"),
        (F.coalesce("missing", F.lit(True)), "missing_context"),
        (F.col("same"), "region_error"),
        (F.col("short"), "window_error"),
        (n == 0, "no_window"),
        (F.coalesce("rebuilt", F.lit(False)), "rebuilt"),
        otherwise="ok",
    )
    return both.select("event_id", status_.alias("status"), n.alias("n_windows"), F.coalesce("n_peptides", F.lit(0)).alias("n_peptides"))


def labelled_once(df: DataFrame, key: str, label: str, order: list[Column | str]) -> DataFrame:
    """df's keys once each: key, label, n_rows, conflict (labels 0 and 1 both occur) and the row
    that comes first in order as the struct first. One aggregation, partial on the map side, so
    a key of any number of rows is a few of them in the shuffle."""
    rest = F.struct(*[c for c in df.columns if c != key])
    mask = F.bit_or(F.expr(f"shiftleft(1, cast(`{label}` as int))"))
    g = df.groupBy(key).agg(F.count("*").alias("n_rows"), mask.alias("mask"), F.min_by(rest, F.struct(*order)).alias("first"))
    return g.select(key, F.col(f"first.{label}").alias(label), "n_rows", (F.col("mask") == 3).alias("conflict"), "first")


def removal_counts(once: DataFrame) -> DataFrame:
    """stage and n of labelled_once: rows, keys, conflicting keys and rows, duplicates, kept."""
    c = F.col("conflict")
    facts = {"rows": F.sum("n_rows"), "keys": F.count("*"), "conflict_keys": F.count_if(c), "conflict_rows": F.sum(F.when(c, F.col("n_rows")).otherwise(0)), "duplicate_rows": F.sum(F.when(~c, F.col("n_rows") - 1).otherwise(0)), "kept": F.count_if(~c)}
    one = once.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in facts.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("stage"), F.col(k).alias("n")) for k in facts])).alias("x")).select("x.*")
