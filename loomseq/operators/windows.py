"""Ranking, caps, islands and running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomseq.functions.sequences import count_below
from loomseq.storage import stored


def in_ranges(df: DataFrame, group: list[str], order: list[Column | str]) -> DataFrame:
    """df dealt into ranges of (group, order), written to the shared folder with the number
    of the range (__part) and a row id (__row). A group of any size is spread over ranges,
    so what runs over it need not meet in one task."""
    dealt = df.repartitionByRange(*group, *order)
    return stored(df.sparkSession, dealt.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}), "ranges")


def running(ranges: DataFrame, group: list[str], order: list[Column | str], value: Column, out: str, how=F.sum, empty: Column | None = None) -> DataFrame:
    """Adds out: how (sum or max) of value over the rows of the group before each row, in
    the order (ties by row id); empty where there are none. Ranges run side by side; their
    totals, one row for each range of a group, are then run over."""
    empty = F.lit(0) if empty is None else empty
    both = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) if how is F.sum else F.greatest(a, b)
    keys = [*group, "__part"]
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranges.withColumn("__value", value)
    totals = rows.groupBy(*keys).agg(how("__value").alias("__total"))
    base = totals.withColumn("__base", how("__total").over(before(Window.partitionBy(*group).orderBy("__part")))).drop("__total")
    base = base.select(F.col("__part").alias("__p"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__base")
    on = F.col("__part") == F.col("__p")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    local = how("__value").over(before(Window.partitionBy(*keys).orderBy(*order, "__row")))
    found = rows.withColumn("__local", local).join(base, on, "left")
    return found.withColumn(out, F.coalesce(both(F.col("__base"), F.col("__local")), empty)).select(*ranges.columns, out)


def running_sums(ranges: DataFrame, group: list[str], order: list[Column | str], values: dict[str, Column]) -> DataFrame:
    """Adds, for each name of values, its sum over the group's rows up to and with each row, in
    the order (ties by row id); all of them in one pass over the ranges."""
    keys = [*group, "__part"]
    rows = ranges.withColumns({f"__v_{n}": v for n, v in values.items()})
    totals = rows.groupBy(*keys).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in values])
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*keys, *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__b_{n}") for n in values])
    own = Window.partitionBy(*keys).orderBy(*order, "__row").rowsBetween(Window.unboundedPreceding, 0)
    found = beside(rows, base, keys)
    return found.select(*ranges.columns, *[(F.col(f"__b_{n}") + F.sum(f"__v_{n}").over(own)).alias(n) for n in values])


def beside(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the further columns of facts, one row for each value of keys (nulls too)."""
    other = [c for c in facts.columns if c not in keys]
    named = facts.select(*other, *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return rows.join(named, on, "left").select(*rows.columns, *other)


def _selection_ranges(df: DataFrame, group: list[str], order: list[Column | str], masks: dict[str, Column]) -> DataFrame:
    """df over ranges of (group, order), ties by place in df, so that equal keys are split as
    well; with a flag __m_<name> for each mask and __before_<name>, __in_<name>: the flagged
    rows of the group in earlier ranges, and in the row's own range. Only the counts, a row
    for each range of a group, are run over."""
    flagged = df.withColumns({f"__m_{n}": F.coalesce(m, F.lit(False)) for n, m in masks.items()} | {"__tie": F.monotonically_increasing_id()})
    ranges = in_ranges(flagged, group, [*order, "__tie"])
    keys = [*group, "__part"]
    counts = ranges.groupBy(*keys).agg(*[F.count_if(F.col(f"__m_{n}")).alias(f"__in_{n}") for n in masks])
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.withColumns({f"__before_{n}": F.coalesce(F.sum(f"__in_{n}").over(earlier), F.lit(0)) for n in masks})
    return beside(ranges, totals, keys)


def _place_in_range(rows: DataFrame, group: list[str], order: list[Column | str], mask: str) -> Column:
    """Place of each flagged row among those of its group; sorts single ranges."""
    own = Window.partitionBy(*group, "__part").orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, 0)
    return F.col(f"__before_{mask}") + F.sum(F.col(f"__m_{mask}").cast("long")).over(own)


def ranked_cap(df: DataFrame, group: list[str], order: list[Column | str], cap: int, eligible: Column | None = None, out: str = "selected") -> DataFrame:
    """Mark the first cap eligible rows of each group; the rest stays, as deferred.
    Eligibility is decided before ranking, so the choice is complete and does not depend on
    batches. The rows are dealt into ranges of (group, order); by the ranges' counts every
    range lies before, behind or across the cap. Those before it are taken whole and those
    behind it left, without a sort; only the one range across the cap of each group is ranked,
    so neither a group's size nor the cap decides how much meets in one task. Of rows that are
    equal in order, those that come first in df are taken."""
    rows = _selection_ranges(df, group, order, {"e": F.lit(True) if eligible is None else eligible})
    before, here = F.col("__before_e"), F.col("__in_e")
    across = (before < cap) & (before + here > cap)
    easy = rows.where(~across).withColumn(out, F.col("__m_e") & (before < cap))
    edge = rows.where(across).withColumn("__place", _place_in_range(rows, group, order, "e"))
    edge = edge.withColumn(out, F.col("__m_e") & (F.col("__place") <= cap))
    columns = [c for c in df.columns if c != out]
    return easy.select(*columns, out).unionAll(edge.select(*columns, out))


def source_rank(df: DataFrame, group: list[str], order: list[Column | str], out: str = "source_rank") -> DataFrame:
    """Place of each row in its group, from 1; whole groups never meet in one task."""
    ranked = running(in_ranges(df, group, order), group, order, F.lit(1), "__before")
    return ranked.withColumn(out, (F.col("__before") + 1).cast("int")).select(*df.columns, out)


def first_ranked(df: DataFrame, group: list[str], order: list[Column | str], most: int, out: str = "place", eligible: Column | None = None) -> DataFrame:
    """The first most (eligible) rows of each group with their place. Ranges behind the last
    place are left out by their counts; each of the others is ranked on its own."""
    rows = _selection_ranges(df, group, order, {"e": F.lit(True) if eligible is None else eligible}).where(F.col("__before_e") < most)
    placed = rows.withColumn(out, _place_in_range(rows, group, order, "e").cast("int"))
    return placed.where(F.col("__m_e") & (F.col(out) <= most)).select(*[c for c in df.columns if c != out], out)


def top_ranked(df: DataFrame, group: list[str], order: list[Column | str], most: int) -> DataFrame:
    """The first most rows of each group, for small numbers (up to 1,000 Spark takes each
    partition's first ones before the shuffle, so a group's size does not meet in one task)."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= most).drop("__place")


def refill(df: DataFrame, group: list[str], order: list[Column | str], cap: int, excluded: Column, out: str = "routing") -> DataFrame:
    """A ranked cap that later exclusions make room in. Of the first cap rows of a group those
    not excluded are retained; the ranked stream goes on until cap rows are chosen again, and
    the rows chosen by that are refilled; others are deferred, or excluded. Both ranks, among
    all rows and among those that are left, come from one pass over ranges; only ranges that
    the first or the second cap may lie in are sorted."""
    gone = F.coalesce(excluded, F.lit(False))
    rows = _selection_ranges(df, group, order, {"all": F.lit(True), "left": ~gone})
    # Ranks among the rows left are never larger, so a range behind the second cap is behind both.
    reached = F.col("__before_left") < cap
    near = rows.where(reached).withColumns({f"__p_{m}": _place_in_range(rows, group, order, m) for m in ("all", "left")})
    chosen = F.when(~F.col("__m_left"), "excluded").when(F.col("__p_all") <= cap, "retained").when(F.col("__p_left") <= cap, "refilled").otherwise("deferred")
    far = F.when(~F.col("__m_left"), "excluded").otherwise("deferred")
    columns = [c for c in df.columns if c != out]
    return near.withColumn(out, chosen).select(*columns, out).unionAll(rows.where(~reached).withColumn(out, far).select(*columns, out))


def merge_intervals(df: DataFrame, group: list[str], start: str, end: str) -> DataFrame:
    """Union of the half-open intervals of each group; intervals that touch join. Islands
    are numbered from 1 by position. Rows with a null end are left out."""
    order = [start, end]
    rows = in_ranges(df.select(*group, start, end).where(F.col(start).isNotNull() & F.col(end).isNotNull()), group, order)
    reach = running(rows, group, order, F.col(end), "__reach", F.max, F.lit(None))
    marked = reach.withColumn("__new", F.coalesce(F.col(start) > F.col("__reach"), F.lit(True)).cast("int"))
    numbered = running(marked, group, order, F.col("__new"), "__islands").withColumn("island", F.col("__islands") + F.col("__new"))
    return numbered.groupBy(*group, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_merged"))


def running_offset(df: DataFrame, group: list[str], order: list[Column | str], length: str, out: str = "offset") -> DataFrame:
    """Sum of the lengths before each row."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(length).over(w) - F.col(length))


def suffixed_ids(df: DataFrame, base: str, order: list[Column | str], out: str = "event_id") -> DataFrame:
    """base, with |dupN on its second and later occurrences (N from 2); a base of any number
    of rows is spread over ranges."""
    n = F.col("__nth")
    ranked = source_rank(df, [base], order, "__nth")
    return ranked.withColumn(out, F.when(n == 1, F.col(base)).otherwise(F.concat(base, F.lit("|dup"), n))).drop("__nth")


def beside_first(df: DataFrame, group: list[str], start: str, out: str) -> DataFrame:
    """start relative to the smallest start of the row's group; only the minima meet."""
    first = df.groupBy(*group).agg(F.min(start).alias("__first"))
    return beside(df, first, group).withColumn(out, F.col(start) - F.col("__first")).drop("__first")


def best_two(df: DataFrame, group: list[str], score: str, order: list[Column | str], gap: float, least: float) -> DataFrame:
    """Best row of each group with its verdict: ok, ambig (the second is within gap) or
    novel (the best is below least)."""
    w = Window.partitionBy(*group).orderBy(F.desc(score), *order)
    top = df.withColumn("__rn", F.row_number().over(w)).where("__rn <= 2")
    best = top.groupBy(*group).agg(F.max(F.when(F.col("__rn") == 1, F.col(score))).alias("best"), F.max(F.when(F.col("__rn") == 2, F.col(score))).alias("second"))
    verdict = F.when(F.col("best") < least, "novel").when(F.coalesce(F.col("best") - F.col("second") < gap, F.lit(False)), "ambig").otherwise("ok")
    return best.withColumn("verdict", verdict)


def with_group_size(ranked: DataFrame, group: list[str], out: str) -> DataFrame:
    """ranked with the number of rows of each group; only the counts are brought together."""
    return beside(ranked, ranked.groupBy(*group).agg(F.count("*").alias(out)), group)


def nested_sample(df: DataFrame, strata: list[str], key: Column, fractions: list[float]) -> DataFrame:
    """For each fraction f the first ceil(n * f) rows (one at least) of every stratum in
    the order of key; smaller fractions are contained in larger ones by construction."""
    ranked = source_rank(df.withColumn("__key", key), strata, ["__key"], "__rn").drop("__key")
    swept = with_group_size(ranked, strata, "__n").withColumn("fraction", F.explode(F.array(*[F.lit(f) for f in fractions])))
    return swept.where(F.col("__rn") <= F.greatest(F.ceil(F.col("__n") * F.col("fraction")), F.lit(1))).drop("__rn", "__n")


def folds(df: DataFrame, classes: list[str], order: list[Column | str], k: int, out: str = "fold") -> DataFrame:
    """Contiguous folds 0..k-1 within each class; the last takes the remainder."""
    ranked = with_group_size(source_rank(df, classes, order, "__rn"), classes, "__n")
    fold = F.least(F.floor((F.col("__rn") - 1) / F.greatest(F.floor(F.col("__n") / k), F.lit(1))), F.lit(k - 1)).cast("int")
    return ranked.withColumn(out, fold).drop("__rn", "__n")


def percentile_among(scores: DataFrame, score: str, reference: DataFrame, value: str, out: str = "pct") -> DataFrame:
    """Percentage of reference values below each score, equal ones counted half. Both sides
    run as one stream of distinct values over ranges; scores then look up their value."""
    every = reference.select(F.col(value).alias("__v"), F.lit(1).alias("__ref")).unionAll(scores.select(F.col(score).alias("__v"), F.lit(0).alias("__ref")))
    per = in_ranges(every.where("__v is not null").groupBy("__v").agg(F.sum("__ref").alias("__n")), [], ["__v"])
    total = reference.agg(F.count(value).alias("__total"))
    below = running(per, [], ["__v"], F.col("__n"), "__below").crossJoin(F.broadcast(total))
    share = below.select("__v", (100.0 * (F.col("__below") + 0.5 * F.col("__n")) / F.col("__total")).alias(out))
    return scores.join(share, scores[score] == share["__v"], "left").select(*scores.columns, out)


def quantile_table(reference: DataFrame, value: str, tail: float, coarse: int, fine: int) -> DataFrame:
    """A distribution at two resolutions, in one row: every value at about coarse even ranks
    over the whole range (coarse), and at about fine even ranks among the smallest tail share
    (fine, up to the value edge), as sorted arrays, with n_coarse, n_fine, n (values) and n_tail
    (values up to the edge). Ranks run over ranges, so the reference may be of any size; the row
    holds at most 2 * coarse + 2 * fine numbers. Null values and NaN do not count."""
    per = reference.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("k"))
    ranks = running_sums(in_ranges(per, [], ["v"]), [], ["v"], {"upto": F.col("k")})
    n = per.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    ranked = ranks.crossJoin(F.broadcast(n)).withColumn("below", F.col("upto") - F.col("k"))
    edge = ranked.where(F.col("upto") >= F.ceil(F.col("n") * tail)).agg(F.min("v").alias("edge"), F.min("upto").alias("n_tail"))
    both = ranked.crossJoin(F.broadcast(edge))

    def picked(total: Column, size: int) -> Column:
        """How many of size even ranks of total values fall on this value."""
        step = F.greatest(total / size, F.lit(1.0))
        return (F.floor(F.col("upto") / step) - F.floor(F.col("below") / step)).cast("int")

    times = both.select("v", "edge", "n", "n_tail", picked(F.col("n"), coarse).alias("c"), F.when(F.col("v") <= F.col("edge"), picked(F.col("n_tail"), fine)).otherwise(0).alias("f"))
    listed = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col(c) > 0, F.struct("v", F.col(c).alias("k"))))), lambda r: F.array_repeat(r["v"], r["k"])))
    return times.where("c > 0 or f > 0").agg(listed("c").alias("coarse"), listed("f").alias("fine"), F.max("edge").alias("edge"), F.max("n").alias("n"), F.max("n_tail").alias("n_tail"))


def two_resolution_share(scores: DataFrame, score: str, quantiles: DataFrame, out: str = "share") -> DataFrame:
    """Share of a reference at or below each score, by binary search in its quantile_table;
    scores that occur several times there take the middle of their ranks. Scores up to the
    edge are looked up among the fine values, others among the coarse ones: the error is at
    most 1 / coarse, and n_tail / n / fine in the tail, and none where a table holds all of its
    values. Null scores and an empty reference give null."""
    row = quantiles.select(F.struct("coarse", "fine", "edge", "n", "n_tail").alias("__q"))
    q, x = F.col("__q"), F.col(score).cast("double")

    def rank(values: Column) -> Column:
        left, right = count_below(values, x), count_below(values, x, equal=True)
        return F.when(right > left, (left + right + 1) / 2).otherwise(left.cast("double"))

    coarse = rank(q["coarse"]) / F.size(q["coarse"])
    fine = rank(q["fine"]) / F.size(q["fine"]) * q["n_tail"] / q["n"]
    share = F.when(q["n"] > 0, F.when(x > q["edge"], coarse).otherwise(fine))
    return scores.crossJoin(F.broadcast(row)).withColumn(out, F.when(x.isNotNull(), share)).select(*[c for c in scores.columns if c != out], out)
