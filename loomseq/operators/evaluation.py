"""Metrics, calibration, curves and resampling of scored and labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomseq.operators.windows import beside, in_ranges, running_sums


def binary_metrics(df: DataFrame, groups: list[str], label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts and the usual ratios, one conditional aggregate."""
    y, s = F.col(label) == 1, F.col(score) >= threshold
    c = df.groupBy(*groups).agg(F.count("*").alias("n"), F.count_if(y & s).alias("tp"), F.count_if(~y & s).alias("fp"), F.count_if(~y & ~s).alias("tn"), F.count_if(y & ~s).alias("fn"), F.avg(F.pow(F.col(score) - F.col(label), F.lit(2))).alias("brier"))
    ratio = lambda a, b: F.when(b > 0, a / b)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.withColumns({"accuracy": (tp + tn) / F.col("n"), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "specificity": ratio(tn, tn + fp), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def reliability(df: DataFrame, label: str, score: str, bins: int) -> DataFrame:
    """Equal bins of the score, the last closed on the right; empty bins are kept."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    filled = df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("rate"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean_score", "rate")


def calibration_error(df: DataFrame, label: str, score: str, bins: int) -> DataFrame:
    r = reliability(df, label, score, bins).where("n > 0")
    return r.agg((F.sum(F.col("n") * F.abs(F.col("mean_score") - F.col("rate"))) / F.sum("n")).alias("ece"))


def score_table(df: DataFrame, groups: list[str], label: str, score: str) -> DataFrame:
    """Per distinct score: positives and negatives, and running sums (tp, fp) from the highest
    score down. Ties are collapsed first; the sums run over ranges of (group, score), both in
    one pass, so no group's scores meet in one task."""
    t = df.groupBy(*groups, score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    order = [F.desc(score)]
    return running_sums(in_ranges(t, groups, order), groups, order, {"tp": F.col("pos"), "fp": F.col("neg")})


def precision_recall(df: DataFrame, groups: list[str], label: str, score: str) -> DataFrame:
    """The precision-recall curve: one row for each distinct score of each group, with tp, fp,
    precision and recall of the rows at or above it, and step_area, its trapezoid below the
    curve from the next higher score (from recall 0 and precision 1 at the first). recall and
    step_area are null in groups without positives."""
    t = score_table(df, groups, label, score)
    n = beside(t, t.groupBy(*groups).agg(F.sum("pos").alias("__np")), groups) if groups else t.crossJoin(F.broadcast(t.agg(F.sum("pos").alias("__np"))))
    tp, fp = F.col("tp"), F.col("fp")
    before, seen = tp - F.col("pos"), tp + fp - F.col("pos") - F.col("neg")
    precision = tp / (tp + fp)
    earlier = F.when(seen > 0, before / seen).otherwise(1.0)
    some = F.col("__np") > 0
    area = F.when(some, F.col("pos") / F.col("__np") * (precision + earlier) / 2)
    return n.select(*groups, score, "tp", "fp", precision.alias("precision"), F.when(some, tp / F.col("__np")).alias("recall"), area.alias("step_area"))


def ranking_metrics(df: DataFrame, groups: list[str], label: str, score: str) -> DataFrame:
    """AUROC (ties count half) and average precision of each group; null where one class
    is missing."""
    t = score_table(df, groups, label, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    g = t.groupBy(*groups).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), area.alias("area"), F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("hits"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return g.select(*groups, "n_pos", "n_neg", F.when(both, F.col("area") / (F.col("n_pos") * F.col("n_neg"))).alias("auroc"), F.when(F.col("n_pos") > 0, F.col("hits") / F.col("n_pos")).alias("average_precision"))


def top_precision(df: DataFrame, groups: list[str], label: str, score: str, order: list[str]) -> DataFrame:
    """Precision among the n_pos best rows, and the mean of the precisions at 1..n_pos. Places
    and true positives run over ranges in one pass."""
    by = [F.desc(score), *order]
    rows = in_ranges(df.select(*groups, label, score, *order), groups, by)
    sums = running_sums(rows, groups, by, {"__rn": F.lit(1).cast("bigint"), "__tp": F.col(label).cast("bigint")})
    r = beside(sums, df.groupBy(*groups).agg(F.sum(label).alias("__np")), groups)
    g = r.where("__rn <= __np").groupBy(*groups)
    return g.agg(F.max("__np").alias("n_pos"), F.max(F.when(F.col("__rn") == F.col("__np"), F.col("__tp") / F.col("__rn"))).alias("ppv_at_n_pos"), F.avg(F.col("__tp") / F.col("__rn")).alias("mean_ppv"))


def in_sets(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row once for every column of columns (grouped_by: its name, value: its value as text, which
    may be null) and once for all rows (grouped_by = "all"): groups of several columns in one plan, in
    which a null value stays apart from all. The copies are aggregated where they are made."""
    sets = [F.struct(F.lit(c).alias("grouped_by"), F.col(c).cast("string").alias("value")) for c in columns]
    sets.append(F.struct(F.lit("all").alias("grouped_by"), F.lit(None).cast("string").alias("value")))
    return df.withColumn("__set", F.explode(F.array(*sets))).select("*", "__set.grouped_by", "__set.value").drop("__set")


def grouped_metrics(df: DataFrame, columns: list[str], label: str, score: str, threshold: float = 0.5, least: int = 2) -> DataFrame:
    """binary_metrics, ranking_metrics and the trapezoid area below the precision-recall curve
    (pr_area) of each value of each column and of all rows; sets of fewer than least rows are
    left out."""
    every = in_sets(df.select(*columns, label, score), columns)
    sets = ["grouped_by", "value"]
    plain = binary_metrics(every, sets, label, score, threshold).where(F.col("n") >= least)
    ranked = ranking_metrics(every, sets, label, score)
    areas = precision_recall(every, sets, label, score).groupBy(*sets).agg(F.sum("step_area").alias("pr_area"))
    return beside(beside(plain, ranked, sets), areas, sets)


def attribution(df: DataFrame, features: str, coefficients: list[float], label: str) -> DataFrame:
    """What each feature (from 1) of a linear score adds: mean_contribution, mean_abs, the means
    by label (mean_positive, mean_negative), and drop, by how much the area under the ROC curve
    falls when the feature is left out of the score (the total minus the feature's share, so
    one pass gives all reduced scores). features is an array column; the coefficients are a
    parameter. Scores are rounded to 9 digits, so that sums in another order tie alike."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    parts = F.zip_with(features, weights, lambda x, w: x.cast("double") * w)
    rows = df.select(F.col(label).alias("label"), parts.alias("parts")).withColumn("total", F.aggregate("parts", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))))
    each = rows.select("label", "total", F.posexplode("parts").alias("at", "part"))
    each = each.select((F.col("at") + 1).alias("feature"), "label", "part", F.round(F.col("total") - F.coalesce("part", F.lit(0.0)), 9).alias("score"))
    y = F.col("label") == 1
    means = each.groupBy("feature").agg(F.avg("part").alias("mean_contribution"), F.avg(F.abs("part")).alias("mean_abs"), F.avg(F.when(y, F.col("part"))).alias("mean_positive"), F.avg(F.when(~y, F.col("part"))).alias("mean_negative"))
    whole = rows.select(F.lit(0).alias("feature"), "label", F.round("total", 9).alias("score"))
    areas = ranking_metrics(whole.unionByName(each.select("feature", "label", "score")), ["feature"], "label", "score").select("feature", "auroc")
    full = areas.where("feature = 0").select(F.col("auroc").alias("full_auroc"))
    return means.join(areas, "feature", "left").crossJoin(F.broadcast(full)).withColumn("drop", F.col("full_auroc") - F.col("auroc")).drop("auroc")


def best_and_median(df: DataFrame, keys: list[str], value: str, algorithm: str, preferred: list[str], only: list[str] | None = None) -> DataFrame:
    """Smallest value with its algorithm (ties in preferred order), exact median, count."""
    use = F.col(algorithm).isin(only) if only else F.lit(True)
    v = F.when(use, F.col(value))
    place = F.array_position(F.array(*[F.lit(a) for a in preferred]), F.col(algorithm))
    return df.groupBy(*keys).agg(F.min(v).alias("best"), F.min_by(algorithm, F.when(v.isNotNull(), F.struct(v.alias("v"), place.alias("p")))).alias("best_method"), F.median(v).alias("median"), F.count(v).alias("n_values"))


#: Constants of the hash that gives weights and signs (fixed values): a prime and factors.
_PRIME, _A, _B, _C = 2_147_483_647, 48_271, 1_299_709, 69_621


def hashed_unit(key: Column, replicate: Column, seed: int) -> Column:
    """A number in [0, 1) from an integer key, a replicate and a seed, by arithmetic that any
    engine repeats."""
    x = F.pmod(key.cast("bigint") * _A + seed * 7_919, F.lit(_PRIME))
    y = F.pmod(x + (replicate + 1) * _B, F.lit(_PRIME))
    return F.pmod(F.pmod(y * y, F.lit(_PRIME)) * _C + x, F.lit(_PRIME)) / float(_PRIME)


def _replicated(df: DataFrame, groups: list[str], key: str, value: Column, replicates: int, seed: int) -> DataFrame:
    """Each row with every replicate (__r) and its number (__u). The copies live between the
    scan and the partial aggregation; only a group's sums of a replicate are shuffled."""
    rows = df.select(*groups, F.col(key).cast("bigint").alias("__key"), value.alias("__value")).dropna(subset=["__key", "__value"])
    every = rows.withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)).cast("array<bigint>")))
    return every.withColumn("__u", hashed_unit(F.col("__key"), F.col("__r"), seed))


def bootstrap(df: DataFrame, groups: list[str], key: str, value: Column | str, replicates: int, seed: int = 1) -> DataFrame:
    """Mean of value, its 95 % interval over Poisson(1) replicates, and the share of
    replicates whose mean is above 0. Weights are a hash of the integer key and the
    replicate, so reruns agree, and rows of one key are drawn together: a row id gives the
    plain bootstrap, a group's number the grouped one, and a difference of two scores as
    value the paired one. Rows without a value or key do not count."""
    u = F.col("__u")
    weight = F.when(u < 0.36787944, 0).when(u < 0.73575888, 1).when(u < 0.91969860, 2).when(u < 0.98101184, 3).when(u < 0.99634015, 4).otherwise(5)
    every = _replicated(df, groups, key, F.col(value) if isinstance(value, str) else value, replicates, seed).withColumn("__w", weight)
    per = every.groupBy(*groups, "__r").agg(F.count("*").alias("n"), F.avg("__value").alias("mean"), F.sum(F.col("__w") * F.col("__value")).alias("s"), F.sum("__w").alias("w"))
    drawn = per.withColumn("m", F.when(F.col("w") > 0, F.col("s") / F.col("w")))
    ends, above = F.percentile("m", F.array(F.lit(0.025), F.lit(0.975))), F.avg((F.col("m") > 0).cast("double"))
    out = drawn.groupBy(*groups).agg(F.min("n").alias("n"), F.min("mean").alias("mean"), ends.alias("e"), above.alias("above_zero"))
    return out.select(*groups, "n", "mean", F.col("e")[0].alias("low"), F.col("e")[1].alias("high"), "above_zero")


def permutation_test(df: DataFrame, groups: list[str], key: str, difference: Column, replicates: int, seed: int = 1) -> DataFrame:
    """Two-sided p-value of the mean of paired differences, by replicates in which the sign
    of every key's rows is drawn anew: (1 + those at least as far from 0) / (1 + all)."""
    every = _replicated(df, groups, key, difference, replicates, seed + 1)
    signed = F.when(F.col("__u") < 0.5, F.col("__value")).otherwise(-F.col("__value"))
    per = every.groupBy(*groups, "__r").agg(F.count("*").alias("n"), F.sum("__value").alias("d"), F.sum(signed).alias("t"))
    far = F.count_if(F.abs("t") >= F.abs("d") - 1e-9)
    return per.groupBy(*groups).agg(F.min("n").alias("n"), F.min(F.col("d") / F.col("n")).alias("mean_difference"), ((far + 1) / F.lit(replicates + 1)).alias("p_value"))


def standardise(df: DataFrame, columns: list[str], clip: float) -> DataFrame:
    """z-scores by mean and population deviation (0 counts as 1), clipped. The fit is one
    row, so it is broadcast at any size."""
    fit = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(fit))
    z = {f"z_{c}": F.greatest(F.lit(-clip), F.least(F.lit(clip), (F.col(c) - F.col(f"m_{c}")) / F.when(F.col(f"s_{c}") > 0, F.col(f"s_{c}")).otherwise(1.0))) for c in columns}
    return out.withColumns(z).drop(*[f"{p}_{c}" for p in "ms" for c in columns])


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Order-insensitive fingerprint of distinct rows: count, exclusive or and sum of the
    first 60 bits of their MD5. Null is told from the empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])
    h = df.select(text.alias("t")).distinct().select(F.conv(F.substring(F.md5("t"), 1, 15), 16, 10).cast("bigint").alias("h"))
    return h.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"), F.coalesce(F.sum(F.pmod("h", F.lit(1 << 30))), F.lit(0)).alias("s"))
