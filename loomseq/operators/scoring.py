"""Pluggable scorers over DataFrames.

A scorer is registered by name with the family of tools that share a run. Rows go to it in
Arrow batches that are homogeneous in family, allele and length (by partitioning and
sorting, not by grouping, so no group is held whole). A failure becomes rows with status
error, not an exception.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomseq.storage import stored

Scorer = Callable[[pd.DataFrame], pd.Series]
REGISTRY: dict[str, tuple[str, Scorer]] = {}
SCORED = "peptide string, hla_allele string, algorithm string, mhc_class string, score double, status string, error string"


def register(name: str, family: str | None = None):
    def keep(fn: Scorer) -> Scorer:
        REGISTRY[name] = (family or name, fn)
        return fn

    return keep


@register("hydropathy", family="linear")
def hydropathy(rows: pd.DataFrame) -> pd.Series:
    """Mean hydropathy of the peptide's letters; empty peptides fail."""
    from loomseq.functions.sequences import HYDROPATHY

    if (rows["peptide"].str.len() == 0).any():
        raise ValueError("empty peptide")
    total = sum((rows["peptide"].str.count(a) * v for a, v in HYDROPATHY.items()), pd.Series(0.0, index=rows.index))
    return total / rows["peptide"].str.len()


@register("length_logistic", family="linear")
def length_logistic(rows: pd.DataFrame) -> pd.Series:
    return 1 / (1 + np.exp(-(rows["peptide"].str.len().astype(float) - 9)))


#: Tasks of one run of a tool; more of one family, allele and length are dealt to several.
CHUNK_TASKS = 50_000


def job_chunks(tasks: DataFrame, size: int = CHUNK_TASKS) -> DataFrame:
    """tasks with family, length and chunk: tasks of one family, allele and length share a
    run, and where they are more than size they are dealt over chunks by a hash of the
    peptide. Only counts are brought together. Tasks of an algorithm that is not registered
    have the empty family."""
    family = F.create_map(*[F.lit(x) for name, (fam, _) in REGISTRY.items() for x in (name, fam)])
    kinds = ["family", "hla_allele", "length"]
    placed = tasks.withColumns({"family": F.coalesce(F.try_element_at(family, F.col("algorithm")), F.lit("")), "length": F.coalesce(F.length("peptide"), F.lit(0))})
    parts = placed.groupBy(*kinds).agg(F.ceil(F.count("*") / size).cast("int").alias("chunks"))
    parts = parts.select(*[F.col(k).alias(f"__{k}") for k in kinds], "chunks")
    same = (F.col("family") == F.col("__family")) & F.col("hla_allele").eqNullSafe(F.col("__hla_allele")) & (F.col("length") == F.col("__length"))
    dealt = placed.join(parts, same, "left").withColumn("chunk", F.pmod(F.xxhash64("peptide", F.lit(31)), F.col("chunks")).cast("int"))
    return dealt.select(*tasks.columns, *[k for k in kinds if k not in tasks.columns], "chunks", "chunk")


def score_tasks(tasks: DataFrame, size: int = CHUNK_TASKS) -> DataFrame:
    """tasks (peptide, hla_allele, algorithm, mhc_class) with score, status and error. Tasks
    of an algorithm that is not registered are skipped, with that status."""
    known = dict(REGISTRY)
    dealt = job_chunks(tasks.select("peptide", "hla_allele", "algorithm", "mhc_class"), size)
    placed = dealt.repartition("family", "hla_allele", "length", "chunk").sortWithinPartitions("algorithm", "hla_allele", "length", "chunk")

    def run(frames):
        for frame in frames:
            for (name, _, _), part in frame.groupby(["algorithm", "hla_allele", "length"], sort=False, dropna=False):
                out = part[["peptide", "hla_allele", "algorithm", "mhc_class"]].copy()
                out["score"], out["status"], out["error"] = np.nan, "ok", None
                if name not in known:
                    out["status"], out["error"] = "skipped", "not registered"
                else:
                    try:
                        out["score"] = known[name][1](part).astype(float)
                    except Exception as e:  # a failing tool must not end the job
                        out["status"], out["error"] = "error", f"{type(e).__name__}: {e}"
                out["score"] = out["score"].astype(object).where(out["score"].notna(), None)
                yield out

    return placed.mapInPandas(run, SCORED)


def linear_model(df: DataFrame, weights: dict[str, float], bias: float, out: str = "score") -> DataFrame:
    """Logistic score of feature columns; a missing feature gives a null score and status
    missing."""
    from loomseq.functions.sequences import sigmoid

    z = F.lit(bias)
    known = F.lit(True)
    for c, w in weights.items():
        z = z + F.col(c) * w
        known = known & F.col(c).isNotNull()
    return df.withColumns({out: F.when(known, sigmoid(z)), "status": F.when(known, "ok").otherwise("missing")})


def _composition(df: DataFrame, sequence: str) -> DataFrame:
    from loomseq.functions.sequences import AMINO_ACIDS, fraction_of

    return df.withColumns({f"f_{a}": F.coalesce(fraction_of(F.col(sequence), a), F.lit(0.0)) for a in AMINO_ACIDS})


def ngram_features(df: DataFrame, sequence: str, most: int, buckets: int = 1 << 14):
    """A fitted pipeline from text to features: TF-IDF of the character n-grams of 1 to most
    letters, hashed to buckets. df is what it is fitted on."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, SQLTransformer

    from loomseq.functions.grams import GramCounts

    tidy = SQLTransformer(statement="SELECT * EXCEPT (__tf) FROM __THIS__")
    return Pipeline(stages=[GramCounts(sequence, most, buckets, "__tf"), IDF(inputCol="__tf", outputCol="features"), tidy]).fit(df)


def ngram_classifier(df: DataFrame, sequence: str, label: str, most: int, reg: float = 0.01, buckets: int = 1 << 14):
    """A logistic regression with balanced class weights on the features of ngram_features;
    returns (fitted model, rows with features in place of the sequence). The counts are made
    once and stored, for the weights of the n-grams, the fit and the rows read them in turn."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF

    from loomseq.functions.grams import GramCounts

    counted = GramCounts(sequence, most, buckets, "__tf").transform(_balanced(df, label)).drop(sequence)
    counted = stored(df.sparkSession, counted, "grams")
    rows = IDF(inputCol="__tf", outputCol="features").fit(counted).transform(counted).drop("__tf")
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=30, regParam=reg).fit(rows), rows


def _balanced(rows: DataFrame, label: str) -> DataFrame:
    """rows with the label as a number, and weights that balance the classes of these rows."""
    counts = rows.groupBy(label).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__t"), F.count("*").alias("__k"))
    weights = counts.crossJoin(F.broadcast(total)).select(label, (F.col("__t") / (F.col("__k") * F.col("__n"))).alias("weight"))
    return rows.join(F.broadcast(weights), label).withColumn("label", F.col(label).cast("double"))


def _logistic_pipeline(reg: float):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from loomseq.functions.sequences import AMINO_ACIDS

    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=30, regParam=reg)
    return Pipeline(stages=[VectorAssembler(inputCols=[f"f_{a}" for a in AMINO_ACIDS], outputCol="features"), lr])


def composition_classifier(df: DataFrame, sequence: str, label: str):
    """A logistic regression on amino-acid fractions with balanced class weights; returns
    (fitted pipeline, prepared rows)."""
    rows = _balanced(_composition(df, sequence), label)
    return _logistic_pipeline(0.01).fit(rows), rows


def out_of_fold(spark: SparkSession, df: DataFrame, sequence: str, label: str, group: str, folds: int = 3, inner: int = 3, grid: tuple[float, ...] = (0.001, 0.1)) -> DataFrame:
    """df with fold, score (of class 1) and prediction, each row scored by a model that saw
    no row of its fold. Rows of equal group share a fold. For each fold the regularisation is
    chosen on the other folds only, by the mean area under the ROC curve over inner folds of
    the same groups; class weights come from the rows of the fit at hand. A fold without
    other folds to learn from has null score and prediction."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import vector_to_array

    part = lambda n, seed: F.pmod(F.xxhash64(F.col(group), F.lit(seed)), F.lit(n)).cast("int")
    # The inner fold depends on the outer one, as each outer fold has a search of its own.
    splits = {f"__inner_{k}": part(inner, 101 + k) for k in range(folds)}
    rows = stored(spark, _composition(df, sequence).withColumns({"fold": part(folds, 100), **splits}), "folds")
    evaluator = BinaryClassificationEvaluator(labelCol="label")

    def scored(k: int) -> DataFrame:
        held, train = rows.where(F.col("fold") == k), rows.where(F.col("fold") != k)
        sizes = train.groupBy(F.col(f"__inner_{k}").alias("i"), F.col(label).alias("y")).count().collect()
        if not sizes:
            return held.withColumns({"score": F.lit(None).cast("double"), "prediction": F.lit(None).cast("double")})
        # Inner folds that hold, and leave, both classes; others can rank nothing.
        classes = {r.y for r in sizes}
        both = [i for i in range(inner) if {r.y for r in sizes if r.i == i} == {r.y for r in sizes if r.i != i} == classes and len(classes) > 1]
        found = dict.fromkeys(grid, 0.0)
        for i in both:
            fit_on = _balanced(train.where(F.col(f"__inner_{k}") != i), label)
            valid = train.where(F.col(f"__inner_{k}") == i).withColumn("label", F.col(label).cast("double"))
            for reg in grid:
                found[reg] += evaluator.evaluate(_logistic_pipeline(reg).fit(fit_on).transform(valid))
        best = max(grid, key=lambda reg: found[reg])
        model = _logistic_pipeline(best).fit(_balanced(train, label))
        return model.transform(held).withColumn("score", vector_to_array("probability")[1])

    # The folds' jobs are short and many, so the folds are fitted side by side.
    with ThreadPoolExecutor(folds) as pool:
        out = list(pool.map(inheritable_thread_target(spark)(scored), range(folds)))
    names = [*df.columns, "fold", "score", "prediction"]
    return reduce(DataFrame.unionByName, [x.select(*names) for x in out])


def deletion_windows(events: DataFrame, k: int) -> DataFrame:
    """Windows over the junction of an in-frame deletion, each with the wild-type window
    that shares more residues: the one that starts there (left) or the one that ends there
    (right); where both share equally many, the choice of the window before is kept.
    events: event, wt, position (1-based first removed residue), removed."""
    raw = events.where(F.length("wt") >= F.col("position") + F.col("removed") - 1 + k)
    mt = F.concat(F.substring("wt", F.lit(1), F.col("position") - 1), F.col("wt").substr(F.col("position") + F.col("removed"), F.length("wt")))
    base = raw.withColumn("mt", mt)
    starts = F.sequence(F.greatest(F.lit(1), F.col("position") - k + 1), F.col("position") - 1)
    w = base.where("position > 1").select("event", "wt", "mt", "removed", F.explode(starts).alias("start"))
    part = lambda s, at: F.col(s).substr(at, F.lit(k))
    w = w.select("event", "start", part("mt", F.col("start")).alias("peptide"), part("wt", F.col("start")).alias("left"), part("wt", F.col("start") + F.col("removed")).alias("right"))
    same = lambda a: F.size(F.filter(F.sequence(F.lit(1), F.lit(k)), lambda i: F.col("peptide").substr(i, F.lit(1)) == F.col(a).substr(i, F.lit(1))))
    w = w.withColumns({"n_left": same("left"), "n_right": same("right")})
    clear = F.when(F.col("n_left") > F.col("n_right"), "left").when(F.col("n_right") > F.col("n_left"), "right")
    order = Window.partitionBy("event").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    choice = F.coalesce(F.last(clear, ignorenulls=True).over(order), F.lit("left"))
    return w.withColumn("choice", choice).select("event", "start", "peptide", "choice", F.when(F.col("choice") == "left", F.col("left")).otherwise(F.col("right")).alias("wt_peptide"))
