"""Toxicity by weak supervision.

1. Voters. Words and word beginnings (3 to 8 letters) that labelled toxic texts hold far
   more often than others form lexicon voters, grouped by kind and strength; a fixed
   word list and some patterns vote beside them. A voter says toxic, clean or abstains.
2. Label model. A generative model with a class prior and, for each voter, the
   probabilities of its votes given the class is fitted by expectation maximisation.
   Correlations between voters within a class are estimated each round, and a voter's
   weight is reduced by what it shares with others.
   The given labels are one more voter, whose errors are estimated like the others'.
   Nothing is held at a given value.
3. Classifier. A logistic regression over term counts and votes is trained on the
   posterior labels; it alone gives the score.

The fit uses a sample of labelled rows bounded by MAX_TOXIC and MAX_CLEAN (those of
smallest hash of doc_id); scoring covers every whole text, where it is read, without a
shuffle. Null or empty text has no terms and gets the score of the intercept. Without
labelled rows of both classes the score is 0 throughout. Several labels of one doc_id:
toxic if any says so. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import materialise, stable_bucket, table, text_slices

MAX_TOXIC, MAX_CLEAN = 4_000, 12_000
LIMIT = 0.3
#: Least logarithm of how much more often toxic texts hold a voter's term.
LEAST = 2.0
BEGINNINGS = (3, 4, 5, 6, 7, 8)
FIXED_WORDS = ("idiot", "idiots", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "worthless", "pathetic", "disgusting", "clown", "dumb", "filthy", "vermin", "hate")
PHRASES = ("shut up", "go away", "get lost", "nobody likes", "kill yourself")
WORD = re.compile(r"[^\W\d_]+")
PATTERNS = (
    re.compile(r"\byou(?:'re| are) (?:an? |such |so |all )*(?:" + "|".join(FIXED_WORDS) + r")\b"),
    re.compile(r"\b(?:" + "|".join(FIXED_WORDS) + r")\b[^.!?]{0,80}\b(?:" + "|".join(FIXED_WORDS) + r")\b"),
    re.compile(r"\b(?:" + "|".join(PHRASES) + r")\b"),
    re.compile(r"!{3,}"),
)


def terms_of(text: str) -> Counter:
    """Counts of words and of beginnings (marked *) of a lower-case text."""
    out: Counter = Counter()
    for w, n in Counter(WORD.findall(text)).items():
        out[w] += n
        for k in BEGINNINGS:
            if len(w) > k:
                out[w[:k] + "*"] += n
    return out


def _count_terms(batches):
    """Documents that hold a term, by class."""
    for piece in text_slices(batches, 1 << 20):
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, y in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist(), strict=True):
            seen[y].update(terms_of((text or "").lower()).keys())
        terms = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([seen[y][t] for t in terms], pa.int64()) for y in (1, 0))], names=["term", "toxic", "clean"])


class Scorer:
    """Terms with their voter, and the weights of the linear classifier."""

    def __init__(self, terms: list[str], voters: np.ndarray, n_voters: int):
        self.terms, self.voters, self.n_lexicon = terms, voters, n_voters
        self.index = {t: i for i, t in enumerate(terms)}
        self.lengths = sorted({len(t) - 1 for t in terms if t.endswith("*")})
        self.weights, self.bias = np.zeros(len(terms) + self.n_voters), -np.inf

    @property
    def n_voters(self) -> int:
        return self.n_lexicon + 2 + len(PATTERNS)

    def features(self, text: str | None) -> tuple[list[int], list[float], np.ndarray]:
        """Indices and values of term features, and the votes (1 toxic, -1 clean, 0)."""
        low = (text or "").lower()
        votes = np.zeros(self.n_voters)
        counts: dict[int, int] = {}
        words = Counter(WORD.findall(low))
        get = self.index.get
        for w, n in words.items():
            i = get(w)
            if i is not None:
                counts[i] = counts.get(i, 0) + n
            for k in self.lengths:
                if len(w) <= k:
                    break
                i = get(w[:k] + "*")
                if i is not None:
                    counts[i] = counts.get(i, 0) + n
        at = sorted(counts)
        value = np.log1p([counts[i] for i in at]).tolist()
        votes[self.voters[at]] = 1
        fixed = sum(words[w] for w in FIXED_WORDS if w in words)
        votes[self.n_lexicon] = 1 if fixed > 1 else 0
        # A pattern is looked for where the text holds what it cannot match without.
        needed = (fixed, fixed, any(p in low for p in PHRASES), "!!!" in low)
        for k, p in enumerate(PATTERNS):
            votes[self.n_lexicon + 2 + k] = 1 if needed[k] and p.search(low) else 0
        votes[self.n_lexicon + 1] = -1 if not counts and not fixed and not votes[self.n_lexicon + 2 :].any() else 0
        return at, value, votes

    def score(self, text: str | None) -> float:
        if self.bias == -np.inf:
            return 0.0
        at, value, votes = self.features(text)
        z = self.bias + float(np.dot(self.weights[at], value)) + float(np.dot(self.weights[len(self.terms) :], votes))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row of votes; accuracies P(vote | class), as
    [voter, class, vote]; and correlations [voter, voter] within the classes."""
    n, m = votes.shape
    which = (votes + 1).astype(int)
    post = np.clip(0.5 + 0.5 * np.sign(votes.sum(1)), 0.02, 0.98)
    onehot = np.stack([which == k for k in range(3)], axis=2).astype(float)
    correlation = np.eye(m)
    table_ = np.zeros((m, 2, 3))
    for _ in range(rounds):
        weight = np.stack([1 - post, post])
        for y in (0, 1):
            table_[:, y] = (np.einsum("n,nmk->mk", weight[y], onehot) + 0.1) / (weight[y].sum() + 0.3)
        spread = np.zeros((m, m))
        for y in (0, 1):
            mean = (weight[y] @ votes) / max(weight[y].sum(), 1e-9)
            d = votes - mean
            spread += (d * weight[y][:, None]).T @ d
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        correlation = spread / scale[:, None] / scale[None, :]
        shared = np.where(correlation > 0.1, correlation, 0.0)
        np.fill_diagonal(shared, 0.0)
        share = 1 / (1 + shared.sum(1))
        share /= share.mean()
        evidence = np.log(table_[:, 1]) - np.log(table_[:, 0])
        z = np.log(prior / (1 - prior)) + (share[None, :] * np.take_along_axis(evidence[None], which[:, :, None], axis=2)[:, :, 0]).sum(1)
        new = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post, table_, correlation


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 400, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam, from zero, over all rows a step."""
    w, b = np.zeros(x.shape[1], dtype=x.dtype), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    y = y.astype(x.dtype)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40)))
        g = np.append(x.T @ (p - y) / len(y) + ridge * w, (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1].astype(x.dtype), b - step[-1]
    return w.astype(float), float(b)


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n1: int, n0: int, least: float = LEAST) -> list[str]:
    """Terms by a cautious estimate of the logarithm of how much more often toxic texts
    hold them. A term is left out where a chosen beginning of it is about as telling, and
    a beginning where it tells little beyond the chosen terms that it begins."""

    def odds(n: float, c: float) -> float:
        return np.log((n + 0.5) / (n1 + 1)) - np.log((c + 0.5) / (n0 + 1))

    def sure(n: float, c: float) -> float:
        return odds(n, c) - 1.5 * np.sqrt(1 / (n + 0.5) + 1 / (c + 0.5))

    of = {t: (n, clean.get(t, 0)) for t, n in toxic.items()}
    value = {t: sure(*nc) for t, nc in of.items()}
    chosen: dict[str, float] = {}
    inside: dict[str, list[int]] = {}
    for t in sorted((t for t in of if value[t] >= least), key=lambda t: (-value[t], len(t), t)):
        n, c = of[t]
        stem = t.rstrip("*")
        above = [stem[:k] + "*" for k in BEGINNINGS if k < len(stem) or (k == len(stem) and t == stem)]
        if any(chosen.get(b, -np.inf) >= odds(n, c) - 0.7 for b in above):
            continue
        n_in, c_in = inside.get(t, (0, 0))
        if n_in and sure(max(0, n - n_in), max(0, c - c_in)) < least:
            continue
        chosen[t] = odds(n, c)
        for b in above:
            held = inside.setdefault(b, [0, 0])
            held[0] += n
            held[1] += c
    return list(chosen)


def _featurise(scorer: Scorer):
    def run(batches):
        for batch in batches:
            rows = [scorer.features(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64())), batch.column("toxic"), batch.column("h")]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "value", "votes", "toxic", "h"])

    return run


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Scorer:
    """Fit on docs (doc_id, text) with labels (doc_id, toxic); the caller chooses the rows
    that may be learnt from. Only bounded results reach the driver: terms of the sample that
    are far more frequent in its toxic texts, and the features of max_toxic + max_clean rows."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    chosen = [marks.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(n) for y, n in ((1, max_toxic), (0, max_clean))]
    ids = materialise(spark, chosen[0].unionAll(chosen[1]), "labelled")
    sample = materialise(spark, docs.join(F.broadcast(ids), "doc_id").select("text", "toxic"), "sample")
    sizes = dict(sample.groupBy("toxic").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    scorer = Scorer([], np.zeros(0, dtype=int), 1)
    if not n1 or not n0:
        return scorer
    counts = sample.mapInArrow(_count_terms, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    often = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    telling = counts.where((F.col("toxic") >= max(5, n1 // 200)) & (often >= LEAST)).collect()
    toxic, clean = {r.term: r.toxic for r in telling}, {r.term: r.clean for r in telling}
    ranked = choose_terms(toxic, clean, n1, n0)
    kinds: dict[str, int] = {}
    voters = []
    for rank, t in enumerate(ranked):
        kind = f"{len(t) if t.endswith('*') else 'word'}/{min(2, 3 * rank // max(1, len(ranked)))}"
        voters.append(kinds.setdefault(kind, len(kinds)))
    scorer = Scorer(ranked, np.array(voters, dtype=int), max(1, len(kinds)))
    # In a fixed order, so that sums of the fit, and scores, are the same in every run.
    kinds_ = "at array<int>, value array<double>, votes array<double>, toxic int, h long"
    rows = sample.select("text", "toxic", F.xxhash64("text").alias("h")).mapInArrow(_featurise(scorer), kinds_).toArrow().sort_by([("h", "ascending"), ("toxic", "ascending")])
    votes = np.array(rows.column("votes").to_pylist())
    x = np.zeros((len(votes), len(ranked)), dtype=np.float32)
    for i, (at, value) in enumerate(zip(rows.column("at").to_pylist(), rows.column("value").to_pylist(), strict=True)):
        x[i, at] = value
    given = 2.0 * rows.column("toxic").to_numpy() - 1
    post, _, _ = label_model(np.hstack([votes, given[:, None]]), n1 / (n1 + n0))
    scorer.weights, scorer.bias = logistic(np.hstack([x, votes.astype(np.float32)]), post)
    return scorer


def score(docs: DataFrame, scorer: Scorer, limit: float = LIMIT, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with two columns added, the score and whether it reaches the limit; columns of
    these names are replaced."""
    others = [c for c in docs.columns if c not in names]
    kept = docs.select(*[f"`{c}`" for c in others])

    def run(batches):
        for piece in text_slices(batches, 1 << 20):
            s = [scorer.score(t) for t in piece.column("text").to_pylist()]
            columns = [*piece.columns, pa.array(s, pa.float64()), pa.array([int(v >= limit) for v in s], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{kinds}, `{names[0]}` double, `{names[1]}` int")


def learnable(rows: DataFrame) -> DataFrame:
    return rows.where(stable_bucket(F.col("doc_id"), 4) != 2)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = fit(spark, docs, learnable(table(spark, sf_dir, "labels")))
    out = score(docs, scorer)
    return out.select("doc_id", (stable_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    scorer = fit(spark, docs.select("doc_id", "text"), learnable(labels))
    names = ("__toxic_score", "__toxic")
    return score(docs, scorer, names=names).where("__toxic = 0").select(*[f"`{c}`" for c in docs.columns])
