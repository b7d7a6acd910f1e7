"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier in numpy is trained from confirmed toxic documents and
unlabelled text; no text is taken to be clean. With class prior ``pi`` and
logistic loss, the risk is ``pi * Rp+ + max(0, Ru- - pi * Rp-)``: where the
second part, the risk on what is not toxic, falls below zero, its gradient is
turned round, so the classifier can't fit the positives by heart. The step of
least risk is kept.

The prior is estimated on the unlabelled text: a set of documents that holds a
share ``p`` of the toxic and ``u`` of all can't hold more toxic ones than it has,
so ``pi <= u / p``; the least such bound over the sets with at least k features
counts. By the same shares the chance of a document without a feature follows,
which bounds the bias.

Features are the words of a document and their first and last letters, present
or not. Which of them are used is counted by Spark over the training sample, in
each language by itself: the ones that toxic documents hold more often than
chance explains. The sample itself is bounded by ``POSITIVES`` and
``UNLABELLED`` documents, dealt evenly to the languages as far as these have
them, the ones whose hashed ids are lowest; weights restore each language's
share in the risk. Every document is scored, whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strata.llm.common import saved, small_batches, worker_cache

POSITIVES = 2000
UNLABELLED = 8000
#: Features used at most, the surest of each language first.
FEATURES = 4096
#: Languages that are told apart at most; rarer ones count as one.
LANGUAGES = 1000
EDGES = (4, 5, 6)
STEPS = 400
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.3
#: Words whose sum of weights a worker remembers at most.
REMEMBERED = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}-" for n in EDGES if len(word) >= n), *(f"-{word[-n:]}" for n in EDGES if len(word) >= n)]


def found(text: str | None) -> set[str]:
    """The features of a text; null has none."""
    return {f for w in set(_WORD.findall((text or "").lower())) for f in features(w)}


def in_fold(folds: int, number: int):
    """Whether crc32 of doc_id as text leaves ``number``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == number, F.lit(False))


def quota(counts: list[int], most: int) -> int:
    """What each may take at most so that all together take ``most`` at most, 1 at least."""
    left = most
    for no, count in enumerate(sorted(counts)):
        if count * (len(counts) - no) > left:
            return max(1, left // (len(counts) - no))
        left -= count
    return max([1, *counts])


def _drawn(ids: DataFrame, most: int) -> DataFrame:
    """(doc_id, lang, weight): about ``most`` of the ids, of each language the lowest by hash.

    A weight is the share of the language among all ids, over how many of it are
    drawn. Of each language a share of the hashes that holds twice as many as
    are wanted is cut off first, so tasks do not each bring as many.
    """
    counts = ids.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).collect()
    total = max(1, ids.count())
    sizes = {r["lang"]: r["count"] for r in counts}
    if rest := total - sum(sizes.values()):
        sizes[None] = rest
    each = quota(list(sizes.values()), most)
    top = (1 << 64) - 1025
    plan = [
        (lang, int(-(1 << 63) + min(1.0, (2 * each + 20) / n) * top), n / total / min(n, each)) for lang, n in sizes.items()
    ]
    spark = ids.sparkSession
    known = F.broadcast(spark.createDataFrame(plan, "_lang string, _cut long, weight double"))
    own = ids.withColumn("lang", F.when(F.col("lang").isin(*[x for x in sizes if x is not None]), F.col("lang")))
    few = own.withColumn("_h", F.xxhash64("doc_id")).join(known, F.col("lang").eqNullSafe(F.col("_lang")))
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    return (
        few.where("_h <= _cut")
        .withColumn("_no", F.row_number().over(order))
        .where(F.col("_no") <= each)
        .select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "weight")
    )


def _training(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(text, lang, positive, weight) of the sample, and the share of toxic documents among labelled ones."""
    known = labels.where(~in_fold(4, 2) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    lang = F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")
    # repeated rows of an id count as one, of its first language
    ids = docs.where(~in_fold(4, 2) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(lang).alias("lang"))
    toxic = _drawn(known.where("toxic = 1").select("doc_id").distinct().join(ids, "doc_id"), POSITIVES)
    every = _drawn(ids, UNLABELLED)
    chosen = toxic.withColumn("positive", F.lit(True)).unionByName(every.withColumn("positive", F.lit(False)))
    # about POSITIVES + UNLABELLED ids, so the broadcast is bounded
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").drop("doc_id"), share or 0.0


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worker_cache("toxicity")
    tally: dict[tuple[str, bool], Counter] = {}

    def out():
        for (lang, positive), counter in tally.items():
            yield pd.DataFrame({"lang": lang, "feature": [*counter], "positive": positive, "n": [*counter.values()]})
        tally.clear()

    for batch in batches:
        for text, lang, positive in zip(batch["text"], batch["lang"], batch["positive"], strict=True):
            # a document counts under the empty feature
            tally.setdefault((lang, positive), Counter()).update(found(text) | {""})
        if sum(map(len, tally.values())) > 500_000:
            yield from out()
    yield from out()


def _choose(sample: DataFrame) -> list[str]:
    """The features that toxic documents of a language hold more often than chance explains.

    With ``e`` toxic documents expected to hold a feature by its rate in
    unlabelled ones, at least ``p`` do with a chance below
    ``exp(-(p * ln(p / e) - p + e))``. It is used if that times the number of
    words tried in the language is 1 at most, so a language with few toxic
    documents has its own bar. What two of them do not share shows nothing, and
    does not count as tried; nor do edges, which try much the same as their words.
    """
    counts = (
        sample.mapInPandas(_count, "lang string, feature string, positive boolean, n long")
        .groupBy("lang", "feature")
        .agg(
            F.coalesce(F.sum(F.when(F.col("positive"), F.col("n"))), F.lit(0)).alias("p"),
            F.coalesce(F.sum(F.when(~F.col("positive"), F.col("n"))), F.lit(0)).alias("u"),
        )
        .where("p > 0")
    )
    counts = saved(counts, "toxicity-counts")
    whole = counts.groupBy("lang").agg(
        F.max(F.when(F.col("feature") == "", F.col("p"))).alias("n_p"),
        F.max(F.when(F.col("feature") == "", F.col("u"))).alias("n_u"),
        F.greatest(F.count_if((F.col("p") > 1) & ~F.contains("feature", F.lit("-"))), F.lit(1)).alias("tried"),
    )
    expected = F.col("n_p") * (F.col("u") + 1) / F.greatest(F.col("n_u"), F.lit(1))
    sure = F.col("p") * F.log(F.col("p") / F.col("e")) - F.col("p") + F.col("e")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("sure").desc(), "feature"))
    best = (
        counts.where("feature <> '' and p > 1")
        .join(F.broadcast(whole), "lang")
        .withColumn("e", expected)
        .where("p > e")
        .withColumn("sure", sure)
        .where(F.col("sure") >= F.log("tried"))
        .withColumn("rank", rank)
        .groupBy("feature")
        .agg(F.min("rank").alias("rank"))
        .orderBy("rank", "feature")
        .limit(FEATURES)
    )
    return sorted(r["feature"] for r in best.collect())


def prior_and_rest(held_p: np.ndarray, held_u: np.ndarray, share_p: np.ndarray, share_u: np.ndarray, known: float) -> tuple[float, float]:
    """The class prior, and the chance that a document without a feature is toxic.

    ``held`` are the features that a document holds; ``known``, the share of
    toxic labels, is the prior if no set bounds it lower. Of ``p`` a deviation is
    taken off and ``u`` counts one document more, so a set of a few documents
    shows nothing.
    """
    prior = known
    for k in range(1, int(held_p.max(initial=0)) + 1):
        p, u = share_p[held_p >= k].sum(), share_u[held_u >= k].sum()
        p -= np.sqrt(p * (1 - p) / len(held_p)) + 1 / len(held_p)
        if p > 0:
            prior = min(prior, (u + 1 / len(held_u)) / p)
    none_p, none_u = share_p[held_p == 0].sum(), share_u[held_u == 0].sum()
    return prior, min(prior, prior * (none_p + 1 / len(held_p)) / max(none_u, 1 / len(held_u)))


def fit(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    steps: int = STEPS,
    share_p: np.ndarray | None = None,
    share_u: np.ndarray | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam over all rows; rows have equal shares if none are given.

    ``prior`` is an upper bound, lowered by :func:`prior_and_rest`.
    """
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    softplus = lambda v: np.logaddexp(0, v)
    logit = lambda v: float(np.log(v / (1 - v)))
    rows = np.vstack([positive, unlabelled]).astype(np.float32)
    n_p, n_u = len(positive), len(unlabelled)
    share_p = np.full(n_p, 1 / n_p) if share_p is None else share_p / share_p.sum()
    share_u = np.full(n_u, 1 / n_u) if share_u is None else share_u / share_u.sum()
    prior, rest = prior_and_rest(positive.sum(1, dtype=int), unlabelled.sum(1, dtype=int), share_p, share_u, prior)
    prior, most = float(np.clip(prior, 1e-4, 0.9)), logit(float(np.clip(rest, 1e-4, 0.9)))
    weights, bias = np.zeros(rows.shape[1]), min(logit(prior), most)
    mean, square = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    best = (np.inf, weights, bias)
    for step in range(1, steps + 1):
        g = rows @ weights.astype(np.float32) + bias
        pull = np.zeros(len(rows))
        clean = share_u @ softplus(g[n_p:]) - prior * (share_p @ softplus(g[:n_p]))
        risk = prior * (share_p @ softplus(-g[:n_p])) + max(0.0, clean) + DECAY / 2 * float(weights @ weights)
        if risk < best[0]:
            best = (risk, weights, bias)
        negative = np.concatenate([-prior * sigmoid(g[:n_p]) * share_p, sigmoid(g[n_p:]) * share_u])
        pull[:n_p] = -prior * sigmoid(-g[:n_p]) * share_p
        pull = pull + negative if clean >= 0 else -negative
        slope = np.append(pull.astype(np.float32) @ rows + DECAY * weights, pull.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], min(bias - move[-1], most)
    return best[1], float(best[2])


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """A weight per feature, and the bias.

    Without toxic documents to learn from there are no features, and the bias
    follows from the share of toxic labels alone.
    """
    small_batches(docs.sparkSession)
    sample, share = _training(docs, labels)
    sample = saved(sample, "toxicity-sample")
    prior = min(max(share, 1e-3), 0.9)
    chosen = _choose(sample)
    if not chosen:
        return {}, float(np.log(prior / (1 - prior)))
    place = {f: i for i, f in enumerate(chosen)}

    def seen(batches):
        worker_cache("toxicity")
        for batch in batches:
            yield pd.DataFrame(
                {"positive": batch["positive"], "weight": batch["weight"], "at": [sorted(place[f] for f in found(t) & place.keys()) for t in batch["text"]]}
            )

    got = sample.mapInPandas(seen, "positive boolean, weight double, at array<int>").toPandas()
    matrix = np.zeros((len(got), len(chosen)), np.uint8)
    for row, at in enumerate(got["at"]):
        matrix[row, np.asarray(at, int)] = 1
    is_positive = got["positive"].to_numpy(bool)
    # rows in one order, whatever order they came in, so that reruns agree
    weight = got["weight"].to_numpy(float)
    order = np.lexsort((weight, *matrix.T[:64], matrix.sum(1)))
    matrix, is_positive, weight = matrix[order], is_positive[order], weight[order]
    weights, bias = fit(
        matrix[is_positive], matrix[~is_positive], prior, share_p=weight[is_positive], share_u=weight[~is_positive]
    )
    return {f: float(w) for f, w in zip(chosen, weights, strict=True)}, bias


def scorer(weights: dict[str, float], bias: float):
    """A function from a text to its score; null counts as empty."""
    used: dict[str, tuple[str, ...]] = {}

    def of(word: str) -> tuple[str, ...]:
        got = used.get(word)
        if got is None:
            if len(used) >= REMEMBERED:
                used.clear()
            got = used[word] = tuple(f for f in features(word) if f in weights)
        return got

    def score(text: str | None) -> float:
        present: set[str] = set()
        for word in set(_WORD.findall((text or "").lower())):
            present.update(of(word))
        g = bias + sum(weights[f] for f in sorted(present))
        return float(1 / (1 + np.exp(-np.clip(g, -500, 500))))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Labels with a null id or mark are left out, as are those of the held-out
    fold. Repeated rows are scored each; other columns of both tables are
    ignored.
    """
    weights, bias = train(docs, labels)

    def run(batches):
        worker_cache("toxicity")
        score = scorer(weights, bias)
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": [score(t) for t in batch["text"]]}
            )

    # the id kept as it is, also where it is null
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), in_fold(4, 2).alias("held_out"), "text")
    return rows.mapInPandas(run, "doc_id string, held_out boolean, score double").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "held_out",
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns."""
    weights, bias = train(docs, labels)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("toxicity")
        score = scorer(weights, bias)
        for batch in texts:
            yield pd.Series([score(t) for t in batch], dtype="float64")

    return docs.where(F.pandas_udf(run, DoubleType())("text") < threshold)
