"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and texts of unknown kind train a linear classifier in numpy. Its risk estimator
corrects for the toxic share (the class prior) among the unlabelled: prior * risk of the positives + the
unlabelled's risk as negatives, less the positives' part of it, held at zero from below.

Features are distinct words and the beginnings of words, hashed. A feature enters the classifier if it is
markedly commoner among the positives than among the unlabelled. The class prior is the toxic share of the
labelled rows that are there. It moves the intercept a lot and the order of texts hardly at all, so the
threshold is set on confirmed texts of both kinds that were kept out of the fit. The fit uses a sample of at
most about MAX_POSITIVES, MAX_UNLABELLED and twice MAX_CALIBRATION different texts, chosen by hashes of id and
text; everything is scored.

Defined results: a null or empty text has no features and gets the intercept's score; texts of any length
are read whole. Of several labels of one id the highest counts, null labels are no labels, and repeated
rows are scored alike. Without any confirmed toxic text every score is 0, and without confirmed texts of
both kinds to set it on, the threshold is the estimator's own. Extra columns pass through `scored` and
`keep`. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewell.llm.common import fold, settled

MAX_POSITIVES, MAX_UNLABELLED, MAX_CALIBRATION = 4000, 16000, 4000
CALIBRATED = 0.25  # of the labelled texts, to set the threshold
POSITIVE, UNLABELLED, TOXIC, CLEAN = 1, 0, 2, 3  # parts of the sample
BUCKETS = 1 << 18
STEMS = (3, 4, 5, 6, 7)
MARKED = 5.0  # standard errors between the shares of positives and unlabelled texts with a feature
MAX_FEATURES = 4096
CACHED_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    return [zlib.crc32(s.encode()) % BUCKETS for s in ("=" + word, *(word[:n] for n in STEMS if len(word) >= n))]


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """parts, feats: a text's features, each as often as distinct words have it."""
    known: dict[str, list[int]] = {}
    for batch in batches:
        if len(known) > CACHED_WORDS:
            known.clear()
        out = []
        for text in batch["text"]:
            mine: list[int] = []
            for w in words(text):
                if (f := known.get(w)) is None:
                    f = known[w] = word_features(w)
                mine += f
            out.append(np.array(mine, dtype=np.int32))
        yield pd.DataFrame({"parts": batch["parts"], "feats": out})


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per partition: how many positives and unlabelled texts have each feature."""
    found = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for part, feats in zip(batch["part"], batch["feats"]):
            found[part][np.unique(feats)] += 1
    some = np.flatnonzero(found.sum(0))
    yield pd.DataFrame({"feat": some.astype(np.int32), "pos": found[1][some], "unl": found[0][some]})


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], features: int, prior: float,
        strength: float = 1e-3, rate: float = 0.05, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch gradient steps (Adam). Each text is an array of feature numbers.
    While the corrected negative risk is below zero only the positives' risk is followed."""
    def side(texts):
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        feat = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts] or [np.zeros(0, dtype=np.int64)])
        return feat, row, len(texts)

    (fu, ru, nu), (fp, rp, n_pos) = side(unlabelled), side(positive)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    w = np.zeros(features + 1)
    w[-1] = odds = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        zu = np.bincount(ru, w[fu], nu) + w[-1]
        zp = np.bincount(rp, w[fp], n_pos) + w[-1]
        su, sp = sigmoid(zu), sigmoid(zp)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gu, gp = np.zeros(nu), -prior * (1 - sp) / n_pos
        if negative_risk >= 0:
            gu, gp = su / nu, gp - prior * sp / n_pos
        g = np.append(np.bincount(fu, gu[ru], features) + np.bincount(fp, gp[rp], features) + strength * w[:-1],
                      gu.sum() + gp.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        w[-1] = min(w[-1], odds)  # a text without any feature is no likelier toxic than texts on the whole
    return w[:-1], float(w[-1])


def offset(toxic: np.ndarray, clean: np.ndarray) -> float:
    """The score that best tells toxic from clean texts, midway between two of theirs: the most toxic ones above
    it less clean ones above it, as shares. Of several the highest, which leaves most clean texts alone."""
    scores = np.unique(np.concatenate([toxic, clean]))
    cuts = np.concatenate([scores[:1] - 1, (scores[1:] + scores[:-1]) / 2, scores[-1:] + 1])
    above = lambda side: 1 - np.searchsorted(np.sort(side), cuts) / len(side)
    gain = above(toxic) - above(clean)
    return float(cuts[gain >= gain.max() - 1e-12][-1])


def sampled(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[DataFrame, float] | None:
    """(part, feats) of the texts to learn from, and the toxic share of the labelled rows; None without a
    confirmed toxic text. Rows with the same id and text are one, so a hot id or text takes one place; the
    parts are drawn by hashes of their own, and no label of fold 0 is looked at."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0)).groupBy(
        F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.where(fold(F.col("doc_id"), folds) != 0).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    ids = settled(rows.groupBy("doc_id", "h").agg(F.count("*").alias("n")).join(
        known, F.col("doc_id") == F.col("id"), "left").select("h", "n", "toxic"))
    counts = ids.agg(F.count("*").alias("texts"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"),
                     F.sum(F.when(F.col("toxic") == 1, F.col("n"))).alias("toxic_rows"),
                     F.sum(F.when(F.col("toxic").isNotNull(), F.col("n"))).alias("labelled_rows")).first()
    if not counts["toxic"]:
        return None
    place = lambda name: F.pmod(F.xxhash64(F.lit(name), "h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    aside = place("aside") < CALIBRATED  # confirmed texts that set the threshold are not fitted
    drawn = lambda name, most, of: place(name) < min(1.0, most / max(1, of))
    part = F.array_compact(F.array(
        F.when((F.col("toxic") == 1) & ~aside & drawn("positive", MAX_POSITIVES, counts["toxic"] * (1 - CALIBRATED)), POSITIVE),
        F.when(drawn("unlabelled", MAX_UNLABELLED, counts["texts"]), UNLABELLED),
        F.when((F.col("toxic") == 1) & aside & drawn("toxic", MAX_CALIBRATION, counts["toxic"] * CALIBRATED), TOXIC),
        F.when((F.col("toxic") == 0) & aside & drawn("clean", MAX_CALIBRATION, counts["clean"] * CALIBRATED), CLEAN)))
    chosen = ids.select("h", part.alias("parts")).where(F.size("parts") > 0)  # bounded: the four sizes together
    texts = rows.select("text", "h").join(F.broadcast(chosen), "h").groupBy("h").agg(
        F.first("text").alias("text"), F.first("parts").alias("parts"))
    feats = settled(texts.select("parts", "text").mapInPandas(_featured, "parts array<int>, feats array<int>"))
    return (feats.select(F.explode("parts").alias("part"), "feats"),
            min(0.5, max(0.001, counts["toxic_rows"] / counts["labelled_rows"])))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[dict[int, float], float] | None:
    """Weights by bucket and the intercept, from rows outside fold 0; None without a confirmed toxic text."""
    sample = sampled(docs, labels, folds)
    if sample is None:
        return None
    feats, prior = sample
    sizes = {r["part"]: r["count"] for r in feats.groupBy("part").count().collect()}
    n_pos, n_unl = sizes.get(POSITIVE, 0), sizes.get(UNLABELLED, 0)
    if not n_pos or not n_unl:
        return None
    counts = feats.where(F.col("part").isin(POSITIVE, UNLABELLED)).mapInPandas(_counted, "feat int, pos long, unl long").groupBy(
        "feat").agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))
    usual = (F.col("unl") + 1) / F.lit(n_unl + 2.0)
    marked = (F.col("pos") / F.lit(float(n_pos)) - usual) / F.sqrt(usual * (1 - usual) * (1 / n_pos + 1 / n_unl))
    chosen = counts.where("pos >= 3").withColumn("marked", marked).where(F.col("marked") > MARKED).orderBy(
        F.desc("marked"), "feat").limit(MAX_FEATURES).collect()
    number = {r["feat"]: i for i, r in enumerate(chosen)}

    def chosen_only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["feats"] = [[number[f] for f in feats if f in number] for feats in batch["feats"]]
            yield batch

    texts = feats.mapInPandas(chosen_only, "part int, feats array<int>").collect()  # of bounded number and length
    # the order of partitions must not show in sums of floats
    side = lambda part: sorted(sorted(r["feats"]) for r in texts if r["part"] == part)
    weights, intercept = fit(side(POSITIVE), side(UNLABELLED), len(chosen), prior)
    toxic, clean = (np.array([weights[f].sum() for f in side(part)]) for part in (TOXIC, CLEAN))
    if len(toxic) and len(clean):  # the estimator ranks well whatever the prior; where to cut follows from labels
        intercept = -offset(toxic, clean)
    return {f: float(weights[i]) for f, i in number.items()}, intercept


def scored(docs: DataFrame, model: tuple[dict[int, float], float] | None) -> DataFrame:
    """row (all columns of docs), score."""
    rows = docs.select(F.struct("*").alias("row"))
    if model is None:
        return rows.withColumn("score", F.lit(0.0))
    weights, intercept = model

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for batch in batches:
            if len(known) > CACHED_WORDS:
                known.clear()
            out = []
            for text in batch:
                marked = []
                for w in words(text):
                    if (s := known.get(w)) is None:
                        s = known[w] = sum(weights.get(f, 0.0) for f in word_features(w))
                    if s:
                        marked.append(s)
                out.append(math.fsum(marked) + intercept)  # the same in any order of words
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -40, 40))))

    return rows.withColumn("score", score("row.text"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold, unchanged."""
    return scored(docs, train(docs, labels)).where(F.col("score") < threshold).select("row.*")


def query(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    rows = docs.select("doc_id", "text")
    return scored(rows, train(rows, labels, folds)).select(
        "row.doc_id", (fold(F.col("row.doc_id"), folds) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
