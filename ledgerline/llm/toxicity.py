"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Confirmed toxic documents are the positive sample, documents drawn from the whole training fold the unlabelled one. The
risk is prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)]): the second part is what negatives would
lose, estimated without any confirmed negative; where it falls below zero the step climbs back instead. Features are the
presence of words and of character 4- and 5-grams within words; Spark counts them over both samples and keeps those that
set the two apart most. A linear model with the logistic loss is fitted in numpy and applied to whole texts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, give_back, held_out, only_cache

LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str) -> set[str]:
    """A word's features: the word between its borders, and its character 4- and 5-grams."""
    w = f"^{word}$"
    return {w} | {w[i : i + n] for n in (4, 5) for i in range(len(w) - n + 1)}


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall((text or "").lower()))


class Model:
    """Weights by feature; most_kept bounds the table of words already looked up."""

    def __init__(self, features: list[str], weights: np.ndarray, bias: float, most_kept: int = 150_000):
        self.index = {f: i for i, f in enumerate(features)}
        self.weights, self.bias, self.most_kept = weights.tolist(), float(bias), most_kept
        self.words: dict[str, tuple[int, ...]] = {}

    def hits(self, text: str | None) -> set[int]:
        known, out = self.words, set()
        if len(known) > self.most_kept:
            known.clear()
        for w in words_of(text):
            found = known.get(w)
            if found is None:
                found = known[w] = tuple(i for g in grams(w) if (i := self.index.get(g)) is not None)
            if found:
                out.update(found)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[i] for i in self.hits(text))
        return 1 / (1 + np.exp(-z)) if z > -700 else 0.0


def fit_nnpu(x_pos: np.ndarray, x_unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, ridge: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss, by Adam on the whole samples."""
    d = x_pos.shape[1]
    x_pos, x_unl = x_pos.astype(np.float32), x_unl.astype(np.float32)
    w = np.zeros(d + 1, np.float32)
    w[d] = np.log(prior / (1 - prior))
    m, v = np.zeros(d + 1, np.float32), np.zeros(d + 1, np.float32)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def grad(x, g):
        return np.r_[g.astype(np.float32) @ x, g.sum()].astype(np.float32) / max(len(x), 1)

    for t in range(1, steps + 1):
        zp, zu = x_pos @ w[:d] + w[d], x_unl @ w[:d] + w[d]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_negative = grad(x_unl, sigmoid(zu)) - prior * grad(x_pos, sigmoid(zp))
        g = prior * grad(x_pos, sigmoid(zp) - 1) + g_negative if negative >= 0 else -g_negative
        g[:d] += ridge * w[:d]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:d], w[d]


def train(docs: DataFrame, labels: DataFrame, most_positive: int = 4000, most_unlabelled: int = 12_000, most_features: int = 512, least_support: int = 5, least_apart: float = 40.0) -> Model:
    """Fit on at most most_positive confirmed toxic and most_unlabelled drawn training documents (bounds of the samples
    that a classifier is fitted on; both are drawn by a hash of the id, and of rows that share an id the least text counts,
    so that the bounds hold for rows too). The class prior is the share of toxic rows among
    all labelled rows of the training fold. A feature needs least_support toxic documents and a chi-square of
    least_apart between the samples. Without a confirmed toxic document the model scores everything 0."""
    spark = docs.sparkSession
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out(F.col("doc_id")))
    toxic, all_ = labelled.agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.count(F.lit(1))).first()
    if not toxic:
        return Model([], np.zeros(0), -1e9)
    prior = min(max(toxic / all_, 1e-4), 0.9)
    mixed = F.xxhash64("doc_id", F.lit("toxicity"))
    positive = labelled.filter("toxic = 1").select("doc_id").distinct().orderBy(mixed, "doc_id").limit(most_positive).withColumn("kind", F.lit(1))
    fold = docs.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().filter(~held_out(F.col("doc_id")))
    drawn = fold.distinct().orderBy(mixed, "doc_id").limit(most_unlabelled).withColumn("kind", F.lit(0))
    picked = spark.createDataFrame(positive.unionByName(drawn).collect(), "doc_id long, kind int")  # bounded by the two parameters
    texts = checkpoint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id").groupBy("kind", "doc_id").agg(F.min("text").alias("text")).select("kind", "text"))

    def count(batches):
        only_cache("toxicity", lambda: None)
        counts = (Counter(), Counter())
        for pdf in batches:
            for kind, text in zip(pdf["kind"], pdf["text"], strict=True):
                counts[kind].update(set().union(*map(grams, words_of(text))))
            if len(counts[0]) + len(counts[1]) > 150_000:
                yield table(counts)
                counts = (Counter(), Counter())
        yield table(counts)

    def table(counts):
        rows = [(g, 0, n) for g, n in counts[0].items()] + [(g, n, 0) for g, n in counts[1].items()]
        return pd.DataFrame(rows, columns=["gram", "pos", "unl"])

    n = {r["kind"]: r["n"] for r in texts.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1):
        return Model([], np.zeros(0), -1e9)
    p, q = F.col("pos") / F.lit(n[1]), F.col("unl") / F.lit(max(n.get(0, 0), 1))
    both = (F.col("pos") + F.col("unl")) / F.lit(n[1] + n.get(0, 0))
    apart = (p - q) * (p - q) / (both * (1 - both) + F.lit(1e-6))
    best = texts.mapInPandas(count, "gram string, pos long, unl long").groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl")).filter((F.col("pos") >= least_support) & (p > q) & (apart * (n[1] * n.get(0, 0) / (n[1] + n.get(0, 0))) >= least_apart)).orderBy(apart.desc(), "gram").limit(most_features)
    features = [r["gram"] for r in best.collect()]
    look = Model(features, np.zeros(len(features)), 0.0)

    def rows(batches):
        for pdf in batches:
            yield pd.DataFrame({"kind": pdf["kind"], "hits": [sorted(look.hits(t)) for t in pdf["text"]]})

    sample = texts.mapInPandas(rows, "kind int, hits array<int>").toPandas()
    x = np.zeros((len(sample), len(features)), np.float32)
    for i, hits in enumerate(sample["hits"]):
        x[i, hits] = 1
    kind = sample["kind"].to_numpy()
    weights, bias = fit_nnpu(x[kind == 1], x[kind == 0], prior)
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, cutoff: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> all its columns and score (0 to 1) and predicted (score >= cutoff), from the whole text and nothing else.

    Null and empty texts get the score of a text without features. Repeated rows get equal scores; an empty table stays
    empty; columns named score or predicted are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most most_features strings and weights
    names = [c for c in docs.columns if c not in ("score", "predicted")]

    @F.pandas_udf("double")
    def scores(text: pd.Series) -> pd.Series:
        only_cache("toxicity", shared.value.words.clear)
        found = pd.Series([float(shared.value.score(t)) for t in text], dtype="float64")
        give_back()
        return found

    return docs.select(*names, scores(F.col(text_col)).alias("score")).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
