"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, other texts are unlabelled. A linear model over hashed
words minimises the class-prior-corrected risk

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

with the logistic loss. Where the second term falls below zero the model has begun to fit the
unlabelled texts one by one, and the step goes up that term instead.
"""

import string
import zlib
from collections.abc import Iterator
from itertools import chain
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.llm import common
from ferrocar.llm.sparse import Rows
from ferrocar.session import stage

# Inflected and compounded words are also known by so many first letters.
HEADS = (4, 5)
# Features count that differ by so many standard errors between the two samples.
CLEAR = 4.0
# The fit takes at most so many confirmed and unlabelled rows, those first by a hash of their id, and the
# clearest features.
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 3_000, 6_000, 20_000
FOLDS, HELD_OUT, CUT = 4, 2, 0.3


def hashes(token: str) -> tuple[int, ...]:
    """Hashes of a token's lower-case form without outer punctuation, and of its first letters."""
    word = token.lower().strip(string.punctuation)
    heads = [word[:n] + "-" for n in HEADS if len(word) > n]
    return tuple(zlib.crc32(x.encode()) for x in [word, *heads] if x)


def features(text: str | None, memo: common.Memo) -> set[int]:
    """The distinct features of a text's words; ``memo`` gives those of a word."""
    return set(chain.from_iterable(map(memo.__getitem__, set((text or "").split()))))


class Model:
    """Weights of the features that tell toxic from other texts, and the bias."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    def known(self, token: str) -> tuple[int, ...]:
        return tuple(m for m in hashes(token) if m in self.weights)

    def score(self, text: str | None, memo: common.Memo) -> float:
        f = self.bias + sum(self.weights[m] for m in sorted(features(text, memo)))
        return 1 / (1 + exp(-min(max(f, -30.0), 30.0)))


def train(positive: Rows, unlabelled: Rows, prior: float, rounds: int = 300, speed: float = 0.05, decay: float = 1e-4) -> Model:
    """The model of rows of features. Without positives or unlabelled rows it is the prior alone."""
    bias = float(np.log(prior / (1 - prior)))
    n, m = len(positive), len(unlabelled)
    if not n or not m:
        return Model({}, bias)
    # Only features whose rate among the positives differs by CLEAR standard errors can tell.
    names, place = np.unique(np.r_[positive.cols, unlabelled.cols], return_inverse=True)
    often, other = (np.bincount(p, minlength=len(names)).astype(float) for p in np.split(place, [len(positive.cols)]))
    rate = (often + other) / (n + m)
    error = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n + 1 / m))
    used = np.flatnonzero((np.abs(often / n - other / m) > CLEAR * error) & (often + other >= 3))
    at = np.full(len(names), -1)
    at[used] = np.arange(len(used))

    def compact(rows: Rows, cols: np.ndarray):
        row = np.repeat(np.arange(len(rows)), np.diff(rows.start))
        ok = at[cols] >= 0
        return at[cols][ok], row[ok], len(rows)

    pos, unl = compact(positive, place[: len(positive.cols)]), compact(unlabelled, place[len(positive.cols) :])

    def score(rows, w, b):
        return np.bincount(rows[1], w[rows[0]], rows[2]) + b

    def pull(rows, by):
        return np.bincount(rows[0], by[rows[1]], len(used)), by.sum()

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    w, b = np.zeros(len(used)), bias
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, rounds + 1):
        fp, fu = score(pos, w, b), score(unl, w, b)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # Derivatives: the loss of a positive as negative, of an unlabelled row as negative, of a positive.
        gp, bp = pull(pos, -prior * sigmoid(fp) / pos[2])
        gu, bu = pull(unl, sigmoid(fu) / unl[2])
        if negative < 0:
            g, gb = -(gp + gu), -(bp + bu)
        else:
            gt, bt = pull(pos, -prior * sigmoid(-fp) / pos[2])
            g, gb = gp + gu + gt, bp + bu + bt
        step = np.r_[g + decay * w, gb]
        first, second = 0.9 * first + 0.1 * step, 0.999 * second + 0.001 * step**2
        move = speed * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(dict(zip(names[used].tolist(), w.tolist())), float(b))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text", key: str = "doc_id") -> Model:
    """Train on the rows of ``docs`` whose id is ``usable``; labels of other ids are not looked at.

    An id with several labels is toxic if one of them says so; null labels are none. The prior is
    the share of toxic ids among all usable labels, so the unlabelled texts are drawn from the same ids,
    whatever their label: the risk is right only if the prior is that of the unlabelled texts.
    """
    common.small_batches(docs.sparkSession)
    marks = labels.select(F.col("doc_id").alias(key), "toxic").where(usable & F.col("toxic").isNotNull())
    marks = marks.groupBy(key).agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(max(share or 0.05, 0.001), 0.5)
    order = F.xxhash64(F.col(key), F.lit(9))
    toxic = marks.where("toxic = 1").orderBy(order, key).limit(MAX_POSITIVE)
    others = marks.select(key).orderBy(F.xxhash64(F.col(key), F.lit(3)), key).limit(MAX_UNLABELLED)
    ids = toxic.select(F.col(key).alias("id"), F.lit(1).alias("positive")).union(others.select(F.col(key).alias("id"), F.lit(0)))
    # Written first: its size decides how it meets the documents, which are not shuffled for it.
    chosen = stage(ids.groupBy("id").agg(F.max("positive").alias("positive"), (F.min("positive") == 0).alias("unlabelled")), "sample")
    texts = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    found = texts.join(chosen, F.col("doc") == F.col("id")).select("text", "positive", "unlabelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = common.Memo(hashes)
        for batch in batches:
            rows = pa.array([sorted(features(t, memo)) for t in batch.column(0).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([rows, batch.column(1), batch.column(2)], ["cols", "positive", "unlabelled"])

    # Counted over the cluster, so that only features that can tell reach the driver.
    rows = stage(found.mapInArrow(run, "cols array<long>, positive int, unlabelled boolean"), "features")
    pos, unl = (F.col("positive") == 1).cast("int"), F.col("unlabelled").cast("int")
    n, m = rows.agg(F.coalesce(F.sum(pos), F.lit(0)), F.coalesce(F.sum(unl), F.lit(0))).first()
    if not n or not m:
        return train(Rows.of([], 1), Rows.of([], 1), prior)
    counts = rows.select(F.explode("cols").alias("mark"), pos.alias("pos"), unl.alias("unl")).groupBy("mark")
    counts = counts.agg(F.sum("pos").alias("often"), F.sum("unl").alias("other")).where("often + other >= 3")
    rate = (F.col("often") + F.col("other")) / F.lit(n + m)
    clear = F.abs(F.col("often") / n - F.col("other") / m) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * (1 / n + 1 / m))
    telling = counts.withColumn("clear", clear).where(F.col("clear") > CLEAR).orderBy(F.desc("clear"), "mark").limit(MAX_FEATURES)
    known = docs.sparkSession.sparkContext.broadcast(np.array(sorted(r["mark"] for r in telling.select("mark").collect()), np.int64))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c[np.isin(c, known.value)] for c in (np.array(x, np.int64) for x in batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(cols, pa.list_(pa.int64())), *batch.columns[1:]], batch.schema.names)

    sample = rows.mapInArrow(keep, rows.schema).toPandas()

    def sparse(of: pd.DataFrame) -> Rows:
        return Rows.of([(np.asarray(c, np.int64), np.ones(len(c), np.float32)) for c in of["cols"]], 1 << 32)

    return train(sparse(sample[sample["positive"] == 1]), sparse(sample[sample["unlabelled"] == True]), prior)  # noqa: E712


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """A column with the probability that a row's text is toxic; of a null or empty text, by the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = common.Memo(shared.value.known)
        for part in parts:
            yield pd.Series([shared.value.score(t, memo) for t in part], dtype=float)

    return run(F.col(text).cast("string"))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Labels of rows whose fold is ``HELD_OUT`` are never learnt from; a null id is not held out.
    Other columns are ignored; without labels every score is the prior.
    """
    apart = F.coalesce(common.fold(key, FOLDS) == HELD_OUT, F.lit(False))
    model = fit(docs, labels, common.fold(key, FOLDS) != HELD_OUT, text, key)
    rows = docs.select(F.col(key).alias("doc_id"), apart.alias("held_out"), score(model, docs, text).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = fit(docs, labels, common.fold(key, FOLDS) != HELD_OUT, text, key)
    return docs.withColumn("__toxic", score(model, docs, text)).where(F.col("__toxic") < CUT).drop("__toxic")
