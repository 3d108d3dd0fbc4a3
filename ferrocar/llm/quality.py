"""Text quality by a vote of the nearest labelled texts in a latent-semantic space.

A text becomes weighted terms: the shapes of its tokens (letter case, digits, marks), how far
tokens repeat, and its hashed words. Weights are TF-IDF. A randomised singular value decomposition
of the labelled texts gives the latent space. The labelled vectors are broadcast; every text's
cosines with all of them are computed exactly, block by block, and its nearest neighbours vote with
their labels, each weighted by its similarity.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.llm import common
from ferrocar.llm.sparse import Rows, randomised_svd, unit
from ferrocar.session import stage

SHAPES, WORDS = 1 << 12, 1 << 14
REPEATED, SEEN_BEFORE = SHAPES, SHAPES + 1
WIDTH = SHAPES + 2 + WORDS
# Labelled texts that vote: those first by a hash of their id. With RANK this bounds the broadcast.
MAX_LABELLED, RANK = 4_096, 48
# Words tell the topic more than the quality, so they weigh less than shapes.
WORD_WEIGHT, REPEAT_WEIGHT = 0.15, 3.0
NEIGHBOURS, BLOCK = 25, 1_024
FOLDS, HELD_OUT, CUT = 5, 0, 0.3


def shape(token: str) -> str:
    """Classes of a token's characters, runs shortened to two marks or one letter or digit class."""
    out = ""
    for c in token[:40]:
        k = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != k or (k not in "Xx9" and out[-2:] != k + k):
            out += k
        if len(out) == 8:
            break
    return out


def code(token: str) -> int:
    """The hash buckets of a token's shape (high) and of its lower-case form (low)."""
    return zlib.crc32(shape(token).encode()) % SHAPES << 14 | zlib.crc32(token.lower().encode()) % WORDS


def terms(text: str | None, memo: common.Memo) -> tuple[np.ndarray, np.ndarray]:
    """Term columns of a text and their frequencies before the inverse document frequency."""
    tokens = (text or "").split()
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    codes = np.fromiter(map(memo.__getitem__, tokens), np.int64, n)
    shapes, count = np.unique(codes >> 14, return_counts=True)
    words, often = np.unique(codes & (WORDS - 1), return_counts=True)
    again = np.count_nonzero(codes[1:] == codes[:-1]) / n
    before = max(0.0, 1 - len(words) / n - 0.3)
    cols = np.concatenate([shapes, [REPEATED, SEEN_BEFORE], SHAPES + 2 + words])
    vals = np.concatenate([np.sqrt(count / n), [REPEAT_WEIGHT * again, REPEAT_WEIGHT * before], WORD_WEIGHT * np.sqrt(often / n)])
    return cols, vals.astype(np.float32)


class Model:
    """The latent space and the labelled vectors in it."""

    def __init__(self, idf: np.ndarray, space: np.ndarray, voters: np.ndarray, labels: np.ndarray, share: float):
        self.idf, self.space, self.voters, self.labels, self.share = idf, space, voters, labels, share

    def vectors(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return unit(Rows.of(rows, WIDTH).scaled(self.idf).dot(self.space))

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest voters; without any, the prior share."""
        out = np.full(len(vectors), self.share)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(vectors) if k else 0, BLOCK):
            sims = vectors[at : at + BLOCK] @ self.voters.T
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(float) ** 4
            total = weight.sum(axis=1)
            voted = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
            out[at : at + BLOCK] = np.where(total > 0, voted, self.share)
        return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float) -> Model:
    """The model of labelled term rows."""
    raw = Rows.of(rows, WIDTH)
    idf = np.log((1 + len(raw)) / (1 + np.bincount(raw.cols[raw.vals > 0], minlength=WIDTH))) + 1
    full = raw.scaled(idf)
    if not len(raw):
        return Model(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), labels, share)
    basis, size = randomised_svd(full, RANK)
    # Between the plain and the whitened space, so that one direction common to all does not rule.
    space = (basis / np.sqrt(np.maximum(size, 1e-6))).astype(np.float32)
    return Model(idf, space, unit(full.dot(space)).astype(np.float32), labels, share)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text", key: str = "doc_id") -> Model:
    """Train on the rows of ``docs`` that have a label and a ``usable`` id; other labels are not looked at.

    An id with several labels counts as good only if all of them say so; null labels are none.
    """
    common.small_batches(docs.sparkSession)
    marks = labels.select(F.col("doc_id").alias("id"), "quality").where(F.col("quality").isNotNull())
    marks = marks.groupBy("id").agg(F.min("quality").alias("quality"))
    usable_ids = marks.withColumnRenamed("id", key).where(usable).withColumnRenamed(key, "id")
    share = usable_ids.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    chosen = stage(usable_ids.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(MAX_LABELLED), "sample")
    known = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    found = known.join(chosen, F.col("doc") == F.col("id")).select("text", F.col("quality").cast("int"), F.col("id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = common.Memo(code)
        for batch in batches:
            rows = [terms(t, memo) for t in batch.column(0).to_pylist()]
            cols = pa.array([c for c, _ in rows], pa.list_(pa.int64()))
            vals = pa.array([v for _, v in rows], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([cols, vals, batch.column(1), batch.column(2)], ["cols", "vals", "quality", "id"])

    sample = found.mapInArrow(run, "cols array<long>, vals array<float>, quality int, id long").toPandas()
    sample = sample.sort_values("id", kind="stable")
    rows = [(np.asarray(c, np.int64), np.asarray(v, np.float32)) for c, v in zip(sample["cols"], sample["vals"])]
    return train(rows, (sample["quality"].to_numpy() == 1).astype(float), 0.5 if share is None else float(share))


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """A column with the neighbours' vote on a row's text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = common.Memo(code)
        for part in parts:
            yield pd.Series(shared.value.vote(shared.value.vectors([terms(t, memo) for t in part])), dtype=float)

    return run(F.col(text).cast("string"))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Labels of rows whose fold is ``HELD_OUT`` are never learnt from; a null id is not held out. Empty
    and null texts have no direction and get the share of label 1, as all texts do without labels.
    Other columns are ignored.
    """
    apart = F.coalesce(common.fold(key, FOLDS) == HELD_OUT, F.lit(False))
    model = fit(docs, labels, common.fold(key, FOLDS) != HELD_OUT, text, key)
    rows = docs.select(F.col(key).alias("doc_id"), apart.alias("held_out"), score(model, docs, text).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be of low quality, with all their columns."""
    model = fit(docs, labels, common.fold(key, FOLDS) != HELD_OUT, text, key)
    return docs.withColumn("__quality", score(model, docs, text)).where(F.col("__quality") >= CUT).drop("__quality")
