"""Benchmark decontamination by latent semantic retrieval.

Texts and benchmark items become sequences of the items' words; other words cannot match. Windows
of a text are passages with TF-IDF weights, whose document frequencies are counted over all passages. All
words of the items count, frequent ones by their weights alone. A randomised singular value decomposition, summed over the cluster, gives the
latent space; passages whose cosine with an item reaches NEAR are candidates. A candidate holds the
item if the longest common subsequence covers most of it, or a smaller share of it together with its
answer, which is its last sentence: so paraphrases are found as well.
"""

import re
import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.llm import common
from ferrocar.llm.sparse import Rows, unit
from ferrocar.session import stage

# Words in a passage, and between the starts of two.
WINDOW, STRIDE = 32, 16
RANK = 64
NEAR = 0.45
# Shares of an item that a text must hold in order: alone, or together with its answer.
ALONE, WITH_ANSWER, ANSWER = 0.75, 0.55, 0.8
# Words of 64 bits in which passages and items mark their words.
MARKS = 4
# At most so many items are searched for at a time.
ITEMS = 1_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")


def word(token: str) -> str:
    return token.lower().strip(string.punctuation)


class Benchmark:
    """The items' words as numbers, and the items as sequences of them. Items without words are left out."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.index: dict[str, int] = {}
        self.ids, self.seqs, self.answers = [], [], []
        for item, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
            sentences = [[w for t in s.split() if (w := word(t))] for s in _SENTENCE.split(text or "")]
            sentences = [[self.index.setdefault(w, len(self.index)) for w in s] for s in sentences if s]
            if sentences:
                self.ids.append(item)
                self.seqs.append([w for s in sentences for w in s])
                self.answers.append(sentences[-1])

    def sequence(self, text: str | None) -> np.ndarray:
        """A text's words as numbers, -1 for words of no item and for marks without letters."""
        # White space ends whatever lower() looks at around a letter, so tokens come out as from ``word``.
        tokens = (text or "").lower().split()
        words = map(str.strip, tokens, repeat(string.punctuation))
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int32, len(tokens))


def passages(seqs: list[np.ndarray], width: int) -> tuple[Rows, np.ndarray, np.ndarray]:
    """The windows that hold words of items, as rows of their counts; the sequence and the place of each."""
    sizes = np.array([len(s) for s in seqs], np.int64)
    words = np.concatenate([*seqs, np.zeros(0, np.int32)])
    owner = np.repeat(np.arange(len(seqs)), sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ok = words >= 0
    words, owner, place = words[ok].astype(np.int64), owner[ok], place[ok] // STRIDE
    # A word lies in the window that starts in its stride and in those that started before and reach it.
    offset = np.cumsum(np.r_[0, sizes // STRIDE + 1])
    back = WINDOW // STRIDE
    place = np.concatenate([place - b for b in range(back)])
    words, owner = np.tile(words, back), np.tile(owner, back)
    ok = place >= 0
    key = (offset[owner[ok]] + place[ok]) * width + words[ok]
    key, count = np.unique(key, return_counts=True)
    window, cols = key // width, key % width
    starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else np.zeros(0, np.int64)
    of = np.searchsorted(offset, window[starts], "right") - 1
    rows = Rows(np.r_[starts, len(cols)], cols, (1 + np.log(count)).astype(np.float32), width)
    return rows, of, (window[starts] - offset[of]) * STRIDE


def common_length(item: list[int], text: list[int]) -> int:
    """The length of the longest common subsequence, a bit for each word of ``item``."""
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        if w in masks:
            u = v & masks[w]
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


class Index:
    """The items in the latent space, and the checks of candidates."""

    def __init__(self, bench: Benchmark, idf: np.ndarray, space: np.ndarray):
        self.bench, self.idf, self.space = bench, idf, space
        rows = [np.unique(s, return_counts=True) for s in bench.seqs]
        rows = Rows.of([(c, (1 + np.log(n)).astype(np.float32)) for c, n in rows], len(bench.index))
        self.items = unit(rows.scaled(idf).stacked(space))
        self.bag = np.zeros((len(bench.seqs), len(bench.index)), bool)
        self.bag[np.repeat(np.arange(len(rows)), np.diff(rows.start)), rows.cols] = True
        # Of any text that holds an item, one passage holds a stride of it at least.
        whole = np.array([len(s) for s in bench.seqs])
        self.least = WITH_ANSWER * self.bag.sum(axis=1) * np.minimum(1, STRIDE / whole)
        self.wants, self.held = [np.array(s) for s in bench.seqs], np.zeros(len(bench.index), bool)
        # Each word's bit among 64 * MARKS, and all bits of each item.
        at = np.arange(len(bench.index)) % (64 * MARKS)
        self.bits = np.where(at[:, None] // 64 == np.arange(MARKS), np.uint64(1) << (at % 64).astype(np.uint64)[:, None], np.uint64(0))
        self.marks = np.bitwise_or.reduceat(self.bits[rows.cols], rows.start[:-1]) if len(rows) else np.zeros((0, MARKS), np.uint64)

    def search(self, seqs: list[np.ndarray]) -> list[dict[int, tuple[float, float, float]]]:
        """For each sequence the items that it holds, each with cosine, common share and answer's share."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in seqs]
        rows, of, place = passages(seqs, len(self.bench.index))
        near = unit(rows.scaled(self.idf).stacked(self.space))
        for at in range(0, len(near), 4096):
            cosines = near[at : at + 4096] @ self.items.T
            where, item = np.nonzero(cosines >= NEAR)
            cosine, where = cosines[where, item], where + at
            # A passage that holds too few of the item's words cannot be part of a match. It shares at most the bits
            # that both have, and one word more for each that another word of the passage has set already.
            lo, hi = rows.start[at], rows.start[min(at + 4096, len(near))]
            marks = np.bitwise_or.reduceat(self.bits[rows.cols[lo:hi]], rows.start[at : at + 4096][: len(cosines)] - lo)
            spare = np.diff(rows.start[at : at + len(cosines) + 1]) - np.bitwise_count(marks).sum(axis=1, dtype=np.int64)
            most = spare[where - at]
            for k in range(MARKS):
                most += np.bitwise_count(marks[where - at, k] & self.marks[item, k])
            some = np.flatnonzero(most >= self.least[item])
            where, item, cosine = where[some], item[some], cosine[some]
            size = np.diff(rows.start)[where]
            first = np.repeat(rows.start[where], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            shared = np.bincount(np.repeat(np.arange(len(where)), size), self.bag[np.repeat(item, size), rows.cols[first]], len(where))
            enough = np.flatnonzero(shared >= self.least[item])
            for k in enough[np.argsort(-cosine[enough], kind="stable")]:
                i, j = where[k], int(item[k])
                if j not in found[of[i]] and (checked := self.check(j, seqs[of[i]], int(place[i]))):
                    found[of[i]][j] = (float(cosine[k]), *checked)
        return found

    def check(self, item: int, seq: np.ndarray, place: int) -> tuple[float, float] | None:
        """The shares of the item and of its answer that the text has in order around a passage, if enough."""
        want = self.bench.seqs[item]
        text = seq[max(0, place - len(want)) : place + WINDOW + len(want)]
        text = text[text >= 0]
        # Other items' words cannot be in the common subsequence.
        text = text[self.bag[item][text]]
        if len(text) < WITH_ANSWER * len(want):
            return None
        # Nor more of the item than the words that the text holds at all.
        self.held[text] = True
        held = np.count_nonzero(self.held[self.wants[item]])
        self.held[text] = False
        if held < WITH_ANSWER * len(want):
            return None
        text = text.tolist()
        share = common_length(want, text) / len(want)
        if share < WITH_ANSWER:
            return None
        answer = self.bench.answers[item]
        given = common_length(answer, text) / len(answer)
        return (share, given) if share >= ALONE or given >= ANSWER else None


# Rows of a summed matrix that travel together, tasks whose sums meet at a time.
_BLOCK, _FAN = 256, 64


def _pieces(total: np.ndarray) -> pa.RecordBatch:
    """A task's matrix as blocks of rows."""
    bodies = [total[i : i + _BLOCK].tobytes() for i in range(0, len(total), _BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(bodies)), pa.int32()), pa.array(bodies, pa.binary())], ["block", "body"])


def _summed(partials: DataFrame, rows: int) -> np.ndarray:
    """The sum of the tasks' matrices, added up block by block in groups of ``_FAN`` tasks."""

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float64) for b in part["body"].to_pylist())
        return pa.table({"block": part["block"].slice(0, 1), "task": part["task"].slice(0, 1), "body": pa.array([total.tobytes()], pa.binary())})

    met = partials.withColumn("task", F.spark_partition_id())
    for _ in range(3):
        met = met.withColumn("task", F.floor(F.col("task") / _FAN).cast("int"))
        met = met.select("block", "task", "body").groupBy("block", "task").applyInArrow(add, "block int, task int, body binary")
    blocks = (rows + _BLOCK - 1) // _BLOCK
    got = {r.block: np.frombuffer(r.body, np.float64) for r in met.groupBy("block").applyInArrow(add, "block int, task int, body binary").collect()}
    if not got:
        return np.zeros((rows, 1))
    width = len(got[0]) // min(_BLOCK, rows)
    return np.concatenate([got[i] for i in range(blocks)]).reshape(rows, width)


def _read(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [np.frombuffer(b, np.int32) for b in batch.column(column).to_pylist()]


def sequences(docs: DataFrame, bench: Benchmark, text: str, key: str) -> DataFrame:
    """(doc_id, seq): each row's words as numbers of the items' words, in the shared folder."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(bench)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = pa.array([shared.value.sequence(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), seqs], ["doc_id", "seq"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string"))
    return stage(rows.mapInArrow(run, "doc_id long, seq binary"), "sequences")


def fit(seqs: DataFrame, bench: Benchmark, rank: int = RANK) -> Index:
    """Count document frequencies over all passages, then find the latent space in one pass over them.

    The pass sums A'(A O) for the passages A and a random O; with G = A'A, the eigenvectors of the
    Nystrom form of G are the right singular vectors of A.
    """
    width = len(bench.index)
    spark = seqs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row counts the passages.
        total = np.zeros((width + 1, 1))
        for batch in batches:
            rows, _, _ = passages(_read(batch, 1), width)
            total[:-1, 0] += np.bincount(rows.cols, minlength=width)
            total[-1, 0] += len(rows)
        yield _pieces(total)

    seen = _summed(seqs.mapInArrow(count, "block int, body binary"), width + 1)[:, 0]
    # Squared, so that an item's rare words say more than its frequent ones; never quite zero.
    idf = ((np.log((1 + seen[-1]) / (1 + seen[:-1])) + 0.1) ** 2).astype(np.float32)
    start = np.random.default_rng(0).standard_normal((width, max(1, min(rank + 8, width)))).astype(np.float32)
    shared = spark.sparkContext.broadcast((idf, start))

    def power(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, start = shared.value
        total = np.zeros(start.shape)
        for batch in batches:
            rows = passages(_read(batch, 1), width)[0].scaled(idf)
            total += rows.transposed().stacked(rows.stacked(start))
        yield _pieces(total)

    drawn = _summed(seqs.mapInArrow(power, "block int, body binary"), width)
    if drawn.shape != start.shape:
        drawn = start.astype(float)
    core = start.T.astype(float) @ drawn
    values, turn = np.linalg.eigh((core + core.T) / 2)
    keep = values > max(values.max(), 0) * 1e-10
    half = drawn @ (turn[:, keep] / np.sqrt(values[keep])) if keep.any() else np.linalg.qr(drawn)[0]
    space = np.linalg.svd(half, full_matrices=False)[0][:, :rank]
    return Index(bench, idf, np.ascontiguousarray(space, np.float32))


def _blocks(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The benchmark's items, at most about ``ITEMS`` at a time."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-rows.count() // ITEMS))
    for b in range(blocks):
        bench = Benchmark([(r.item_id, r.text) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()])
        if bench.seqs:
            yield bench


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, cosine, share, answer_share) for each text that holds a benchmark item.

    ``cosine`` is that of the best passage, ``share`` and ``answer_share`` what the text holds of the
    item and of its answer, in order. Null and empty texts and items hold nothing; rows with one id
    are taken together; other columns are ignored. Many items are searched for in several blocks.
    """
    schema = "doc_id long, item_id long, cosine double, share double, answer_share double"
    spark = docs.sparkSession
    found = spark.createDataFrame([], schema)
    for bench in _blocks(benchmark):
        seqs = sequences(docs, bench, text, key)
        shared = spark.sparkContext.broadcast(fit(seqs, bench))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                hits = index.search(_read(batch, 1))
                rows = [(d, index.bench.ids[j], *v) for d, hit in zip(batch.column(0).to_pylist(), hits) for j, v in hit.items()]
                cols = zip(*rows) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "cosine", "share", "answer_share"])

        found = found.union(seqs.mapInArrow(run, schema))
    return found.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("cosine", "share", "answer_share")))


def holds(index: Index, docs: DataFrame, text: str = "text") -> Column:
    """A column that tells whether a row's text holds an item."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bench = shared.value.bench
        for part in parts:
            yield pa.array([bool(x) for x in shared.value.search([bench.sequence(t) for t in part.to_pylist()])], pa.bool_())

    return run(F.col(text).cast("string"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns."""
    kept = docs
    for bench in _blocks(benchmark):
        index = fit(sequences(docs, bench, text, key), bench)
        kept = kept.withColumn("__leak", holds(index, docs, text)).where(~F.col("__leak")).drop("__leak")
    return kept
