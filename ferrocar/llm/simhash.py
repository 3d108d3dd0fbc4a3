"""SimHash near-duplicates by a Gray-order hierarchical index.

A fingerprint holds, bit by bit, the majority of the 64-bit hashes of a text's word shingles.
Texts whose fingerprints differ in few bits are linked, and the components of the links are the
groups of near-copies.

Two fingerprints within ``distance`` bits agree in one of ``distance + 1`` bands, so each distinct
fingerprint goes to one bucket per band, and every bucket is searched by an index: its fingerprints
are sorted by their rank in the reflected Gray code, runs of neighbours share an upper node that
keeps the bits they all agree in, and so on up to a root. Two nodes are compared on the bits that
both share, the differences found on the way down are added up, and a pair of nodes is left as soon
as they exceed the distance.

Copies meet as one fingerprint. A bucket with more fingerprints than a block holds is cut into
blocks, and each pair of its blocks is a task's group of its own. A task gives back a spanning
forest of the links that it found, never all pairs.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrocar.llm import common
from ferrocar.llm.components import components, local_labels
from ferrocar.session import stage

SHINGLE, DISTANCE, SEED = 3, 3, 42
# Fingerprints in a block, children of an upper node, node pairs looked at together.
BLOCK, FAN, CHUNK = 32_768, 8, 1 << 19

_BYTES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text; of a text without words, zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        # Eight bits at a time, one in each byte of a word: 255 rows add up without a carry.
        part = (h[at : at + (1 << 16), None] >> _SHIFTS) & _BYTES
        sums = np.add.reduceat(part, np.arange(0, len(part), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 8, 8).sum(axis=0, dtype=np.int64).T.reshape(64)
    return int(np.bitwise_or.reduce(np.where(2 * counts > n, np.uint64(1) << np.arange(64, dtype=np.uint64), np.uint64(0))))


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint of each row as a signed long."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _signed(found)], ["doc_id", "fp"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(v: np.ndarray) -> np.ndarray:
    """Where each word stands in the reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        v = v ^ (v >> np.uint64(s))
    return v


class Levels:
    """The index of several groups: level 0 holds the fingerprints, each level above their shared bits."""

    def __init__(self, group: np.ndarray, value: np.ndarray):
        self.shared, self.bits, self.first, self.roots = [np.full(len(value), ~np.uint64(0))], [value], [], []
        every, some = value, value
        while True:
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            size = np.diff(np.r_[starts, len(group)])
            self.roots.append(starts[size == 1])
            keep = np.repeat(size > 1, size)
            if not keep.any():
                break
            at = np.flatnonzero(keep)
            place = at - np.repeat(starts, size)[at]
            cut = np.flatnonzero(place % FAN == 0)
            self.first.append((at[cut], np.diff(np.r_[cut, len(at)])))
            every, some = np.bitwise_and.reduceat(every[at], cut), np.bitwise_or.reduceat(some[at], cut)
            group = group[at][cut]
            self.shared.append(~(every ^ some))
            self.bits.append(every)

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of fingerprints (a < b) of a group within the distance, in pieces."""
        top = len(self.shared) - 1
        stack = [(k, r, r, np.zeros(len(r), np.uint8)) for k, r in enumerate(self.roots) if k and len(r)]
        assert top == len(self.first)
        while stack:
            level, x, y, apart = stack.pop()
            if len(x) > CHUNK // (FAN * FAN):
                half = len(x) // 2
                stack += [(level, x[:half], y[:half], apart[:half]), (level, x[half:], y[half:], apart[half:])]
                continue
            start, size = self.first[level - 1]
            pairs = size[x] * size[y]
            parent = np.repeat(np.arange(len(x)), pairs)
            inner = np.arange(len(parent)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            px, py = x[parent], y[parent]
            a, b = start[px] + inner // size[py], start[py] + inner % size[py]
            ok = (px != py) | (a < b if level == 1 else a <= b)
            parent, px, py, a, b = parent[ok], px[ok], py[ok], a[ok], b[ok]
            # Only bits that the parents did not both share are new: their differences are added up.
            fresh = self.shared[level - 1][a] & self.shared[level - 1][b] & ~(self.shared[level][px] & self.shared[level][py])
            total = apart[parent] + np.bitwise_count((self.bits[level - 1][a] ^ self.bits[level - 1][b]) & fresh)
            near = total <= distance
            a, b, total = a[near], b[near], total[near]
            if level == 1:
                if len(a):
                    yield a, b
            elif len(a):
                stack.append((level - 1, a, b, total))


def forest(group: np.ndarray, fp: np.ndarray, node: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that connect the nodes of each group as its pairs within the distance do."""
    value = fp.view(np.uint64)
    order = np.lexsort((gray_rank(value), group))
    node = node[order]
    label = np.arange(len(node))
    waiting, held = [], 0
    for a, b in Levels(group[order], value[order]).links(distance):
        open_ = label[a] != label[b]
        if open_.any():
            waiting.append((label[a[open_]], label[b[open_]]))
            held += int(open_.sum())
        if held > CHUNK:
            label = local_labels(len(node), *map(np.concatenate, zip(*waiting)))[label]
            waiting, held = [], 0
    if waiting:
        label = local_labels(len(node), *map(np.concatenate, zip(*waiting)))[label]
    linked = label != np.arange(len(node))
    u, v = node[linked], node[label[linked]]
    return u[u != v], v[u != v]


def _search(distance: int):
    """A task's groups, sorted by group; a chunk ends where a group does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def out(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            named, fp, node = (np.concatenate(c) for c in zip(*parts))
            group = np.cumsum(np.r_[False, named[1:] != named[:-1]])
            u, v = forest(group, fp, node, distance)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        size = 0
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(cols[0]):
                continue
            held.append(cols)
            size += len(cols[0])
            if size >= 4 * BLOCK:
                named, fp, node = (np.concatenate(c) for c in zip(*held))
                cut = int(np.searchsorted(named, named[-1]))
                if cut:
                    yield out([[named[:cut], fp[:cut], node[:cut]]])
                held, size = [[named[cut:], fp[cut:], node[cut:]]], len(named) - cut
        if held:
            yield out(held)

    return run


def links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between the nodes of distinct fingerprints (fp, node), a forest per group searched."""
    bands = distance + 1
    width = 64 // bands
    keys = [
        F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << (width if i < bands - 1 else 64 - i * width)) - 1) for i in range(bands)
    ]
    spread = distinct.select("fp", "node", F.posexplode(F.array(*[k.cast("long") for k in keys])).alias("band", "bits"))
    spread = spread.select("fp", "node", (F.col("bits") * bands + F.col("band")).alias("bucket"))
    full = spread.groupBy("bucket").count().where(F.col("count") > block)
    full = full.select("bucket", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.expr("sequence(0, blocks - 1)")))
    met = spread.join(full, "bucket", "left").select("fp", "node", "bucket", F.coalesce(mine, F.lit(0)).alias("mine"), other.alias("other"))
    pair = F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))
    named = met.select(pair.alias("pair"), "fp", "node")
    return named.repartition("pair").sortWithinPartitions("pair").mapInArrow(_search(distance), "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable over links of at
    most ``distance`` differing bits. A null text is empty; texts without words have fingerprint
    zero and are linked like others; a null id takes part in no comparison of ids, so it never names
    a component that has an id. Rows with one id are returned as often as they come. Other columns
    are ignored; an empty table gives no rows.
    """
    marks = stage(fingerprints(docs, text, key, shingle), "fingerprints")
    distinct = stage(marks.groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    known = distinct.where("node IS NOT NULL")
    found = components(links(known, distance))
    named = distinct.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marks.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each group of near-copies: that with the smallest id, all columns kept.

    Of several rows with that id one stays. Rows with a null id cannot be named and stay as they are.
    """
    groups = near_duplicates(docs.where(F.col(key).isNotNull()), text, key)
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    named = docs.where(F.col(key).isNotNull()).repartition(key)
    kept = named.join(first, named[key] == F.col("__kept"), "left_semi").dropDuplicates([key])
    return kept.union(docs.where(F.col(key).isNull()))
