"""Approximate nearest neighbours over balanced posting lists.

A bounded sample gives centroids by balanced clustering. Every vector joins the list of its nearest
centroid, and, if it lies near a border, the lists of further ones; a centroid closer to one already
chosen than to the vector adds little and is passed over. A query walks a graph of the centroids held in
memory, and searches the lists whose centroids are at most ``RATIO`` times as far as the nearest, and further
ones until these hold enough entries. Queries that are still short of neighbours search all lists.

Equal vectors are one entry that keeps its smallest ids, so a crowd of copies neither fills a list nor
is lost. Lists are dealt out in pieces of bounded size, and so are the queries that meet them.
"""

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrocar.llm import common
from ferrocar.session import stage

# Sampled vectors, those first by a hash of their id; sampled vectors in a list; most centroids.
SAMPLE, LIST, MOST = 40_000, 40, 1_024
# Lists that a vector joins at most and how much farther than the nearest their centroids may be.
COPIES, CLOSURE = 6, 1.3
# Lists that a query searches: at most so many, their centroids at most so much farther than the nearest.
PROBES, RATIO = 96, 1.6
DEGREE, BEAM = 24, 160
# Entries of a list and queries that meet in a task at a time.
PIECE = 2_048


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of rows, for search only: results are measured on differences."""
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0)


def centroids(sample: np.ndarray, seed: int = 0, rounds: int = 12) -> np.ndarray:
    """Centres of clusters of about equal size: a cluster's size adds to its distance."""
    rng = np.random.default_rng(seed)
    k = int(min(MOST, max(1, len(sample) // LIST)))
    centre = sample[rng.choice(len(sample), k, replace=False)].copy()
    penalty = np.zeros(k)
    for _ in range(rounds):
        own = np.concatenate([np.argmin(distances(sample[i : i + 4096], centre) + penalty, axis=1) for i in range(0, len(sample), 4096)])
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, own, sample)
        full = size > 0
        centre[full] = total[full] / size[full, None]
        # An empty cluster starts again at a member of a crowded one.
        for j in np.flatnonzero(~full):
            centre[j] = sample[rng.choice(np.flatnonzero(own == np.argmax(size)))]
        spread = distances(sample[:2048], centre).min(axis=1).mean()
        penalty = 0.05 * spread * (size * k / len(sample) - 1)
    return centre


class Graph:
    """A navigable graph of the centroids: each knows its nearest and a few others."""

    def __init__(self, centre: np.ndarray, seed: int = 0):
        self.centre = centre
        d = distances(centre, centre)
        np.fill_diagonal(d, np.inf)
        k = min(DEGREE, len(centre) - 1)
        near = np.argsort(d, axis=1)[:, :k] if k > 0 else np.zeros((len(centre), 0), int)
        far = np.random.default_rng(seed).integers(0, len(centre), (len(centre), 4))
        self.links = [np.unique(np.r_[a, b]) for a, b in zip(near, far)]
        # Links go both ways, so that every centroid can be reached from any.
        back = [[] for _ in self.links]
        for i, out in enumerate(self.links):
            for j in out:
                back[j].append(i)
        ring = [(i + 1) % len(centre) for i in range(len(centre))]
        self.links = [np.unique(np.r_[a, b, c]).astype(int) for a, b, c in zip(self.links, back, ring)]

    def search(self, query: np.ndarray, beam: int = BEAM) -> list[tuple[float, int]]:
        """The nearest centroids found, nearest first, by best-first search from the first."""
        first = float(((self.centre[0] - query) ** 2).sum())
        todo, seen, best = [(first, 0)], {0}, [(-first, 0)]
        while todo:
            d, i = heappop(todo)
            if len(best) >= beam and d > -best[0][0]:
                break
            new = [j for j in self.links[i].tolist() if j not in seen]
            seen.update(new)
            if new:
                for e, j in zip(((self.centre[new] - query) ** 2).sum(axis=1).tolist(), new):
                    if len(best) < beam or e < -best[0][0]:
                        heappush(todo, (e, j))
                        heappush(best, (-e, j))
                        if len(best) > beam:
                            heappop(best)
        return sorted((-d, i) for d, i in best)


def lists_of(vectors: np.ndarray, centre: np.ndarray) -> list[list[int]]:
    """The lists that each vector joins, the nearest first."""
    out = []
    between = distances(centre, centre)
    for at in range(0, len(vectors), 2048):
        d = distances(vectors[at : at + 2048], centre)
        k = min(4 * COPIES, d.shape[1])
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        for row, cand in zip(d, near):
            cand = cand[np.argsort(row[cand], kind="stable")]
            chosen = [int(cand[0])]
            for c in cand[1:].tolist():
                if len(chosen) == COPIES or row[c] > CLOSURE**2 * row[cand[0]]:
                    break
                if all(between[c, o] > 0.25 * row[c] for o in chosen):
                    chosen.append(c)
            out.append(chosen)
    return out


def probes(query: np.ndarray, graph: Graph, first: np.ndarray, least: int) -> list[int]:
    """The lists to search, nearest first; ``first`` has how many entries have each list as their nearest.

    An entry is nearest to one list alone, so lists with ``least`` of these hold as many distinct entries.
    """
    beam = BEAM
    while True:
        found = graph.search(query, beam)
        held = np.cumsum(first[[i for _, i in found]])
        if held[-1] >= least or len(found) == len(graph.centre):
            break
        beam *= 2
    # As many as are needed, and within the bounds those that are near enough.
    need = int(np.searchsorted(held, least)) + 1
    return [i for n, (d, i) in enumerate(found) if n < need or (n < PROBES and d <= RATIO**2 * found[0][0])]


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, v): vectors as doubles that are not null or zero and hold finite numbers alone."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(fine & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _through_all(keyed: DataFrame, short: DataFrame, k: int, size: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries of ``short`` among all vectors, a block of queries in each task."""
    rows = short.select("query_id", "q").toArrow()
    given = (rows["query_id"].to_numpy(), _matrix(rows["q"].combine_chunks(), size)) if len(rows) else None
    shared = keyed.sparkSession.sparkContext.broadcast(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict[int, float]] = {}
        for batch in batches:
            ids, v = batch.column(0).to_numpy(), _matrix(batch.column(1), size)
            for query, q in zip(*shared.value) if shared.value else ():
                near = best.setdefault(int(query), {})
                for i, s in zip(ids.tolist(), np.sqrt(((v - q) ** 2).sum(axis=1)).tolist()):
                    if i != query and s < near.get(i, np.inf):
                        near[i] = s
                best[int(query)] = dict(sorted(near.items(), key=lambda x: (x[1], x[0]))[:k])
        out = [(q, i, s) for q, near in best.items() for i, s in near.items()]
        cols = zip(*out) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    pairs = keyed.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score double")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each id divisible by ``every``.

    Nearness is Euclidean distance in double precision; ties go to the smaller id; a query is never its
    own neighbour, also where its id is repeated. Null, zero and not wholly finite vectors and null ids
    take no part, nor do vectors of another length than the most common one (of several, the smallest).
    Of rows with one id and one vector one takes part; one id with several vectors is several candidates,
    and is returned once, at its nearest. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, vector, key)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    size = usual.n
    rows = stage(rows.where(F.size("v") == size), "vectors")
    # Adding zero makes negative zeros positive, so that equal vectors have equal hashes.
    entry = F.sha2(F.array_join(F.transform("v", lambda x: (x + 0.0).cast("string")), ",").cast("binary"), 256)
    keyed = stage(rows.select("id", "v", entry.alias("entry")).dropDuplicates(["id", "entry"]), "entries")
    # Of equal vectors no query can need more than k and itself.
    place = F.row_number().over(Window.partitionBy("entry").orderBy("id"))
    members = stage(keyed.select("entry", "id").withColumn("place", place).where(F.col("place") <= k + 1).select("entry", "id"), "members")
    entries = keyed.groupBy("entry").agg(F.first("v").alias("v"))
    entries = stage(entries, "distinct")
    drawn = entries.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").toArrow()
    centre = centroids(_matrix(drawn.column("v").combine_chunks(), size))
    graph = spark.sparkContext.broadcast(Graph(centre))
    common.small_batches(spark)

    @F.arrow_udf("array<int>")
    def joined(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(lists_of(_matrix(part, size), graph.value.centre), pa.list_(pa.int32()))

    @F.arrow_udf("array<int>")
    def probed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([probes(q, graph.value, first, k + 1) for q in _matrix(part, size)], pa.list_(pa.int32()))

    def measure(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({"query": [], "entry": [], "score": []})
        v, q = np.stack(held["v"]), np.stack(asked["v"])
        near = distances(q, v)
        most = min(k + 8, len(v))
        out_q, out_v, out_s = [], [], []
        for i, row in enumerate(near):
            # All that could be among the nearest, allowing for the rounding of the products.
            bound = np.partition(row, most - 1)[most - 1]
            some = np.flatnonzero(row <= bound * (1 + 1e-9) + 1e-9)
            exact = np.sqrt(((v[some] - q[i]) ** 2).sum(axis=1))
            out_q += [asked["query"].iloc[i]] * len(some)
            out_v += held["entry"].iloc[some].tolist()
            out_s += exact.tolist()
        return pd.DataFrame({"query": out_q, "entry": out_v, "score": out_s})

    lists = stage(entries.select("entry", "v", F.posexplode(joined("v")).alias("nth", "list")), "lists")
    first = np.zeros(len(centre), np.int64)
    for r in lists.where(F.col("nth") == 0).groupBy("list").count().collect():
        first[r["list"]] = r["count"]
    sizes = lists.groupBy("list").count()
    pieces = sizes.select("list", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces"))
    dealt = lists.join(pieces, "list").select("list", F.pmod(F.xxhash64("entry"), F.col("pieces")).cast("int").alias("piece"), "entry", "v")
    asking = keyed.where(F.col("id") % every == 0).select(F.col("entry").alias("query"), "v").dropDuplicates(["query"])
    asked = asking.select("query", "v", F.explode(probed("v")).alias("list"))
    turns = asked.groupBy("list").count().select("list", F.ceil(F.col("count") / PIECE).cast("int").alias("turns"))
    met = asked.join(pieces, "list").join(turns, "list").select("list", "query", "v", F.pmod(F.xxhash64("query"), F.col("turns")).cast("int").alias("turn"), F.explode(F.expr("sequence(0, pieces - 1)")).alias("piece"))
    held = dealt.join(turns, "list").select("list", "piece", "entry", "v", F.explode(F.expr("sequence(0, turns - 1)")).alias("turn"))
    by = ["list", "piece", "turn"]
    found = held.groupBy(*by).cogroup(met.groupBy(*by)).applyInPandas(measure, "query string, entry string, score double")
    # An entry in several lists is found several times, with one score.
    found = found.groupBy("query", "entry").agg(F.first("score").alias("score"))
    ranks = F.rank().over(Window.partitionBy("query").orderBy("score"))
    few = found.withColumn("near", ranks).where(F.col("near") <= k + 1).drop("near")
    queries = keyed.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("entry").alias("query"))
    pairs = queries.join(few, "query").join(members, "entry").where("id <> query_id")
    pairs = pairs.groupBy("query_id", F.col("id").alias("vec_id")).agg(F.min("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    found = stage(pairs.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "found")
    # Where one id has several vectors, entries enough can be candidates too few.
    got = found.groupBy("query_id").agg(F.count("*").alias("got"))
    asking = queries.select("query_id").distinct().join(got, "query_id", "left").where(F.coalesce("got", F.lit(0)) < k).select("query_id")
    short = stage(keyed.join(asking, F.col("id") == F.col("query_id")).select("query_id", F.col("v").alias("q")), "short")
    blocks = -(-short.count() // PIECE)
    # A single id has no candidates.
    if blocks and keyed.select("id").distinct().limit(2).count() < 2:
        return found
    for b in range(blocks):
        block = short.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        found = found.join(block.select("query_id").distinct(), "query_id", "left_anti").union(_through_all(keyed, block, k, size))
    return found
