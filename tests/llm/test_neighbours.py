import numpy as np
import pytest

from ferrocar.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, vectors, k, every):
    out = {}
    for i, v in zip(ids, vectors):
        if i % every == 0:
            d = np.sqrt(((vectors - v) ** 2).sum(axis=1))
            order = [(float(s), int(j)) for s, j in zip(d, ids) if j != i]
            out[int(i)] = sorted(order)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    given = rows.collect()
    want = brute(np.array([r.vec_id for r in given]), np.array([r.embedding for r in given], float), 10, 100)
    got = found(neighbours.nearest(rows))
    assert got.keys() == want.keys()
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    scores = {(q, j): s for q in want for s, j in want[q]}
    assert all(s == scores[q, j] for q in got for s, j in got[q] if (q, j) in scores)


def test_a_crowd_of_copies_is_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PIECE", 16)
    rng = np.random.default_rng(1)
    vectors = np.vstack([np.ones((150, 4)), rng.standard_normal((150, 4))]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), every=10))
    assert got == brute(np.arange(300), vectors.astype(float), 10, 10)


def test_every_query_has_its_rows(spark):
    rng = np.random.default_rng(2)
    # A crowd, far vectors alone, and tiny tight groups.
    far = 100 * rng.standard_normal((200, 8))
    groups = 100 * rng.standard_normal((50, 1, 8)) + 1e-3 * rng.standard_normal((50, 3, 8))
    vectors = np.vstack([rng.standard_normal((2000, 8)), far, groups.reshape(-1, 8)])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors.astype(np.float32))]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), every=2))
    assert {q: len(got.get(q, [])) for q in range(0, len(rows), 2)} == {q: 10 for q in range(0, len(rows), 2)}


def test_an_id_of_many_vectors_leaves_room_for_others(spark):
    rng = np.random.default_rng(3)
    ids = np.r_[0:100, np.full(60, 101)]
    vectors = np.vstack([rng.standard_normal((100, 4)) * 10, 1e-2 * rng.standard_normal((60, 4))])
    vectors[0] = 0.01
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, vectors.astype(np.float32))]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), every=100))
    near = {}
    for i, v in zip(ids.tolist(), vectors.astype(np.float32).astype(float)):
        if i:
            near[i] = min(near.get(i, np.inf), float(np.sqrt(((v - vectors[0].astype(np.float32)) ** 2).sum())))
    assert [j for _, j in got[0]] == sorted(near, key=near.get)[:10]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [None, 1.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (6, [1.0, -0.0], 1), (7, [2.0, 0.0], 1), (100, [1.0], 1), (8, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA + "").selectExpr("*", "'x' AS id", "'x' AS v", "'x' AS entry")
    assert found(neighbours.nearest(df)) == {0: [(0.0, 6), (1.0, 7)]}
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.where("vec_id = 1")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 40, 300])
def test_the_graph_reaches_every_centroid(n):
    centre = np.random.default_rng(n).standard_normal((n, 8))
    graph = neighbours.Graph(centre)
    for q in np.random.default_rng(0).standard_normal((5, 8)):
        d = ((centre - q) ** 2).sum(axis=1)
        assert [i for _, i in graph.search(q, beam=n)] == np.argsort(d, kind="stable").tolist()
