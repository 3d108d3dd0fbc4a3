import zlib

import numpy as np
import pytest

from ferrocar.llm import quality, sparse, toxicity
from tests.llm.conftest import DOCS

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def held_out(rows, labels, label):
    known = {r.doc_id: r[label] for r in labels.collect()}
    return [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]


def test_held_out_toxicity(given):
    rows = toxicity.scored(*given).collect()
    assert len(rows) == given[0].count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in rows)
    pairs = held_out(rows, given[1], "toxic")
    assert np.mean([p for y, p in pairs if y == 1]) >= 0.85
    assert np.mean([1 - p for y, p in pairs if y == 0]) >= 0.98


def test_held_out_quality(given):
    rows = quality.scored(*given).collect()
    assert len(rows) == given[0].count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    pairs = held_out(rows, given[1], "quality")
    assert np.mean([p for y, p in pairs if y == 1]) >= 0.98
    assert np.mean([1 - p for y, p in pairs if y == 0]) >= 0.95


def test_risk_is_not_fitted_below_zero():
    """Unlabelled texts that hold toxic words are not pushed to be clean."""
    rng = np.random.default_rng(1)

    def rows(n, toxic):
        out = []
        for _ in range(n):
            words = set(rng.choice(np.arange(100, 400), 30).tolist()) | (set(rng.choice(5, 3).tolist()) if toxic else set())
            out.append((np.array(sorted(words)), np.ones(len(words), np.float32)))
        return out

    model = toxicity.train(sparse.Rows.of(rows(200, True), 400), sparse.Rows.of(rows(40, True) + rows(360, False), 400), 0.1)

    def score(cols):
        return 1 / (1 + np.exp(-sum(model.weights.get(c, 0) for c in cols.tolist()) - model.bias))

    scores, clean = [score(c) for c, _ in rows(50, True)], [score(c) for c, _ in rows(50, False)]
    assert np.mean(np.array(scores) >= 0.3) > 0.85 and np.mean(np.array(clean) < 0.3) > 0.85


def test_votes_match_brute_force():
    rng = np.random.default_rng(2)
    voters, labels = sparse.unit(rng.standard_normal((300, 8))), rng.integers(0, 2, 300).astype(float)
    model = quality.Model(np.ones(1), np.ones((1, 1)), voters, labels, 0.5)
    asked = sparse.unit(rng.standard_normal((40, 8)))
    want = []
    for v in asked:
        sims = voters @ v
        near = np.argsort(-sims)[: quality.NEIGHBOURS]
        weight = np.maximum(sims[near], 0) ** 4
        want.append((weight * labels[near]).sum() / weight.sum())
    assert np.allclose(model.vote(asked), want)


def test_randomised_svd_finds_the_leading_space():
    rng = np.random.default_rng(3)
    dense = (rng.standard_normal((60, 4)) @ rng.standard_normal((4, 40))).astype(np.float32)
    rows = sparse.Rows.of([(np.arange(40), r) for r in dense], 40)
    basis, size = sparse.randomised_svd(rows, 4)
    assert np.allclose(size, np.linalg.svd(dense)[1][:4], rtol=1e-3)
    assert np.allclose(dense @ basis @ basis.T, dense, atol=1e-3)


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_odd_rows_and_labels(spark, odd_documents, operator):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 1, None), (6, None, 1), (None, 1, 1), (99, 0, 0)], LABELS)
    rows = operator.scored(odd_documents, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.held_out in (True, False) for r in rows)
    kept = (toxicity.clean if operator is toxicity else quality.good)(odd_documents, labels)
    assert kept.columns == odd_documents.columns and kept.count() <= 10


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_empty_tables(spark, odd_documents, operator):
    none = spark.createDataFrame([], LABELS)
    assert operator.scored(spark.createDataFrame([], DOCS), none).count() == 0
    assert len({r.score for r in operator.scored(odd_documents, none).collect()}) == 1
