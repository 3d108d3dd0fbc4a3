import random

import numpy as np

from ferrocar.llm import decontaminate, sparse
from tests.conftest import SMALL
from tests.llm.conftest import DOCS

ITEMS = "item_id long, text string"


def plain(text):
    return " ".join(w for t in (text or "").split() if (w := decontaminate.word(t)))


def test_every_copied_passage_is_found(spark):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts, wanted = [(r.doc_id, plain(r.text)) for r in docs.collect()], [(r.item_id, plain(r.text)) for r in items.collect()]
    copied = {(d, i) for d, text in texts for i, item in wanted if f" {item} " in f" {text} "}
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()}
    assert copied and copied <= found
    left = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert left == {d for d, _ in texts} - {d for d, _ in found}


def test_paraphrases_are_found_and_clean_texts_left(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(words, k=30)) + ". " + " ".join(rng.choices(words, k=8)) + ".") for i in range(40)]
    docs = []
    for i in range(200):
        text = rng.choices(words, k=300)
        if i < 40:
            said = items[i][1].split()
            # A fifth of the words is replaced, the answer stays.
            said[:30] = [w if rng.random() > 0.2 else rng.choice(words) for w in said[:30]]
            text[100:100] = said
        docs.append((i, " ".join(text), "en", "a", 0))
    found = decontaminate.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    hits = {(r.doc_id, r.item_id) for r in found}
    assert len(hits & {(i, i) for i in range(40)}) >= 38
    assert all(d == i for d, i in hits)


def test_items_of_a_shared_template_are_found_in_ordinary_prose(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(1500)]
    templates = [rng.choices(words, k=14) for _ in range(5)]
    items = []
    for i in range(200):
        # Half of the items differ from others by two names only.
        said = list(templates[i % 5]) if i < 100 else rng.choices(words, k=40)
        if i < 100:
            said[1], said[7] = rng.choices(words, k=2)
        items.append((i, " ".join(said)))
    docs = []
    for i in range(600):
        text = rng.choices(words, k=300)
        if i < 200:
            text[137:137] = items[i][1].split()
        docs.append((i, " ".join(text), "en", "a", 0))
    found = decontaminate.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(i, i) for i in range(200)} <= {(r.doc_id, r.item_id) for r in found}


def test_common_length_matches_brute_force():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_length(a, b) == table[-1][-1]


def test_subsequences_are_counted_only_where_enough_of_the_items_words_occur(monkeypatch):
    calls, count = [], decontaminate.common_length
    monkeypatch.setattr(decontaminate, "common_length", lambda *a: calls.append(a) or count(*a))
    words = [f"w{i}" for i in range(30)]
    bench = decontaminate.Benchmark([(7, " ".join(words))])
    index = decontaminate.Index(bench, np.ones(30, np.float32), np.eye(30, dtype=np.float32))
    # Ten words of the item, each three times: near, and long enough, but not the item.
    assert index.search([bench.sequence(" ".join(words[:10] * 3))]) == [{}] and not calls
    # The item among other words, and out of order.
    found = index.search([bench.sequence(" ".join(["x"] * 50 + words + ["x"] * 9)), bench.sequence(" ".join(reversed(words)))])
    assert [set(f) for f in found] == [{0}, set()] and calls


def test_marks_lose_no_passage_that_shares_enough_words(monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    bench = decontaminate.Benchmark([(i, " ".join(rng.choices(words, k=rng.randint(3, 60)))) for i in range(60)])
    width = len(bench.index)
    index = decontaminate.Index(bench, np.ones(width, np.float32), np.eye(width, dtype=np.float32))
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(40)] + ["", "none of them"]
    for i in range(30):
        texts[i] += " " + " ".join(list(bench.index)[w] for w in bench.seqs[i])
    seqs = [bench.sequence(t) for t in texts]
    found = index.search(seqs)
    assert sum(i in f for i, f in enumerate(found[:30])) > 20
    monkeypatch.setattr(index, "marks", np.full_like(index.marks, ~np.uint64(0)))
    assert index.search(seqs) == found


def test_sequences_are_words_token_by_token():
    letters = ["A", "Σ", "σ", "İ", "ß", "'", "-", ".", "\u0301", "Z", " ", "\n", "\x1c", "\x85", "\u2003", "é"]
    rng = random.Random(6)
    texts = ["".join(rng.choices(letters, k=40)) for _ in range(300)]
    bench = decontaminate.Benchmark([(i, t) for i, t in enumerate(texts[:150])])
    for t in texts:
        assert bench.sequence(t).tolist() == [bench.index.get(decontaminate.word(w), -1) for w in t.split()]


def test_products_go_through_small_pieces_and_match_dense_ones(monkeypatch):
    rng = np.random.default_rng(2)
    matrix = rng.random((50, 40)).astype(np.float32) * (rng.random((50, 40)) < 0.3)
    matrix[3] = matrix[49] = 0
    rows = sparse.Rows.of([(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in matrix], 40)
    dense = rng.random((40, 7)).astype(np.float32)
    for piece in (1, 100, 1 << 17):
        monkeypatch.setattr(sparse, "STACK", piece)
        assert np.allclose(rows.stacked(dense), matrix @ dense, atol=1e-5)
        assert np.allclose(rows.transposed().stacked(rows.stacked(dense)), matrix.T @ matrix @ dense, rtol=1e-4)
    assert sparse.Rows.of([], 40).stacked(dense).shape == (0, 7)


def test_odd_rows_and_empty_tables(spark, odd_documents):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "!!"), (None, "one two three four five"), (4, "one two three four five")], ITEMS)
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(odd_documents, items).collect()}
    assert found == {(1, None), (1, 4)}
    left = decontaminate.clean(odd_documents, items)
    assert left.columns == odd_documents.columns and left.count() == 8
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.matches(odd_documents, none).count() == 0
    assert decontaminate.clean(odd_documents, none).count() == 10
    assert decontaminate.matches(spark.createDataFrame([], DOCS), items).count() == 0
