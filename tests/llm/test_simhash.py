import random
import re

import numpy as np
import xxhash

from ferrocar.llm import simhash
from ferrocar.llm.components import components
from tests.conftest import SMALL
from tests.llm.conftest import DOCS


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks):
    """Smallest id reachable for (id, fingerprint) rows."""
    ids = sorted(marks)
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (marks[a] ^ marks[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    marks = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    groups = brute_groups(marks)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (format(marks[i], "016x"), groups[i]) for i in marks}


def test_links_match_brute_force_with_small_blocks(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    marks = {}
    for i in range(600):
        v = rng.choice(base)
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        marks[i] = v
    distinct = {}
    for i, v in marks.items():
        distinct.setdefault(v, i)
    rows = [(int(np.uint64(v).view(np.int64)), i) for v, i in distinct.items()]
    links = simhash.links(spark.createDataFrame(rows, "fp long, node long"), block=16)
    found = {r.node: r.component for r in components(links).collect()}
    groups = brute_groups({i: v for v, i in distinct.items()})
    assert {i: found.get(i, i) for i in groups} == groups


def test_gray_rank_orders_the_gray_code():
    codes = np.array([i ^ (i >> 1) for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(1000)).all()


def test_odd_rows(spark, odd_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[2] == by[3] == by[4] == {("0" * 16, 2)}
    assert len(by[1]) == 1 and by[5] != by[7] and {c for _, c in by[6]} <= {5, 6}


def test_one_row_of_each_group_stays(spark, odd_documents):
    kept = simhash.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(2) == 1 and 3 not in ids and 4 not in ids and ids.count(None) == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.deduplicated(empty).count() == 0
