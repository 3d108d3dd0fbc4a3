import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from ferrocar.llm import spelling
from tests.conftest import SMALL
from tests.llm.conftest import DOCS


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{low}".encode())
                if h % 97 == 0:
                    k = h % len(low)
                    low = low[:k] + low[k + 1 :]
            counts[low] += 1
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    nears = {w: [] for w in words}
    for w in words:
        for other in by_length.get(len(w), []) + by_length.get(len(w) + 1, []) + by_length.get(len(w) - 1, []):
            if spelling.near(w, other):
                nears[w].append(other)
    form = {}
    for w, found in nears.items():
        best = min(found, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        (w, form[w], root(w), words[w], len(nears[w]), words[form[w]] if form[w] else None) for w in words
    )


def got(df):
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in spelling.variants(df).select(cols).collect())


def test_near_is_one_edit():
    assert spelling.near("colour", "color") and spelling.near("color", "colour")
    assert spelling.near("house", "mouse") and not spelling.near("house", "house")
    assert not spelling.near("house", "horse!!") and not spelling.near("abcde", "abced")
    assert spelling.near("naïve", "naive") and spelling.near("abcde", "abcdef")


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute(rows)
    assert got(docs) == expected
    assert any(r[1] for r in expected)


def test_planted_variants_small_blocks_and_odd_rows(spark, odd_documents, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 3)
    text = " ".join(["Colour"] * 9 + ["color"] * 3 + ["colours"] * 2 + ["colourss"] * 3 + ["Häuser", "häuser", "hauser"] * 3)
    extra = [(100 + i, text, "en", "s", len(text)) for i in range(3)] + [(None, text, None, None, None)]
    planted = spark.createDataFrame(extra, DOCS).withColumns({c: F.lit("clash") for c in odd_documents.columns[5:]})
    docs = odd_documents.unionByName(planted)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute(rows)
    assert got(docs) == expected
    assert ("color", "colour", "colour", 9, 2, 36) in expected or any(r[0] == "color" and r[2] == "colour" for r in expected)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], DOCS)) == []


def test_search_equals_brute_force_on_words():
    import random

    rng = random.Random(7)
    letters = "abcdeé"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice((5, 6)))) for _ in range(3000)})
    index = [w for w in words if len(w) == 6]
    probes = words
    a, b = spelling.search(index, probes, chunk=97)
    got = set(zip(a, b))
    expected = {(min(p, w), max(p, w)) for p in probes for w in index if spelling.near(p, w)}
    assert got == expected and len(a) == len(got)
