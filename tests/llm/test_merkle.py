import hashlib
import zlib

from pyspark.sql import functions as F

from ferrocar.llm import merkle
from tests.conftest import SMALL
from tests.llm.conftest import DOCS


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, source, lang, n_chars, text):
    return h("".join(enc(v) for v in (doc_id, source, lang, n_chars, text)))


def tree(digests):
    """(top, proofs): proofs as lists of (left, right) from the bottom up."""
    proofs = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    nodes = list(digests)
    while len(nodes) > 1:
        up, up_members = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k in range(len(run)):
                for i in members[at + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h("".join(run)))
            up_members.append([i for k in range(len(run)) for i in members[at + k]])
        nodes, members = up, up_members
    return nodes[0], proofs


def brute(rows):
    """Expected (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) as a sorted list."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r, leaf_of(r[0], r[3], r[2], r[4], r[1])))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subroots, detail = [], []
    for s in order:
        members = sorted(by_source[s], key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
        top, proofs = tree([m[1] for m in members])
        subroots.append(top)
        detail.append((members, top, proofs))
    root, outer = tree(subroots)
    out = []
    for k, (members, top, proofs) in enumerate(detail):
        for (r, digest), proof in zip(members, proofs):
            full = proof + outer[k]
            doc_id, text = r[0], r[1]
            bent = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
            changed = leaf_of(doc_id, r[3], r[2], r[4], text.replace("\n", "") if bent and text is not None else text)
            acc = changed
            for left, right in full:
                acc = h(left + acc + right)
            out.append((doc_id, digest, top, root, h("".join(a + b for a, b in full)), acc, acc == root))
    return sorted(out, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def got(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.manifest(df).select(cols).collect()), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    result = got(docs)
    assert result == brute(rows)
    assert any(not r[-1] for r in result) and any(r[-1] for r in result)


def test_odd_rows_and_many_levels(spark, odd_documents):
    extra = [(100 + i, f"line {i}\nmore", "en", "hot", 10) for i in range(95)] + [(500, "x\ny", None, None, None)]
    docs = odd_documents.unionByName(spark.createDataFrame(extra, DOCS).select(odd_documents.columns[:5]).withColumns(
        {c: F.lit("clash") for c in odd_documents.columns[5:]}))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    assert got(docs) == brute(rows)


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(7, "a\nb", "en", "s", 3)], DOCS)
    [(doc_id, leaf, subroot, root, proof, folded, verified)] = got(one)
    assert zlib.crc32(b"7") % 2 == 0, "doc 7 is tampered with"
    assert leaf == subroot == root and proof == h("")
    assert folded == leaf_of(7, "s", "en", 3, "ab") and not verified
    assert got(spark.createDataFrame([], DOCS)) == []
