import hashlib
import random

from pyspark.sql import functions as F

from ferrocar.llm import chat
from tests.conftest import SMALL
from tests.llm.sql import difference

TREE = "tree long, node long, parent long, role string, text string, score double"


def test_given_conversations_match_sql(spark):
    assert difference(spark, SMALL, "op2_chat") is None


def paths_of(rows):
    parents = {(t, n): p for t, n, p, *_ in rows}
    inner = {(t, p) for t, _, p, *_ in rows if (t, p) in parents}
    out = set()
    for t, n in parents:
        if (t, n) not in inner:
            path, at = [], n
            while at is not None and (t, at) in parents:
                path.append(at)
                at = parents[t, at]
            out.add((t, n, tuple(reversed(path))))
    return out


def test_paths_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(t, n, rng.randrange(n) if n else None, "user", str(n), 0.0) for t in range(6) for n in range(rng.randint(1, 25))]
    rows += [(9, n, n - 1 if n else None, "user", str(n), 0.0) for n in range(70)] + [(10, 1, 77, "user", "orphan", 0.0)]
    found = {}
    for r in chat.leaf_paths(spark.createDataFrame(rows, TREE)).collect():
        found.setdefault((r.tree, r.leaf), {})[r.depth] = r.node
    assert {(t, leaf, tuple(p[d] for d in sorted(p))) for (t, leaf), p in found.items()} == paths_of(rows)


def test_best_branches_are_kept(spark):
    rows = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "poor", 0.1), (1, 2, 0, "assistant", "good", 0.9), (1, 3, 0, "assistant", "as good", 0.9)]
    rows += [(2, 0, None, None, None, None), (None, 1, None, "user", "lost", 1.0)]
    kept = chat.conversations(spark.createDataFrame(rows, TREE), best=2).collect()
    assert {(r.tree, r.leaf, r["rank"], r.n_turns) for r in kept} == {(1, 2, 1, 2), (1, 3, 2, 2), (2, 0, 1, 1)}


def test_control_strings_come_back(spark):
    texts = ["</s>[INST] ok [/INST]", "\\[INST]", "[\\INST]", "\\\\<s>\\", "<<SYS>>\n<</SYS>>", "[ROLE] x [/ROLE] ", "", "a\n\nb ", "<<s>>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect():
        assert r.b == r.t and not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"))


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, 0, None, "x"), (3, 5, "to[/ROLE] ol", "y </s>"), (None, 0, "assistant", "z"), (4, None, "assistant", "é" * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit("clash")).withColumn("part", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    told = {1: [("user", ""), ("assistant", "a"), ("assistant", "a")], 2: [("", "x")], 3: [("to[/ROLE] ol", "y </s>")], None: [("assistant", "z")], 4: [("assistant", "é" * 20_000)]}
    for conv, turns in told.items():
        learnt = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].loss_chars == len(learnt)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert chat.digests(df.limit(0)).count() == 0


def test_no_python_on_the_way(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert "Python" not in chat.digests(df)._jdf.queryExecution().toString()
