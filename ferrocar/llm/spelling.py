"""Spelling variants: words one edit apart, found through a trie of letter-group frequency vectors.

Words are the runs of letters of all texts, counted over the whole table. Two words are near when one
inserted, deleted or replaced code point turns one into the other. A word's letters fall into
``GROUPS`` groups by a fixed rule, and the counts per group, group by group, are its path in a trie.
One edit moves that vector by at most one up in one group (surplus) and one down in another (deficit),
so a depth-first search that may spend a surplus of one and a deficit of one reaches every near word;
the words at the leaves it reaches are verified exactly.

Over the cluster the first two levels of the trie are the key of a task: a word is indexed under
(length, count of group 0, count of group 1) and sent as a probe to the keys that its budget can
reach, of its own length (replacements) and of one more (insertions). A key with more words than
``BLOCK`` is cut into blocks of indexed words and of probes, and each pair of blocks is a task.

A word's form is its near word of largest count (ties: the smaller in code-point order) when that
count is at least twice its own; roots follow forms to the end by pointer jumping over joins.

Edge cases: null texts have no runs; rows without doc_id have no deletion (the hash of a null id is
null); runs of other scripts split words; an empty table, or one without words of five code points
seen three times, gives no rows; other columns are ignored.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.session import stage

# Letter groups: a code point's group is its value modulo GROUPS (two letters of a-z a group); measured
# fastest of 6 to 26 for the search with verification in bulk.
GROUPS = 13
# Words of at least MIN_LENGTH code points seen at least MIN_COUNT times; a form counts FACTOR times more.
MIN_LENGTH, MIN_COUNT, FACTOR, DIVISOR = 5, 3, 2, 97
# Indexed words, and probes, in one task.
BLOCK = 20_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"


def _group(ch: str) -> int:
    return ord(ch) % GROUPS


def vector(word: str) -> tuple[int, ...]:
    """Counts of a word's code points per letter group."""
    counts = [0] * GROUPS
    for ch in word:
        counts[_group(ch)] += 1
    return tuple(counts)


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) == len(b):
        return a != b and sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = (a, b) if len(a) < len(b) else (b, a)
    if len(long_) != len(short) + 1:
        return False
    i = 0
    while i < len(short) and short[i] == long_[i]:
        i += 1
    return short[i:] == long_[i + 1 :]


class Trie:
    """Words of one length by their frequency vectors, one level a group; leaves hold row numbers."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for row, w in enumerate(words):
            node = self.root
            for c in vector(w):
                node = node.setdefault(c, {})
            node.setdefault(-1, []).append(row)

    def reach(self, probe: tuple[int, ...], shorter: bool = False) -> list[list[int]]:
        """Leaves whose vector is the probe's with at most one group one more and one group one less.

        A probe one shorter takes no deficit (its near words have exactly one code point more). For
        a probe as long, a deficit comes only after the surplus: of the two searches from either word
        of a replacement, just one runs this way, so each pair is found once.
        """
        found, stack = [], [(self.root, 0, 0, 1 if shorter else 0)]
        while stack:
            node, level, surplus, deficit = stack.pop()
            if level == GROUPS:
                found.append(node[-1])
                continue
            q = probe[level]
            child = node.get(q)
            if child is not None:
                stack.append((child, level + 1, surplus, deficit))
            if not surplus and (child := node.get(q + 1)) is not None:
                stack.append((child, level + 1, 1, deficit))
            if surplus and not deficit and q > 0 and (child := node.get(q - 1)) is not None:
                stack.append((child, level + 1, surplus, 1))
        return found


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    if not words:
        return np.zeros((0, length), np.uint32)
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def verified(probes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Whether each probe row is one edit from the index row beside it: a replacement if both are as
    long, else an insertion into the probe (index rows one longer)."""
    if probes.shape[1] == index.shape[1]:
        return (probes != index).sum(axis=1) == 1
    n, length = probes.shape
    # Common prefix k, then the probe's rest equals the index row's after one skipped code point.
    k = np.cumprod(probes == index[:, :length], axis=1).sum(axis=1)
    rest = np.concatenate([probes == index[:, 1:], np.ones((n, 1), bool)], axis=1)
    tail = np.flip(np.cumprod(np.flip(rest, axis=1), axis=1), axis=1).astype(bool)
    return tail[np.arange(n), k]


def search(index_words: list[str], probe_words: list[str], chunk: int = 1 << 18) -> tuple[list[str], list[str]]:
    """Near pairs (a < b) between probes and indexed words of one length; probes as long or one shorter."""
    if not index_words:
        return [], []
    length = len(index_words[0])
    trie = Trie(index_words)
    codes = _codes(index_words, length)
    found_a, found_b = [], []
    for size in (length, length - 1):
        mine = [p for p in probe_words if len(p) == size]
        if not mine:
            continue
        pcodes = _codes(mine, size)
        rows_p, rows_i = [], []
        for at, p in enumerate(mine):
            for leaf in trie.reach(vector(p), size < length):
                rows_i.extend(leaf)
                rows_p.extend([at] * len(leaf))
        rows_p, rows_i = np.array(rows_p, np.int64), np.array(rows_i, np.int64)
        for start in range(0, len(rows_p), chunk):
            rp, ri = rows_p[start : start + chunk], rows_i[start : start + chunk]
            ok = verified(pcodes[rp], codes[ri])
            for a, b in zip(rp[ok].tolist(), ri[ok].tolist()):
                p, w = mine[a], index_words[b]
                # Equal vectors are met from both words; other pairs from one only.
                if size < length or p < w or vector(p) != vector(w):
                    found_a.append(min(p, w))
                    found_b.append(max(p, w))
    return found_a, found_b


def runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word): every run of letters after lower-casing A-Z and the deletion rule, one row each.

    h is the unsigned crc32 of ``<doc_id>:<run>``; where DIVISOR divides it, the code point h % length
    (from 0) is deleted.
    """
    raw = docs.select(F.col(key).cast("long").alias("k"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(_LETTERS), 0)).alias("run"))
    lowered = raw.select("k", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    lowered = lowered.withColumn("h", F.crc32(F.concat(F.col("k").cast("string"), F.lit(":"), F.col("run")).cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(
        F.coalesce(F.col("h") % DIVISOR == 0, F.lit(False)),
        F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, cast(h % char_length(run) AS int) + 2)")),
    ).otherwise(F.col("run"))
    return lowered.select(word.alias("word"))


def words(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): words of at least MIN_LENGTH code points seen at least MIN_COUNT times (partial counts per task first)."""
    counted = runs(docs, text, key).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= MIN_COUNT) & (F.char_length("word") >= MIN_LENGTH))


def _code_mod(group: int) -> Column:
    # ascii() gives the first code point of a string.
    return F.expr(f"size(filter(split(word, ''), ch -> ascii(ch) % {GROUPS} = {group}))")


# Moves of the first two group counts that one edit allows, for a probe of the same length (one
# surplus, and a deficit only after it) and for a probe one shorter (one surplus).
SAME = [(0, 0), (1, 0), (0, 1), (1, -1)]
LONGER = [(0, 0), (1, 0), (0, 1)]


def pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, b): every near pair of words once, a before b in code-point order."""
    keyed = vocabulary.select("word", F.char_length("word").alias("len"), _code_mod(0).alias("c0"), _code_mod(1).alias("c1"))
    keyed = stage(keyed, "spelling-keyed")
    moves = F.array(*(F.struct(F.lit(dl).alias("dl"), F.lit(a).alias("d0"), F.lit(b).alias("d1"))
                      for dl, table in ((0, SAME), (1, LONGER)) for a, b in table))
    indexed = keyed.select("word", "len", "c0", "c1", F.lit(True).alias("index"))
    probes = keyed.select("*", F.inline(moves)).select(
        "word",
        (F.col("len") + F.col("dl")).alias("len"),
        (F.col("c0") + F.col("d0")).alias("c0"),
        (F.col("c1") + F.col("d1")).alias("c1"),
        F.lit(False).alias("index"),
    )
    both = indexed.unionByName(probes)
    sizes = both.groupBy("len", "c0", "c1").agg(
        F.ceil(F.sum(F.col("index").cast("int")) / BLOCK).alias("ni"), F.ceil(F.sum((~F.col("index")).cast("int")) / BLOCK).alias("np")
    ).where("ni > 0 AND np > 0")
    # One row per key of the first two trie levels; the optimizer decides by its size how to join it.
    spread = both.join(sizes, ["len", "c0", "c1"])
    block = F.pmod(F.xxhash64("word"), F.when(F.col("index"), F.col("ni")).otherwise(F.col("np")))
    spread = spread.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.when(F.col("index"), F.col("np")).otherwise(F.col("ni")) - 1))
    )
    cell = spread.select(
        "len", "c0", "c1",
        F.when(F.col("index"), F.col("block")).otherwise(F.col("other")).alias("bi"),
        F.when(F.col("index"), F.col("other")).otherwise(F.col("block")).alias("bp"),
        "word", "index",
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        marked = frame["index"].to_numpy()
        words = frame["word"].tolist()
        found_a, found_b = search([w for w, i in zip(words, marked) if i], [w for w, i in zip(words, marked) if not i])
        return pd.DataFrame({"a": pd.Series(found_a, dtype=object), "b": pd.Series(found_b, dtype=object)})

    # Dealt by all five keys: the join above leaves the rows hashed by the first three, which the
    # grouping would keep, putting every block pair of a large key in one task.
    keys = ["len", "c0", "c1", "bi", "bp"]
    return cell.repartition(*keys).groupBy(*keys).applyInPandas(run, "a string, b string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to their end by pointer jumping."""
    jump = forms.select("word", F.coalesce("form", "word").alias("up"))
    while True:
        jump = stage(jump, "spelling-roots")
        ahead = jump.alias("j").join(jump.alias("u"), F.col("j.up") == F.col("u.word")).select(
            F.col("j.word").alias("word"), F.col("u.up").alias("up")
        )
        if ahead.join(jump, ["word", "up"], "left_anti").isEmpty():
            return jump.withColumnRenamed("up", "root")
        jump = ahead


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n (see the module)."""
    vocabulary = stage(words(docs, text, key), "spelling-words")
    links = stage(pairs(vocabulary).distinct(), "spelling-pairs")
    both = links.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    counted = both.join(vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other").alias("w"))).alias("top")
    )
    table = vocabulary.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.neg") >= FACTOR * F.col("n"), F.col("top.w")).alias("form"),
        F.when(-F.col("top.neg") >= FACTOR * F.col("n"), -F.col("top.neg")).alias("form_n"),
    )
    table = stage(table, "spelling-forms")
    roots = _roots(table.select("word", "form"))
    return table.join(roots, "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", F.col("form_n").cast("long").alias("form_n")
    )
