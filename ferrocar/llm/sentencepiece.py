"""SentencePiece encoding and decoding with the Unigram model.

Text is marked (a marker before it and for each space) and cut into the pieces with the greatest
sum of log scores, by Viterbi over a double-array trie of the pieces' bytes. A character that no
piece covers falls back to its bytes. Decoding joins the pieces, bytes included, and turns markers
back into spaces.

No piece holds a marker after another character, so the best path of a text is that of its words,
and each distinct word is cut only once in a task.
"""

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrocar.llm import common

MARK = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNKNOWN_PENALTY = 10.0
# Longer words (in bytes) are cut one by one; shorter ones together, in tables of so many cells.
LONG, CELLS = 96, 1 << 21
_WORDS = re.compile(" *[^ ]+| +")


class DoubleArray:
    """A trie in two arrays: the child of state s by byte c is t = base[s] + c where check[t] == s."""

    def __init__(self, keys: dict[bytes, int]):
        tree: dict = {}
        for key in keys:
            node = tree
            for c in key:
                node = node.setdefault(c, {})
        size = 1 << 12
        self.base, self.check, self.value = (np.full(size, fill, np.int32) for fill in (0, -1, -1))
        self.check[0] = 0
        # The lowest free place, which single children take, and where wider nodes go on looking.
        free, wide, todo = 1, 1, [(0, b"", tree)]
        while todo:
            state, prefix, node = todo.pop()
            self.value[state] = keys.get(prefix, -1)
            if not node:
                continue
            codes = sorted(node)
            while max(free, wide) + 600 > len(self.check):
                self._grow()
            check = self.check
            if len(codes) == 1:
                while check[free] != -1 or free <= codes[0]:
                    free += 1
                start = free - codes[0]
            else:
                start = wide
                while any(check[start + c] != -1 for c in codes):
                    start += 1
                    if start + 600 > len(self.check):
                        self._grow()
                        check = self.check
                # A place that has failed often is left behind.
                wide = start if start - wide < 64 else start - 32
            self.base[state] = start
            for c in codes:
                check[start + c] = state
            todo += [(start + c, prefix + bytes([c]), child) for c, child in node.items()]

    def _grow(self) -> None:
        more = len(self.check)
        self.base = np.r_[self.base, np.zeros(more, np.int32)]
        self.check = np.r_[self.check, np.full(more, -1, np.int32)]
        self.value = np.r_[self.value, np.full(more, -1, np.int32)]


class Model:
    """Pieces with scores by id; the bytes that each id stands for; the trie."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        """``pieces``: text, log score and kind by id; kinds as in SentencePiece's model files."""
        self.scores = np.array([s for _, s, _ in pieces], np.float64)
        self.trie = DoubleArray({p.encode(): i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL})
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next((i for i, x in enumerate(pieces) if x[2] == UNKNOWN), 0)
        normal = [s for _, s, kind in pieces if kind == NORMAL]
        self.unknown_score = (min(normal) if normal else 0.0) - UNKNOWN_PENALTY
        plain = {NORMAL: lambda p: p.replace(MARK, " ").encode(), BYTE: lambda p: bytes([int(p[3:5], 16)]), UNKNOWN: lambda p: " ⁇ ".encode()}
        # Neighbouring characters that no piece holds: a word's best path is that of the parts between them.
        self.joined = {pair for p, _, kind in pieces if kind == NORMAL for pair in zip(p, p[1:])}
        self.bytes = [plain[kind](p) if kind in plain else b"" for p, _, kind in pieces]

    def fallback(self, char: bytes) -> tuple[int, ...]:
        return tuple(self.byte_ids.get(c, self.unknown) for c in char) if self.byte_ids else (self.unknown,)

    def _trace(self, word: bytes, back: list[int] | np.ndarray, ids: list[int] | np.ndarray) -> tuple[int, ...]:
        out, at = [], len(word)
        while at:
            start = int(back[at])
            out.append((int(ids[at]),) if ids[at] >= 0 else self.fallback(word[start:at]))
            at = start
        return tuple(chain.from_iterable(reversed(out)))

    def cut_long(self, word: bytes) -> tuple[int, ...]:
        """The best pieces of one word of any length."""
        base, check, value, n = self.trie.base, self.trie.check, self.trie.value, len(word)
        best, back, ids = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0], at = 0.0, 0
        while at < n:
            width = _char_width(word[at])
            state, k, single, here = 0, at, False, best[at]
            while k < n:
                to = int(base[state]) + word[k]
                if to >= len(check) or check[to] != state or to == 0:
                    break
                state, k = to, k + 1
                if (i := int(value[state])) >= 0:
                    single |= k - at == width
                    if (s := here + float(self.scores[i])) > best[k]:
                        best[k], back[k], ids[k] = s, at, i
            if not single and (s := here + self.unknown_score) > best[at + width]:
                best[at + width], back[at + width], ids[at + width] = s, at, -1
            at += width
        return self._trace(word, back, ids)

    def cut_short(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The best pieces of each of many short words, all of them a byte at a time."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        n, size = len(words), np.array([len(w) for w in words])
        wide = int(size.max())
        text = np.zeros((n, wide + 1), np.uint8)
        text[np.repeat(np.arange(n), size), np.concatenate([np.arange(s) for s in size])] = np.frombuffer(b"".join(words), np.uint8)
        best = np.full((n, wide + 1), -np.inf)
        back, ids = np.zeros((n, wide + 1), np.int16), np.full((n, wide + 1), -1, np.int32)
        best[:, 0] = 0
        for at in range(wide):
            row = np.flatnonzero((size > at) & (best[:, at] > -np.inf))
            if not len(row):
                continue
            here, width = best[row, at], _WIDTHS[text[row, at]]
            single = np.zeros(len(row), bool)
            live, state = np.arange(len(row)), np.zeros(len(row), np.int64)
            for k in range(at, wide):
                live_ok = size[row[live]] > k
                live, state = live[live_ok], state[live_ok]
                to = base[state] + text[row[live], k].astype(np.int64)
                ok = (to > 0) & (to < len(check))
                ok[ok] = check[to[ok]] == state[ok]
                live, state = live[ok], to[ok]
                if not len(live):
                    break
                found = value[state]
                end = found >= 0
                if end.any():
                    who, piece = live[end], found[end]
                    single[who] |= width[who] == k + 1 - at
                    s = here[who] + self.scores[piece]
                    better = s > best[row[who], k + 1]
                    r = row[who[better]]
                    best[r, k + 1], back[r, k + 1], ids[r, k + 1] = s[better], at, piece[better]
            alone = np.flatnonzero(~single)
            r, to = row[alone], at + width[alone]
            s = here[alone] + self.unknown_score
            better = s > best[r, to]
            best[r[better], to[better]], back[r[better], to[better]], ids[r[better], to[better]] = s[better], at, -1
        return [self._trace(w, back[i], ids[i]) for i, w in enumerate(words)]

    def parts(self, word: str) -> list[str]:
        """A word's parts that no piece reaches beyond."""
        out, start = [], 0
        for i, pair in enumerate(zip(word, word[1:]), 1):
            if pair not in self.joined:
                out.append(word[start:i])
                start = i
        return [*out, word[start:]]

    def cut(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """The pieces of each of several words, spaces standing for markers."""
        parts = {w: self.parts(w.replace(" ", MARK)) for w in words}
        todo = sorted((w.encode() for w in set(chain.from_iterable(parts.values()))), key=len)
        known: dict[str, tuple[int, ...]] = {}
        at = 0
        while at < len(todo) and len(todo[at]) <= LONG:
            to = at + 1
            while to < len(todo) and len(todo[to]) <= LONG and (to - at + 1) * len(todo[to]) <= CELLS:
                to += 1
            known.update(zip((w.decode() for w in todo[at:to]), self.cut_short(todo[at:to])))
            at = to
        known.update((w.decode(), self.cut_long(w)) for w in todo[at:])
        return {w: known[p[0]] if len(p) == 1 else tuple(chain.from_iterable(map(known.__getitem__, p))) for w, p in parts.items()}

    def encode(self, texts: list[str | None], memo: common.Seen) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts together, and where each text's begin and the last one's end."""
        split = [_split(t) for t in texts]
        found = memo.all(set(chain.from_iterable(split)), self.cut)
        ids, ends = [], [0]
        for words in split:
            ids.append(np.fromiter(chain.from_iterable(map(found.__getitem__, words)), np.int32))
            ends.append(ends[-1] + len(ids[-1]))
        return np.concatenate([*ids, np.zeros(0, np.int32)]), np.array(ends, np.int32)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids; ids beyond the pieces are unknown, control pieces stand for nothing."""
        known = len(self.bytes)
        table = np.empty(known, object)
        table[:] = self.bytes
        parts = table[np.where((ids >= 0) & (ids < known), ids, self.unknown)].tolist()
        texts = [b"".join(parts[a:b]).decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
        return [t[1:] if t[:1] == " " else t for t in texts]


def _char_width(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


_WIDTHS = np.array([_char_width(c) for c in range(256)])


def _split(text: str | None) -> list[str]:
    """A text's words, each with the spaces before it and the text's marker; markers count as spaces."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _WORDS.findall(" " + text)
    return (" " + text.replace(" ", "\x00 ")).split("\x00") if "\x00" not in text else _WORDS.findall(" " + text)


def load(path: str) -> Model:
    """The pieces of a model file. Its pieces stand in order of their merges, the more frequent first, so
    Zipf's law gives the log scores: minus the logarithm of a piece's place.
    """
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return Model([(p.piece, float(np.float32(-np.log(i + 2))), p.type) for i, p in enumerate(proto.pieces)])


def encode(model: Model, spark: SparkSession, text: str = "text") -> Column:
    """A column with the ids of a text; of a null text, none."""
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("array<int>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = common.Seen()
        for part in parts:
            ids, ends = shared.value.encode(part.to_pylist(), memo)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))

    return run(F.col(text).cast("string"))


def _lengths(part: pa.ListArray) -> np.ndarray:
    return np.diff(part.offsets.to_numpy())


def decode(model: Model, spark: SparkSession, ids: str = "ids") -> Column:
    """A column with the text of some ids; null ids give an empty text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            part = part.fill_null([]) if part.null_count else part
            yield pa.array(shared.value.decode(part.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(_lengths(part))]), pa.string())

    return run(F.col(ids))


def tokenised(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids, same): each row's ids and whether decoding them gives its text again.

    A null text is empty. A text that holds the marker itself comes back with spaces in its place, so
    it is compared in that form. Other columns are ignored; rows with one id are each returned.
    """
    spark, model = docs.sparkSession, load(path)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("ids", encode(model, spark)).withColumn("back", decode(model, spark))
    same = F.col("back") == F.translate("text", MARK, " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("same"))
