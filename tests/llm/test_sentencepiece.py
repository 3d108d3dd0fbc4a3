import random

import numpy as np
import pytest

from ferrocar.llm import common, sentencepiece
from ferrocar.llm.queries import TOKENIZERS
from tests.conftest import SMALL
from tests.llm.conftest import DOCS

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.load(PATH)


@pytest.fixture(scope="module")
def library():
    """The library's own Unigram over the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):
        piece.score = float(np.float32(-np.log(i + 2)))
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def ids_of(model, texts):
    ids, ends = model.encode(texts, common.Seen())
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def test_same_pieces_as_the_library(spark, model, library):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["", " ", "  a  b ", "☃ \n x   y", "a" * 300 + "日本語 テキスト" * 30, "é́ ﷺ 🙂"]
    mine, theirs = ids_of(model, texts), library.encode(texts)
    total = lambda ids: sum(model.scores[i] for i in ids if i not in model.byte_ids.values())
    # The library adds up single precision numbers, so near-ties may fall otherwise.
    assert all(a == b or total(a) >= total(b) - 0.01 for a, b in zip(mine, theirs))
    assert np.mean([a == b for a, b in zip(mine, theirs)]) > 0.9


def test_every_piece_is_in_the_trie(model):
    trie = model.trie
    for i, (score, text) in enumerate(zip(model.scores, model.bytes)):
        if i < 259:
            continue
        state = 0
        for c in text.replace(b" ", "▁".encode()):
            to = int(trie.base[state]) + c
            assert trie.check[to] == state
            state = to
        assert trie.value[state] == i


def test_short_and_long_paths_agree(model):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdehinorst▁.☃ß", k=rng.randint(1, 30))).encode() for _ in range(300)]
    assert model.cut_short(words) == [model.cut_long(w) for w in words]


def test_best_path_matches_brute_force():
    pieces = [("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("aba", -6.0, 1), ("▁", -1.0, 1), ("▁a", -2.2, 1)]
    model = sentencepiece.Model(pieces)
    normal = {p: s for p, s, kind in pieces if kind == 1}

    def best(word):
        if not word:
            return 0.0
        return max([s + best(word[len(p) :]) for p, s in normal.items() if word.startswith(p)] + ([model.unknown_score + best(word[1:])] if word[0] not in normal else []))

    rng = random.Random(4)
    for _ in range(100):
        word = "".join(rng.choices("ab▁c", k=rng.randint(1, 9)))
        ids = model.cut_long(word.encode())
        got = sum(model.scores[i] if i > 256 else model.unknown_score for i in ids)
        assert got == pytest.approx(best(word))


def test_decoding_gives_the_texts_back(model):
    texts = ["", "a", " a", "a  b\n", "☃🙂 ß", "\x00 \x01"]
    ids, ends = model.encode(texts, common.Seen())
    assert model.decode(ids, ends) == texts
    assert model.decode(np.array([10**6, -1, 1, 2], np.int32), np.array([0, 4])) == ["⁇  ⁇ "]


def test_odd_rows(spark, odd_documents):
    rows = sentencepiece.tokenised(odd_documents, PATH).collect()
    assert len(rows) == 10 and all(r.same and r.n_tokens == len(r.ids) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert sentencepiece.tokenised(spark.createDataFrame([], DOCS), PATH).count() == 0
