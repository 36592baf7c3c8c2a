"""Packing, token counts and language identification."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tests.llm.helpers import DOCS, awkward, frame, repeated
from tokenizers import Tokenizer, models, normalizers

from opsflow.llm.language_id import Lattice, Model, expected, forward, held_out, identify, train, vocabulary_path
from opsflow.llm.packing import WordBpe, pack
from opsflow.llm.token_counts import MARK, Unigram, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "it's can't 'tis we'll I'D", "<|endoftext|> a", "Ünï ﬁ ſ İ ĉ́ 漢字 Ω", "a\x1cb\x85c\xa0d​e", "12 ½ ²x _-!?", "\n\n a  b   c\t", "a" * 500,
]


def test_word_ids_are_those_of_the_library():
    ours, library = WordBpe(WORDS), Tokenizer.from_file(WORDS)
    for text in [r[1] or "" for r in awkward()] + ODD:
        assert np.frombuffer(ours.ids(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("room", [64, 4096])
def test_packing_round_trip(spark, room):
    rows = repeated(awkward())
    library = Tokenizer.from_file(WORDS)
    pieces = pack(frame(spark, rows), WORDS, end_id=2, room=room, open_windows=4).collect()
    want = Counter()
    ids = defaultdict(list)
    for doc, text, *_ in rows:
        own = library.encode(text or "", add_special_tokens=False).ids + [2]
        want[(doc, len(own))] += len(own)
        ids[(doc, len(own))].append(own)
    got, windows = Counter(), defaultdict(list)
    for p in pieces:
        got[(p.doc_id, p.doc_tokens)] += p.length
        windows[p.sequence_id].append((p.offset, p.length))
        crcs = {zlib.crc32(np.array(d[p.start : p.start + p.length], np.uint32).tobytes()) for d in ids[(p.doc_id, p.doc_tokens)]}
        assert p.ids_crc32 in crcs
    assert got == want
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    assert len(windows) * room <= 1.25 * sum(want.values()) + room


def test_counts_equal_the_library(spark):
    ours = Unigram.load(PIECES)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = [(str(i) if model.is_control(i) else model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    library = Tokenizer(models.Unigram(vocabulary, 0, True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend(MARK), normalizers.Replace(" ", MARK)])
    rows = awkward()
    texts = [r[1] or "" for r in rows] + [t for t in ODD if "<" not in t]
    for text in texts:
        assert ours.count(text)[1] == len(library.encode(text, add_special_tokens=False).ids)
    got = {r.doc_id: r.n_tokens for r in token_counts(frame(spark, rows), PIECES).collect()}
    assert got == {r[0]: ours.count(r[1] or "")[1] for r in rows}


def test_ties_go_to_the_earliest_start():
    model = Unigram({"a": -2.0, "aa": -3.0, "aaa": -5.0, "b": -1.0, MARK: -1.0})
    assert model.best("aaa") == (-5.0, 1)  # a+aa ties with aaa, whose last piece starts first
    assert model.count("ab") == (-4.0, 3)
    assert model.count("é")[1] == 3  # mark and two bytes


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "▁", "▁a"]
    probs = np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.3], [0.2, 0.2], [0.2, 0.2], [1e-7, 1e-7]])
    model = Model(pieces, ["x", "y"], probs)
    lattice = Lattice(pieces)
    _, logs = forward(lattice(["ab"]), ["ab"], model.weights())
    want = [0.2 * 0.1 * 0.3 + 0.2 * 0.2 + 0.2 * 0.3, 0.2 * 0.2 * 0.3 + 0.2 * 0.1 + 0.2 * 0.3]
    assert np.allclose(np.exp(logs[0]), want)
    uses = expected(lattice(["ab"]), ["ab"], np.ones((1, 2)), model.weights())
    assert np.allclose(uses[4], [0.06 / want[0], 0.06 / want[1]])


def test_language_identification(spark):
    rows = repeated(awkward(5, 90))
    docs = held_out(frame(spark, rows))
    found = identify(docs, train(docs.where("NOT held_out"), vocabulary_path(), sample=50)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    sure = [r for r in found if r.held_out and r.text and len(r.text.split()) > 20 and r.doc_id < 400]
    assert len(sure) > 5 and all(r.lang == r.lang_pred for r in sure)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert pack(empty, WORDS, 2).count() == 0
    assert token_counts(empty, PIECES).count() == 0
    model = train(empty, vocabulary_path())
    assert model.langs == []
    assert identify(empty, model).count() == 0
    assert {r.lang_pred for r in identify(frame(spark, awkward()[:3]), model).collect()} == {"und"}
