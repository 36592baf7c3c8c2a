"""Language scores against sums over every segmentation, written out."""

import math
import random
import unicodedata

import numpy as np
import pytest

from opsflow.llm.language_id import (
    MARK, RARE, Lattice, Model, Scorer, expected, forward, identify, letters, long_expected, long_forward,
)
from tests.llm.helpers import DOCS

PIECES = sorted([MARK, *"abcdeé", MARK + "a", MARK + "ab", "ab", "bc", "abc", "cd", "dé", "éa", MARK + "cde", "aa", "aaa"])


def model(seed=1):
    rng = np.random.default_rng(seed)
    probs = rng.random((len(PIECES) + 1, 3)) + 0.01
    probs /= probs.sum(axis=0)
    probs[-1] = RARE
    return Model(PIECES, ["x", "y", "z"], probs)


def segmentations(word):
    """All lists of pieces; a letter that no piece is may stand alone (place ``len(PIECES)``)."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        head = word[:n]
        if head in PIECES:
            yield from ([PIECES.index(head), *rest] for rest in segmentations(word[n:]))
        elif n == 1:
            yield from ([len(PIECES), *rest] for rest in segmentations(word[1:]))


def plain(now, word):
    return sum(np.prod(now.probs[cut], axis=0) for cut in segmentations(MARK + word))


def by_position(now, word):
    """The log of the sum for one word of any length, with whole numbers of any size."""
    from fractions import Fraction

    marked, out = MARK + word, []
    for lang in range(3):
        sums = [Fraction(1)] + [Fraction(0)] * len(marked)
        for end in range(1, len(marked) + 1):
            for n in range(1, min(4, end) + 1):
                piece = marked[end - n : end]
                at = PIECES.index(piece) if piece in PIECES else len(PIECES) if n == 1 else None
                if at is not None:
                    sums[end] += sums[end - n] * Fraction(float(now.probs[at, lang]))
        top = sums[-1]
        out.append(math.log(top.numerator) - math.log(top.denominator))
    return np.array(out)


WORDS = ["a", "abc", "aaaa", "abcdéa", "qab", "éé", "aaabcq", "cdeab"]


def test_forward_sums_all_segmentations():
    now = model()
    got = forward(Lattice(PIECES)(WORDS), WORDS, now.weights())[1]
    assert np.allclose(got, np.log([plain(now, w) for w in WORDS]), rtol=1e-9)


@pytest.mark.parametrize("size", [49, 500, 3000])
def test_a_long_run_is_summed_whole(size):
    now, rng = model(), random.Random(size)
    word = "".join(rng.choice("abcdeéq") for _ in range(size))
    got = long_forward(Lattice(PIECES)([word]), size + 1, np.log(now.probs))[-1]
    assert np.allclose(got, by_position(now, word), rtol=1e-9)


def test_expected_uses():
    now, counts = model(), np.array([2.0, 0.0, 5.0])
    for word in WORDS:
        want = np.zeros_like(now.probs)
        for cut in segmentations(MARK + word):
            share = np.prod(now.probs[cut], axis=0) / plain(now, word)
            for piece in cut:
                want[piece] += share * counts
        lattice = Lattice(PIECES)([word])
        assert np.allclose(expected(lattice, [word], counts[None], now.weights()), want)
        assert np.allclose(long_expected(lattice, len(word) + 1, counts, np.log(now.probs)), want)


@pytest.mark.parametrize("room", [10**9, 1])
def test_prediction_is_the_best_of_all_segmentations(room):
    now, rng = model(), random.Random(2)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(1, 9))) for _ in range(50)] + [None, "", "12", "½ ²", "Ab,ABC", "a" * 120]
    scorer = Scorer(now, room)
    for _ in range(2):
        langs, shares = scorer(texts)
        for text, lang, share in zip(texts, langs, shares):
            words = letters(text or "")
            if not words:
                assert (lang, share) == ("und", 0.0)
                continue
            logs = sum(by_position(now, w) for w in words)
            assert lang == now.langs[int(np.argmax(logs))]
            assert share == pytest.approx(1 / np.exp(logs - logs.max()).sum())


def test_letters_are_those_of_unicode(spark):
    text = "½ ² Ⅷ ٣ _ ① Año 水 ªº Ǆ"
    assert letters(text) == ["año", "水", "ªº", "ǆ"]
    every = "".join(map(chr, range(0x3000)))
    assert "".join(letters(every)) == "".join(c for c in every.lower() if unicodedata.category(c)[0] == "L")
    rows = [(i, t, *[None] * 7) for i, t in enumerate(["½ ²", "Ⅷ", None, "", "a½"])]
    found = identify(spark.createDataFrame(rows, DOCS), model()).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in found] == [True, True, True, True, False]
    assert all(r.score == 0 for r in found[:4])
