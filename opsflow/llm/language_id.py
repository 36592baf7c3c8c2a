"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces, computed by
the forward algorithm; a text's score is the product over its words. Piece
probabilities are trained here by expectation-maximisation over the same sum, on a
bounded sample of labelled documents (``sample`` per language, whole texts, chosen
by the hash of id and text).

Scores are sums over words, so a word is scored once while its task remembers it. Words
are runs of letters; long ones, as in scripts without blanks, are summed whole. The
trained model (pieces x languages numbers) is the only thing that is broadcast, and
its size is bounded by the vocabulary.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opsflow.llm.base import query, table
from opsflow.session import settle

MARK = "▁"
#: Probability of a letter that no piece has, the same in all languages.
RARE = 1e-7
#: Keeps products of piece probabilities within range; taken out of every score again.
SCALE = 16.0
#: Words up to this length are scored side by side, longer ones one by one in logarithms.
SHORT = 48
#: Bytes of remembered words, about, after which a worker forgets them.
REMEMBER = 64_000_000


RUNS = re.compile(r"[^\W\d_]+")


@cache
def numbers() -> dict[int, str]:
    """Characters that ``RUNS`` takes but that are no letters, such as ``½`` or ``Ⅷ``, with a blank for each."""
    kinds = ((c, unicodedata.category(chr(c))) for c in range(sys.maxunicode + 1) if chr(c).isalnum())
    return {c: " " for c, kind in kinds if kind[0] != "L" and kind != "Nd"}


@cache
def _number_characters() -> frozenset[str]:
    return frozenset(map(chr, numbers()))


def letters(text: str) -> list[str]:
    """The runs of letters (by Unicode category) of a text, in lower case."""
    text = text.lower()
    if not _number_characters().isdisjoint(text):
        text = text.translate(numbers())
    return RUNS.findall(text)


def pieces_of(path: str) -> list[str]:
    """Pieces of a sentencepiece file that can occur in a marked word of lower-case letters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in names if p and p == p.lower() and (p == MARK or letters(p.removeprefix(MARK)) == [p.removeprefix(MARK)])})


class Lattice:
    """All ways to cut words into pieces, as arrays ordered by where a piece ends."""

    def __init__(self, pieces: list[str]):
        self.automaton = ahocorasick.Automaton()
        for number, piece in enumerate(pieces):
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self.lengths = np.array([len(piece) for piece in pieces], np.int64)
        self.single = np.array([ord(piece) for piece in pieces if len(piece) == 1], np.uint32)
        self.rare = len(pieces)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """``word, start, end, piece`` of every piece occurrence; positions count the mark.

        All words are searched as one text: a mark can only begin a piece, so none crosses.
        """
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        first = np.cumsum(sizes) - sizes
        marked = MARK + MARK.join(words) if words else ""
        found = np.fromiter(chain.from_iterable(self.automaton.iter(marked)), np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        start = end - self.lengths[piece]
        chars = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
        alone = np.flatnonzero(~np.isin(chars, self.single))
        start, end = np.concatenate((start, alone)), np.concatenate((end, alone + 1))
        piece = np.concatenate((piece, np.full(len(alone), self.rare)))
        word = np.searchsorted(first, start, "right") - 1
        start, end = start - first[word], end - first[word]
        order = np.lexsort((word, end))
        return word[order], start[order], end[order], piece[order]

    @staticmethod
    def steps(positions: np.ndarray) -> Iterator[slice]:
        """Stretches of equal, ascending positions."""
        edges = np.flatnonzero(np.diff(positions, prepend=-1))
        for first, last in zip(edges, [*edges[1:], len(positions)]):
            yield slice(first, last)


def forward(lattice: tuple[np.ndarray, ...], words: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled sums over segmentations: per word and position, and the log per word.

    ``weights`` (pieces x languages) are probabilities times ``SCALE ** length``. For
    words of up to ``SHORT`` letters; beyond that sums may leave the range of floats.
    """
    word, start, end, piece = lattice
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    alpha = np.zeros((len(words), int(sizes.max(initial=0)) + 1, weights.shape[1]))
    alpha[:, 0] = 1.0
    for step in Lattice.steps(end):
        w = word[step]
        ways = alpha[w, start[step]] * weights[piece[step]]
        first = np.flatnonzero(np.diff(w, prepend=-1))
        alpha[w[first], end[step][0]] = np.add.reduceat(ways, first, axis=0)
    total = alpha[np.arange(len(words)), sizes]
    return alpha, np.log(np.maximum(total, 1e-280)) - (sizes * np.log(SCALE))[:, None]


def long_forward(lattice: tuple[np.ndarray, ...], size: int, logs: np.ndarray) -> np.ndarray:
    """Logarithms of the sums over all segmentations of one word, per position; ``logs`` of probabilities.

    A run of any length is summed whole.
    """
    _, start, end, piece = lattice
    out = np.full((size + 1, logs.shape[1]), -np.inf)
    out[0] = 0.0
    for step in Lattice.steps(end):
        out[end[step][0]] = np.logaddexp.reduce(out[start[step]] + logs[piece[step]], axis=0)
    return out


def expected(lattice, words: list[str], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in ``words`` (``counts``: times per language)."""
    word, start, end, piece = lattice
    alpha, _ = forward(lattice, words, weights)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    beta = np.zeros_like(alpha)
    beta[np.arange(len(words)), sizes] = 1.0
    back = np.lexsort((word, -start))
    uses = np.zeros_like(weights)
    total = np.maximum(alpha[np.arange(len(words)), sizes], 1e-280)
    for step in Lattice.steps(-start[back] + start.max(initial=0)):
        at = back[step]
        w = word[at]
        ways = beta[w, end[at]] * weights[piece[at]]
        first = np.flatnonzero(np.diff(w, prepend=-1))
        beta[w[first], start[at][0]] = np.add.reduceat(ways, first, axis=0)
        np.add.at(uses, piece[at], alpha[w, start[at]] * ways / total[w] * counts[w])
    return uses


def long_expected(lattice, size: int, counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """``expected`` of one word of any length."""
    _, start, end, piece = lattice
    before, after = long_forward(lattice, size, logs), np.full((size + 1, logs.shape[1]), -np.inf)
    after[size] = 0.0
    back = np.argsort(-start, kind="stable")
    for step in Lattice.steps(-start[back] + start.max(initial=0)):
        at = back[step]
        after[start[at][0]] = np.logaddexp.reduce(after[end[at]] + logs[piece[at]], axis=0)
    uses = np.zeros_like(logs)
    np.add.at(uses, piece, np.exp(before[start] + logs[piece] + after[end] - before[size]) * counts)
    return uses


@dataclass
class Model:
    """Piece log-probabilities per language. Ties go to the first language in code point order."""

    pieces: list[str]
    langs: list[str]
    probs: np.ndarray  # (pieces + 1) x languages; the last row is a letter without a piece

    def weights(self) -> np.ndarray:
        lengths = np.array([len(p) for p in self.pieces] + [1])
        return self.probs * (SCALE**lengths)[:, None]


class Scorer(dict):
    """A model at work in one task: the place of each known word's scores in ``scores``.

    Bounded by bytes: when they are used up, all words are forgotten.
    """

    def __init__(self, model: Model, room: int = REMEMBER):
        super().__init__()
        self.langs, self.lattice, self.weights = model.langs, Lattice(model.pieces), model.weights()
        with np.errstate(divide="ignore"):
            self.logs = np.log(model.probs)
        self.scores = np.zeros((1024, len(model.langs)))
        self.room, self.used = room, 0

    def _learn(self, words: list[str]) -> None:
        short = sorted((w for w in words if len(w) <= SHORT), key=len)
        parts = [short[i : i + 4000] for i in range(0, len(short), 4000)]
        found = [forward(self.lattice(part), part, self.weights)[1] for part in parts]
        for word in words:
            if len(word) > SHORT:
                parts.append([word])
                found.append(long_forward(self.lattice([word]), len(word) + 1, self.logs)[-1:])
        for part, logs in zip(parts, found):
            size, after = len(self), len(self) + len(part)
            if after > len(self.scores):
                self.scores = np.concatenate((self.scores, np.zeros((max(len(self.scores), len(part)), len(self.langs)))))
            self.scores[size:after] = logs
            self.update(zip(part, range(size, after)))
            self.used += sum(map(len, part)) + len(part) * (160 + 16 * len(self.langs))

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted languages and their share of the posterior, for a batch of texts."""
        if self.used > self.room:
            self.clear()
            self.scores, self.used = self.scores[:1024].copy(), 0
        split = [letters(text) if text else [] for text in texts]
        langs, shares = ["und"] * len(texts), np.zeros(len(texts))
        counts = np.array([len(words) for words in split], np.int64)
        full = np.flatnonzero(counts)
        if not len(full) or not self.langs:
            return langs, shares
        self._learn(list(set(chain.from_iterable(split)).difference(self)))
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
        logs = np.add.reduceat(self.scores[at], np.cumsum(counts[full]) - counts[full], axis=0)
        best = logs.argmax(axis=1)
        shares[full] = 1 / np.exp(logs - logs[np.arange(len(full)), best][:, None]).sum(axis=1)
        for i, lang in zip(full.tolist(), best.tolist()):
            langs[i] = self.langs[lang]
        return langs, shares


#: Sampled rows up to which their keys are sent to all tasks.
FEW = 20_000


def _sampled(docs: DataFrame, sample: int) -> DataFrame:
    """``lang, text`` of at most ``sample`` rows per language, by the hash of id and text.

    Only keys travel; texts are read once more and picked by the chosen keys, which are
    sent to all tasks while they are at most ``FEW``.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("doc_id", "text").alias("_key"))
    order = Window.partitionBy("lang").orderBy("_key")
    chosen = known.select("lang", "_key").distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample)
    few = settle(chosen.select("lang", "_key"), "sampled")
    return known.join(F.broadcast(few) if few.count() <= FEW else few, ["lang", "_key"]).select("lang", "text")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts.update((lang, word) for word in letters(text.as_py()))
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())],
            names=["lang", "word", "n"],
        )


def train(docs: DataFrame, vocabulary: str, sample: int = 400, rounds: int = 2) -> Model:
    """Piece probabilities of every ``lang`` that ``docs`` holds.

    ``sample`` bounds the documents per language that are learned from; a language
    with fewer gives all. Rows without language or text are not used; rows without an id
    are, and rows equal in id and text count once in the choice. Word counts
    and expected piece counts are summed on the executors; the driver gets pieces x
    languages numbers per round.
    """
    spark = docs.sparkSession
    counted = (
        _sampled(docs, sample)
        .mapInArrow(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    words = settle(counted, "language-words")
    pieces = pieces_of(vocabulary)
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    probs = np.full((len(pieces) + 1, len(langs)), 1 / max(1, len(pieces)))
    probs[-1] = RARE
    model = Model(pieces, langs, probs)
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast(model)

        def uses(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            now = shared.value
            lattice, weights = Lattice(now.pieces), now.weights()
            logs = np.log(np.maximum(now.probs, 1e-300))
            total = np.zeros_like(weights)
            for frame in frames:
                wide = frame.pivot_table(index="word", columns="lang", values="n", aggfunc="sum", fill_value=0)
                wide = wide.reindex(columns=now.langs, fill_value=0)
                is_long = wide.index.str.len() > SHORT
                for word, counts in zip(wide.index[is_long], wide[is_long].to_numpy(float)):
                    total += long_expected(lattice([word]), len(word) + 1, counts, logs)
                wide = wide[~is_long]
                for i in range(0, len(wide), 2000):
                    part = wide.iloc[i : i + 2000]
                    some = list(part.index)
                    total += expected(lattice(some), some, part.to_numpy(float), weights)
            piece, lang = np.nonzero(total[:-1])
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": total[piece, lang]})

        summed = words.mapInPandas(uses, "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
        got = summed.toPandas()
        counts = np.full((len(pieces), len(langs)), 0.02)
        counts[got["piece"], got["lang"]] += got["uses"]
        probs = np.vstack([counts / counts.sum(axis=0), np.full((1, len(langs)), RARE)])
        model = Model(pieces, langs, probs)
    return model


def identify(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1), from ``text`` alone.

    The language is ``und`` with score 0 for a text that is null, empty or without a
    letter, or if the model knows no language. Columns of the
    names ``lang`` and ``score`` are replaced; all others stay as they are. Repeated rows give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)  # a worker outlives its task, what it remembers does not
        for batch in texts:
            langs, scores = scorer(batch.tolist())
            yield pd.DataFrame({"lang": langs, "score": scores})

    # the row travels as one value, so its columns may have any names
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = docs.select(whole, predict(F.col("text").cast("string")).alias("_found"))
    made = {lang: F.col("_found.lang").alias(lang), score: F.col("_found.score").alias(score)}
    names = [*docs.columns, *[c for c in made if c not in docs.columns]]
    return found.select(*[made.get(c, F.col(f"_row.`{c}`").alias(c)) for c in names])


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``: crc32 of the id as text, modulo 4, is 2 (a null id is not)."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return docs.withColumn("held_out", F.coalesce(rest == 2, F.lit(False)))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op9_language_id")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = held_out(table(spark, folder, "documents"))
    model = train(docs.where("NOT held_out"), vocabulary_path())
    return identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
