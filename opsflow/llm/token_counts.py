"""Token counts without tokens: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates every vocabulary piece in the text; dynamic
programming carries, per position, the best score and the number of pieces on the
way there, and no segmentation is ever built. Ties follow the tokenizer: of equal
scores the path whose last piece begins earliest stays, as a later start replaces
it only by a strictly better score. A character without a piece of its own is an
unknown piece, ten below the lowest score, and counts as its UTF-8 bytes.

No piece has its word mark behind another character, so paths never cross from one
word into the next and the text is counted word by word, each distinct word once per
task. Where a vocabulary has such pieces, the whole text is one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.llm.base import query, table

MARK = "▁"
#: Words whose counts one task remembers at a time; forgetting costs time only.
REMEMBER = 400_000


class Unigram:
    """Pieces with scores. Scores of whole numbers add up without rounding."""

    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece in pieces if len(piece) == 1}
        self.unknown = min(pieces.values(), default=0.0) - 10
        self.byte_fallback = byte_fallback
        self.by_word = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        self.seen: dict[str, tuple[float, int]] = {}

    @classmethod
    def load(cls, path: str) -> Unigram:
        """The pieces and scores of a sentencepiece file; control and byte pieces match no text."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls(
            {
                model.id_to_piece(i): model.get_score(i)
                for i in range(model.get_piece_size())
                if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
            }
        )

    def best(self, word: str) -> tuple[float, int]:
        """Score and piece count of the best segmentation."""
        size = len(word)
        if not size:
            return 0.0, 0
        score: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)
        done = 0

        def close(end: int) -> None:
            """The unknown piece comes last among the ways to ``end``."""
            char = word[end - 1]
            if char not in self.single:
                known, new = score[end], score[end - 1] + self.unknown
                if known is None or new > known:
                    score[end] = new
                    count[end] = count[end - 1] + (len(char.encode()) if self.byte_fallback else 1)

        for last, (length, own) in self.automaton.iter(word):
            end = last + 1
            while done < end - 1:
                done += 1
                close(done)
            new = score[end - length] + own
            known = score[end]
            # matches at one end come longest first, so the earliest start wins a tie
            if known is None or new > known:
                score[end], count[end] = new, count[end - length] + 1
        while done < size:
            done += 1
            close(done)
        return score[size], count[size]

    def count(self, text: str) -> tuple[float, int]:
        """Score and piece count of a whole text, white space marked as the vocabulary does."""
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.best(marked)
        seen = self.seen
        if len(seen) > REMEMBER:
            seen.clear()
        total, pieces = 0.0, 0
        for word in _split(marked):
            found = seen.get(word)
            if found is None:
                found = seen[word] = self.best(word)
            total += found[0]
            pieces += found[1]
        return total, pieces


def _split(marked: str) -> list[str]:
    """Words with the marks before them; line ends, of which no piece is made, stand alone."""
    if MARK + MARK not in marked and "\n" not in marked:
        return [MARK + word for word in marked.split(MARK)[1:]]
    out, marks = [], ""
    for i, word in enumerate(marked.split(MARK)):
        marks += MARK if i else ""
        if word:
            out.append(marks + word)
            marks = ""
    return out + [marks] if marks else out


@cache
def _loaded(path: str) -> Unigram:
    return Unigram.load(path)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_chars, n_tokens, score`` per row of ``docs``.

    ``vocabulary`` is the path of a sentencepiece file that every executor can read.
    Null and empty texts have no tokens. Whole texts are counted; repeated rows give
    a row each; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(vocabulary)
        for batch in batches:
            chars, tokens, scores = [], [], []
            for text in batch.column(1):
                value = text.as_py() or ""
                score, count = model.count(value)
                chars.append(len(value))
                tokens.append(count)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())],
                names=["doc_id", "n_chars", "n_tokens", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_chars long, n_tokens long, score double"
    )


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
