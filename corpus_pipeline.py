"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents its predecessor kept, written and read again, and
all but the last return rows with the columns of ``documents``, whatever these are named.
A null text counts as empty in all of them, an empty table gives an empty one, and rows
without an id are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.llm.base import table
from opsflow.llm.exact_dedup import exact_duplicates, keep_rows
from opsflow.llm.language_id import identify, train, vocabulary_path
from opsflow.llm.mixing import mixed_texts
from opsflow.llm.ngram_join import one_of_each, similar_documents
from opsflow.llm.packing import pack
from opsflow.session import configure, settle

#: Share of the posterior below which a document's language counts as unknown.
SURE = 0.5
END_ID = 2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; texts without a letter (null and empty ones
    too) and doubtful ones go. Rows without ``lang`` are judged like others, but not learned
    from. Repeated rows are judged alike. Without any ``lang`` no language is known and all go.
    """
    configure(spark)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), "text")
    found = identify(whole, train(docs, vocabulary_path()), "found", "share")
    return found.where((F.col("found") != "und") & (F.col("share") >= SURE)).select("document.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with most code points, then the
    least id (null last). Of rows repeated in every column one stays; null and empty texts are one group."""
    return keep_rows(docs, exact_duplicates(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: the least id (null last), then the least
    hash of the text, then one of rows repeated. Texts without words link with nothing and stay."""
    return keep_rows(docs, one_of_each(similar_documents(docs)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: whole documents and stretches of them. A null source is
    one of its own; documents without words are never taken; repeated rows are taken each on its own."""
    return mixed_texts(docs, seed=11)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 4096 tokens. An empty text is its end token
    alone; repeated rows are packed each."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=END_ID)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Training, drawing and packing are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
