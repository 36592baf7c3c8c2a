"""Quality rules with cross-document line frequency, in DataFrame expressions only.

Lines are normalised (ASCII lower case, runs of white space as one blank) and
hashed together with their host. A line that more than ``max_docs`` documents of one
host hold is boilerplate there and is removed from their texts; a document that loses more than
``max_lost`` of its words this way is depleted and rejected, as is one that fails the
base rules. The limits are absolute and the same at every size.

The text is read into a written table of counts and line hashes, and once more when
the lines to remove are known: they are joined to the texts by two hashes of source and
text, which decide both. Lines are counted once per document (distinct inside the row)
with a map-side combine, so a line in a third of all documents costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsflow.llm.base import SPACE, SPACE_CLASS, group_key, query, table
from opsflow.session import settle

SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, not at each use inside a lambda."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words inside any three-word window that occurs twice or more in ``words``.

    Windows are compared by 64-bit hashes. Only where some hash repeats are they
    sorted with their positions; positions next to an equal hash are repeated, and
    each covers three words, less what the next one covers.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    def marked(ordered: Column) -> Column:
        equal = lambda x, j: F.coalesce(x["h"] == F.get(ordered, j)["h"], F.lit(False))
        near = F.filter(ordered, lambda x, j: equal(x, j + 1) | equal(x, j - 1))
        return F.array_sort(F.transform(near, lambda x: x["at"]))

    def of(hashes: Column) -> Column:
        found = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, covered(_let(found, marked))).otherwise(F.lit(0).cast("long"))

    return _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), of)


def _clean(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), SPACE_CLASS + "+", " "))


def _lines(text: Column, host: Column) -> Column:
    """Key of each line that has a word."""
    some = F.filter(F.transform(F.split(text, "\n", -1), _clean), lambda line: line != "")
    return F.transform(some, lambda line: F.xxhash64(host, line))


def _without(text: Column, host: Column, gone: Column) -> Column:
    """``text`` without the lines whose key is in ``gone``; lines without a word stay."""
    return F.array_join(
        F.filter(F.split(text, "\n", -1), lambda line: ~F.array_contains(gone, F.xxhash64(host, _clean(line)))), "\n"
    )


def _identity(text: Column, host: Column) -> list[Column]:
    """Two hashes of text and host, by which a row is found again."""
    return [F.xxhash64(host, text).alias("_one"), F.xxhash64(text, host).alias("_two")]


def measured(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its counts, line keys and identity; null text has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    solid = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACE, "") != "")
    return (
        docs.select(
            group_key("source").alias("_host"),
            text.alias("_text"),
            _words(text).alias("_words"),
            solid.alias("_solid"),
        )
        .select(
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.translate("_text", SPACE, "")).cast("long").alias("word_chars"),
            (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_solid") - F.size(F.array_distinct("_solid"))).cast("long").alias("n_dup_lines"),
            _repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
            _lines(F.col("_text"), F.col("_host")).alias("lines"),
            *_identity(F.col("_text"), F.col("_host")),
        )
    )


def cleaned(docs: DataFrame, max_docs: int = 20, max_lost: float = 0.5) -> DataFrame:
    """Counts, base rules, verdict and the text without frequent lines for every row of ``docs``.

    Lines held by more than ``max_docs`` documents of the row's host (``source``; null is
    a host of its own) are removed from ``text``; the others stay as they are, in their
    order, also those without a word. ``n_removed_words`` are the words that the text
    lost by it. A document stays (``kept``) if the base rules pass, for its whole text,
    and at most ``max_lost`` of its words are removed. Null and empty texts have no words
    and fail. Repeated rows count as documents. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = settle(measured(docs), "quality-rows")
    keys = rows.select(F.explode(F.array_distinct("lines")).alias("key"))
    frequent = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_docs).select("key")
    frequent = settle(frequent, "frequent-lines")
    identity = ["_one", "_two"]
    gone = (
        rows.select(*identity, F.explode(F.array_distinct("lines")).alias("key"))
        .join(frequent, "key", "left_semi")
        .groupBy(*identity)
        .agg(F.collect_set("key").alias("_gone"))
    )
    counts = [c for c in rows.columns if c not in (*identity, "lines")]
    facts = rows.groupBy(*identity).agg(*[F.max(c).alias(c) for c in counts]).join(gone, identity, "left")
    text, host = F.col("text").cast("string"), group_key("source")
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text"),
        *_identity(F.coalesce(text, F.lit("")), host),
    )
    lost = F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.col("n_words") - F.size(_words(F.col("text"))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        whole.join(facts, identity)
        .withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(_without(F.col("text"), host, F.col("_gone"))))
        .withColumn("n_removed_words", lost.cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("n_removed_words") <= max_lost * F.col("n_words")))
        .select("doc_id", "source", *counts, "n_removed_words", "base_failed", "kept", "text")
    )


def quality(docs: DataFrame, max_docs: int = 20, max_lost: float = 0.5) -> DataFrame:
    """What ``cleaned`` says of every row of ``docs``, without the texts."""
    return cleaned(docs, max_docs, max_lost).drop("text")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
tri AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
s AS (
  SELECT doc_id, source, line,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM s GROUP BY doc_id),
f AS (SELECT source, norm FROM s GROUP BY source, norm HAVING count(DISTINCT doc_id) > 20),
lost AS (
  SELECT doc_id, sum(len(string_split(norm, ' ')))::BIGINT AS n FROM s
  WHERE EXISTS (SELECT 1 FROM f WHERE f.norm = s.norm AND f.source IS NOT DISTINCT FROM s.source) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, d.source, len(w.words) AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         coalesce(lost.n, 0) AS n_removed_words
  FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND n_removed_words <= 0.5 * n_words AS kept FROM b
"""


@query("op8_quality_rules", SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"))
