"""Small document tables with the awkward cases, and plain versions of the operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns with names that operators use themselves
        T.StructField("size", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("hash", T.StringType()),
    ]
)
VOCAB = {
    "en": "the of and with which people water stone letter under winter these morning would table number before".split(),
    "fr": "le la des avec quelle rivière pierre lettre sous hiver matin pourrait nombre avant être école garçon".split(),
}


def prose(rng, lang, words):
    out = [rng.choice(VOCAB[lang]) + rng.choice(["", "", ",", "."]) for _ in range(words)]
    return "".join(w + rng.choice([" ", " ", "  ", "\n"]) for w in out)


def awkward(seed=0, n=60):
    """Rows with copies, near copies, a shared passage, nulls, empties, repeats and one long text."""
    rng = random.Random(seed)
    rows = []
    passage = prose(rng, "en", 60)
    for i in range(n):
        lang = "fr" if i % 3 == 0 else "en"
        rows.append([i, prose(rng, lang, rng.randrange(1, 120)), lang, rng.choice(["a", "a", "a", "b", "c", None])])
    for i in range(12):
        base = rows[i][1]
        rows.append([100 + i, base if i % 2 else base.replace(" ", "\t", 3), rows[i][2], "a"])
    long_ = prose(rng, "en", 200)
    for i in range(8):
        words = long_.split(" ")
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append([200 + i, " ".join(words), "en", "b"])
    for i in range(6):
        rows.append([300 + i, prose(rng, "en", 20) + passage + prose(rng, "en", 20), "en", "c"])
    rows += [
        [400, None, "en", "a"], [401, "", None, None], [402, " \n\t", "en", "b"], [403, "123 456 !!", "en", "b"],
        [404, prose(rng, "en", 6000), "en", "d"], [405, "aaaa" * 90, "en", "d"], [406, "x", None, "d"], [407, "X", "fr", "d"],
    ]
    return [(d, t, lang, s, len(t or ""), "9", "r", "s", "h") for d, t, lang, s in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3, "doc_id")


def repeated(rows):
    """The rows, some of them twice, and some without an id."""
    return rows + rows[:5] + [(None, *r[1:]) for r in rows[3:6]]
