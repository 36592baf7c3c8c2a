"""Ranked search by ball trees against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from opsflow.llm.ball_tree_search import BallTree, Queries, lexical_search
from tests.llm.helpers import DOCS, awkward, frame, prose, repeated

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row", T.StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, k):
    bags = [Counter(terms(r[1])) for r in rows]
    docs, total = sum(1 for b in bags if b), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text, _ in items:
        scored = []
        for (doc, *_), bag in zip(rows, bags):
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * bag.total() * docs) // total
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i, s[3], -s[0]) for i, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def items():
    rng = random.Random(8)
    out = [(i, prose(rng, "fr" if i % 2 else "en", rng.randrange(1, 40)), "x") for i in range(12)]
    return out + [(20, None, "x"), (21, "", "x"), (22, "unknownterm", "x"), (None, "water Été garçon!", "x"), (3, out[3][1], "x"), (23, "x X 123", None)]


@pytest.mark.parametrize("sizes", [{}, {"block_terms": 40, "entries": 300, "leaf": 2}])
def test_ranks_equal_scores_of_every_document(spark, sizes):
    rows = repeated(awkward(6))
    found = lexical_search(frame(spark, rows), spark.createDataFrame(items(), ITEMS).repartition(2), k=7, **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows, items(), 7)


def test_nothing_on_either_side(spark):
    none, some = spark.createDataFrame([], DOCS), frame(spark, awkward())
    asked = spark.createDataFrame(items(), ITEMS)
    assert lexical_search(none, asked).collect() == []
    assert lexical_search(some, spark.createDataFrame([], ITEMS)).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "--- !!", None)], ITEMS)
    assert lexical_search(some, blank).collect() == []


def test_balls_bound_every_score_and_prune():
    """Groups of documents with terms of their own: most leaves are never scored."""
    rng = np.random.default_rng(3)
    ends, held, values = [0], [], []
    for doc in range(2000):
        own = np.unique(np.concatenate((rng.integers(0, 40, 4), 40 + 40 * (doc % 50) + rng.integers(0, 40, 30))))
        held.append(own)
        values.append(rng.integers(1, 500_000, len(own)))
        ends.append(ends[-1] + len(own))
    held, values, ends = np.concatenate(held), np.concatenate(values), np.array(ends)
    weights = np.concatenate((np.full(40, 100), np.full(2000, 6000)))
    asked = np.concatenate([40 + 40 * g + np.arange(20) for g in range(5)])
    queries = Queries(np.arange(5), np.arange(6) * 20, asked, np.ones(100, np.int64), weights)
    tree = BallTree(ends, held, values, queries)
    best = [[] for _ in range(5)]
    leaves = tree.search(best, list(range(2000)), 10)
    for i in range(5):
        weight = np.zeros(2040, np.int64)
        weight[asked[20 * i : 20 * i + 20]] = 6000
        scores = np.add.reduceat(values * weight[held], ends[:-1])
        want = sorted((-int(s), d) for d, s in enumerate(scores) if s > 0)[:10]
        assert [(s, d) for s, _, d in best[i]] == want
        for node, leaf in enumerate(tree.leaves):
            if leaf is not None:
                assert scores[leaf[0]].max() <= tree.bounds[node][i]
    assert leaves < 5 * sum(leaf is not None for leaf in tree.leaves) / 4
