"""Any column names, empty tables, and plain versions of sharding and mixing."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opsflow.llm.exact_dedup import exact_duplicates, keep_rows
from opsflow.llm.language_id import identify, train, vocabulary_path
from opsflow.llm.mixing import draw, mix, mixed_texts, permuted, targets
from opsflow.llm.ngram_join import linked_documents, one_of_each, similar_documents
from opsflow.llm.packing import pack
from opsflow.llm.sharding import interleave
from opsflow.llm.url_filters import candidates
from tests.llm.helpers import DOCS, awkward, frame, repeated

CLASHES = ["_id", "_null", "_text", "_source", "_copy", "_row", "_found", "_maybe", "_hash", "_stay", "_turn", "found", "share", "document", "a.b"]


def clashing(spark, rows):
    """Extra columns of names that operators use, each telling its own row."""
    return frame(spark, rows).withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHES})


def untouched(df):
    names = [*DOCS.names, *CLASHES]
    assert df.columns == names
    rows = df.collect()
    for r in rows:
        for c in CLASHES:
            assert r[c] == f"{c}:{'-' if r.doc_id is None else r.doc_id}"
    return rows


def test_columns_of_any_name_stay_as_they_are(spark):
    rows = repeated(awkward(9, 40))
    docs = clashing(spark, rows)
    assert untouched(keep_rows(docs, exact_duplicates(docs)))
    assert untouched(keep_rows(docs, one_of_each(similar_documents(docs))))
    assert untouched(mixed_texts(docs, seed=1, block_words=16))
    model = train(docs, vocabulary_path(), sample=20, rounds=1)
    named = identify(docs, model, "_found", "_row")
    assert named.columns == docs.columns and named.count() == len(rows)
    assert untouched(corpus_pipeline.known_language(spark, docs, ""))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert interleave(empty, shards=4).collect() == []
    assert mix(empty).taken().collect() == []
    assert mixed_texts(empty).collect() == []
    assert [df.count() for df in linked_documents(empty)] == [0, 0]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_sharding_equals_its_plain_version(spark, shards):
    """Seeded order within each source, fractional ranks, and cuts of equal length."""
    rows = awkward(2)
    keyed = []
    for r in rows:
        crc = zlib.crc32((r[1] or "").encode())
        digest = hashlib.md5(f"7|s{r[0]}|{crc}".encode()).hexdigest()
        keyed.append(("n" if r[3] is None else f"s{r[3]}", digest, len((r[1] or "").encode()) + 16, r[0]))
    line, sizes = [], Counter(k[0] for k in keyed)
    for source in sizes:
        own = sorted(k for k in keyed if k[0] == source)
        line += [((i + 0.5) / sizes[source], *k) for i, k in enumerate(own)]
    line.sort()
    want, slots = [], Counter()
    for i, (_, _, _, size, doc) in enumerate(line):
        shard = i * shards // len(line)
        want.append((doc, size, shard, slots[shard]))
        slots[shard] += 1
    got = [(r.doc_id, r["size"], r.shard, r.slot) for r in interleave(frame(spark, rows), shards, seed=7).collect()]
    assert sorted(got) == sorted(want)


def plain_targets(sizes, weights, most):
    """Excess over a source's limit is shared again, by weight, until none is above."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped and sizes[i])
        share = {i: left * w / weight for i, w in enumerate(weights) if i not in capped and sizes[i]} if weight else {}
        over = {i for i, s in share.items() if s > most * sizes[i]}
        if not over:
            return [most * s if i in capped else share.get(i, 0.0) for i, s in enumerate(sizes)]
        capped |= over


def test_targets_over_several_rounds():
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        sizes = np.floor(10 ** rng.uniform(0, 5, n)).astype(np.int64) * (rng.random(n) > 0.1)
        weights = np.array([(1, 2, 3)[i % 3] for i in range(n)])
        if sizes.sum():
            assert np.allclose(targets(sizes, weights, 3.0), plain_targets(sizes.tolist(), weights.tolist(), 3.0))


def test_permutations_take_every_block_once():
    for blocks in (1, 2, 3, 17, 1000):
        for key in (0, 5, 2**63):
            n = np.arange(blocks)
            out = permuted(n, np.full(blocks, blocks), np.full(blocks, key, np.uint64))
            assert sorted(out.tolist()) == n.tolist()


@pytest.mark.parametrize("left", [[5, 0, 7], [2 * 10**9, 3 * 10**9, 1], [10**15, 7, 10**12], [0, 0, 0]])
def test_draws_of_any_size(left):
    rng, left = np.random.default_rng(1), np.array(left, np.int64)
    total = int(left.sum())
    for take in {0, 1, total // 64, total - 1, total}:
        if 0 <= take <= total:
            counts = draw(rng, left, take)
            assert counts.sum() == take and (counts >= 0).all() and (counts <= left).all()


def test_draws_follow_what_is_left():
    rng, left = np.random.default_rng(2), np.array([3 * 10**9, 10**9])
    shares = [draw(rng, left, 10**8)[0] / 10**8 for _ in range(20)]
    assert abs(np.mean(shares) - 0.75) < 0.001


def test_addresses_are_in_no_domain(spark):
    hosts = spark.createDataFrame([("10.0.0.1",), ("[::1]",), ("a.example",), ("x1.2.3.4",)], "h string")
    found = [r.k for r in hosts.select("h", candidates(F.col("h"), F.lit("/p")).alias("k")).orderBy(F.monotonically_increasing_id()).collect()]
    assert found[0] == ["10.0.0.1", "10.0.0.1/p"] and found[1] == ["[::1]", "[::1]/p"]
    assert found[2] == ["a.example", "example", "a.example/p"] and len(found[3]) == 5


def test_packing_without_texts(spark):
    import public_tokenizers

    rows = [(1, None, *[None] * 7), (2, "", *[None] * 7)]
    found = pack(spark.createDataFrame(rows, DOCS), public_tokenizers.path("word_bpe_49k.json"), end_id=2).collect()
    assert sorted((r.doc_id, r.length, r.doc_tokens) for r in found) == [(1, 1, 1), (2, 1, 1)]
