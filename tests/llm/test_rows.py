"""Sharding, mixing, quality rules and URL filters, and the registered queries."""

import datetime as dt
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tests.llm.helpers import DOCS, awkward, frame, repeated

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import TABLES, rows_of
from opsflow.llm import ORACLES, QUERIES
from opsflow.llm.mixing import mix, mixed_texts, permuted, targets
from opsflow.llm.quality_rules import cleaned, quality
from opsflow.llm.sharding import interleave
from opsflow.llm.url_filters import judge

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_sharding(spark):
    rows = repeated(awkward())
    got = interleave(frame(spark, rows), shards=7, seed=1).collect()
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    by_source = Counter((r.shard, r.source) for r in got)
    for source, n in Counter(r[3] for r in rows).items():
        for shard in range(7):
            assert abs(by_source[(shard, source)] - n / 7) <= 2
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows
    }
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, interleave(frame(spark, rows), 7, 1).collect()), key=repr)


def test_targets_stop_at_the_limit():
    got = targets(np.array([10, 1000, 100]), np.array([1, 2, 3]), 3.0)
    assert got[0] == 30 and got[2] == 300 and np.isclose(got.sum(), 1110)


def test_permutations():
    for n in (1, 2, 3, 10, 257):
        for key in (1, 99):
            seen = permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(seen) == list(range(n))


def test_mixing(spark):
    rows = repeated(awkward(7, 300))
    got = mix(frame(spark, rows), shards=5, block_words=16, seed=3).taken().collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, targets(np.array([sizes[s] for s in order]), np.array([(1, 2, 3)[i % 3] for i in range(len(order))]), 3.0)))
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source] and np.isclose(r.target, want[r.source])
        taken[r.source] += r.taken
    for source in order:
        assert abs(taken[source] - want[source]) <= 32
    again = mix(frame(spark, rows), shards=5, block_words=16, seed=3).taken().collect()
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in got) == sorted((r.doc_id or -1, r.size, r.taken) for r in again)


def test_mixed_texts_hold_the_words_taken(spark):
    rows = repeated(awkward(7, 300))
    options = dict(shards=5, block_words=16, seed=3)
    taken = defaultdict(int)
    for r in mix(frame(spark, rows), **options).taken().collect():
        taken[r.doc_id] += r.taken
    out = mixed_texts(frame(spark, rows), **options)
    assert out.columns == DOCS.names
    words, texts = defaultdict(int), defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1])
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
        assert any(t and r.text in t for t in texts[r.doc_id])
    assert dict(words) == {d: n for d, n in taken.items() if n}


def test_quality_rules(spark):
    line = "All rights reserved here today."
    rows = [
        (i, " ".join(f"w{i}x{k}" for k in range(60)) + ("\n" + line) * (i % 3), "en", "a" if i < 30 else None, 0, "9", "r", "s", "h")
        for i in range(60)
    ]
    rows += [(100, "a b c " * 40, "en", "a", 0, "9", "r", "s", "h"), (101, None, "en", None, 0, "9", "r", "s", "h")]
    got = {r.doc_id: r for r in quality(frame(spark, rows), max_docs=15).collect()}
    assert len(got) == 62
    for i in range(30):
        assert got[i].n_removed_words == (i % 3) * 5 and got[i].n_dup_lines == max(0, i % 3 - 1) and got[i].kept
        assert got[i].n_repeat_words == (10 if i % 3 == 2 else 0)
    assert got[100].n_repeat_words == 120 and got[100].base_failed and not got[100].kept
    assert got[101].n_words == 0 and got[101].base_failed
    assert quality(spark.createDataFrame([], DOCS)).count() == 0


def test_frequent_lines_leave_the_texts(spark):
    """Against a plain version, with repeated rows, null hosts, other spacing and lines without words."""
    rng = np.random.default_rng(3)
    lines = ["All rights reserved here.", "all  RIGHTS\treserved here. ", "Back to top", "\u00c9cole", " ", ""]
    rows = []
    for i in range(60):
        parts = [" ".join(f"w{i}x{k}" for k in range(8)) for _ in range(3)] + [lines[j] for j in rng.integers(0, len(lines), i % 4)]
        rows.append((i, "\n".join(parts[j] for j in rng.permutation(len(parts))), "en", (None, "a", "a", "b")[i % 4], 0, "9", "r", "s", "h"))
    rows += rows[:7] + [(100, None, "en", "a", 0, "9", "r", "s", "h"), (101, "", "en", None, 0, "9", "r", "s", "h")]

    def plain(line):
        return " ".join(WORD.findall("".join(c.lower() if c.isascii() else c for c in line)))

    held = Counter((r[3], key) for r in rows for key in {plain(x) for x in (r[1] or "").split("\n")} - {""})
    want = Counter()
    for r in rows:
        text = r[1] and "\n".join(x for x in r[1].split("\n") if held[(r[3], plain(x))] <= 5)
        want[(r[0], text, len(WORD.findall(r[1] or "")) - len(WORD.findall(text or "")))] += 1
    got = Counter((r.doc_id, r.text, r.n_removed_words) for r in cleaned(frame(spark, rows), max_docs=5).collect())
    assert got == want and sum(n for (_, _, lost), n in got.items() if lost) > 10


def test_url_filters(spark):
    day = lambda d: dt.date(2024, 1, d)
    entries = spark.createDataFrame(
        [
            ("l", "bad.example.org", day(5), True), ("l", "bad.example.org", day(10), False), ("l", "bad.example.org", day(20), True),
            ("l", "bad.example.org", day(21), True), ("m", "example.org", day(7), True), ("m", "x.org/ads", day(1), True),
            ("m", None, day(1), True), (None, "y.org", day(1), True), ("m", "y.org", None, True),
        ],
        "list string, key string, day date, listed boolean",
    )
    asked = {
        ("http://bad.example.org/a", 4): (0, ""), ("http://bad.example.org/a", 5): (1, "l"), ("http://bad.example.org/a", 9): (2, "l,m"),
        ("http://bad.example.org/a", 10): (1, "m"), ("https://u@BAD.example.org:80/", 25): (2, "l,m"), ("http://x.org/ads/1?q", 3): (1, "m"),
        ("http://x.org/", 3): (0, ""), ("http://y.org/", 3): (0, ""), (None, 3): (0, ""), ("no url", 3): (0, ""), ("http://x.org/ads", None): (0, ""),
    }
    rows = [(i, url, day(d) if d else None) for i, (url, d) in enumerate(asked)]
    captures = spark.createDataFrame(rows + rows[:2], "page_id long, url string, fetched_on date")
    for bins in (1, 32):
        got = {r.page_id: r for r in judge(captures, entries, bin_days=bins).collect()}
        assert [(got[i].n_active, got[i].lists) for i in range(len(rows))] == list(asked.values())
        assert got[0].copies == 2 and got[4].rule == "bad.example.org" and got[4].rule_from == day(20)
    assert judge(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in judge(captures, entries.limit(0)).collect())


def test_url_filters_equal_brute_force(spark):
    """Entries with capitals in host or path, of any depth, and of one label."""
    keys = ["Bad.Org/Ads", "bad.org/ads", "x.org/a/b/c", "x.org/a/b/c/d/E", "org", "COM", "a.b.c.net", "net", "x.org", "localhost"]
    hosts = ["bad.org", "BAD.org", "x.org", "z.a.b.c.net", "q.com", "localhost", "u.x.org"]
    paths = ["", "/Ads", "/ads/", "/ads/X", "/Ads/x", "/a/b", "/a/b/c", "/a//b/c/d", "/a/b/c/d/E/f?q#t", "/a/b/c/d/e"]
    day = dt.date(2024, 1, 2)
    entries = spark.createDataFrame([(f"l{i}", k, day, True) for i, k in enumerate(keys)], "list string, key string, day date, listed boolean")
    urls = [f"http://{h}{p}" for h in hosts for p in paths]
    captures = spark.createDataFrame([(i, u, day) for i, u in enumerate(urls)], "page_id long, url string, fetched_on date")

    def holds(key, host, path):
        name, *want = key.split("/")
        have = [s for s in re.split(r"[?#]", path)[0].split("/") if s]
        if want:
            return name.lower() == host.lower() and have[: len(want)] == want
        return ("." + host.lower()).endswith("." + name.lower())

    want = [",".join(f"l{i}" for i, k in enumerate(keys) if holds(k, h, p)) for h in hosts for p in paths]
    got = {r.page_id: r.lists for r in judge(captures, entries).collect()}
    assert [got[i] for i in range(len(urls))] == want


def test_pipeline_on_awkward_rows(spark):
    """Each stage in turn, against what the stage must leave."""
    docs = frame(spark, repeated(awkward()))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == DOCS.names, name
        kept.append(docs.collect())
    lettered = [r for r in repeated(awkward()) if any(c.isalpha() for c in r[1] or "")]
    assert len(kept[0]) >= 0.95 * len(lettered)
    squeezed = [re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in kept[0]]
    assert sorted({re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in kept[1]}) == sorted(set(squeezed))
    assert len(kept[1]) == len(set(squeezed))
    assert {r.text for r in kept[2]} <= {r.text for r in kept[1]}
    total = sum(len(WORD.findall(r.text)) for r in kept[2])
    assert abs(sum(len(WORD.findall(r.text)) for r in kept[3]) - total) <= 128 * 6
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sum(p.length for p in pieces) > total


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_all_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in names
