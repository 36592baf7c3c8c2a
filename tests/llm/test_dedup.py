"""Exact, near and substring deduplication against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.helpers import DOCS, awkward, frame, prose, repeated

from opsflow.llm.exact_dedup import exact_duplicates, keep_rows
from opsflow.llm.ngram_join import linked_documents, one_of_each, similar_documents
from opsflow.llm.suffix_dedup import BASES, NEED, Rolling, _fetch, phrases, remove_repeats

BLANK = re.compile(r"[\x20\x09-\x0D]")


def test_exact_duplicates(spark):
    rows = awkward()
    got = {r.doc_id: r for r in exact_duplicates(frame(spark, rows)).collect()}
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[BLANK.sub("", text or "")].append((-len(text or ""), doc))
    assert len(got) == len(rows)
    for key, members in groups.items():
        for _, doc in members:
            r = got[doc]
            assert (r.keep_id, r.group_size) == (min(members)[1], len(members))
            assert r.kept == (doc == min(members)[1])
            assert r.text_sha256 == hashlib.sha256(key.encode()).hexdigest()


def test_a_full_filter_changes_nothing(spark):
    rows = awkward()
    plain = exact_duplicates(frame(spark, rows)).orderBy("doc_id").collect()
    tiny = exact_duplicates(frame(spark, rows), bits_per_row=1, max_bits=1).orderBy("doc_id").collect()
    assert plain == tiny


def test_exact_duplicates_keep_one_of_repeated_rows(spark):
    rows = repeated(awkward())
    found = exact_duplicates(frame(spark, rows))
    kept = Counter(r.text_sha256 for r in found.collect() if r.kept)
    assert set(kept.values()) == {1}
    stay = keep_rows(frame(spark, rows), found)
    assert stay.columns == DOCS.names
    assert stay.count() == len(kept)


def near(rows, percent=75):
    sets = {}
    for doc, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        shingles = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}
        sets[doc] = shingles if words else set()
    label = {d: d for d in sets}

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    docs = sorted(sets)
    for i, x in enumerate(docs):
        for y in docs[i + 1 :]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                label[b] = a
    return sorted((d, len(sets[d]), find(d)) for d in docs)


@pytest.mark.parametrize("often", [2, 32])
def test_similar_documents(spark, often):
    """Also where nearly all shingles are spread as frequent ones, over many small buffers."""
    rows = awkward(1)
    found = similar_documents(frame(spark, rows), buffer=500 if often == 2 else 2_000_000, times_often=often)
    got = sorted(tuple(r)[:3] for r in found.select("doc_id", "n_shingles", "component_id").collect())
    assert got == near(rows)


@pytest.mark.parametrize("often", [2, 32])
def test_all_links_are_found(spark, often):
    """Also those inside a component: a group of near copies links pair by pair."""
    rows = repeated(awkward(1))
    sets = []
    for _, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    linked = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    want = Counter((r[0], len(s), sum(linked(s, t) for t in sets) - bool(s)) for r, s in zip(rows, sets))
    classes = sorted(set(sets) - {frozenset()}, key=sorted)
    apart = Counter(
        tuple(sorted((len(a), len(b)))) + (len(a & b),) for i, a in enumerate(classes) for b in classes[i + 1 :] if linked(a, b)
    )
    pairs, counts = linked_documents(frame(spark, rows), buffer=500 if often == 2 else 2_000_000, times_often=often)
    got = pairs.collect()
    assert Counter(tuple(sorted((p.n_x, p.n_y))) + (p.n_shared,) for p in got) == apart and sum(apart.values()) >= 28
    assert len({(p.class_x, p.class_y) for p in got}) == len(got) and all(p.class_x < p.class_y for p in got)
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in counts.collect()) == want


def test_one_of_each_component_stays(spark):
    rows = repeated(awkward(2))
    stay = keep_rows(frame(spark, rows), one_of_each(similar_documents(frame(spark, rows))))
    assert stay.columns == DOCS.names
    want = {c for _, n, c in near(awkward(2)) if n}
    assert sorted(r.doc_id for r in stay.collect() if r.text and r.text.strip()) == sorted(want)


def cut(rows, length):
    seen, out = set(), []
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("buffer", [50, 300_000])
def test_remove_repeats(spark, buffer):
    rows = awkward(3)
    got = sorted(tuple(r) for r in remove_repeats(frame(spark, rows), buffer=buffer).drop("kept").collect())
    assert got == cut(rows, 100)


def test_repeated_rows_are_repeats_of_the_first(spark):
    rows = [r for r in awkward(3) if len((r[1] or "").encode()) >= 100][:4]
    got = remove_repeats(frame(spark, rows + rows), with_text=True).collect()
    whole = Counter((r.doc_id, r.n_removed == r.n_bytes) for r in got)
    for r in rows:
        assert whole[(r[0], True)] >= 1
    once = {r.doc_id: r.n_removed for r in remove_repeats(frame(spark, rows)).collect()}
    for r in rows:
        assert once[r[0]] in [g.n_removed for g in got if g.doc_id == r[0]]


@pytest.mark.parametrize("buffer", [50, 300_000])
def test_split_triggers_change_nothing(spark, buffer):
    """A passage in most documents: edge phrases of one trigger, in few large or many small ranges."""
    rng = random.Random(6)
    passage = prose(rng, "en", 60)
    rows = awkward(4) + [(500 + i, prose(rng, "en", 30) + passage + prose(rng, "fr", 30), *awkward(4)[0][2:]) for i in range(40)]
    for many, in_range in ((2, 2), (3, 1000), (10_000, 2)):
        found = remove_repeats(frame(spark, rows), buffer=buffer, many=many, many_in_range=in_range).drop("kept")
        assert sorted(tuple(r) for r in found.collect()) == cut(rows, 100)


@pytest.mark.parametrize("in_range", [1, 1000])
def test_a_hot_trigger_does_not_stay_in_one_group(in_range):
    """Windows of edge phrases go out by their hash, not by trigger."""
    rng = random.Random(7)
    passage = prose(rng, "en", 60)
    texts = [f"{i} " + prose(rng, "en", 40) + passage for i in range(80)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    row, start, windows, gram, _ = phrases(data, offsets, 100, 40, tuple(Rolling(b) for b in BASES))
    hot = max(set(gram.tolist()), key=gram.tolist().count)
    needs = np.zeros(int((gram == hot).sum()), NEED)
    needs["start"], needs["windows"], needs["split"], needs["trigger"] = start[gram == hot], windows[gram == hot], in_range == 1, hot
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(row[gram == hot]), pa.array([False] * len(needs)), pa.array(row[gram == hot]),
            pa.array([texts[r] for r in row[gram == hot]]), pa.array([[n.tobytes()] for n in needs]),
        ],
        names=["id", "null", "hash", "text", "needs"],
    )
    parts = [p for out in _fetch(100, 4, 4)([batch]) for p in out.column(0).to_pylist()]
    assert len(needs) >= 80 and len(set(parts)) == (16 if in_range == 1 else 1)


@pytest.mark.parametrize("buffer", [50, 300_000])
def test_a_row_given_twice_loses_only_its_inner_repeats(spark, buffer):
    """Both copies in one task; the passage stands twice in the text, in other surroundings each time."""
    rng = random.Random(5)
    passage = prose(rng, "en", 60)
    row = (1, prose(rng, "en", 40) + passage + prose(rng, "fr", 40) + passage + prose(rng, "en", 40), "en", "a", 0, "9", "r", "s", "h")
    got = remove_repeats(spark.createDataFrame([row, row], DOCS).coalesce(1), buffer=buffer).drop("kept").collect()
    (once,) = cut([row], 100)
    assert sorted(r.n_removed for r in got) == sorted([once[2], once[1]])
    assert once in [tuple(r) for r in got] and 0 < once[2] < once[1]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_duplicates(empty).count() == 0
    assert similar_documents(empty).count() == 0
    assert remove_repeats(empty).count() == 0
    assert keep_rows(empty, exact_duplicates(empty)).count() == 0
