"""Near duplicates by tensored MinHash against a comparison of all pairs."""

import random
import re

import numpy as np
import pytest

from opsflow.llm.linking import linked_groups, parity_sketches
from opsflow.llm.tensor_minhash import band_keys, minhashes, similar_documents
from tests.llm.helpers import DOCS, awkward, frame, prose, repeated


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def plain(rows, percent=85):
    """``id, size, component`` per row, from all pairs."""
    sets = [shingles(r[1]) for r in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least = {}
    for p, r in zip(part, rows):
        least[p] = min((x for x in (least.get(p), r[0]) if x is not None), default=None)
    return sorted(((r[0], len(s), least[p]) for r, s, p in zip(rows, sets, part)), key=repr)


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(n=60):
    """Edited copies of one text, on both sides of the limit, and copies of copies."""
    rng = random.Random(4)
    base = prose(rng, "en", 300)
    texts = [edited(rng, base, rng.randrange(0, 9)) for _ in range(n)]
    texts += [edited(rng, t, rng.randrange(0, 6)) for t in texts[: n // 2]]
    return [(1000 + i, t, "en", "a", len(t), "9", "r", "s", "h") for i, t in enumerate(texts)]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [1_500_000, 4_000])
def test_components_equal_all_pairs(spark, block):
    rows = repeated(awkward()) + near_copies()
    found = similar_documents(frame(spark, rows), block=block)
    assert got(found) == plain(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_empty_table_and_texts(spark):
    assert similar_documents(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(1, None, *[None] * 7), (2, "", *[None] * 7), (3, " \n", *[None] * 7), (None, None, *[None] * 7)]
    found = similar_documents(spark.createDataFrame(rows, DOCS))
    assert got(found) == sorted(((i, 0, i) for i in (1, 2, 3, None)), key=repr)


def test_band_keys_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        common = rng.integers(0, 1 << 63, 850).astype(np.uint64)
        x, y = (np.concatenate((common, rng.integers(0, 1 << 63, 75).astype(np.uint64))) for _ in range(2))
        (a,), (b,) = (band_keys(minhashes(np.array([len(s)]), s, 78), 13, 3)[0] for s in (x, y))
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.85**3) < 0.05


def test_parity_never_tells_sets_further_apart_than_they_are():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(40)]
    sketch = parity_sketches(np.array([len(s) for s in sets]), np.concatenate(sets))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert np.bitwise_count(sketch[i] ^ sketch[j]).sum() <= len(np.setxor1d(x, y))


def test_groups_join_through_members_in_between():
    chain = [np.arange(i * 4, i * 4 + 100).astype(np.uint64) for i in range(10)]
    assert len(set(linked_groups(chain, np.full(10, 100), np.arange(10), 85))) == 1
    assert len(set(linked_groups(chain[::3], np.full(4, 100), np.arange(4), 85))) == 4
