"""Hard negatives by threshold joins against scores of every pair."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from opsflow.llm.threshold_join import Index, hard_negatives
from opsflow.session import configure

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()), T.StructField("anchor", T.BooleanType()),
        T.StructField("row", T.StringType()), T.StructField("norm", T.StringType()), T.StructField("x", T.StringType()),
    ]
)


def plain(rows, k=5, m=10, low=30, high=90, scale=256):
    used = []
    for n, (id_, vector, label, anchor, *_) in enumerate(rows):
        if label is not None and vector is not None and all(v is not None and math.isfinite(v) for v in vector):
            used.append((n, id_, [math.floor(scale * float(np.float32(v))) for v in vector], label, anchor))
    out = []
    for n, id_, x, label, anchor in used:
        if not anchor:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i is None, i or 0, l, i) for o, i, y, l, _ in used if o != n)
        for score, _, _, _, pos in [s for s in scored if s[3] == label][:k]:
            fits = [s for s in scored if s[3] != label and low * -score <= 100 * -s[0] <= high * -score][:m]
            out += [(id_, pos, rank, s[4], -score, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


def rows_of(seed, n=300, dims=20, scale=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(4, dims))
    out = []
    for i in range(n):
        label = int(rng.integers(0, 5))
        v = rng.normal(size=dims) + (centers[label] if label < 4 else 0)
        v = (v / np.linalg.norm(v) * scale).astype(np.float32).tolist()
        out.append((i, v, label, i % 9 == 0, "r", "n", "x"))
    rest = ("r", "n", "x")
    out += [
        (900, None, 1, True, *rest), (901, [1.0, None], 1, True, *rest), (902, [float("nan")] * dims, 2, False, *rest),
        (903, [float("inf")] * dims, 2, True, *rest), (904, out[0][1], None, True, *rest), (905, [], 3, True, *rest),
        (906, out[0][1][:5], 0, True, *rest), (907, out[0][1], 77, True, *rest), (908, [0.0] * dims, 1, None, *rest),
        (None, out[0][1], 1, True, *rest), (None, out[9][1], 2, None, *rest), (909, [-v for v in out[0][1]], 88, True, *rest),
    ]
    return out + out[:3] + [(1000 + i, out[18][1], i % 3, i == 0, *rest) for i in range(25)]


@pytest.mark.parametrize("scale, anchors", [(1.0, 4096), (40.0, 7), (1e5, 4096), (3e5, 4096)])
def test_negatives_equal_scores_of_every_pair(spark, scale, anchors):
    """Sums that fit 32-bit and 64-bit floats and 64-bit integers, one block of anchors and many."""
    rows = rows_of(int(scale), n=120 if anchors == 7 else 300, scale=scale)
    found = hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), anchors=60 if anchors == 7 else anchors)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)


def test_nothing_to_mine(spark):
    configure(spark)
    assert hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    only = [(i, [1.0, 2.0], 1, i == 0, "", "", "") for i in range(4)]
    assert hard_negatives(spark.createDataFrame(only, VECTORS)).collect() == []
    none = [(i, [1.0, 2.0], i, False, "", "", "") for i in range(4)]
    assert hard_negatives(spark.createDataFrame(none, VECTORS)).collect() == []
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives(spark.createDataFrame([(0, [1e9, 3e30], 1, True, "", "", "")], VECTORS)).collect()


def test_index_finds_all_pairs_above_the_floor_and_omits_dimensions():
    rng = np.random.default_rng(5)
    spread = np.array([300.0] * 6 + [5.0] * 26)
    x, y = (np.floor(rng.normal(size=(n, 32)) * spread).astype(np.float64) for n in (40, 500))
    floors = np.sort(x @ y.T, axis=1)[:, -7].astype(np.int64)
    index = Index(x, floors, float(np.linalg.norm(y, axis=1).max()))
    a, r, score = index.pairs(y, floors)
    want = [(i, j) for i in range(40) for j in range(500) if x[i] @ y[j] >= floors[i]]
    assert sorted(zip(a.tolist(), r.tolist())) == want
    assert all(score == (x[a] * y[r]).sum(axis=1))
    assert index.omitted.any()
