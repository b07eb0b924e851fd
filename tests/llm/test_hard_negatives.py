"""Packed products and mined negatives against plain integer arithmetic over all pairs."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formlens.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>"


def within_long(x):
    return min(max(x, H.LONG_MIN), H.LONG_MAX)


def brute(rows, is_anchor, k=H.POSITIVES, m=H.NEGATIVES, low=H.LOW, high=H.HIGH):
    whole = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
             if None not in (i, lab, v) and all(x is not None and math.isfinite(256.0 * x) for x in v)]
    out = []
    for a, label, q in whole:
        if not is_anchor(a):
            continue
        scored = sorted((-within_long(sum(x * y for x, y in zip(q, p))), i, lab == label) for i, lab, p in whole if i != a)
        for ps, pid, _ in [s for s in scored if s[2]][:k]:
            fit = [(ns, i) for ns, i, same in scored if not same and low * -ps <= 100 * -ns <= high * -ps][:m]
            out += [(a, pid, r, nid, -ps, -ns) for r, (ns, nid) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", rank int").repartition(4)
    out = H.mine(frame, F.col("vec_id") % 10 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(seed, n, dims, scale=1.0, labels=3):
    r = random.Random(seed)
    return [(i, r.randrange(labels), [scale * (abs(r.gauss(0.4, 0.3))) for _ in range(dims)]) for i in range(n)]


components = st.integers(-(1 << 12), 1 << 12)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9).flatmap(lambda d: st.tuples(
    st.lists(st.lists(components, min_size=d, max_size=d), min_size=1, max_size=12),
    st.lists(st.lists(components, min_size=d, max_size=d), min_size=1, max_size=4))), st.sampled_from([1, 1 << 20, 1 << 45, 1 << 90]))
def test_fields_are_the_exact_products(both, scale):
    dtype = np.int64 if scale == 1 else object
    c, a = (np.array([[x * scale for x in row] for row in rows], dtype=dtype) for rows in both)
    packed = H.Packed(c, a)
    for row in a:
        assert packed.scores(row).tolist() == [within_long(sum(int(x) * int(y) for x, y in zip(row, other))) for other in c]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=40), st.integers(1, 12))
def test_first_by_score_then_id(pairs, k):
    scores = np.array([s for s, _ in pairs], dtype=np.int64)
    ids = np.array([i for _, i in pairs], dtype=np.int64)
    got = [(scores[i], ids[i]) for i in H.first(scores, ids, k)]
    assert got == sorted(pairs, key=lambda p: (-p[0], p[1]))[:k]


@pytest.mark.parametrize("dims, scale", [(8, 1.0), (3, 1e6), (2, 1e30), (3, 3e6)])
def test_equals_brute_force(spark, dims, scale):
    rows = vectors(dims, 120, dims, scale)
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert scale > 1e20 or mined(spark, rows)


def test_several_blocks_and_wide_integers(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_COMPONENTS", 10)
    monkeypatch.setattr(H, "PACKED", 7)
    rows = vectors(4, 60, 5)
    assert mined(spark, rows, positives=2, negatives=3, low=10, high=95) == brute(rows, lambda i: i % 10 == 0, 2, 3, 10, 95) != []


def test_nulls_odd_components_ragged_vectors_and_signs(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(7, 60, 4) + [
        (100, None, [1.0] * 4), (110, 1, None), (120, 1, [1.0, None, 1.0, 1.0]), (130, 1, [nan, 1.0, 1.0, 1.0]), (140, 1, [-inf, 1.0, 1.0, 1.0]),
        (150, 1, [1.7e308, 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (160, 1, []), (170, 0, [0.5]), (180, 1, [0.4, 0.4, 0.4, 0.4, 0.9]), (190, 2, [-0.9] * 4), (200, 9, [0.3] * 4),
    ]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_copies_tie_by_id_and_repeated_rows_count(spark):
    rows = [(i, i % 2, [0.5, 0.5]) for i in range(1, 90)] + [(10, 0, [1.0, 0.25])] * 2 + [(91, 1, [0.4, 0.3])] * 15
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want and len({r[0] for r in want}) > 5


def test_empty_and_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [0.5])]) == []
    assert mined(spark, [(10, 1, [1.0])]) == []
