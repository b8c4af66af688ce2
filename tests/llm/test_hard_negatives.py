from fractions import Fraction
from math import floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverframe.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=5, positives=5, negatives=3):
    """The contract, row by row, for distinct ids."""
    ok = [(i, [floor(256 * Fraction(x)) for x in v], y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, a, y in ok:
        if i % every:
            continue
        score = {j: sum(p * q for p, q in zip(a, v, strict=True)) for j, v, _ in ok if j != i and len(v) == len(a)}
        label = {j: z for j, _, z in ok}
        best = sorted((j for j in score if label[j] == y), key=lambda j: (-score[j], j))[:positives]
        for p in best:
            able = [j for j in score if label[j] != y and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            for r, j in enumerate(sorted(able, key=lambda j: (-score[j], j))[:negatives], 1):
                out.append((i, p, r, j, score[p], score[j]))
    return sorted(out)


def vectors_of(seed, n, dim=12, labels=3, size=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(labels, dim))[np.arange(n) % labels] + rng.normal(size=(n, dim)) + 0.8
    x[: n // 6] = x[n // 2 : n // 2 + n // 6]  # equal scores
    return [(i, (x[i] * size).tolist(), int(rng.integers(labels))) for i in range(n)]


def found(df, **how):
    return sorted(tuple(r) for r in hn.mine(df, lambda c: c % 5 == 0, **how).collect())


@pytest.mark.parametrize("how", [{}, {"anchor_bytes": 700}])
def test_equal_to_brute_force(spark, how):
    rows = vectors_of(1, 240)
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows], SCHEMA + ", rank string, negative_id double").repartition(5)
    want = brute(rows)
    assert len(want) > 200 and found(df, **how) == want


@pytest.mark.parametrize("size", [1e4, 1e7, 1e14, 1e60])
def test_components_of_any_size_have_exact_scores(spark, size):
    rows = vectors_of(2, 60, size=size)
    long = lambda v: v if -(1 << 63) <= v < 1 << 63 else None
    want = sorted((*r[:4], long(r[4]), long(r[5])) for r in brute(rows))
    assert len(want) > 20 and sorted(found(spark.createDataFrame(rows, SCHEMA)), key=str) == sorted(want, key=str)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 1.0], [1.0, 0.5]
    bad = [(None, a, 1), (20, a, None), (25, None, 1), (30, [1.0, None], 1), (35, [nan, 1.0], 1), (40, [-inf, 1.0], 1)]
    good = [(0, a, 1), (1, a, 1), (2, b, 2), (3, b, 2), (4, [1.0], 1), (5, [], 1), (6, [], 2), (7, [], 1), (10, [-1.0, -1.0], 3), (11, [0.0, 0.0], 3), (12, [0.0, 0.0], 1)]
    df = spark.createDataFrame(bad + good, SCHEMA)
    want = brute(good)
    # Scores of 0 open the window that holds 0 alone; negative ones open none.
    assert (5, 7, 1, 6, 0, 0) in want and (0, 1, 1, 2, 131072, 98304) in want
    assert found(df) == want
    assert found(df.unionAll(df)) == want, "repeated rows"
    assert found(df.limit(0)) == [] and found(df.where("vec_id % 5 <> 0")) == []
    floats = spark.createDataFrame(good, "vec_id int, embedding array<float>, label string")
    assert found(floats) == want


def test_an_id_with_several_vectors_counts_with_its_better_score(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [0.5, 0.5], 1), (2, [0.8, 0.8], 2), (2, [0.9, 0.9], 2)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 1, 2, 131072, 2 * 256 * floor(0.9 * 256))]


@settings(max_examples=120, deadline=None)
@given(st.integers(0, 6), st.integers(0, 9), st.integers(1, 5), st.sampled_from([3, 300, 2**20, 2**40, 2**70]), st.integers(0, 1000))
def test_packed_scores_are_inner_products(n, m, dim, size, seed):
    rng = np.random.default_rng(seed)
    draw = lambda k: [[int(v) * (size // 2) for v in row] for row in rng.integers(-1000, 1000, (k, dim))]
    a, x = draw(n), draw(m)
    kind = np.int64 if size < 2**50 else object
    got = hn.packed_scores(np.array(a, kind).reshape(n, dim), np.array(x, kind).reshape(m, dim))
    assert got.tolist() == [[sum(p * q for p, q in zip(r, c, strict=True)) for c in x] for r in a]


def test_production_vectors_share_a_wide_integer():
    """Two candidates a double for unit vectors of 64 components: half the multiplications."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 64))
    x = hn.integers(x / np.linalg.norm(x, axis=1)[:, None], hn.SCALE)
    calls = []
    plain = hn._in_doubles
    try:
        hn._in_doubles = lambda *a: (calls.append(a[-1]), plain(*a))[1]
        assert (hn.packed_scores(x[:20], x) == x[:20] @ x.T).all()
    finally:
        hn._in_doubles = plain
    assert calls == [2]


def test_pruning_often_changes_nothing():
    rng = np.random.default_rng(5)
    place, score, ids = rng.integers(0, 7, 3000), rng.integers(-20, 20, 3000), rng.integers(0, 400, 3000)
    want = []
    for p in range(7):
        best = {}
        for s, i in zip(score[place == p].tolist(), ids[place == p].tolist(), strict=True):
            best[i] = max(s, best.get(i, s))
        want += [(p, s, i) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:4]]
    held = hn.Best(7, 4)
    for a in range(0, 3000, 37):
        held.add(place[a : a + 37], score[a : a + 37].astype(object), ids[a : a + 37])
        held.prune()
    assert list(zip(held.place.tolist(), held.score.tolist(), held.id.tolist(), strict=True)) == want
