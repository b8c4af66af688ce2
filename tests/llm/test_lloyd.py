import hashlib
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverframe.llm import lloyd

SCHEMA = "vec_id long, embedding array<double>, label string"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Full rescans in Python integers; vec_id -> (code, error), and the digest, for vectors of one length."""
    kept = [(i, [floor(scale * Fraction(x)) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = len(kept[0][1])
    cut = [dim * p // parts for p in range(parts + 1)]
    first = {}
    for i, v in sorted((i, v) for i, v in kept if i is not None):
        first.setdefault(i, v)
    start = [first[i] for i in sorted(first)] + sorted(v for i, v in kept if i is None)
    books = [[v[cut[p] : cut[p + 1]] for v in start[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((x - y) ** 2 for x, y in zip(v[cut[p] : cut[p + 1]], e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(p, v)[1] for p in range(parts)] for _, v in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[cut[p] : cut[p + 1]] for (_, v), a in zip(kept, at, strict=True) if a[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for i, v in kept:
        best = [nearest(p, v) for p in range(parts)]
        error = sum(d for d, _ in best)
        out.append((i, bytes(k for _, k in best), error if error < 1 << 63 else None))
    return out, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def result(df, **how):
    coded = lloyd.compress(df, **how)
    return sorted(((r["vec_id"], bytes(r["codes"]), r["error"]) for r in coded.rows.collect()), key=str), {d: b.digest() for d, b in coded.books.items()}


def draw(seed, n, dim=16, size=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(7, dim))[rng.integers(0, 7, n)] + rng.normal(size=(n, dim)) * 0.4
    x[: n // 5] = x[n // 2 : n // 2 + n // 5]  # repeated vectors
    x = np.where(rng.random((n, dim)) < 0.2, np.round(x), x) * size
    return [(int(i), v.tolist(), "ab"[k % 2]) for k, (i, v) in enumerate(zip(rng.permutation(n) * 3, x, strict=True))]


@pytest.mark.parametrize(("dim", "size"), [(16, 1.0), (19, 1.0), (8, 1e-3), (16, 1e5), (16, 1e9), (16, 1e200)])
def test_equal_to_full_rescans(spark, dim, size):
    rows = draw(dim, 160, dim, size)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", codes string, kind int").repartition(5)
    want, digest = brute(rows)
    got, digests = result(df)
    assert got == sorted(want, key=str) and digests == {dim: digest}


def test_one_vector_of_another_size_does_not_disturb_the_rest(spark):
    rows = draw(3, 120) + [(1, [1e30] * 16, "a"), (2, [-1e12] + [0.0] * 15, None)]
    want, digest = brute(rows)
    got, digests = result(spark.createDataFrame(rows, SCHEMA))
    assert got == sorted(want, key=str) and digests == {16: digest}


def test_floats_are_kept_as_floats_and_labels_sum(spark):
    rows = [(i, [float(np.float32(x)) for x in v], y) for i, v, y in draw(4, 90)] + [(1, [0.5] * 16, None), (2, [0.25] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label string")
    coded = lloyd.compress(df)
    found = lloyd.errors_by_label(coded.rows).collect()
    want, _ = brute(rows)
    total = {}
    for (_, _, y), (_, _, e) in zip(rows, want, strict=True):
        total[y] = total.get(y, 0) + e
    assert len(found) == len(rows) and all(r["label_error"] == total[r["label"]] for r in found)


def test_few_rows_repeated_ids_and_missing_ones(spark):
    rows = [(5, [1.0] * 8, "a"), (5, [0.5] * 8, "a"), (5, [0.5] * 8, "a"), (None, [2.0] * 8, None), (None, [-2.0] * 8, "a"), (1, [0.0] * 8, "b")]
    want, digest = brute(rows)
    got, digests = result(spark.createDataFrame(rows, SCHEMA))
    assert got == sorted(want, key=str) and digests == {8: digest}
    many = [(None, [float(i)] * 8, "a") for i in range(40)] + [(7, [3.5] * 8, "a")]
    want, digest = brute(many)
    got, digests = result(spark.createDataFrame(many, SCHEMA))
    assert got == sorted(want, key=str) and digests == {8: digest}


def test_dropped_rows_lengths_and_empty_tables(spark):
    bad = [(1, None, "a"), (2, [1.0, None], "a"), (3, [float("nan")] * 8, "a"), (4, [float("inf")] * 8, "a")]
    eight, three = draw(6, 40, 8), [(1000 + i, [i / 7, 0.5, -i / 3], "c") for i in range(30)]
    got, digests = result(spark.createDataFrame(bad + eight + three + [(9, [], "e")], SCHEMA))
    (a, da), (b, db) = brute(eight), brute(three)
    assert got == sorted([*a, *b, (9, bytes(8), 0)], key=str)
    assert digests == {8: da, 3: db, 0: hashlib.sha256(b"").hexdigest()}
    empty = lloyd.compress(spark.createDataFrame([], SCHEMA))
    assert empty.rows.collect() == [] and lloyd.errors_by_label(empty.rows).collect() == []
    assert lloyd.compress(spark.createDataFrame(bad, SCHEMA)).rows.collect() == []


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 2, 5]), st.booleans())
def test_active_entries_equal_a_full_scan(seed, dim, exact):
    """Small integers make many ties; entries move by little or not at all."""
    rng = np.random.default_rng(seed)
    kind = object if exact else np.float64
    x = rng.integers(-4, 5, (60, dim)).astype(kind)
    book = rng.integers(-4, 5, (9, dim)).tolist()
    codes, far = lloyd.assign(x, book, [], None, None, exact)
    moved = [k for k in range(9) if rng.random() < 0.3]
    new = [[v + int(rng.integers(-1, 2)) for v in e] if k in moved else e for k, e in enumerate(book)]
    moved = [k for k in moved if new[k] != book[k]]
    got = lloyd.assign(x, new, moved, codes, far, exact)
    want = lloyd.assign(x, new, [], None, None, exact)
    assert [list(map(int, v)) for v in got] == [list(map(int, v)) for v in want]
    dist = [[sum((int(a) - b) ** 2 for a, b in zip(r, e, strict=True)) for e in new] for r in x]
    assert list(map(int, want[0])) == [d.index(min(d)) for d in dist]


def test_an_unmoved_entry_is_compared_with_moved_ones_only(monkeypatch):
    asked = []
    plain = lloyd.nearest
    monkeypatch.setattr(lloyd, "nearest", lambda x, e, among: (asked.append((len(x), list(among))), plain(x, e, among))[1])
    x, book = np.arange(12.0)[:, None], [[0], [5], [11]]
    codes, far = lloyd.assign(x, book, [], None, None, False)
    asked.clear()
    lloyd.assign(x, [[0], [5], [10]], [2], codes, far, False)
    assert asked == [(int((codes == 2).sum()), [0, 1, 2]), (int((codes != 2).sum()), [2])]


def test_two_states_at_a_time(spark, monkeypatch):
    """Every state but the last is removed once its successor is written."""
    gone = []
    plain = lloyd.discard
    monkeypatch.setattr(lloyd, "discard", lambda t: (gone.append(1), plain(t))[1])
    coded = lloyd.compress(spark.createDataFrame(draw(8, 100), SCHEMA))
    assert coded.rows.count() == 100 and 1 <= len(gone) <= lloyd.ROUNDS
