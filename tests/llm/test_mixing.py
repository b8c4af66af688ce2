import collections
from fractions import Fraction
from math import ceil, floor

import pytest

from riverframe.llm import mixing


def edf(weights, slots):
    """Slot by slot: the released block with the earliest deadline, sources in order of name among equals."""
    h, done, out = sum(weights.values()), collections.Counter(), {}
    for t in range(slots):
        ready = [(ceil(Fraction((done[s] + 1) * h, w)), s) for s, w in sorted(weights.items()) if w and floor(Fraction(done[s] * h, w)) <= t]
        _, s = min(ready)
        out[s, done[s]] = t
        done[s] += 1
    return out


@pytest.fixture
def rows(documents):
    sizes = {"a": 230, "b": 40, None: 25, "c": 3, "": 9}
    data, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            data.append((k, "t", None, source))
            k += 1
    return documents(data)


@pytest.mark.parametrize("targets", [None, {"a": 0.5, "b": 0.2, None: 0.2, "c": 0.05, "": 0.05}, {"a": 1, "b": 2}])
def test_schedule(rows, targets):
    plan = mixing.plan(rows, targets, slots=20, block_docs=4).collect()
    assert len(plan) == rows.count() and len({r["doc_id"] for r in plan}) == len(plan)
    used = [r for r in plan if r["slot"] is not None]
    if targets:
        assert {r["source"] for r in used} == set(targets)
        assert all(not r["on_target"] and r["weight"] is None for r in plan if r["slot"] is None)
    weights = {("" if r["source"] is None else f"={r['source']}"): r["weight"] for r in used}
    h = sum(weights.values())
    assert h == 20
    want = edf(weights, 20 * 80)
    for r in used:
        key = "" if r["source"] is None else f"={r['source']}"
        assert r["slot"] == want[key, r["block"]] and r["release"] <= r["slot"] < r["deadline"] and r["block"] == r["position"] // 4
    seen = collections.Counter()
    blocks = sorted({(r["slot"], r["source"]) for r in used if r["on_target"]}, key=lambda b: b[0])
    assert [b[0] for b in blocks] == list(range(len(blocks)))
    for t, (_, source) in enumerate(blocks):
        seen[source] += 1
        for r in {r["source"]: r for r in used}.values():
            assert abs(seen[r["source"]] - Fraction((t + 1) * r["weight"], h)) < 1
    for source in {r["source"] for r in plan}:
        positions = sorted(r["position"] for r in plan if r["source"] == source)
        assert positions == list(range(len(positions)))


def test_weights_by_largest_remainder(spark):
    sizes = spark.createDataFrame([("=a", 100), ("=b", 1), ("=c", 49)], "key string, n long")
    row = mixing.whole_weights(sizes, {"a": 0.7, "b": 0.0001, "c": 0.2999}, slots=100).first()
    assert list(row["keys"]) == ["=a", "=b", "=c"] and sum(row["w"]) == row["h"] == 100 and row["w"][1] >= 1 and abs(row["w"][0] - 70) <= 2


def test_edge_cases(documents):
    assert mixing.plan(documents([])).collect() == []
    same = mixing.plan(documents([(1, "x", None, "a"), (1, "x", None, "a"), (None, None, None, None)])).collect()
    assert sorted((r["source"] or "", r["position"]) for r in same) == [("", 0), ("a", 0), ("a", 1)]
    assert all(r["slot"] is not None for r in same)
    nothing = mixing.plan(documents([(1, "x", None, "a")]), {"b": 1.0}).first()
    assert nothing["slot"] is None and nothing["on_target"] is False


def test_plan_is_native(rows):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        mixing.plan(rows).explain()
    assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()
