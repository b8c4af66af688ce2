import numpy as np
import pytest

from riverframe.llm import vectors


def brute(rows, threshold=0.98):
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids, label = [r[0] for r in rows], np.array([r[2] for r in rows])
    link = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(len(rows))]
    return {ids[i]: (int(link[i].sum()), ids[root[i]], root[i] == i) for i in range(len(rows))}


def family(seed, n, dim=24, labels=3):
    """Random directions, near copies of some (cosine about 0.98 and above), exact and scaled copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = base[: n // 3] + rng.normal(size=(n // 3, dim)) * np.linspace(0.02, 0.25, n // 3)[:, None]
    crowd = base[0] + rng.normal(size=(60, dim)) * 0.1
    x = np.concatenate([base, near, crowd, base[:9], base[9:12] * 3]).astype(np.float32)
    label = np.concatenate([np.arange(n) % labels, np.arange(n // 3) % labels, np.zeros(60), np.arange(9) % labels, np.arange(9, 12) % labels]).astype(int)
    return [(i, x[i].tolist(), int(label[i])) for i in range(len(x))]


@pytest.mark.parametrize("block", [2048, 7])
def test_links_and_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "PER_LIST", 40)
    rows = family(4, 400)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, node string, n int")
    found = vectors.near_duplicates(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == brute(rows)


def test_recall_of_the_production_probes(spark):
    """The whole margin loses no link; the contract asks for 0.9."""
    rows = family(9, 1500, dim=64, labels=2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want, found = brute(rows), {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df).collect()}
    total = sum(w[0] for w in want.values())
    assert total > 100 and sum(found.values()) == total


def test_no_link_is_lost_among_vectors_that_vary_in_few_directions(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PER_LIST", 100)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(2000, 4)) @ rng.normal(size=(4, 64)) + rng.normal(size=(2000, 64)) * 0.02).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == brute(rows)


def test_vectors_of_any_magnitude_link(spark):
    rows = [(1, [1e200, 2e200, 0.0], 0), (2, [1e200, 2e200, 0.0], 0), (3, [1e-200, 2e-200, 0.0], 0), (4, [5e-324, 1e-323, 0.0], 0), (5, [1.0, 2.0, 1e-300], 0), (6, [1.7e308, -1.7e308, 1.7e308], 0), (7, [1.0, -1.0, 1.0], 0)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {**{i: (4, 1) for i in range(1, 6)}, 6: (1, 6), 7: (1, 6)}


def test_edge_cases(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    nan = float("nan")
    rows = [(1, a, 1), (2, a, 1), (2, a, 1), (3, a, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 0.0], 1), (7, [1.0, nan, 0.0], 1), (8, [], 1), (9, a, 2), (10, [1.0, 0.0], 1), (11, b, 1), (None, a, 1), (12, [2.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in vectors.near_duplicates(df).where("vec_id is not null").collect())
    linked = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (12, 3, 1, False)]
    assert found == sorted(linked + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)])
    assert [tuple(r) for r in vectors.near_duplicates(df).where("vec_id is null").collect()] == [(None, 0, None, False)]
    assert vectors.near_duplicates(df.limit(0)).collect() == []
