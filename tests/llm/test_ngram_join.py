import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from riverframe.llm import ngram_join


def brute(rows):
    """Sizes and components by comparing all pairs of sets."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(sentence):
    """Families of near copies around the threshold, a shared passage, copies and odd texts."""
    rng, rows = random.Random(5), []
    passage = sentence(999, 55)
    for family in range(6):
        base = sentence(family, 60 + 40 * family).split()
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randrange(0, 6)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append(" ".join(own))
    rows += [f"{sentence(100 + i, 20 + i)} {passage} {sentence(300 + i, 15)}" for i in range(60)]
    rows += [rows[0]] * 5 + [rows[3].upper(), None, "", " \n\t ", "one", "One", "one two", "a b c d e", "a b c d e f", "word " * 3000]
    return list(enumerate(rows))


@pytest.mark.parametrize("limits", [{}, {"SMALL": 2, "ASKED": 3, "HELD": 4, "PER_HUB": 2}])
def test_components_equal_brute_force(documents, sentence, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = variants(sentence)
    found = ngram_join.components(documents(rows).repartition(5)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)
    assert len(found) == len(rows)


def test_signatures_meet_for_every_pair_that_links():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) for size in (1, 2, 3, 4, 5, 7, 9, 14, 26, 27, 60, 200, 401)]
    frequent_codes = np.sort(np.concatenate(base[8:])[::3])
    frequent = ngram_join.Frequent(frequent_codes, 1 + np.arange(len(frequent_codes)) % 5)
    for own in base:
        for _ in range(30):
            other = own.copy()
            drop = rng.integers(0, len(own) // 4 + 1)
            other = rng.permutation(other)[drop:]
            added = rng.integers(0, 2**63, rng.integers(0, len(own) // 6 + 1), dtype=np.uint64)
            pair = [np.unique(own), np.unique(np.concatenate([other, added]))]
            both = len(np.intersect1d(*pair))
            if 100 * both < 75 * (len(pair[0]) + len(pair[1]) - both):
                continue
            sets = ngram_join.Sets(np.concatenate(pair), np.cumsum([0, *map(len, pair)]))
            sign, row, need = ngram_join.signatures(sets, frequent)
            assert len(set(sign[row == 0].tolist()) & set(sign[row == 1].tolist())) >= need.min() >= 1


def test_edge_cases(documents):
    text = "the same few words are here twice over again"
    rows = [(None, text), (7, text), (7, text), (9, text), (10, None), (11, ""), (12, "short"), (12, text)]
    found = collections.Counter(tuple(r) for r in ngram_join.components(documents(rows)).collect())
    assert found == {(None, 5, None): 1, (7, 5, 7): 2, (9, 5, 7): 1, (10, 0, 10): 1, (11, 0, 11): 1, (12, 1, 7): 1, (12, 5, 7): 1}


def test_empty_table_and_kept_rows(documents):
    assert ngram_join.components(documents([])).collect() == []
    docs = documents([(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "x"), (4, None), (None, "x"), (3, "x")])
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, "x"), (1, "a b c d e f"), (3, "x"), (4, "")]


def test_components_of_edges(spark):
    from riverframe.llm.components import connected

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(5, 5), (None, 3)]
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert found == {x: find(x) for x in list(root)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_very_long_text_uses_pieces(monkeypatch):
    from riverframe.llm import textbuf

    column = pa.array(["w%d " % 1 * 4000 + " ".join(f"x{i}" for i in range(2000))])
    whole = ngram_join.shingle_sets(column)
    monkeypatch.setattr(textbuf, "PIECE", 500)
    assert np.array_equal(whole.code, ngram_join.shingle_sets(column).code)
