import collections
import random

import numpy as np
import pyarrow as pa

from riverframe.llm import decontam

STRIP = str.maketrans("", "", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def words(text):
    return [w for w in (x.translate(STRIP) for x in (text or "").lower().split()) if w]


def runs(text, n=5):
    w = words(text)
    return [tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))] if w else []


def best(text, item):
    """Largest similarity of any window of the item's size."""
    a, s = collections.Counter(runs(item)), runs(text)
    n, top = sum(a.values()), 0.0
    for k in range(max(1, len(s) - n + 1)):
        b = collections.Counter(s[k : k + n])
        both = sum((a & b).values())
        top = max(top, both / max(1, n + sum(b.values()) - both))
    return top


def corpus(sentence):
    rng = random.Random(8)
    items = [(i, sentence(1000 + i, 15 + 2 * i)) for i in range(22)]
    rows = []
    for k in range(110):
        own = words(items[k % 22][1])
        for _ in range((k // 22) % 4):
            own[rng.randrange(len(own))] = f"q{k}"
        rows.append((k, f"{sentence(k, rng.randrange(0, 90))} {' '.join(own).upper()}, {sentence(k + 500, rng.randrange(0, 60))}"))
    rows += [(200 + k, sentence(3000 + k, 80)) for k in range(40)]
    return items, rows


def test_equal_to_brute_force(spark, documents, sentence):
    items, rows = corpus(sentence)
    want = {(d, i): best(text, item) for d, text in rows for i, item in items}
    want = {k: v for k, v in want.items() if v >= 0.75}
    found = decontam.matches(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    assert set(got) <= set(want) and len(found) == len(got)
    exact = {k for k, v in want.items() if v == 1}
    assert exact <= set(got) and len(exact) >= 22
    assert len(got) >= 0.95 * len(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def altered(sentence):
    """Passages with some words replaced, and their similarity to the item where it is enough."""
    rng = random.Random(5)
    items = [(i, sentence(1000 + i, 40 + 7 * i)) for i in range(30)]
    rows = []
    for k in range(900):
        own = words(items[k % 30][1])
        for _ in range(1 + rng.randrange(1 + len(own) // 30)):
            own[rng.randrange(len(own))] = f"q{k}"
        rows.append(f"{sentence(k, rng.randrange(0, 60))} {' '.join(own)} {sentence(k + 5000, rng.randrange(0, 60))}")
    want = {(k, k % 30): best(text, items[k % 30][1]) for k, text in enumerate(rows)}
    want = {k: v for k, v in want.items() if v >= 0.75}
    assert sum(v < 0.8 for v in want.values()) > 100
    return items, rows, want


def found_within(items, rows, radius):
    block = decontam.searchers(*map(list, zip(*items, strict=True)), radius=radius)
    return {(m[0], m[1]): m[2] for m in decontam._matches(pa.array(rows), block, [x.tables() for x in block])}


def test_altered_passages_come_through_their_fingerprints(sentence):
    items, rows, want = altered(sentence)
    every = found_within(items, rows, 64)
    assert every.keys() == want.keys() and all(abs(every[k] - want[k]) < 1e-9 for k in want)
    near = found_within(items, rows, decontam.RADIUS)
    assert near.items() <= every.items() and len(near) >= 0.995 * len(want)
    assert {k for k, v in want.items() if v >= 0.85} <= near.keys()
    # The fingerprints decide: without flips only windows that fall together with an item are left.
    none = found_within(items, rows, 0)
    assert len(none) < 0.2 * len(want) and found_within(items, rows, -1) == {}


def test_keep_clean_and_blocks(spark, documents, sentence, monkeypatch):
    items, rows = corpus(sentence)
    bench = spark.createDataFrame(items + [(99, None), (98, "")], "item_id long, text string")
    docs = documents([*rows, (500, None), (501, ""), (None, items[0][1])])
    found = {r["doc_id"] for r in decontam.matches(docs, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK", 7)
    assert {r["doc_id"] for r in decontam.matches(docs, bench).collect()} == found
    kept = decontam.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - found | {500, 501} and None in found
    assert decontam.matches(docs, bench.limit(0)).collect() == [] and decontam.matches(documents([]), bench).collect() == []


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(6)
    item = rng.integers(0, 2**63, 1, dtype=np.uint64)
    table = decontam.Size(10, np.array([0]), np.array([10]), item).tables()
    for _ in range(3000):
        bits = rng.choice(64, rng.integers(0, decontam.RADIUS + 1), replace=False)
        near = item ^ np.bitwise_or.reduce(np.concatenate([[np.uint64(0)], np.uint64(1) << bits.astype(np.uint64)]))
        assert any(table[k][part] for k, part in enumerate(near.view(np.uint16)))


def test_fingerprints_by_running_sums():
    rng = np.random.default_rng(2)
    code = rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 400, dtype=np.uint64)
    for kind, size in ((np.uint8, 53), (np.uint16, 300)):
        start = np.arange(0, 400 - size)
        found = decontam.fingerprints(decontam.running_bits(code, kind), start, start + size)
        bits = np.unpackbits(code.view(np.uint8).reshape(-1, 8), axis=1)
        want = [np.packbits(bits[s : s + size].sum(0) > size // 2).view(np.uint64)[0] for s in start]
        assert np.array_equal(found, np.array(want))


def test_short_items_and_long_texts(sentence):
    block = decontam.searchers([1, 2], ["only three words", sentence(5, 40)])
    tables = [x.tables() for x in block]
    column = pa.array(["here are Only three, words now", sentence(7, 30000) + " " + sentence(5, 40), None, "", "only three"])
    assert sorted((m[0], m[1]) for m in decontam._matches(column, block, tables)) == [(0, 1), (1, 2)]
