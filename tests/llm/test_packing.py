import itertools
import json
import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riverframe.llm import packing


@cache
def libraries():
    with open(packing.TOKENIZER, encoding="utf-8") as file:
        definition = file.read()
    t = Tokenizer.from_str(definition)
    t.encode_special_tokens = True
    return t, packing.Encoder(definition)


@pytest.fixture
def tokenizer():
    return libraries()[0]


@pytest.fixture
def encoder():
    return libraries()[1]


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_ids_are_those_of_the_tokenizer(tokenizer, encoder):
    """Letters, digits, marks and spaces of every block of code points, in several contexts."""
    points = [c for c in [*range(0x3000), *range(0x3000, 0x110000, 101)] if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)} \n{chr(c)}'s" for c in points]
    assert [ids_of(x) for x in encoder.encode(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "don't", "12", "é", "你", "!", "<|endoftext|>", "\r\n", " x"]), max_size=20))
def test_ids_of_mixed_texts(parts):
    text, (t, encoder) = "".join(parts), libraries()
    assert ids_of(encoder.encode([text])[0]) == t.encode(text, add_special_tokens=False).ids


def test_a_file_whose_ids_do_not_follow_its_merges_is_read_by_the_tokenizer(tokenizer):
    with open(packing.TOKENIZER, encoding="utf-8") as file:
        model = json.load(file)
    model["model"]["merges"] = model["model"]["merges"][::-1]
    text = "the cats and the dogs"
    encoder = packing.Encoder(json.dumps(model))
    assert not encoder.ranked
    assert ids_of(encoder.encode([text])[0]) == Tokenizer.from_str(json.dumps(model)).encode(text, add_special_tokens=False).ids


def check(rows, tokens, documents=None, attention=None):
    """Every sequence is gapless from 0 and keeps all capacities; returns the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= tokens and len(held) <= (documents or tokens) and sum(n * n for _, n in held) <= (attention or tokens * tokens)
    return len(by)


def test_whole_documents_come_back(spark, documents, tokenizer, sentence):
    texts = [sentence(i, n) for i, n in enumerate([1, 5, 30, 200, 900, 2500, 40, 7, 60, 3000, 12, 1])]
    texts += ["", None, texts[2], "<|endoftext|> x", "word" * 9000]
    df = documents([(i, t) for i, t in enumerate(texts)]).repartition(3)
    packed = packing.pack(packing.cut(df, 256), 256)
    rows = packed.collect()
    assert packed.columns == ["doc_id", "piece", "start", "length", "tokens", "sequence_id", "offset"]
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    for i, ids in want.items():
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and mine[0]["start"] == 0
        assert all(a["start"] + a["length"] == b["start"] for a, b in itertools.pairwise(mine))
        assert sum((ids_of(r["tokens"]) for r in mine), []) == ids
        assert all(r["length"] == 256 for r in mine[1:]) and 1 <= mine[0]["length"] <= 256
        assert len(mine) == -(-len(ids) // 256)
    n = check(rows, 256)
    total = sum(map(len, want.values()))
    assert -(-total // 256) <= n <= -(-total // 256) + 1
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert len(whole) == n
    for r in rows:
        s = whole[r["sequence_id"]]
        k = s["offsets"].index(r["offset"])
        assert s["doc_ids"][k] == r["doc_id"] and s["tokens"][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["tokens"]


def test_one_length_over_many_tasks_keeps_places_apart(spark):
    df = spark.range(0, 5000, 1, 13).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 700L ELSE id % 50 + 1 END AS length", "'x' AS sequence_id", "id AS __other")
    rows = packing.pack(df).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 5000 == len({r["doc_id"] for r in rows})
    total = sum(r["length"] for r in rows)
    # 1667 pieces of 700 tokens go in pairs; what is left beside them takes the short ones.
    assert check(rows, 2048) == max(-(-total // 2048), 834)


@pytest.mark.parametrize("limits", [(100, 3, None), (100, None, 2500), (100, 4, 3000), (64, 2, 64 * 64)])
def test_every_capacity_holds(spark, limits):
    tokens, documents, attention = limits
    longest = packing.max_piece(tokens, attention)
    df = spark.range(0, 900, 1, 5).selectExpr("id AS doc_id", f"1 + (id * 7919) % {longest} AS length")
    rows = packing.pack(df, tokens, documents, attention).collect()
    n = check(rows, tokens, documents, attention)
    lengths = [r["length"] for r in rows]
    bound = max(-(-sum(lengths) // tokens), -(-len(lengths) // (documents or tokens)), -(-sum(x * x for x in lengths) // (attention or tokens * tokens)))
    assert bound <= n <= 1.35 * bound + 1


def smallest(lengths, tokens):
    """Fewest sequences by trying all ways."""
    best = [len(lengths)]

    def go(i, free):
        if len(free) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(free)
            return
        for k in {f: k for k, f in enumerate(free) if f >= lengths[i]}.values():
            go(i + 1, [*free[:k], free[k] - lengths[i], *free[k + 1 :]])
        go(i + 1, [*free, tokens - lengths[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plan_against_all_ways(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    best = smallest(sorted(lengths, reverse=True), 20)
    for fit in ("norm", "dot"):
        p = packing.plan(counts, 20, fit=fit)
        assert best <= p.sequences <= 11 * best // 9 + 1
        placed = [(n, r) for n in counts for r in range(counts[n])]
        seen = set()
        for n, r in placed:
            steps = [i for i in range(len(p.length)) if p.length[i] == n and p.rank[i] <= r]
            i = max(steps, key=lambda i: p.rank[i])
            seen.add((int(p.sequence[i] + r - p.rank[i]), int(p.offset[i])))
        assert len(seen) == len(placed) and {s for s, _ in seen} == set(range(p.sequences))


def test_plan_grows_with_lengths_and_not_with_documents():
    counts = {n: 3 + n * 7919 % 101 for n in range(1, 2049)}
    small, large = packing.plan(counts), packing.plan({n: c * 10**6 for n, c in counts.items()})
    assert len(large.length) < 4 * len(small.length) + 4096
    assert large.sequences <= 1.005 * sum(n * c * 10**6 for n, c in counts.items()) / 2048


def test_edges(spark, documents):
    assert packing.pack(packing.cut(documents([]))).collect() == []
    rows = packing.pack(packing.cut(documents([(None, None), (None, ""), (1, " "), (1, " ")]))).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (0, 1), (1, 2), (1, 2)]
    assert {r["sequence_id"] for r in rows} == {0} and {zlib.crc32(r["tokens"]) for r in rows if r["doc_id"] is None} == {zlib.crc32(b"\0\0\0\0")}
    for bad in (0, 2049):
        with pytest.raises(ValueError, match="fits in no sequence"):
            packing.pack(spark.createDataFrame([(bad,)], "length long"))
    with pytest.raises(ValueError, match="unknown fit"):
        packing.plan({1: 2}, fit="first")
