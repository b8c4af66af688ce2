import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from riverframe.llm import textbuf

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é漢\n\t .,\x0b", max_size=40)), max_size=12)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_hashes_agree_with_a_regular_expression(rows):
    found = textbuf.split_words(*textbuf.column_bytes(pa.array(rows, pa.string())))
    names = {}
    for i, row in enumerate(rows):
        own = found.hash[found.first[i] : found.first[i + 1]].tolist()
        assert len(own) == len(words(row))
        for word, code in zip(words(row), own, strict=True):
            assert names.setdefault(word, code) == code
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_shingles(rows):
    code, row, first = textbuf.shingles(textbuf.split_words(*textbuf.column_bytes(pa.array(rows, pa.string()))))
    names = {}
    for i, text in enumerate(rows):
        w = words(text)
        want = [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
        assert first[i + 1] - first[i] == len(want)
        for s, c in zip(want, code[first[i] : first[i + 1]].tolist(), strict=True):
            assert names.setdefault(s, c) == c
    assert len(set(names.values())) == len(names)


def test_pieces_do_not_change_words(monkeypatch):
    column = pa.array(["one two three " * 50, None, "x" * 300, "", "a b"])
    whole = textbuf.split_words(*textbuf.column_bytes(column))
    monkeypatch.setattr(textbuf, "PIECE", 37)
    parts = textbuf.split_words(*textbuf.column_bytes(column))
    assert np.array_equal(whole.hash, parts.hash) and np.array_equal(whole.start, parts.start)


def test_slices_cover_all_rows_once():
    column = pa.array(["abc"] * 10 + ["x" * 100] + [""] * 3)
    assert sum((p.to_pylist() for p in textbuf.row_slices(column, 8)), []) == column.to_pylist()
