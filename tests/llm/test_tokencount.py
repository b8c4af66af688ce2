import os
import random

import pytest
from tokenizers import Tokenizer, models

from riverframe.llm import tokencount

pytestmark = pytest.mark.skipif(not os.path.exists(tokencount.VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def pair():
    """Our counter and a public unigram tokenizer with the same vocabulary."""
    vocabulary = tokencount.read_vocabulary()
    low = min(score for _, score in vocabulary)
    full = [("<unk>", low)] + [(f"<0x{i:02X}>", low) for i in range(256)] + vocabulary
    other = Tokenizer(models.Unigram(full, unk_id=0, byte_fallback=True))

    def reference(text):
        return len(other.encode("▁" + text.replace(" ", "▁")).ids) if text else 0

    return tokencount.Counter(vocabulary), reference


def test_equal_to_the_public_tokenizer_on_documents(spark, pair):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    counter, reference = pair
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"]: r["n_tokens"] for r in tokencount.count(docs).collect()}
    assert found == {i: reference(t) for i, t in texts.items()}


def test_equal_on_random_text(pair):
    counter, reference = pair
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice(" \n\tabcdeio  ▁éñ漢🙂.!<0x41>thein") for _ in range(rng.randrange(0, 40)))
        assert counter.text(text) == reference(text), repr(text)


def test_memory_does_not_change_counts(pair, monkeypatch):
    counter, reference = pair
    monkeypatch.setattr(tokencount, "REMEMBERED", 3)
    text = "many different words in a row, all of them counted again and again"
    assert counter.text(text) == counter.text(text) == reference(text)
    long = "x" * 5000 + "é漢" * 200
    assert counter.text(long) == reference(long)


def test_small_vocabulary_ties():
    counter = tokencount.Counter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)])
    assert counter.text("ab") == 2  # all paths cost 3; the longest last piece wins: ▁, ab
    assert counter.text("q") == 2 and counter.text("漢") == 4 and counter.text(" ") == 2


def test_edge_cases(documents):
    found = {r["doc_id"]: r["n_tokens"] for r in tokencount.count(documents([(1, None), (2, ""), (3, " "), (None, "a"), (4, "the " * 50000)])).collect()}
    assert found[1] == found[2] == 0 and found[3] >= 1 and found[None] >= 1 and found[4] >= 50000
    assert tokencount.count(documents([])).collect() == []
