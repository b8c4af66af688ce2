import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture(scope="session")
def sentence():
    """Random but fixed prose of a number of words."""

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + rng.choice(("", "s", "n", "x")) for _ in range(n))

    return make


@pytest.fixture
def documents(spark):
    """Documents (doc_id, text, lang, source) with columns that clash with those of the results."""

    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), "x", 0.5, 1) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, score string, component_id double, n int")

    return make
