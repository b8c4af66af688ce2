"""Language identification, quality and toxicity: held-out accuracy, folds, edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from riverframe.llm import langid, quality, toxicity

SYLLABLES = {"aa": ("lorem", "tion", "wei", "sch"), "bb": ("qua", "rix", "ñor", "ll"), "cc": ("éau", "oix", "mur", "ze")}


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def text_of(lang, seed, n=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def language_rows():
    rows = [(i, text_of(lang, i, 3 + i % 40), lang) for i, lang in ((i, list(SYLLABLES)[i % 3]) for i in range(240))]
    return rows + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !!", "aa"), (1003, text_of("aa", 1, 2000), None), (None, text_of("bb", 2), "bb"), (0, text_of("aa", 0, 3), "aa")]


def test_language(documents, language_rows):
    docs = documents(language_rows)
    found = langid.identify(docs).collect()
    assert len(found) == len(language_rows)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    held = [(r["lang_pred"], list(SYLLABLES)[i % 3]) for i, r in by_id.items() if i < 240 and r["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    assert all(r["held_out"] == (fold(i, 3) == 1) for i, r in by_id.items())
    for i in (1000, 1001, 1002):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[1003]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in found)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("text is null or text = '12 34 !!'").count() == 0
    assert kept.count() >= 240


def test_language_does_not_learn_from_held_out_or_unlabelled(documents):
    rows = [(i, text_of("aa", i), "aa") for i in range(40)]
    poison = [(i, text_of("bb", i), "zz") for i in range(500, 560) if fold(i, 3) == 1] + [(None, text_of("bb", 9), "yy")]
    model = langid.train(documents(rows + poison))
    assert model.langs == ["aa"]
    empty = langid.identify(documents([])).collect()
    assert empty == []
    nothing = langid.identify(documents([(1, "abc", None)])).collect()[0]
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


def test_pieces_do_not_change_language(monkeypatch, documents, language_rows):
    import pyarrow as pa

    model = langid.train(documents(language_rows))
    column = pa.array([text_of("cc", 5, 400), None, "", text_of("bb", 6)])
    whole = langid.predict(model, column)
    monkeypatch.setattr(langid, "PIECE", 101)
    parts = langid.predict(model, column)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def bad_text(seed):
    rng = random.Random(seed)
    return " ".join(["SPAM!!"] * rng.randrange(5, 40)) if seed % 2 else " ".join(w + "***" for w in text_of("aa", seed).split())


@pytest.fixture(scope="module")
def quality_rows():
    return [(i, bad_text(i) if i % 4 == 0 else text_of("aa", i, 5 + i % 60), int(i % 4 != 0)) for i in range(320)]


def test_quality(spark, documents, quality_rows):
    extra = [(900, None), (901, ""), (902, "word " * 30000), (None, "text"), (1, text_of("aa", 1, 6))]
    docs = documents([r[:2] for r in quality_rows] + extra)
    labels = spark.createDataFrame([(r[0], r[2], None) for r in quality_rows] + [(900, None, 1), (None, 1, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    truth = {r[0]: r[2] for r in quality_rows}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95
    assert all(r["held_out"] == (r["doc_id"] is None or fold(r["doc_id"], 5) == 0) for r in found)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(documents([(1, "a b")]), none).collect()[0]["score"] == 0.5
    assert quality.classify(documents([]), none).collect() == []
    held = [i for i in range(60) if fold(i, 5) == 0]
    labels = spark.createDataFrame([(i, 0, 0) for i in held], "doc_id long, quality int, toxic int")
    assert quality.train(documents([(i, "x") for i in held]), labels).tables == []


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    fresh = rng.random((500, 3))
    assert np.mean((quality.margin(model, fresh) > 0) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))) > 0.9


def test_features_of_single_texts():
    import pyarrow as pa

    f = dict(zip(quality.FEATURES, quality.features(pa.array(["Go go GO! | 12", None]))[0], strict=True))
    assert np.isclose(f["log_words"], np.log1p(5)) and np.isclose(f["repeat_share"], 1 / 5) and np.isclose(f["bar_share"], 1 / 5)
    assert np.isclose(f["digit_share"], 2 / 14) and np.isclose(f["distinct_share"], 4 / 5)
    assert not quality.features(pa.array([None, ""], pa.string())).any()


@pytest.fixture(scope="module")
def toxic_rows(sentence):
    rows = []
    for i in range(400):
        words = sentence(i, 12 + i % 30).split()
        if i % 5 == 0:
            words.insert(i % len(words), f"zorg{'abcdefg'[i % 7]}" if i % 2 else "idiot")
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    return rows


def test_toxicity(spark, documents, toxic_rows):
    extra = [(900, None), (901, ""), (902, "you zorgx"), (903, "calm words only"), (904, "Idiot. " + "calm " * 20000), (None, "idiot")]
    docs = documents([r[:2] for r in toxic_rows] + extra)
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in toxic_rows], "doc_id long, quality int, toxic int")
    found = toxicity.rate(docs, labels).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (r["doc_id"] is None or fold(r["doc_id"], 4) == 2) for r in found)
    held = [(by_id[r[0]]["predicted"], r[2]) for r in toxic_rows if by_id[r[0]]["held_out"]]
    assert len(held) > 60 and np.mean([a == b for a, b in held]) > 0.97
    assert [by_id[i]["predicted"] for i in (900, 901, 902, 903, 904)] == [0, 0, 1, 0, 1] and by_id[None]["predicted"] == 1


def test_grammar_classes():
    import pyarrow as pa

    grammar = toxicity.Grammar({n: frozenset(toxicity.pack(w[:n]) for w in (b"idiot", b"scum") if len(w) == n) for n in toxicity.LENGTHS})
    rows = ["what an idiot", "you idiot", "she is not an idiot", 'He said "idiot" twice', "I will kill you", "kill the process", "not now. idiot", "scum scum", None, ""]
    counts = toxicity.class_counts(grammar, pa.array(rows)).astype(int).tolist()
    plain, targeted, negated, reported, threat = np.eye(5, dtype=int).tolist()
    nothing = [0] * 5
    assert counts == [plain, targeted, negated, reported, threat, nothing, plain, [2, 0, 0, 0, 0], nothing, nothing]
    p = toxicity.probability(toxicity.Grammar(), np.array([plain, targeted, negated, reported, threat, nothing]))
    assert p[1] > p[0] > p[3] > p[2] > p[5] and p[4] > p[3]


def test_copies_of_one_toxic_text_teach_no_words(spark, documents, toxic_rows):
    copied = [(2000 + i, "quibber blonk idiot frazzle") for i in range(200)]
    docs = documents([r[:2] for r in toxic_rows] + copied)
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in toxic_rows] + [(i, 1, 1) for i, _ in copied], "doc_id long, quality int, toxic int")
    grammar = toxicity.train(docs, labels)
    assert grammar.symbol(toxicity.pack(b"quibber")) == "o" and grammar.symbol(toxicity.pack(b"idiot")) == "I" and grammar.symbol(toxicity.pack(b"zorgq")) == "I"


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.rate(documents([(1, "you moron"), (2, "hello")]), none).orderBy("doc_id").collect()] == [1, 0]
    assert toxicity.rate(documents([]), none).collect() == []


@pytest.mark.parametrize("text", ["¡Idiota!", "“idiot”", "«idiot»", "so —idiot— there", "un… ¡idiota!", "idi\u00adot", "你idiot", "\ufeffidiot"])
def test_toxic_words_behind_marks_of_other_scripts(text):
    grammar = toxicity.Grammar({n: frozenset([toxicity.pack(b"idiot")] if n == 5 else []) for n in toxicity.LENGTHS})
    assert toxicity.class_counts(grammar, pa.array([text])).sum() == 1


def test_toxic_clauses_with_typographic_marks_and_other_scripts():
    entries = {5: frozenset([toxicity.pack(b"idiot")]), 6: frozenset([toxicity.pack("笨蛋".encode())])}
    grammar = toxicity.Grammar({n: entries.get(n, frozenset()) for n in toxicity.LENGTHS})
    typed = ["you're an idiot", "isn't an idiot", 'he said "idiot" again', "you. an idiot", "you。an idiot", "¿tú? idiota", "tú, ¡idiota!", "他是个笨蛋吗", "他是个好人"]
    plain, targeted, negated, reported = np.eye(5)[:4].astype(int).tolist()
    want = [targeted, negated, reported, plain, plain, plain, targeted, plain, [0] * 5]
    for rows in (typed, [t.replace("'", "’").replace(' "', " “").replace('" ', "” ") for t in typed]):
        assert toxicity.class_counts(grammar, pa.array(rows)).astype(int).tolist() == want
    heads = [toxicity._runs(*toxicity._plain(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())])))[2].tolist() for w in ("словарь", "словами", "словарь")]
    assert heads[0] == heads[2] != heads[1]


def test_every_language_is_learned(documents):
    rows = [(6 * k + j, text_of("aa", 6 * k + j), f"l{k:03}") for k in range(210) for j in range(6)]
    learned = {lang for i, _, lang in rows if fold(i, 3) != 1}
    assert len(learned) > 205 and langid.train(documents(rows)).langs == sorted(learned)


def test_texts_of_known_languages_stay_and_others_go(documents):
    """Of 3000 texts that no training saw, short ones among them, at most 1 in 1000 goes; of another language nearly all do."""
    import pyarrow as pa

    model = langid.train(documents([(i, text_of(list(SYLLABLES)[i % 3], i, 3 + i % 60), list(SYLLABLES)[i % 3]) for i in range(900)]))
    known = pa.array([text_of(list(SYLLABLES)[i % 3], 10_000 + i, 3 + i % 60) for i in range(3000)])
    langs, _, rejected = langid.judge(model, known)
    assert rejected.sum() <= 3 and np.mean([a == list(SYLLABLES)[i % 3] for i, a in enumerate(langs)]) > 0.99
    strange = ["xo", "qui", "wex", "zyk", "vuq", "jaw"]
    rng = random.Random(5)
    other = pa.array([" ".join("".join(rng.choice(strange) for _ in range(rng.randrange(1, 4))) for _ in range(30)) for _ in range(300)] + ["Быстрая коричневая лиса прыгает через ленивую собаку"] * 3)
    assert langid.judge(model, other)[2].mean() > 0.9


def test_levels_of_a_sample_without_surprises():
    """Separable languages and no new subword: the temperature is finite and a single new subword rejects nothing."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    ids = [np.unique(rng.integers(0, 200, 80)).astype(np.int32) + 300 * (i % 2) for i in range(400)]
    model = langid.fit(["ab"[i % 2] for i in range(400)], [True] * 400, ids, [np.ones(len(x), np.int32) for x in ids])
    assert 0.01 < model.temperature < 10 and model.usual == 0 and model.unseen_above == langid.LEAST_NEW
    langs, scores, rejected = langid.judge(model, pa.array(["", None, "..."]))
    assert langs == ["und"] * 3 and rejected.all() and (scores == 0).all()


@pytest.mark.parametrize("share", [0.01, 0.0005])
def test_tail_levels_hold(share):
    """From 300 values, the level that a share of all exceeds: held by a million others of the same kind."""
    rng = np.random.default_rng(2)
    for draw in (lambda n: rng.normal(size=n), lambda n: rng.exponential(size=n), lambda n: rng.logistic(size=n)):
        held = [np.mean(draw(1_000_000) > langid._beyond(draw(300), share)) for _ in range(20)]
        assert np.mean(held) <= 1.2 * share


def test_rejection_level_is_the_calibrated_share(documents, language_rows):
    assert langid.train(documents(language_rows)).reject_below > 0.4
