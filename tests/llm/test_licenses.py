import pytest

from riverframe.llm import licenses


@pytest.fixture(scope="module")
def scanned(spark, sentence):
    rows = [(i, "\n".join(sentence(10 * i + k, 10 + k) for k in range(4))) for i in range(120)]
    rows += [(1000 + i, f"{sentence(i, 12)}.\n{text}\n{sentence(i + 50, 9)}") for i, (_, text) in enumerate(flat())]
    rows += [(2000, None), (2001, ""), (2002, "Released under the MIT License.\nAll rights reserved."), (None, "Released under the MIT License."), (2003, "He lost his driving license last year."), (2004, "word " * 20000 + "\nLicensed under CC BY-NC 4.0."), (2005, "released  under the mit license")]
    rows += [(2002, "Released under the MIT License.\nAll rights reserved.")]
    df = spark.createDataFrame([(*r, "x", 0.1) for r in rows], "doc_id long, text string, family string, similarity double")
    return df, licenses.scan(df).collect()


def flat():
    return [(family, text) for family, texts in sorted(licenses.NOTICES.items()) for text in texts]


def test_every_notice_is_found_in_its_line(scanned):
    _, found = scanned
    got = {(r["doc_id"], r["family"]) for r in found if r["paragraph"] == 1 and r["doc_id"] is not None and r["doc_id"] < 2000}
    want = {(1000 + i, family) for i, (family, _) in enumerate(flat())}
    assert len(got & want) >= 0.95 * len(want) and not got - want
    assert all(r["similarity"] >= licenses.CONFIRM and 0 <= r["probability"] <= 1 for r in found)


def test_ordinary_text_is_left_alone(scanned):
    _, found = scanned
    assert not [r for r in found if r["doc_id"] is not None and (r["doc_id"] < 1000 or r["doc_id"] in (2000, 2001, 2003))]
    assert not [r for r in found if r["doc_id"] is not None and 1000 <= r["doc_id"] < 2000 and r["paragraph"] != 1]


def test_edge_cases(spark, scanned):
    df, found = scanned
    assert sorted((r["paragraph"], r["family"]) for r in found if r["doc_id"] == 2002) == [(0, "MIT"), (0, "MIT"), (1, "proprietary"), (1, "proprietary")]
    assert [r["family"] for r in found if r["doc_id"] is None] == ["MIT"] and [r["family"] for r in found if r["doc_id"] == 2005] == ["MIT"]
    assert [(r["paragraph"], r["family"]) for r in found if r["doc_id"] == 2004] == [(1, "CC-BY-NC-4.0")]
    assert licenses.scan(df.limit(0)).collect() == []


def test_plan_is_native(scanned):
    import contextlib
    import io

    df, _ = scanned
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        licenses.paragraphs(df).explain()
    assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()


def wrapped(text, width):
    import textwrap

    return "\n".join(textwrap.wrap(text, width))


def test_wrapped_in_line_and_dual_notices(spark, sentence):
    model_rows = [(i, "\n".join(sentence(10 * i + k, 10 + k) for k in range(4))) for i in range(120)]
    rows, want = list(model_rows), set()
    for i, (family, text) in enumerate(flat()):
        rows.append((1000 + i, f"{sentence(i, 40)}\n\n{wrapped(text, 40)}\n\n{sentence(i + 9, 40)}"))
        rows.append((2000 + i, f"{sentence(i, 300)}. {text} {sentence(i + 9, 300)}"))
        rows.append((3000 + i, f"# {wrapped(text, 72)}".replace("\n", "\r\n# ")))
        want |= {(1000 * k + i, family) for k in (1, 2, 3)}
    duals = [
        ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        (f"{sentence(5, 20)} Licensed under the BSD License. {sentence(6, 20)} Licensed under CC BY 4.0.", {"BSD", "CC-BY-4.0"}),
        (wrapped(licenses.NOTICES["MIT"][3] + " " + licenses.NOTICES["BSD"][2], 60), {"MIT", "BSD"}),
    ]
    for i, (text, families) in enumerate(duals):
        rows.append((4000 + i, text))
        want |= {(4000 + i, f) for f in families}
    rows.append((5000, "All rights\n\nreserved by the licensed released permission"))
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [(r["doc_id"], r["family"]) for r in found]
    assert len(set(got)) == len(got)
    assert set(got) - want == set() and len(want - set(got)) <= 0.03 * len(want), (set(got) - want, want - set(got))
    assert {k for k in want if k[0] >= 4000} <= set(got)


def test_paragraphs_cover_every_word_and_keep_their_lines(spark):
    text = "\n".join(f"w{i} x{i}" if i % 7 else "" for i in range(400))
    got = licenses.paragraphs(spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "one")], "doc_id long, text string")).collect()
    mine = sorted((r for r in got if r["doc_id"] == 1), key=lambda r: r["window"])
    seen = {}
    for r in mine:
        assert len(r["words"]) == len(r["at"]) <= licenses.WORDS
        seen |= {r["window"] * licenses.STEP + k: (w, n) for k, (w, n) in enumerate(zip(r["words"], r["at"], strict=True))}
    want = [(w, i) for i in range(400) for w in ([f"w{i}"[:1], str(i), "x", str(i)] if i % 7 else [""])]
    assert [seen[k] for k in range(len(seen))] == want
    assert [(r["words"], r["at"]) for r in got if r["doc_id"] == 4] == [(["one"], [0])]


def test_key_words_lose_no_confirmation(spark):
    known = licenses._known(spark)
    keys = set(licenses.key_words(known))
    for r in known:
        without = [p for p in r["notice_pairs"] if not keys & set(p.split(" "))]
        assert len(without) < licenses.CONFIRM * len(r["notice_pairs"])


def test_all_ordinary_paragraphs_are_counted(spark, sentence):
    """Every paragraph of every document is trained on or calibrates the level, however many there are."""
    rows = [(i, f"{sentence(i, 9)} of this work {sentence(i + 7, 9)}" if i % 2 else sentence(i, 80)) for i in range(5000)]
    docs = spark.createDataFrame([*rows, (9000, "Released under the MIT License."), (9001, None), (9002, "\n")], "doc_id long, text string")
    counted = licenses.ordinary(docs, licenses._known(spark)).collect()
    assert sum(r["n"] for r in counted) == 2500 + 2 * 2500 and {r["part"] for r in counted} == {0, 1}
    assert sum(r["n"] for r in counted if "this work" in r["grams"]) == 2500
    assert {w for r in counted for w in r["grams"]} <= {"of", "this", "work", "of this", "this work"}


def test_the_level_is_the_exact_rank(spark, monkeypatch):
    monkeypatch.setattr(licenses, "FALSE_SHARE", 0.1)
    docs = spark.createDataFrame([(i, " ".join(["under the license this work is licensed"][: i % 2] + [f"w{i % 13}", "software", "the terms"][: i % 4])) for i in range(300)], "doc_id long, text string")
    model = licenses.train(docs)
    held = licenses.ordinary(docs, licenses._known(spark)).where("part = 1")
    scored = licenses._scored(model.pipeline, licenses._features(held)).select(licenses._odds(model.families)[0]["probability"].alias("top"), "n")
    want = scored.selectExpr("percentile(top, 0.9, n)").first()[0]
    assert model.least == pytest.approx(want, rel=1e-9)


def mixed(spark, sentence):
    told = "this work is licensed under the terms of the version 2 and 2.0 license".split()
    rows = [(i, " ".join(w for k, own in enumerate(sentence(i, 5 + 23 * (i % 9)).split()) for w in ([own] if (i + k) % 3 else [own, told[(i * k) % len(told)], told[(i * k + 1) % len(told)]]))) for i in range(200)]
    rows += [(1000 + i, f"{sentence(i, 31 * (i % 3))}\n{text}\n\n{sentence(i, 40)}") for i, (_, text) in enumerate(flat())]
    rows += [(2000, None), (2001, ""), (2002, "\n" * 200 + "of the\n\nlicense"), (2003, "the"), (2004, "licensed\n\nunder the"), (2005, "of the " * 500), (2005, "of the " * 500)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_ordinary_paragraphs_have_the_grams_of_their_words(spark, sentence):
    """The words of a text are looked up once; each paragraph gets what a lookup of its own words and pairs gives."""
    docs, known = mixed(spark, sentence), licenses._known(spark)
    notices = [set(r["notice_pairs"]) for r in known]
    told, want = {g for own in notices for pair in own for g in (pair, *pair.split(" "))}, {}
    for r in licenses.paragraphs(docs).selectExpr("words", "pmod(xxhash64(words), 2) AS part").collect():
        pairs = {f"{a} {b}" for a, b in zip(r["words"], r["words"][1:])}
        if any(r["words"]) and not any(len(own & pairs) / len(own) >= licenses.ALIKE for own in notices):
            key = (r["part"], tuple(sorted(told & {*r["words"], *pairs})))
            want[key] = want.get(key, 0) + 1
    counted = licenses.ordinary(docs, known)
    got = [((r["part"], tuple(r["grams"])), r["n"]) for r in counted.collect()]
    assert len(got) == len(want) and dict(got) == want
    # Neither a function per paragraph that Spark must convert rows for, nor the words of every paragraph as rows.
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(" not in plan and "posexplode" not in plan


def test_paragraphs_with_key_words(spark, sentence):
    docs, keys = mixed(spark, sentence), licenses.key_words(licenses._known(spark))
    columns = ("doc_id", "window", "words", "at")
    some = sorted(tuple(map(str, r)) for r in licenses.paragraphs(docs, keys).select(*columns).collect())
    every = licenses.paragraphs(docs).select(*columns).collect()
    assert some == sorted(tuple(map(str, r)) for r in every if set(keys) & set(r["words"])) and 0 < len(some) < len(every)
