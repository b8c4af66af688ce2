"""Licence scan: a paragraph classifier over word n-grams, confirmed by comparison with templates.

A paragraph is a window of ``WORDS`` words that starts every half of it, over all lines of a text, so that wrapped notices and notices in
the middle of long lines are seen; a blank line is a wall that no word pair crosses. Words and word pairs that stand in a notice are
hashed to a sparse presence vector; a multinomial logistic regression (Spark ML, on the JVM) gives the probability of every
licence family and of "unknown". It is trained on the notices in ``NOTICES``, alone, in part (as a window may cut them) and between the
words of ordinary paragraphs, against all ordinary paragraphs of all documents: those that do not look like a notice. Paragraphs with the
same vector are one row with their number as weight, so that whole tables fit; together they weigh ``ORDINARY_WEIGHT`` at most, so that the
notices do not fade as tables grow. One half of the paragraphs, by hash of their words, is not trained on but calibrates the unknown class:
the odds of a family against unknown must reach a level that all but ``FALSE_SHARE`` of them stay below, by exact rank.

Every family above the level must then be confirmed, the likeliest first: one of its notices must have ``CONFIRM`` of its
word pairs in the paragraph, not counting pairs that a family before it has taken. So two licences in one line are
two rows, and a licence whose text contains most of another's is one. Findings of neighbouring windows are held against each other by the
same rule, unless the whole notice is seen. The scan is DataFrame functions and Spark ML alone; documents are
mapped, and the rows found (never the texts) are shuffled once so that one notice in two windows is one row.

A paragraph in which no notice could be confirmed is not scored: so many pairs of every notice hold one of its longest words
that without any of these words in the paragraph fewer than ``CONFIRM`` are left (``key_words``).

Defined results: null and empty texts have no paragraphs and no rows; ``paragraph`` is the line, from 0, that holds most of the notice's
pairs (the first among equals); a text with several notices gives a row for each, and one for a notice that stands twice
within a window; repeated rows each give theirs; among notices of a family that fit equally the first in alphabetical order is
named; null ids pass through; an empty table gives an empty result. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverframe.llm.tables import pick_text
from riverframe.operators.settle import settle

#: What all ordinary paragraphs weigh together against the notices, each of which weighs one.
ORDINARY_WEIGHT = 2000
ALIKE = 0.5
TRAINED_IN_TASK = 20_000
WORDS = 64
STEP = WORDS // 2
FEATURES = 1 << 14
CONFIRM = 0.6
FALSE_SHARE = 0.0005
UNKNOWN = "unknown"

# Short notices by licence family.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "Distributed under the Apache License 2.0.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This software is distributed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Released under the GNU GPL v3.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2.",
        "Released under the GNU GPL v2.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
        "Released under the LGPL.",
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL.",
    ],
    "BSD": [
        "Licensed under the BSD License.",
        "Released under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright the author. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}

_WORD = r"\p{L}+|[0-9]+(?:\.[0-9]+)*"


@dataclass
class LicenseModel:
    pipeline: PipelineModel
    families: list[str]
    least: float


def _words(df: DataFrame) -> DataFrame:
    """``df`` with the words and word pairs of a text column ``line``."""
    return _pairs(RegexTokenizer(inputCol="line", outputCol="words", pattern=_WORD, gaps=False, toLowercase=True).transform(df))


def _pairs(df: DataFrame) -> DataFrame:
    return NGram(n=2, inputCol="words", outputCol="pairs").transform(df)


def _told(known: list) -> list[str]:
    """The words and pairs that stand in a notice."""
    return sorted({gram for r in known for pair in r["notice_pairs"] for gram in (pair, *pair.split(" "))})


def _grams(df: DataFrame, known: list) -> DataFrame:
    """``df`` with those of its words and pairs that stand in a notice."""
    told = _told(known)
    return df.withColumn("grams", F.array_sort(F.array_distinct(F.filter(F.concat("words", "pairs"), lambda gram: gram.isin(told)))))


def _features(df: DataFrame) -> DataFrame:
    """``df`` with the sparse presence vector of its ``grams``."""
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(df)


def _worded(docs: DataFrame) -> DataFrame:
    """doc_id and w, the words of each line of the texts that are not null. A blank line is one empty word."""
    cut = F.transform(F.split("text", "\n"), lambda x: F.regexp_extract_all(F.lower(x), F.lit(_WORD), F.lit(0)))
    return pick_text(docs).where("text is not null").select("doc_id", F.transform(cut, lambda w: F.when(F.size(w) == 0, F.array(F.lit(""))).otherwise(w)).alias("w"))


def _starts() -> Column:
    """Where, from 0, the windows over ``words`` start."""
    return F.sequence(F.lit(0), F.greatest(F.size("words") - STEP - 1, F.lit(0)), F.lit(STEP))


def paragraphs(docs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """row (a number for each row of ``docs``), doc_id, window (from 0), words and the line of each word.

    A blank line is one empty word. With ``keys`` only the paragraphs that hold one of these words."""
    # The row number stands between words and filter, so that words are not cut again for the filter.
    flat, starts = _worded(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.flatten("w").alias("words"), "w"), _starts()
    if keys is not None:
        held = F.array(*[F.lit(w) for w in keys])
        flat = flat.where(F.arrays_overlap("words", held))
        starts = F.filter(starts, lambda s: F.arrays_overlap(F.slice("words", s + 1, WORDS), held))
    lined = flat.select("row", "doc_id", "words", F.flatten(F.transform("w", lambda w, i: F.array_repeat(i, F.size(w)))).alias("at"))
    windows = F.transform(starts, lambda s: F.struct((s / STEP).cast("int").alias("window"), F.slice("words", s + 1, WORDS).alias("words"), F.slice("at", s + 1, WORDS).alias("at")))
    return lined.select("row", "doc_id", F.explode(windows).alias("x")).select("row", "doc_id", "x.window", "x.words", "x.at")


def notices(spark: SparkSession) -> DataFrame:
    """family, notice and its distinct word pairs."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    return _words(spark.createDataFrame(rows, "family string, line string")).select("family", F.col("line").alias("notice"), F.array_distinct("pairs").alias("notice_pairs"))


def key_words(known: list, share: float = CONFIRM) -> list[str]:
    """Words without any of which no notice keeps ``share`` of its pairs: of every notice its longest ones, as many as it takes."""
    keys = set()
    for r in known:
        left, least = [p.split(" ") for p in r["notice_pairs"]], share * len(r["notice_pairs"])
        for word in sorted({w for p in left for w in p}, key=lambda w: (-len(w), w)):
            if len(left) < least:
                break
            keys.add(word)
            left = [p for p in left if word not in p]
    return sorted(keys)


def _known(spark: SparkSession) -> list:
    """The constant NOTICES, cut into word pairs."""
    return sorted(notices(spark).collect(), key=lambda r: (r["family"], r["notice"]))


def _fits(known: list, pairs: Column) -> Column:
    """The notices as structs of the share of their pairs in ``pairs``, family, notice and pairs."""
    return F.array(*[
        F.struct(
            (F.size(F.array_intersect(own, pairs)) / F.lit(max(1, len(r["notice_pairs"])))).alias("similarity"),
            F.lit(r["family"]).alias("family"), F.lit(r["notice"]).alias("template"), own.alias("pairs"),
        )
        for r in known
        for own in [F.array(*[F.lit(p) for p in r["notice_pairs"]])]
    ])


def _views() -> list[tuple[str, str]]:
    """Family and text of every notice, and of the first and last two thirds of those that a window may cut."""
    out = []
    for family, texts in NOTICES.items():
        for text in texts:
            words = text.split()
            third = len(words) // 3
            out += [(family, text)] + ([(family, " ".join(words[:-third])), (family, " ".join(words[third:]))] if len(words) > STEP // 2 else [])
    return out


def _odds(families: list[str]) -> Column:
    """For a column ``p`` of probabilities: family and its odds against unknown (0 to 1), the likeliest first."""
    names = F.array(*[F.lit(f) for f in families])
    every = F.transform("p", lambda p, i: F.struct((p / (p + F.col("p")[0])).alias("probability"), (-i).alias("i"), names[i].alias("family")))
    return F.reverse(F.array_sort(F.slice(every, 2, len(families))))


def ordinary(docs: DataFrame, known: list) -> DataFrame:
    """part (0 to train on, 1 to calibrate), grams and n: how many paragraphs of all documents that do not look like a notice have them.

    A word is looked up once, not once per paragraph and pair: ``told`` has two places per word, for itself and for the pair it begins, null
    where they cannot stand in a notice. Key words and the pairs that a paragraph shares with a notice are all among its grams."""
    told, pairs = _told(known), sorted({pair for r in known for pair in r["notice_pairs"]})
    first, second = (sorted({pair.split(" ")[i] for pair in pairs}) for i in (0, 1))
    flat = _worded(docs).select(F.flatten("w").alias("words"))

    def places(a: Column, b: Column) -> Column:
        pair = F.when(a.isin(first) & b.isin(second), F.concat(a, F.lit(" "), b))
        return F.when(a.isin(told), F.array(a, pair)).otherwise(F.array(F.lit(None).cast("string"), F.lit(None).cast("string")))

    both = F.zip_with("words", F.slice("words", F.lit(2), F.size("words")), places)
    marked = flat.select("words", F.flatten(both).alias("told"))

    def paragraph(s: Column) -> Column:
        words, seen = F.slice("words", s + 1, WORDS), F.array_distinct(F.slice("told", 2 * s + 1, 2 * WORDS - 1))
        grams = F.sort_array(F.filter(seen, lambda gram: gram.isin(told)))
        return F.struct(F.pmod(F.xxhash64(words), F.lit(2)).alias("part"), grams.alias("grams"))

    worded = F.filter(_starts(), lambda s: F.exists(F.slice("words", s + 1, WORDS), lambda w: w != ""))
    counted = marked.select(F.explode(F.transform(worded, paragraph)).alias("x")).groupBy("x.part", "x.grams").agg(F.count("*").alias("n"))
    keys = key_words(known, ALIKE)
    alike = F.when(F.exists("grams", lambda gram: gram.isin(keys)), F.exists(_fits(known, F.col("grams")), lambda x: x["similarity"] >= ALIKE)).otherwise(F.lit(False))
    return counted.where(~alike)


def train(docs: DataFrame) -> LicenseModel:
    """Fit on the notices and all ordinary paragraphs of ``docs``."""
    spark = docs.sparkSession
    families, known = [UNKNOWN, *sorted(NOTICES)], _known(docs.sparkSession)
    counted = settle(ordinary(docs, known), "license-paragraphs")
    sizes = {r["part"]: r for r in counted.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    learned = counted.where("part = 0")
    alone = _grams(_words(spark.createDataFrame(_views(), "family string, line string")), known).select("family", "grams")
    # Every notice also in the middle of some ordinary paragraph, in up to eight ways, with a third or all of its words around it.
    by_hash = F.xxhash64(F.lit(5), "grams")
    around = learned.groupBy(F.pmod(by_hash, F.lit(8)).alias("turn")).agg(F.min_by("grams", by_hash).alias("around"))
    turned = alone.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long")))).join(F.broadcast(around), "turn")
    near = F.filter("around", lambda gram: (F.col("turn") % 2 == 1) | (F.pmod(F.xxhash64(gram), F.lit(3)) == 0))
    inside = turned.select("family", F.array_union("grams", near).alias("grams"))
    label = F.element_at(F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(float(i)))]), F.col("family"))
    plain = _grams(_words(spark.createDataFrame([(UNKNOWN, text) for text in _ORDINARY], "family string, line string")), known).select("family", "grams")
    each = min(1.0, ORDINARY_WEIGHT / sizes[0]["n"]) if 0 in sizes else 1.0
    negative = learned.select(F.lit(UNKNOWN).alias("family"), "grams", (F.col("n") * F.lit(each)).alias("weight"))
    rows = alone.unionAll(inside).unionAll(plain).withColumn("weight", F.lit(1.0)).unionAll(negative)
    tasks = 1 + (sizes[0]["rows"] if 0 in sizes else 0) // TRAINED_IN_TASK
    rows = settle(_features(rows.select(label.alias("label"), "weight", "grams")).drop("grams").coalesce(tasks), "license-training")
    regression = LogisticRegression(family="multinomial", regParam=2e-4, maxIter=80, featuresCol="features", labelCol="label", weightCol="weight")
    model = PipelineModel([regression.fit(rows)])
    return LicenseModel(model, families, _level(model, families, counted.where("part = 1"), sizes[1]["n"]) if 1 in sizes else 0.5)


def _level(model: PipelineModel, families: list[str], held: DataFrame, n: int) -> float:
    """The odds that all but ``FALSE_SHARE`` of ``n`` paragraphs stay below; only those at the top are put in order."""
    scored = _scored(model, _features(held)).select(_odds(families)[0]["probability"].alias("top"), "n")
    place = FALSE_SHARE * (n - 1)
    first = int(place)
    highest = scored.orderBy(F.desc("top")).limit(first + 2)
    upto = F.sum("n").over(Window.orderBy(F.desc("top")).rowsBetween(Window.unboundedPreceding, 0))
    at = [F.max(F.when(F.col("upto") > min(k, n - 1), F.col("top"))) for k in (first, first + 1)]
    above, below = highest.select("top", upto.alias("upto")).agg(*at).first()
    return above + (place - first) * (below - above)


# Lines that speak of licences without granting one.
_ORDINARY = [
    "He lost his driving license last year.", "The license plate was from another state.", "The general public was invited to the version of the play.", "Students at MIT released a new study.",
    "The Apache helicopter landed under the bridge.", "A license fee is due for version 2.0 of the product.", "She is licensed to practise medicine.", "The work is under way.", "Fishing licences are sold at the lake.",
]


def _scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("p", vector_to_array("probability"))


def _confirmed(known: list, model: LicenseModel) -> Column:
    """Families above the level that a notice confirms, each by pairs that no likelier family has taken."""
    found = "struct<family:string,probability:double,template:string,similarity:double,pairs:array<string>>"
    likely = F.filter(_odds(model.families), lambda x: x["probability"] >= model.least)

    def step(done: Column, family: Column) -> Column:
        fits = F.filter(_fits(known, done["left"]), lambda x: (x["family"] == family["family"]) & (x["similarity"] >= CONFIRM))
        # One element or none: the closest notice, the first in order among equals.
        closest = F.slice(F.array_sort(fits, lambda a, b: F.when(a["similarity"] > b["similarity"], -1).when(a["similarity"] < b["similarity"], 1).otherwise(0)), 1, 1)
        named = F.transform(closest, lambda x: F.struct(family["family"].alias("family"), family["probability"].alias("probability"), x["template"].alias("template"), x["similarity"].alias("similarity"), x["pairs"].alias("pairs")))
        return F.struct(F.array_except(done["left"], F.flatten(F.transform(closest, lambda x: x["pairs"]))).alias("left"), F.concat(done["found"], named.cast(f"array<{found}>")).alias("found"))

    start = F.struct(F.col("pairs").alias("left"), F.array().cast(f"array<{found}>").alias("found"))
    return F.aggregate(likely, start, step, lambda done: done["found"])


def scan(docs: DataFrame, model: LicenseModel | None = None) -> DataFrame:
    """doc_id, paragraph, family, probability, template, similarity of every licence notice found."""
    model = model or train(docs)
    known = _known(docs.sparkSession)
    rows = _scored(model.pipeline, _features(_grams(_pairs(paragraphs(docs, key_words(known))), known))).where(_odds(model.families)[0]["probability"] >= model.least)
    hits = rows.select("row", "doc_id", "window", "pairs", "at", F.explode(_confirmed(known, model)).alias("x")).select(
        "row", "doc_id", "window", "x.family", "x.probability", "x.template", "x.similarity", _line().alias("paragraph"),
        "x.pairs", F.array_intersect("x.pairs", "pairs").alias("seen"),
    )
    # A window may cut a notice: it counts where more of it is seen, and not as another family whose words it shares.
    own, beside = F.struct("window", "family", "template", "similarity", "pairs", "seen"), Window.partitionBy("row").orderBy("window").rangeBetween(-1, 1)

    def better(x: Column) -> Column:
        same = (x["template"] == F.col("template")) & ((x["similarity"] > F.col("similarity")) | ((x["similarity"] == F.col("similarity")) & (x["window"] < F.col("window"))))
        more = (x["family"] != F.col("family")) & (F.size(x["seen"]) > F.size("seen")) & (F.size(F.array_except("seen", x["pairs"])) < CONFIRM * F.size("pairs"))
        return (x["window"] != F.col("window")) & (same | more)

    placed = hits.withColumn("near", F.collect_list(own).over(beside)).where((F.col("similarity") == 1) | ~F.exists("near", better))
    best = F.max_by(F.struct("probability", "template", "similarity"), F.struct("similarity", "probability", (-F.col("window")).alias("w"))).alias("x")
    return placed.groupBy("row", "family", "doc_id", "paragraph").agg(best).select("doc_id", "paragraph", "family", "x.probability", "x.template", "x.similarity")


def _line() -> Column:
    """The line that holds most of the pairs of the notice ``x``."""
    lines = F.transform(F.filter(F.sequence(F.lit(0), F.size("pairs") - 1), lambda i: F.array_contains(F.col("x.pairs"), F.get("pairs", i))), lambda i: F.get("at", i))
    return -F.array_max(F.transform(F.array_distinct(lines), lambda n: F.struct(F.size(F.filter(lines, lambda m: m == n)).alias("many"), (-n).alias("line"))))["line"]
