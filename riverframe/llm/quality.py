"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a whole text are counts and shares taken from its bytes and words (``FEATURES``). Each
feature is cut into quantile bins. Cyclic boosting visits the features in turn and fits a tree of at
most four leaves on one feature's bins to the current log-loss gradient; the leaves are added to
that feature's look-up table. The ``PAIRS`` pairs of features whose 2-D tables reduce the remaining loss
most are then boosted in the same way with trees that cut each of the two axes once. A score is the
sum of one table entry per feature and pair, through a sigmoid: vectorised additions of bins.

Training takes at most ``SAMPLE`` labelled documents, chosen by hash of the id; their features are
computed on executors and only these numbers reach the driver.

Defined results: null text counts as empty; an empty text has all features 0 and is scored like any
other; without training rows every score is 0.5; with one class only, scores stay near that class;
repeated rows are scored one by one; several labels of one id are averaged (0.5 or more is 1); rows with a
null id are scored, count as held out and are never learned from. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.llm.tables import fold, hash_share, pick_text
from riverframe.llm.textbuf import column_bytes, row_slices, row_sums, shingles, split_words

FOLDS = 5
CUT = 0.3
SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 60
PAIR_ROUNDS = 30
RATE = 0.15
RIDGE = 2.0

FEATURES = (
    "log_words", "word_length", "upper_share", "symbol_share", "exclaim_share", "digit_share", "distinct_share",
    "repeat_share", "shingle_share", "words_per_line", "stop_share", "short_share", "capital_share", "bar_share", "long_word",
)

_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


def _class(chars: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(chars)] = True
    return marks


_UPPER = _class(bytes(range(65, 91)))
_LETTER = _class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = _class(bytes(range(48, 58)))
_SYMBOL = _class(bytes(c for c in _PUNCTUATION if c not in b".,;:'\"!?-()"))
_EXCLAIM = _class(b"!?")
_STOP = _class(b".!?")
_BAR = _class(b"|")
_STARTS = _class(bytes(range(0, 128)) + bytes(range(192, 256)))  # first bytes of characters


def _distinct(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct codes of each row; sorts within rows, in place of a copy."""
    code = code.copy()
    for a, b in zip(first[:-1], first[1:], strict=True):
        code[a:b].sort()
    new = np.ones(len(code), np.int64)
    new[1:] = code[1:] != code[:-1]
    new[first[:-1][first[:-1] < len(code)]] = 1
    return row_sums(new, first)


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for every text."""
    parts = [_features(part) for part in row_slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def _features(column: pa.Array) -> np.ndarray:
    raw, offsets = column_bytes(column)
    words = split_words(raw, offsets)
    n = np.diff(words.first).astype(float)
    size = np.maximum(n, 1)
    chars = np.maximum(row_sums(_STARTS[raw], offsets), 1)
    letters = np.maximum(row_sums(_LETTER[raw], offsets), 1)
    long = words.end - words.start
    lead = raw[words.start]
    same = np.zeros(len(words.row), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    runs, _, runs_first = shingles(words)
    lines = row_sums(raw == 10, offsets) + 1
    sums = lambda marks: row_sums(marks, words.first)
    return np.column_stack([
        np.log1p(n),
        sums(long) / size,
        row_sums(_UPPER[raw], offsets) / letters,
        row_sums(_SYMBOL[raw], offsets) / chars,
        row_sums(_EXCLAIM[raw], offsets) / chars,
        row_sums(_DIGIT[raw], offsets) / chars,
        _distinct(words.hash, words.first) / size,
        sums(same) / size,
        _distinct(runs, runs_first) / np.maximum(np.diff(runs_first), 1),
        n / lines,
        row_sums(_STOP[raw], offsets) / size,
        sums(long <= 2) / size,
        sums(_UPPER[lead]) / size,
        row_sums(_BAR[raw], offsets) / size,
        sums(long > 20) / size,
    ])


@dataclass
class QualityModel:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
    return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]


def margin(model: QualityModel, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model.base)
    for table, at in zip(model.tables, _bins(x, model.edges), strict=True):
        total += table[at]
    if model.pairs:
        at = _bins(x, model.pair_edges)
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[at[i], at[j]]
    return total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of ordered bins into two leaves."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gt, ht = g.sum(), h.sum()
    gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values, bin by bin, of a tree of depth two on one feature."""
    _, k = _best_cut(g, h)
    cuts = [0, len(g)]
    if k:
        cuts = sorted({0, _best_cut(g[:k], h[:k])[1], k, k + _best_cut(g[k:], h[k:])[1], len(g)})
    out = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts each axis once, the better first axis chosen."""
    best: tuple[float, np.ndarray] = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, k = _best_cut(a.sum(1), b.sum(1))
        out, gain = np.zeros_like(a), -(a.sum() ** 2) / (b.sum() + RIDGE)
        for part in (slice(0, k), slice(k, None)):
            ga, ha = a[part].sum(0), b[part].sum(0)
            if not a[part].size:
                continue
            _, m = _best_cut(ga, ha)
            for side in (slice(0, m), slice(m, None)):
                gs, hs = ga[side].sum(), ha[side].sum()
                out[part, side] = gs / (hs + RIDGE)
                gain += gs**2 / (hs + RIDGE)
        if gain > best[0]:
            best = (gain, out.T if turned else out)
    return best


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]


def fit(x: np.ndarray, y: np.ndarray) -> QualityModel:
    if not len(y):
        return QualityModel()
    share = np.clip(y.mean(), 0.5 / (len(y) + 1), 1 - 0.5 / (len(y) + 1))
    model = QualityModel(float(np.log(share / (1 - share))), _edges(x, BINS), pair_edges=_edges(x, PAIR_BINS))
    at = _bins(x, model.edges)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            p = _sigmoid(z)
            step = RATE * _tree(np.bincount(at[j], y - p, len(table)), np.bincount(at[j], p * (1 - p), len(table)))
            table += step
            z += step[at[j]]
    at = _bins(x, model.pair_edges)
    width = [len(e) + 1 for e in model.pair_edges]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(z)
        cell = at[i] * width[j] + at[j]
        return tuple(np.bincount(cell, v, width[i] * width[j]).reshape(width[i], width[j]) for v in (y - p, p * (1 - p)))

    gains = sorted(((_pair_tree(*sums(i, j))[0], i, j) for i in range(len(width)) for j in range(i + 1, len(width))), key=lambda g: (-g[0], g[1:]))
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((width[i], width[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * _pair_tree(*sums(i, j))[1]
            table += step
            z += step[at[i], at[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Learn from labelled documents outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .where(fold(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    )
    count = known.count()
    if count > sample:
        known = known.where(hash_share("doc_id") < sample / count)
    # At most about ``sample`` ids and labels: 16 bytes each.
    rows = pick_text(docs).join(F.broadcast(known), "doc_id").mapInArrow(_labelled, "y int, x array<double>").limit(2 * sample).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = np.array(rows.column("y").to_pylist(), float)
    order = np.lexsort(np.column_stack([x, y]).T)
    return fit(x[order], y[order])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch.column("text"))
        yield pa.record_batch({"y": batch.column("y"), "x": pa.array(list(x), pa.list_(pa.float64()))})


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _sigmoid(margin(shared.value, features(batch.column("text"))))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(p, pa.float64()), "predicted": pa.array((p >= CUT).astype(np.int32))})

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(True)).alias("held_out")
    return pick_text(docs).select("doc_id", "text", held).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on labelled documents that are not held out, then score all documents."""
    return score(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are predicted good, with their own columns; the others go."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _sigmoid(margin(shared.value, features(batch.column("text"))))
            yield batch.filter(pa.array(p >= CUT))

    return docs.mapInArrow(run, docs.schema)
