"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased; every byte that is no letter separates. Its subwords are the runs of 3 and 4
bytes inside a word, the word's two edges included, hashed to ``BUCKETS`` rows of an embedding
table. The average of a text's rows goes through a linear softmax. Both tables are learned together
by stochastic gradient descent in numpy on a bounded sample of labelled texts: ``PER_LANG`` texts of
every language, chosen by hash of the id, each as a whole text and as one short passage; beyond
``FULL_LANGS`` languages fewer of each, ``LEAST`` at least, so that no language is left out. Executors turn the sample into sparse bucket counts; only those reach the driver.

Calibration: a fifth of the sample, whole texts and passages, is kept out of the descent. On it one temperature is fitted to the
log-likelihood of smoothed targets (of n right answers, 1 in n + 2 is taken to be wrong, so that separable languages do not make it
infinitely sure). Two tests reject a text: its best score, in log-odds, is lower than those of known languages; or more of its
subwords were never met in training, and its score is nearer to a guess than to certainty (new words alone do not make a text foreign). Each has a level that a text of a known language passes with a probability of at most
``REJECT_SHARE`` / 2. That is far out in the tail of a few hundred texts, so it is not read off the lowest one: beyond the outer ``TAIL``
of the values the excess is taken to fall off exponentially. Short texts say little about new subwords: their share is
drawn towards the usual one by ``PRIOR`` subwords.

Scoring multiplies the embedding table by the softmax weights once, so that a subword costs one look-up
per language, and reads whole texts as bytes of Arrow batches in pieces of bounded size.

Defined results: null text, text without a letter, or no training rows give ``und``, score 0, rejected;
repeated rows are scored one by one; ties go to the alphabetically first language; rows with a null id
are scored and count as held out. Columns other than doc_id, text and (for training) lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.llm.tables import fold, hash_share, pick_text
from riverframe.llm.textbuf import PIECE, column_bytes, row_slices
from riverframe.operators.settle import settle

BUCKETS = 1 << 15
DIM = 12
EPOCHS = 6
PER_LANG = 500
FULL_LANGS = 200
LEAST = 20
PASSAGE = 60
REJECT_SHARE = 0.001
TAIL = 0.1
PRIOR = 60
LEAST_NEW = 0.02  # fewer new subwords reject nothing
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray  # languages x buckets: the product of both learned tables
    bias: np.ndarray
    temperature: float
    reject_below: float
    unseen: np.ndarray | None = None  # 1 for a bucket that no training text has
    usual: float = 0.0  # share of such subwords in a known language
    unseen_above: float = 1.0


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all rows with one separator before each row and one at the end."""
    raw, offsets = column_bytes(pc.utf8_lower(column))
    moved = offsets + np.arange(len(offsets))
    out = np.full(len(raw) + len(offsets), 32, np.uint8)
    keep = np.ones(len(out), bool)
    keep[moved] = False
    out[keep] = _LETTER[raw]
    return out, moved


def _subwords(padded: np.ndarray, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start positions, buckets) of the subwords that start in [lo, hi)."""
    part = padded[lo : hi + 3]
    if len(part) < hi - lo + 3:
        part = np.concatenate([part, np.full(hi - lo + 3 - len(part), 32, np.uint8)])
    gap = part == 32
    wide = part.astype(np.uint32)
    n = hi - lo
    three = wide[:n] | (wide[1 : n + 1] << 8) | (wide[2 : n + 2] << 16)
    ok = ~gap[1 : n + 1]
    at = np.flatnonzero(ok)
    yield at, (three[at] * np.uint32(2654435761)) >> np.uint32(17)
    at = np.flatnonzero(ok & ~gap[2 : n + 2])
    four = three[at] | (wide[at + 3] << 24)
    yield at, (four * np.uint32(2246822519)) >> np.uint32(17)


def _letters(column: pa.Array, padded: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Whether each row has a letter. Bytes decide for a-z; rows without one are looked at singly."""
    ascii_letter = np.concatenate([[0], np.cumsum((padded >= 97) & (padded <= 122))])
    any_letter = np.concatenate([[0], np.cumsum(padded != 32)])
    has = ascii_letter[moved[1:]] > ascii_letter[moved[:-1]]
    for i in np.flatnonzero(~has & (any_letter[moved[1:]] > any_letter[moved[:-1]])):
        has[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return has


def _logits(model: LanguageModel, padded: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight of each row's subwords for every language, bias included; and the share of subwords that are new."""
    rows, k = len(moved) - 1, len(model.langs)
    total, count, new = np.zeros((rows, k)), np.zeros(rows), np.zeros(rows)
    for lo in range(0, int(moved[-1]), PIECE):
        hi = min(lo + PIECE, int(moved[-1]))
        a, b = np.searchsorted(moved, lo, side="right") - 1, np.searchsorted(moved, hi, side="left")
        edges = np.clip(moved[a : b + 1], lo, hi) - lo
        for at, bucket in _subwords(padded, lo, hi):
            cut = np.searchsorted(at, edges)
            count[a:b] += np.diff(cut)
            full = np.flatnonzero(np.diff(cut))
            if not len(full):
                continue
            for j in range(k):
                total[a + full, j] += np.add.reduceat(model.weights[j][bucket], cut[full], dtype=np.float64)
            if model.unseen is not None:
                new[a + full] += np.add.reduceat(model.unseen[bucket], cut[full], dtype=np.float64)
    return total / np.maximum(count, 1)[:, None] + model.bias, _drawn(new, count, model.usual)


def _drawn(new: np.ndarray, count: np.ndarray, usual: float) -> np.ndarray:
    """Share of new subwords, drawn towards the usual one where there are few."""
    return (new + PRIOR * usual) / (count + PRIOR)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def predict(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and calibrated score of every text of a column."""
    return judge(model, column)[:2]


def judge(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated score and rejection of every text of a column."""
    n = len(column)
    if not n or not model.langs:
        return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
    langs, scores, rejected = [], [], []
    for part in row_slices(column.fill_null("")):
        padded, moved = _padded(part)
        has = _letters(part, padded, moved)
        z, new = _logits(model, padded, moved)
        p = _softmax(z / model.temperature)
        best = p.argmax(axis=1)
        langs += [model.langs[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
        scores.append(np.where(has, p[np.arange(len(part)), best], 0.0))
        unsure = scores[-1] < (1 + 1 / len(model.langs)) / 2  # nearer to a guess than to certainty
        rejected.append(~has | (scores[-1] < model.reject_below) | ((new > model.unseen_above) & (unsure | (len(model.langs) == 1))))
    return langs, np.concatenate(scores), np.concatenate(rejected)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse bucket counts of each text, and of a passage of it chosen by its id."""
    for batch in batches:
        langs, kind, ids, counts = [], [], [], []
        for lang, text, share in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "share")), strict=True):
            begin = int(share * 7919 % 1 * max(1, len(text) - PASSAGE))
            for whole, piece in ((True, text), (False, text[begin : begin + PASSAGE])):
                padded, moved = _padded(pa.array([piece]))
                found = np.zeros(BUCKETS, np.int64)
                for lo in range(0, len(padded), PIECE):
                    for _, bucket in _subwords(padded, lo, min(lo + PIECE, len(padded))):
                        found += np.bincount(bucket, minlength=BUCKETS)
                at = np.flatnonzero(found)
                langs.append(lang), kind.append(whole), ids.append(at.astype(np.int32)), counts.append(found[at].astype(np.int32))
        yield pa.record_batch(
            {"lang": pa.array(langs, pa.string()), "whole": pa.array(kind, pa.bool_()), "ids": pa.array(ids, pa.list_(pa.int32())), "counts": pa.array(counts, pa.list_(pa.int32()))}
        )


def train(docs: DataFrame, per_lang: int = PER_LANG) -> LanguageModel:
    """Learn from documents whose id is not held out and whose language is known."""
    known = pick_text(docs, "lang").where("lang is not null and text is not null and doc_id is not null").where(fold(F.col("doc_id"), 3) != 1)
    sizes = settle(known.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")  # one small row per language
    many = sizes.count()
    if not many:
        return LanguageModel([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), 1.0, 0.5)
    if many > FULL_LANGS:
        per_lang = min(per_lang, max(LEAST, per_lang * FULL_LANGS // many))
    picked = known.join(F.broadcast(sizes), "lang").withColumn("share", hash_share("doc_id")).where(F.col("share") < F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("n"))).drop("n")
    rows = picked.mapInArrow(_counts, "lang string, whole boolean, ids array<int>, counts array<int>").limit(3 * per_lang * many).toArrow()
    return fit(rows.column("lang").to_pylist(), rows.column("whole").to_pylist(), _arrays(rows.column("ids")), _arrays(rows.column("counts")))


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its numbers, without an object for every number."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        values, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out


def fit(lang: list[str], whole: list[bool], ids: list[np.ndarray], counts: list[np.ndarray]) -> LanguageModel:
    """Gradient descent over sparse samples, then temperature and rejection level."""
    langs = sorted(set(lang))
    label = {x: i for i, x in enumerate(langs)}
    order = sorted(range(len(lang)), key=lambda i: (lang[i], whole[i], len(ids[i]), ids[i][:8].tolist()))
    samples = [(label[lang[i]], whole[i], ids[i], counts[i]) for i in order if len(ids[i])]
    rng = np.random.default_rng(7)
    held = rng.random(len(samples)) < 0.2
    learn = [s for s, h in zip(samples, held, strict=True) if not h] or samples
    check = [s for s, h in zip(samples, held, strict=True) if h] or samples
    table, out, bias = np.zeros((BUCKETS, DIM)), rng.normal(0, 1 / np.sqrt(DIM), (DIM, len(langs))), np.zeros(len(langs))
    if not learn:
        return LanguageModel(langs, np.zeros((len(langs), BUCKETS), np.float32), bias, 1.0, 0.5)
    for epoch in range(EPOCHS):
        rate = 1.0 * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(learn)):
            y, _, at, n = learn[i]
            part = n / n.sum()
            mean = part @ table[at]
            error = _softmax(mean @ out + bias)
            error[y] -= 1
            back = out @ error
            out -= rate * 0.2 * np.outer(mean, error)
            bias -= rate * 0.02 * error
            table[at] -= (rate * 20 * part)[:, None] * back
    weights = (table @ out).T
    z = np.array([weights[:, at] @ (n / n.sum()) + bias for _, _, at, n in check])
    y = np.array([s[0] for s in check])
    temperature = _temperature(z, y)
    unseen = np.ones(BUCKETS, np.float32)
    for _, _, at, _ in learn:
        unseen[at] = 0
    count = np.array([n.sum() for _, _, _, n in check])
    new = np.array([n[unseen[at] > 0].sum() for _, _, at, n in check])
    usual = float(new.sum() / count.sum())
    odds = _log_odds(_softmax(z / temperature).max(axis=1))
    low = -_beyond(-odds, REJECT_SHARE / 2)
    high = max(LEAST_NEW, _beyond(_drawn(new, count, usual), REJECT_SHARE / 2))
    return LanguageModel(langs, np.ascontiguousarray(weights, np.float32), bias, temperature, float(1 / (1 + np.exp(-low))), unseen, usual, high)


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the highest likelihood of smoothed targets."""
    k, wrong = z.shape[1], 1.0 / (len(y) + 2)
    if k == 1:
        return 1.0
    target = np.full(z.shape, wrong / (k - 1))
    target[np.arange(len(y)), y] = 1 - wrong
    grid = np.geomspace(0.01, 10, 140)
    return float(grid[int(np.argmin([-(target * np.log(_softmax(z / t) + 1e-300)).sum() for t in grid]))])


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-15, 1 - 1e-15)
    return np.log(p / (1 - p))


def _beyond(values: np.ndarray, share: float) -> float:
    """The value that ``share`` of such values exceeds: past the outer ``TAIL`` of those seen the excess falls off exponentially."""
    edge = float(np.quantile(values, 1 - TAIL))
    excess = values[values > edge] - edge
    # The mean of a few excesses is uncertain itself: two standard errors more.
    mean = float(excess.mean() * (1 + 2 / np.sqrt(len(excess)))) if len(excess) else 0.0
    return edge + mean * float(np.log(TAIL / share))


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, rejected = judge(shared.value, batch.column("text"))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected)})

    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out")
    return pick_text(docs).select("doc_id", "text", held).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, then score all of them."""
    return score(docs, train(docs))


def keep_identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """Documents whose language is recognised, with their own columns; the others go."""
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~judge(shared.value, batch.column("text"))[2]))

    return docs.mapInArrow(run, schema)
