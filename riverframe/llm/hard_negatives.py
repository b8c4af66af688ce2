"""Hard negatives of anchor vectors by Kronecker-packed inner products.

Components become the integers ``floor(SCALE * x)``. The candidates of a chunk are shifted to be non-negative and several of
them are written side by side into one wide integer per component, each in a field that is wide enough for a
whole inner product. One multiplication by an anchor's component then multiplies all of them, the sum over the components
is formed once, and the fields hold the exact scores (less the shift times the anchor's sum).

Two carriers hold the wide integers. The 53 bits in which doubles are exact integers, where at least one field fits: there a
matrix product multiplies whole chunks. Python's unbounded integers otherwise, with fields of any width, so components of any
size have exact scores.

Anchors are the query set, in blocks of at most ``ANCHOR_BYTES``, and each block is sent to all tasks; candidates are never
shuffled or copied, each task scans its own rows once per block and phase. The first phase finds the positives of
each anchor, the second, with the score windows that these open, the negatives. Tasks send back the best few per anchor (and
positive); these are merged by anchor. A task holds a block, one chunk's scores and the best so far, however
many rows it reads.

Defined results: rows with a null id or label, a null vector or a null or non-finite component take no part; vectors of
different length do not meet; the empty vector scores 0. Rows of one id are one row, no partner of itself, and a repeated row is
listed once; if an id has several vectors or labels, each of them is a candidate and each is an anchor, and the better
scores count. Ties go to the smaller id. Anchors without positives, and positives without negatives, have no rows.
Scores outside the range of a long are compared exactly and returned as null. Empty tables give empty results; columns
besides vec_id, embedding and label are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverframe.operators.settle import settle

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: The window of a negative's score in hundredths of its positive's.
LOW, HIGH = 50, 95
#: Bytes of anchors in one block: what is sent to every task at once.
ANCHOR_BYTES = 16 << 20
CHUNK = 4096
GROUP = 512
_EXACT = 53
_PLAIN = 1 << 40


@dataclass
class Anchors:
    """The anchors of one block and one vector length."""

    ids: np.ndarray
    labels: np.ndarray  # numbers of label names
    vectors: np.ndarray  # int64, or Python integers where these do not do
    low: np.ndarray | None = None  # anchors x positives, Python integers; None where there is no such positive
    high: np.ndarray | None = None


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles: int64 where all are small, else an array of Python integers."""
    if not x.size or np.abs(x).max() < _PLAIN:
        return np.floor(x * scale).astype(np.int64)
    whole = np.empty(x.shape, object)
    for at, v in np.ndenumerate(x):
        a, b = float(v).as_integer_ratio()
        whole[at] = a * scale // b
    return whole


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, anchors x rows: int64, or Python integers where these do not do."""
    n, m = len(anchors), len(rows)
    if not n or not m or not rows.shape[1]:
        return np.zeros((n, m), np.int64)
    shift = max(0, -int(rows.min()))
    # No field leaves [-bound, bound], in no partial sum either.
    bound = max(sum(abs(int(v)) for v in a) for a in _extremes(anchors)) * (int(rows.max()) + shift)
    width = (2 * bound + 1).bit_length()
    fields = _EXACT // width
    if fields and rows.dtype != object and anchors.dtype != object and shift < _PLAIN:
        return _in_doubles(anchors, rows, shift, bound, width, fields)
    return _in_integers(anchors, rows, shift, bound, width)


def _extremes(anchors: np.ndarray) -> np.ndarray:
    """The anchor with the largest sum of magnitudes."""
    return anchors[[np.abs(anchors).sum(1).argmax()]]


def _in_doubles(anchors: np.ndarray, rows: np.ndarray, shift: int, bound: int, width: int, fields: int) -> np.ndarray:
    n, m = len(anchors), len(rows)
    words = -(-m // fields)
    raised = np.zeros((words * fields, rows.shape[1]), np.int64)
    raised[:m] = rows + shift
    wide = sum(raised[k * words : (k + 1) * words] << (k * width) for k in range(fields))
    product = (anchors.astype(np.float64) @ wide.astype(np.float64).T).astype(np.int64)
    # A field of its own for the sign: with the bound added to each, no field borrows from the next.
    product += sum(bound << (k * width) for k in range(fields))
    back = bound + shift * anchors.sum(1)[:, None]
    out = np.empty((n, words * fields), np.int64)
    for k in range(fields):
        out[:, k * words : (k + 1) * words] = ((product >> (k * width)) & ((1 << width) - 1)) - back
    return out[:, :m]


def _in_integers(anchors: np.ndarray, rows: np.ndarray, shift: int, bound: int, width: int) -> np.ndarray:
    size = -(-width // 8)
    wide = [int.from_bytes(b"".join((int(v) + shift).to_bytes(size, "little") for v in column), "little") for column in rows.T]
    raise_ = int.from_bytes(bound.to_bytes(size, "little") * len(rows), "little")
    out = np.empty((len(anchors), len(rows)), object)
    for i, anchor in enumerate(anchors):
        values = [int(v) for v in anchor]
        total = (sum(v * w for v, w in zip(values, wide, strict=True)) + raise_).to_bytes(size * len(rows), "little")
        back = bound + shift * sum(values)
        out[i] = [int.from_bytes(total[a : a + size], "little") - back for a in range(0, len(total), size)]
    return out


class Best:
    """The best ``keep`` rows of each place: by score, then by smaller id; a row counts once."""

    def __init__(self, places: int, keep: int) -> None:
        self.keep, self.floor = keep, np.full(places, None, object)
        self.place, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(place):
            self.waiting.append((place, score, ids))
            self.held += len(place)
        if self.held > max(50_000, 4 * self.keep * len(self.floor)):
            self.prune()

    def prune(self) -> None:
        parts = [(self.place, self.score, self.id), *self.waiting]
        place, score, ids = (np.concatenate([p[k] for p in parts]) for k in range(3))
        if len(score):
            low = -(1 << 62)
            plain = all(low < s < -low for s in (score.min(), score.max()))
            order = np.lexsort((ids, -score.astype(np.int64), place)) if plain else np.array(sorted(range(len(place)), key=lambda i: (place[i], -score[i], ids[i])), np.int64)
            place, score, ids = place[order], score[order], ids[order]
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (score[1:] != score[:-1]).astype(bool) | (ids[1:] != ids[:-1])
            place, score, ids = place[new], score[new], ids[new]
            # An id that has several vectors counts with its better score.
            if len(set(zip(place.tolist(), ids.tolist(), strict=True))) < len(place):
                _, first = np.unique(np.stack([place, ids]), axis=1, return_index=True)
                first.sort()
                place, score, ids = place[first], score[first], ids[first]
            begin = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            rank = np.arange(len(place)) - np.repeat(begin, np.diff(np.r_[begin, len(place)]))
            kept = rank < self.keep
            full = rank == self.keep - 1
            self.floor[place[full]] = score[full]
            place, score, ids = place[kept], score[kept], ids[kept]
        self.place, self.score, self.id, self.waiting, self.held = place, score.astype(object), ids, [], 0


def _numbers(batch: pa.RecordBatch, names: dict[str, int]) -> np.ndarray:
    """Labels as the block's numbers; labels that no anchor has are -1."""
    return np.array([names.get(v, -1) for v in batch.column("label").to_pylist()], np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length of the vectors, rows, their integers) in runs of at most ``CHUNK`` rows of one length."""
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            mine = np.flatnonzero(dims == dim)
            for a in range(0, len(mine), CHUNK):
                rows = batch.take(pa.array(mine[a : a + CHUNK]))
                x = rows.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield int(dim), rows, integers(x.reshape(-1, dim) if dim else x.reshape(rows.num_rows, 0), scale)


def _text(scores: np.ndarray) -> pa.Array:
    return pa.array([str(int(s)) for s in scores], pa.string())


def _scan(batches: Iterator[pa.RecordBatch], block: dict[int, Anchors], names: dict[str, int], scale: int, keep: int) -> Iterator[pa.RecordBatch]:
    """The task's best rows per anchor (positives) or per anchor and positive (negatives, where the block has windows)."""
    best: dict[int, list[Best]] = {}
    for dim, rows, x in _chunks(batches, scale):
        anchors = block.get(dim)
        if anchors is None:
            continue
        windows = 1 if anchors.low is None else anchors.low.shape[1]
        found = best.setdefault(dim, [Best(len(anchors.ids), keep) for _ in range(windows)])
        ids, labels = rows.column("vec_id").to_numpy(), _numbers(rows, names)
        for a in range(0, len(anchors.ids), GROUP):
            part = slice(a, a + GROUP)
            score = packed_scores(anchors.vectors[part], x)
            same = anchors.labels[part, None] == labels
            if anchors.low is None:
                allowed = same & (anchors.ids[part, None] != ids)
                _offer(found[0], a, score, allowed, ids, None, None)
            else:
                for k in range(windows):
                    _offer(found[k], a, score, ~same, ids, anchors.low[part, k], anchors.high[part, k])
    for dim, lists in best.items():
        for k, held in enumerate(lists):
            held.prune()
            yield pa.record_batch({
                "dim": pa.array(np.full(len(held.place), dim, np.int64)), "place": pa.array(held.place), "window": pa.array(np.full(len(held.place), k, np.int32)),
                "score": _text(held.score), "id": pa.array(held.id),
            })


def _offer(best: Best, a: int, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, low, high) -> None:
    """Rows that are allowed, within the window, and not below what is kept already."""
    floor = best.floor[a : a + len(score)]
    least = [f if lo is None else lo if f is None else max(f, lo) for f, lo in zip(floor, low if low is not None else [None] * len(floor), strict=True)]
    if low is not None:
        shut = np.array([h is None for h in high], bool)
        allowed = allowed & ~shut[:, None] & (score <= _limit(high, score.dtype, 0)[:, None])
    allowed = allowed & (score >= _limit(least, score.dtype, -1)[:, None])
    i, j = np.nonzero(allowed.astype(bool))
    best.add(a + i, score[i, j].astype(object), ids[j])


def _limit(values, kind, missing: int) -> np.ndarray:
    """Limits in the scores' type; a missing one is below every score (-1) or arbitrary (0)."""
    edge = (1 << 63) - 1
    if kind == object:
        return np.array([(0 if missing == 0 else -(10**700)) if v is None else v for v in values] + [None], object)[:-1]
    return np.array([(0 if missing == 0 else -edge - 1) if v is None else max(-edge - 1, min(edge, int(v))) for v in values], np.int64)


FOUND = "dim long, place long, window int, score string, id long"


def _merge(key, table: pa.Table, keep: int) -> pa.Table:
    """The best of all tasks for one anchor (of one vector length), ranked."""
    held = {}
    for w, s, i in zip(*(table.column(c).to_pylist() for c in ("window", "score", "id")), strict=True):
        at = held.setdefault(w, {})
        at[i] = max(int(s), at.get(i, int(s)))
    out = [(w, r, i, str(s)) for w, rows in held.items() for r, (i, s) in enumerate(sorted(rows.items(), key=lambda x: (-x[1], x[0]))[:keep], 1)]
    n = len(out)
    window, rank, ids, score = zip(*out, strict=True) if out else ((), (), (), ())
    return pa.table({
        "dim": pa.array([key[0].as_py()] * n, pa.int64()), "place": pa.array([key[1].as_py()] * n, pa.int64()), "window": pa.array(window, pa.int32()),
        "rank": pa.array(rank, pa.int32()), "id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.string()),
    })


MERGED = "dim long, place long, window int, rank int, id long, score string"


def usable(vectors: DataFrame, label: Column | None = None) -> DataFrame:
    """vec_id, label (text), embedding (doubles), dim of the rows that take part. ``label`` replaces the column."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where("vec_id is not null and label is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))").withColumn("dim", F.size("embedding"))


def mine(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], label: Column | None = None, scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` tells from the id which rows are anchors. A negative has another label than its anchor and a score of
    ``low`` to ``high`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, label)
    anchors = settle(rows.where(is_anchor(F.col("vec_id"))).distinct(), "anchors")
    size = anchors.agg(F.sum(8 * F.col("dim") + 64)).first()[0] or 0
    blocks = int(size // anchor_bytes + 1)
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding", "label"), F.lit(blocks)).cast("int"))
    if blocks > 1:
        anchors = settle(anchors.repartition(blocks, "block"), "anchor-blocks")
    pieces = [_mine_block(rows, anchors.where(F.col("block") == b), scale, positives, negatives, low, high) for b in range(blocks)]
    spans = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    found = [p for p in pieces if p is not None]
    if not found:
        return spark.createDataFrame([], spans)
    out = found[0]
    for piece in found[1:]:
        out = out.unionAll(piece)
    return out


def _mine_block(rows: DataFrame, block: DataFrame, scale: int, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    """One block: a bounded table, ordered so that its places are the same at every call."""
    spark = rows.sparkSession
    table = block.select("vec_id", "label", "embedding", "dim").orderBy("dim", "vec_id", "label", "embedding").toArrow()
    if not table.num_rows:
        return None
    names = {v: i for i, v in enumerate(sorted(set(table.column("label").to_pylist())))}
    sets = {}
    for dim, part, x in _chunks_of(table, scale):
        sets[dim] = Anchors(part.column("vec_id").to_numpy(), _numbers(part, names), x)

    def scan(state: dict[int, Anchors], keep: int, name: str) -> DataFrame:
        shared = spark.sparkContext.broadcast((state, names))
        best = rows.mapInArrow(lambda b: _scan(b, shared.value[0], shared.value[1], scale, keep), FOUND)
        merged = best.groupBy("dim", "place").applyInArrow(lambda k, t: _merge(k, t, keep), MERGED)
        out = settle(merged, name)
        shared.destroy()
        return out

    near = scan(sets, positives, "positives").collect()  # at most `positives` rows per anchor of the block
    score = {(r["dim"], r["place"], r["rank"] - 1): (r["id"], int(r["score"])) for r in near}
    for dim, a in sets.items():
        a.low, a.high = np.full((len(a.ids), positives), None, object), np.full((len(a.ids), positives), None, object)
        for i in range(len(a.ids)):
            for k in range(positives):
                if (dim, i, k) in score:
                    s = score[dim, i, k][1]
                    a.low[i, k], a.high[i, k] = -(-low * s // 100), high * s // 100
    far = scan(sets, negatives, "negatives")
    known = [(int(sets[d].ids[i]), d, i, k, p, str(s)) for (d, i, k), (p, s) in score.items()]
    schema = "anchor_id long, dim long, place long, window int, positive_id long, positive_score string"
    named = spark.createDataFrame(known, schema)
    fits = lambda c: F.expr(f"try_cast({c} as bigint)").alias(c)
    return far.withColumnRenamed("score", "negative_score").join(named, ["dim", "place", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), fits("positive_score"), fits("negative_score")
    )


def _chunks_of(table: pa.Table, scale: int) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """All anchors of each vector length."""
    dims = table.column("dim").to_numpy()
    for dim in np.unique(dims):
        part = table.take(pa.array(np.flatnonzero(dims == dim))).combine_chunks()
        x = part.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield int(dim), part, integers(x.reshape(-1, dim) if dim else x.reshape(part.num_rows, 0), scale)
