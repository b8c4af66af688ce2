"""Vector codes by active-entry Lloyd rounds on integers.

Components become the integers ``floor(scale * x)`` and vectors are cut into equal consecutive parts, each position with a codebook
of its own. A codebook starts as the parts of the smallest ids. A round assigns every part to the nearest entry
(squared distance, ties to the lower index) and moves every used entry to the floor of its parts' mean.

A row keeps, per part, its entry and the exact distance to it. If that entry did not move, no other unmoved entry can have
become nearer, so only the moved entries are compared with the stored distance; a part whose own entry moved compares all.
Sums per entry are kept the same way: only parts that changed their entry are subtracted and added. All of it is integer arithmetic,
so the result does not depend on how rows are dealt to tasks.

A round is one scan. Its output, rows with their new state and the task's changes of the sums, is written to the shared
checkpoint folder and the state before it is removed, so that two states exist at a time; no row is ever shuffled. The driver
holds the codebooks and sums (``entries`` x vector length integers for every vector length).

Rows and entries of moderate size are computed in doubles, which hold these integers exactly; an entry that is
too far to be the nearest of a moderate row is left out there by a proven bound. Other rows are computed in Python's unbounded integers.

Defined results: vectors that are null or hold a null or non-finite component are dropped; every vector length has
codebooks of its own, cut at ``length * i // parts``; an empty vector has code 0 everywhere and error 0; fewer ids
than ``entries`` make fewer entries; an id that repeats counts once for the start, with its smallest vector; rows without an id start a
codebook only after all others; repeated rows are coded one by one; an error beyond a long is null. An empty table gives an
empty result. Columns besides vec_id, embedding and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.operators.settle import discard, settle

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CHUNK = 8192
LIMB = 40
_LONG = (1 << 63) - 1
ROW = ["vec_id", "label", "embedding", "dim", "codes", "distances"]


@dataclass
class Books:
    """The codebooks of one vector length."""

    cuts: list[int]
    entries: list[list[list[int]]]  # part, entry, component
    moved: list[list[int]]  # entries of each part that the last round moved
    sums: list[list[list[int]]] = field(default_factory=list)
    counts: list[list[int]] = field(default_factory=list)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for entry in part for v in entry).encode()).hexdigest()


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles as Python integers."""
    out = np.empty(x.shape, object)
    for at, v in np.ndenumerate(x):
        a, b = float(v).as_integer_ratio()
        out[at] = a * scale // b
    return out


def moderate(width: int) -> int:
    """Components up to this size have squared distances, to entries that can be nearest, below 2^53."""
    size = max(width, 1)
    return int((2**53 / (size * (2 + 2 * size**0.5) ** 2 * 4)) ** 0.5)


def nearest(x: np.ndarray, entries: list[list[int]], among: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest of the entries ``among``, lowest index first; x moderate doubles.

    The book has a moderate entry, which is at most ``2 b sqrt(d)`` away; an entry with a component above ``b (1 + 2 sqrt(d))`` is
    farther and is left out. Where none is left, the distance is the largest long.
    """
    d = x.shape[1]
    reach = moderate(d) * (1 + 2 * d**0.5)
    able = [k for k in among if max((abs(v) for v in entries[k]), default=0) <= reach]
    if not able:
        return np.zeros(len(x), np.int64), np.full(len(x), _LONG, np.int64)
    book = np.array([entries[k] for k in able], np.float64).reshape(len(able), d)
    far = (x**2).sum(1)[:, None] - 2 * (x @ book.T) + (book**2).sum(1)
    at = far.argmin(1)
    return np.array(able, np.int64)[at], far[np.arange(len(x)), at].astype(np.int64)


def _nearest_exact(x: np.ndarray, entries: list[list[int]], among: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`nearest` in Python integers."""
    best = [min((sum((int(a) - b) ** 2 for a, b in zip(row, entries[k], strict=True)), k) for k in among) for row in x]
    return np.array([k for _, k in best], np.int64), np.array([v for v, _ in best], object)


def assign(x: np.ndarray, book: list[list[int]], moved: list[int], codes: np.ndarray | None, distances: np.ndarray | None, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """New (codes, distances) of one part position. ``codes`` None: no state yet."""
    find = _nearest_exact if exact else nearest
    everything = list(range(len(book)))
    if codes is None:
        return find(x, book, everything)
    codes, distances = codes.copy(), distances.copy()
    if not moved:
        return codes, distances
    touched = np.isin(codes, moved)
    if touched.any():
        codes[touched], distances[touched] = find(x[touched], book, everything)
    still = np.flatnonzero(~touched)
    if len(still):
        at, far = find(x[still], book, moved)
        nearer = (far < distances[still]) | ((far == distances[still]) & (at < codes[still]))
        codes[still[nearer]], distances[still[nearer]] = at[nearer], far[nearer]
    return codes, distances


class Changes:
    """Changes of counts (component -1) and sums that a task has found, per (vector length, part, entry, component)."""

    def __init__(self) -> None:
        self.total: dict[tuple[int, int, int], list[int]] = {}

    def add(self, dim: int, part: int, codes: np.ndarray, x: np.ndarray, sign: int) -> None:
        for k in np.unique(codes):
            mine = x[codes == k]
            row = [sign * len(mine), *(sign * int(v) for v in mine.sum(0))]
            held = self.total.get((dim, part, int(k)))
            self.total[dim, part, int(k)] = row if held is None else [a + b for a, b in zip(held, row, strict=True)]

    def rows(self) -> tuple[list[list[int]], list[int]]:
        """Keys (length, part, entry, component, limb) and values: signed limbs of ``LIMB`` bits, which Spark sums as longs."""
        keys, values = [], []
        for (dim, part, k), row in self.total.items():
            for c, v in enumerate(row, -1):
                sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
                while v:
                    keys.append([dim, part, k, c, limb]), values.append(sign * (v & ((1 << LIMB) - 1)))
                    v, limb = v >> LIMB, limb + 1
        return keys, values


def _record(rows: pa.RecordBatch | None, kind: pa.DataType, codes: list[bytes], distances: list, keys: list, values: list) -> pa.RecordBatch:
    n, m = len(codes), len(keys)
    pad = lambda name, t: pa.concat_arrays([rows.column(name).cast(t), pa.nulls(m, t)]) if n else pa.nulls(m, t)
    return pa.record_batch({
        "kind": pa.array([0] * n + [1] * m, pa.int32()), "vec_id": pad("vec_id", pa.int64()), "label": pad("label", pa.string()), "embedding": pad("embedding", pa.list_(kind)),
        "dim": pad("dim", pa.int32()), "codes": pa.array(codes + [None] * m, pa.binary()), "distances": pa.array(distances + [None] * m, pa.list_(pa.int64())),
        "key": pa.array([None] * n + keys, pa.list_(pa.int32())), "value": pa.array([None] * n + values, pa.int64()),
    })


def _round(batches: Iterator[pa.RecordBatch], books: dict[int, Books], scale: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows with their new state; last the changes of the task."""
    changes = Changes()
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            mine = np.flatnonzero(dims == dim)
            for a in range(0, len(mine), CHUNK):
                rows = batch.take(pa.array(mine[a : a + CHUNK]))
                yield _advance(rows, int(dim), books[int(dim)], scale, changes)
    keys, values = changes.rows()
    yield _record(None, kind, [], [], keys, values)


def _advance(rows: pa.RecordBatch, dim: int, book: Books, scale: int, changes: Changes) -> pa.RecordBatch:
    n, parts = rows.num_rows, len(book.cuts) - 1
    raw = rows.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, dim)
    started = rows.column("codes").null_count == 0
    old = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64) if started else None
    before = rows.column("distances").to_pylist() if started else None
    codes, distances = np.zeros((n, parts), np.int64), np.zeros((n, parts), object)
    width = max(b - a for a, b in zip(book.cuts[:-1], book.cuts[1:], strict=True))
    with np.errstate(over="ignore"):
        scaled = np.floor(raw * scale)
    plain = (np.abs(scaled).max(1, initial=0.0) <= moderate(width)) if dim else np.ones(n, bool)
    if not all(any(max(map(abs, e), default=0) <= moderate(width) for e in p) for p in book.entries):
        plain[:] = False
    for exact in (False, True):
        which = np.flatnonzero(plain != exact)
        if not len(which):
            continue
        x = integers(raw[which], scale) if exact else scaled[which]
        for p, (a, b) in enumerate(zip(book.cuts[:-1], book.cuts[1:], strict=True)):
            part, now = x[:, a:b], None if old is None else old[which, p]
            kept = None
            if now is not None:
                kept = np.array([before[i][p] for i in which], object)
                lost = np.array([v is None for v in kept], bool)  # beyond a long: compared with all again
                if lost.any():
                    now_, kept_ = _rescan(part, book, p, now, kept, lost, exact)
                    codes[which, p], distances[which, p] = now_, kept_
                    _count(changes, dim, p, now, now_, part)
                    continue
                kept = kept if exact else kept.astype(np.int64)
            new, far = assign(part, book.entries[p], book.moved[p], now, kept, exact)
            codes[which, p], distances[which, p] = new, far
            _count(changes, dim, p, now, new, part)
    held = [[int(v) if v <= _LONG else None for v in row] for row in distances]
    return _record(rows, rows.column("embedding").type.value_type, [bytes(c) for c in codes.astype(np.uint8)], held, [], [])


def _rescan(part, book: Books, p: int, now, kept, lost, exact: bool):
    codes, far = now.copy(), kept.copy()
    codes[lost], far[lost] = assign(part[lost], book.entries[p], book.moved[p], None, None, exact)
    known = ~lost
    if known.any():
        codes[known], far[known] = assign(part[known], book.entries[p], book.moved[p], now[known], kept[known] if exact else kept[known].astype(np.int64), exact)
    return codes, far


def _count(changes: Changes, dim: int, p: int, old: np.ndarray | None, new: np.ndarray, x: np.ndarray) -> None:
    if old is None:
        changes.add(dim, p, new, x, 1)
        return
    other = old != new
    if other.any():
        changes.add(dim, p, old[other], x[other], -1)
        changes.add(dim, p, new[other], x[other], 1)


def _starts(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """The task's smallest ids of each vector length, each with its smallest vector; rows without an id come last."""
    best: dict[int, dict[tuple, list]] = {}
    for batch in batches:
        dims, ids = batch.column("dim").to_numpy(zero_copy_only=False), batch.column("vec_id")
        nameless, number = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        for dim in np.unique(dims):
            held = best.setdefault(int(dim), {})
            mine = np.flatnonzero((dims == dim) & ~nameless)
            low = np.unique(number[mine])[:entries]
            rows = [((False, int(number[i]), ()), i) for i in mine[number[mine] <= low[-1]]] if len(low) else []
            if len(held) + len(low) < entries or any(k[0] for k in held):
                rows += [((True, 0, tuple(batch.column("embedding")[int(i)].as_py())), i) for i in np.flatnonzero((dims == dim) & nameless)]
            last = max(held) if len(held) >= entries else None
            for name, i in rows:
                if last is None or name <= last:
                    vector = batch.column("embedding")[int(i)].as_py()
                    held[name] = min(held.get(name, vector), vector)
            for name in sorted(held)[entries:]:
                del held[name]
    rows = [(dim, *name[:2], v) for dim, held in best.items() for name, v in held.items()]
    yield pa.record_batch({
        "dim": pa.array([r[0] for r in rows], pa.int32()), "nameless": pa.array([r[1] for r in rows], pa.bool_()), "id": pa.array([r[2] for r in rows], pa.int64()),
        "embedding": pa.array([r[3] for r in rows], pa.list_(pa.float64())),
    })


def _cuts(dim: int, parts: int) -> list[int]:
    return [dim * i // parts for i in range(parts + 1)]


@dataclass
class Coded:
    """``rows``: vec_id, label, codes (one byte a part), error, dim. ``books``: the codebooks of each vector length."""

    rows: DataFrame
    books: dict[int, Books]


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Coded:
    """Codes of all vectors after ``rounds`` rounds and a last assignment."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number is one byte")
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType.elementType == T.FloatType()
    element, arrow = ("float", pa.float32()) if single else ("double", pa.float64())  # what a component is stored as; the arithmetic is double
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    rows = rows.where("embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))").withColumn("dim", F.size("embedding"))
    small = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "dim").mapInArrow(lambda b: _starts(b, entries), "dim int, nameless boolean, id long, embedding array<double>")
    small = settle(small, "code-starts")
    books = {r["dim"]: _first_books(small.where(F.col("dim") == r["dim"]), r["dim"], scale, parts, entries) for r in small.select("dim").distinct().collect()}
    schema = f"kind int, vec_id long, label string, embedding array<{element}>, dim int, codes binary, distances array<long>, key array<int>, value long"
    state = rows.withColumns({"codes": F.lit(None).cast("binary"), "distances": F.lit(None).cast("array<bigint>")})
    last = None
    for step in range(rounds + 1):
        shared = spark.sparkContext.broadcast({d: Books(b.cuts, b.entries, b.moved) for d, b in books.items()})
        new = settle(state.select(*ROW).mapInArrow(lambda b, s=shared: _round(b, s.value, scale, arrow), schema), "codes")
        shared.destroy()
        if last is not None:
            discard(last)
        last, state = new, new.where("kind = 0")
        if step < rounds:
            _move(books, new)
            if not any(k for b in books.values() for k in b.moved):
                break  # nothing moves any more: every further round would give the same
    error = F.when(F.forall("distances", lambda x: x.isNotNull()), F.aggregate("distances", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)")))
    coded = state.select("vec_id", "label", "dim", "codes", error.alias("__error"))
    return Coded(coded.select("vec_id", "label", "dim", "codes", F.when(F.col("__error") <= _LONG, F.col("__error")).cast("long").alias("error")), books)


def errors_by_label(rows: DataFrame) -> DataFrame:
    """The coded rows with ``label_error``, the error summed over equal labels (nulls together); null beyond a long."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    lost = F.max(F.col("error").isNull())
    sums = settle(rows.groupBy(F.col("label").alias("__label")).agg(F.when(~lost & (total <= _LONG), total).cast("long").alias("label_error")), "label-errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def _first_books(small: DataFrame, dim: int, scale: int, parts: int, entries: int) -> Books:
    named = small.where("not nameless").groupBy("id").agg(F.min("embedding").alias("embedding")).select(F.lit(False).alias("nameless"), "id", "embedding")
    others = small.where("nameless").select("nameless", "id", "embedding")
    first = named.unionAll(others).orderBy("nameless", "id", "embedding").limit(entries).collect()
    cuts = _cuts(dim, parts)
    whole = [[int(v) for v in integers(np.array(r["embedding"], float), scale)] for r in first]
    book = [[row[a:b] for row in whole] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    zero = [[[0] * (b - a) for _ in whole] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return Books(cuts, book, [list(range(len(whole))) for _ in book], zero, [[0] * len(whole) for _ in book])


def _move(books: dict[int, Books], state: DataFrame) -> None:
    """Adds the round's changes to the sums and moves the entries to the floors of their means."""
    changes = state.where("kind = 1").groupBy("key").agg(F.sum("value").alias("value")).collect()
    for r in changes:
        dim, p, k, c, limb = r["key"]
        if c < 0:
            books[dim].counts[p][k] += r["value"] << (LIMB * limb)
        else:
            books[dim].sums[p][k][c] += r["value"] << (LIMB * limb)
    for b in books.values():
        for p, part in enumerate(b.entries):
            new = [[s // n for s in total] if n else entry for entry, total, n in zip(part, b.sums[p], b.counts[p], strict=True)]
            b.moved[p] = [k for k, (x, y) in enumerate(zip(part, new, strict=True)) if x != y]
            b.entries[p] = new
