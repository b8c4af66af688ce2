"""Benchmark decontamination with SimHash over item-sized windows and multi-index Hamming blocks.

Words are lower-cased runs between white space without their ASCII punctuation. A window has as many
word shingles as the item it is held against, to within one in ``SPREAD`` (items of nearly one size share the windows
of the smallest); a row with fewer (three quarters at least) is one window.
Windows start every eighth of the item's length, and at the end of the row. Only a window that, with all that the step
leaves open around it, has ``THRESHOLD`` of the smallest item's shingles among those of the benchmark can hold a match;
the others end here.

A window that is left gets a 64-bit SimHash of its shingles: sums of 64 bit planes are differences of running
sums, so that a window costs the same at every size. Items are entered in four tables by 16-bit block of their
fingerprint, under every value within ``radius // 4`` flips, so that a window within ``radius`` bits of an item always meets it
in one of them. The fingerprint decides what is compared. A pair within the radius is dropped if the window and its surroundings
hold fewer than ``THRESHOLD`` of the item's own shingles, which no match can; what remains is compared exactly with windows of the
item's own size, at all offsets that the step leaves open: sum of minima by sum of maxima of the shingle counts,
``THRESHOLD`` or more. Matches found are thus exact.

The radius follows from the threshold at worst alignment. A match of similarity 0.75 has shingle vectors of cosine 2 * 0.75 / 1.75 =
0.86; the nearest window lies a sixteenth of a size off (times 0.94) and may be a twelfth shorter (times 0.96), so 0.77 is left: an
angle of 40 degrees, 14 of 64 bits on average, with a deviation of 3.3. ``RADIUS`` is 23, 2.7 deviations further; unlike
windows are 32 bits away, 4 a deviation. Neighbouring windows are further chances. ``radius=64`` lets every fingerprint through: an
exact search that loses nothing, at the cost of more comparisons.

Items are given to the tasks in blocks of ``BLOCK`` items, one pass over the documents for each, so that nothing
broadcast grows with the benchmark. Documents are only mapped, never shuffled.

Defined results: null or empty texts match nothing; null or empty items are left out; items of fewer than
``N`` words match as one run of words; repeated rows each give their matches; several items may match one
document, one row each with the best window (the first among equals); an empty benchmark leaves all documents. Columns
besides doc_id, text and item_id, text are not read by ``matches``; ``keep_clean`` hands all through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.llm.tables import pick_text
from riverframe.llm.textbuf import column_bytes, row_slices, shingles, split_words, without

N = 5
THRESHOLD = 0.75
RADIUS = 23
BLOCK = 1000
STEPS = 8
SPREAD = 12
CHUNK = 1 << 17

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _flips(radius: int) -> np.ndarray:
    """Masks of 16 bits that turn a block into every value near enough: of four blocks one has at most a quarter of the bits."""
    return np.array([sum(1 << b for b in c) for n in range(min(16, radius // 4) + 1) for c in combinations(range(16), n)], np.uint16)


def word_shingles(column: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, and where each row's begin."""
    raw, offsets = without(*column_bytes(pc.utf8_lower(column.fill_null(""))), _PUNCTUATION)
    code, _, first = shingles(split_words(raw, offsets), n)
    return code, first


def running_bits(code: np.ndarray, kind: type = np.uint8) -> np.ndarray:
    """Running sums of the 64 bits of the hashes, packed several to a word; one row more than hashes.

    Sums run modulo 2^64 over lanes of ``kind``. A lane of a difference is exact as long as the
    window has fewer hashes than the lane can count, whatever carries the sums themselves hold.
    """
    bits = np.unpackbits(np.ascontiguousarray(code).view(np.uint8).reshape(-1, 8), axis=1).astype(kind, copy=False).view(np.uint64)
    out = np.zeros((len(code) + 1, bits.shape[1]), np.uint64)
    np.cumsum(bits, axis=0, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of each window [start, end): a bit is set if most of its hashes have it."""
    kind = {8: np.uint8, 16: np.uint16, 32: np.uint32}[sums.shape[1]]
    ones = (sums.take(end, axis=0) - sums.take(start, axis=0)).view(kind)
    return np.packbits(ones > ((end - start) // 2).astype(kind)[:, None], axis=1).view(np.uint64).ravel()


@dataclass
class Size:
    """Items of nearly one number of shingles, ``n`` at least: their place, sizes and fingerprints."""

    n: int
    items: np.ndarray
    lengths: np.ndarray
    prints: np.ndarray

    def tables(self, radius: int = RADIUS) -> np.ndarray:
        flips = _flips(radius)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(self.items) <= 8 * np.dtype(t).itemsize)
        out = np.zeros((4, 1 << 16), kind)
        for i, value in enumerate(self.prints):
            for block, part in enumerate(np.array([value]).view(np.uint16)):
                out[block][part ^ flips] |= kind(1 << i)
        return out


@dataclass
class Searcher:
    """A block of items, ready for search. ``width`` is the number of words of a shingle."""

    width: int
    ids: list
    counts: list[tuple[np.ndarray, np.ndarray]]  # sorted shingles and how often, per item
    sizes: list[Size]
    known: np.ndarray  # all shingles of all items, sorted
    holds: np.ndarray  # which items hold a known shingle, from place to place
    place: np.ndarray
    radius: int = RADIUS

    def tables(self) -> list[np.ndarray]:
        return [size.tables(self.radius) for size in self.sizes]

    def shared(self, which: np.ndarray) -> np.ndarray:
        """For every item how many of these known shingles are its own."""
        n = self.place[which + 1] - self.place[which]
        at = np.repeat(self.place[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.holds[at], minlength=len(self.counts))


def searchers(ids: list, texts: list[str], n: int = N, radius: int = RADIUS) -> list[Searcher]:
    """One searcher per shingle width: ``n``, and fewer words for shorter items."""
    column = pa.array(texts, pa.string())
    one, first = word_shingles(column, 1)
    words = np.diff(first)
    out = []
    for width in sorted({int(min(w, n)) for w in words if w}):
        mine = np.flatnonzero(np.minimum(words, n) == width)
        code, first = word_shingles(column.take(pa.array(mine)), width)
        counts, prints = [], []
        for a, b in zip(first[:-1], first[1:], strict=True):
            counts.append(np.unique(code[a:b], return_counts=True))
            sums = running_bits(code[a:b], np.uint32)
            prints.append(fingerprints(sums, np.array([0]), np.array([b - a]))[0])
        length, prints = np.diff(first), np.array(prints, np.uint64)
        order, sizes = np.argsort(length, kind="stable"), []
        while len(order):
            n_least = int(length[order[0]])
            many = min(64, int(np.searchsorted(length[order], n_least + n_least // SPREAD, side="right")))
            at, order = order[:many], order[many:]
            sizes.append(Size(n_least, at, length[at], prints[at]))
        known = np.unique(code)
        at, item = np.searchsorted(known, np.concatenate([c for c, _ in counts])), np.repeat(np.arange(len(counts)), [len(c) for c, _ in counts])
        place = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(known)))])
        out.append(Searcher(width, [ids[i] for i in mine], counts, sizes, known, item[np.argsort(at, kind="stable")], place, radius))
    return out


def _windows(first: np.ndarray, n: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the windows of ``n`` shingles."""
    count = np.diff(first)
    made = np.where(count > n, 1 + -(-(count - n) // step), (count >= np.ceil(THRESHOLD * n)).astype(np.int64))
    row = np.repeat(np.arange(len(count)), made)
    k = np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
    start = first[row] + np.minimum(k * step, np.maximum(count[row] - n, 0))
    return row, start, np.minimum(start + n, first[row + 1])


def similarity(window: np.ndarray, codes: np.ndarray, often: np.ndarray) -> float:
    """Sum of minima by sum of maxima of two shingle multisets."""
    own, times = np.unique(window, return_counts=True)
    _, a, b = np.intersect1d(own, codes, assume_unique=True, return_indices=True)
    both = int(np.minimum(times[a], often[b]).sum())
    return both / (len(window) + int(often.sum()) - both)


def _clusters(start: np.ndarray, end: np.ndarray) -> Iterator[slice]:
    """Runs of windows that overlap, of at most about CHUNK shingles."""
    a = 0
    for k in range(1, len(start) + 1):
        if k == len(start) or start[k] >= end[k - 1] or end[k] - start[a] > CHUNK:
            yield slice(a, k)
            a = k


def search(searcher: Searcher, tables: list[np.ndarray], code: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word, words) of every row and item that match."""
    if not len(code):
        return
    at = np.minimum(np.searchsorted(searcher.known, code), len(searcher.known) - 1)
    is_known = searcher.known[at] == code
    known = np.concatenate([[0], np.cumsum(is_known)])
    which = at[is_known]  # known[p] of these lie before place p
    regions: dict[tuple[int, int], set[int]] = {}
    for size, table in zip(searcher.sizes, tables, strict=True):
        step = max(1, size.n // STEPS)
        row, start, end = _windows(first, size.n, step)
        widest = step + int(size.lengths.max()) - size.n
        left, right = known[np.maximum(start - widest, first[row])], known[np.minimum(end + widest, first[row + 1])]
        some = np.flatnonzero(right - left >= THRESHOLD * size.n)  # no other window can hold a match
        for part in _clusters(start[some], end[some]):
            at = some[part]
            sums = running_bits(code[start[at[0]] : end[at[-1]]], np.uint8 if size.n < 256 else np.uint32)
            prints = fingerprints(sums, start[at] - start[at[0]], end[at] - start[at[0]])
            blocks = prints.view(np.uint16).reshape(-1, 4)
            mask = table[0][blocks[:, 0]] | table[1][blocks[:, 1]] | table[2][blocks[:, 2]] | table[3][blocks[:, 3]]
            for w, fingerprint, bits in zip(at, prints, mask, strict=True):
                close = (bits >> np.arange(len(size.items)).astype(mask.dtype)) & mask.dtype.type(1) > 0
                close &= np.bitwise_count(size.prints ^ fingerprint) <= searcher.radius
                if close.any():
                    close &= searcher.shared(which[left[w] : right[w]])[size.items] >= THRESHOLD * size.lengths
                for i in np.flatnonzero(close):
                    n, item = int(size.lengths[i]), int(size.items[i])
                    reach = step + n - size.n
                    begin, limit = int(first[row[w]]), max(int(first[row[w]]), int(first[row[w] + 1]) - n)
                    regions.setdefault((int(row[w]), item), set()).update(range(max(begin, int(start[w]) - reach), min(limit, int(start[w]) + step) + 1))
    for (row, item), starts in sorted(regions.items()):
        codes, often = searcher.counts[item]
        n, best = int(often.sum()), (0.0, 0, 0)
        for s in sorted(starts):
            e = min(s + n, int(first[row + 1]))
            if known[e] - known[s] < THRESHOLD * n:
                continue
            found = similarity(code[s:e], codes, often)
            if found > best[0]:
                best = (found, s, e)
        if best[0] >= THRESHOLD:
            yield row, item, best[0], best[1] - int(first[row]), best[2] - best[1] + searcher.width - 1


def _matches(column: pa.Array, block: list[Searcher], tables: list[list[np.ndarray]]) -> Iterator[tuple[int, object, float, int, int]]:
    base = 0
    for part in row_slices(column):
        for searcher, table in zip(block, tables, strict=True):
            code, first = word_shingles(part, searcher.width)
            for row, item, *rest in search(searcher, table, code, first):
                yield base + row, searcher.ids[item], *rest
        base += len(part)


def _blocks(benchmark: DataFrame, radius: int) -> Iterator[list[Searcher]]:
    """Items in blocks of at most BLOCK, ordered by id; a block is all that the driver holds."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    count = items.count()
    parts = max(1, -(-count // BLOCK) * 2) if count > BLOCK else 1
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        block = searchers([r["item_id"] for r in rows], [r["text"] for r in rows], radius=radius)
        if block:
            yield block


def matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words of every document that holds a benchmark item."""
    schema = "doc_id long, item_id long, similarity double, first_word int, n_words int"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, radius):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables = [searcher.tables() for searcher in shared.value]
            for batch in batches:
                rows = list(_matches(batch.column("text"), shared.value, tables))
                cells = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.record_batch([batch.column("doc_id").take(pa.array(cells[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cells[1:], (pa.int64(), pa.float64(), pa.int32(), pa.int32()), strict=True))], names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        out = out.unionAll(pick_text(docs).mapInArrow(run, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Documents without any benchmark item, with their own columns."""
    schema = docs.schema
    for block in _blocks(benchmark, radius):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables = [searcher.tables() for searcher in shared.value]
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[m[0] for m in _matches(batch.column("text"), shared.value, tables)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs
