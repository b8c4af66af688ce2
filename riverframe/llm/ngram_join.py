"""N-gram Jaccard self-join with PartEnum signatures.

A document's set holds its distinct word shingles (64-bit hashes). Two sets link when
``100 * intersection >= 75 * union``, which bounds their symmetric difference: ``d <= (a + b) / 7`` for
sizes a and b.

**Signatures.** Sizes are cut into bands that grow by 16/9, so that a set can only link within its band or
to the next one; it makes signatures for its own band and, if its size allows a partner there, for
the next. A band cuts the hash domain into equal ranges. A signature is the hash of a set's part inside one range.
A range without a difference gives both sets the same signature. With ``e`` non-empty ranges, linked
sets have at least ``e - d`` equal non-empty signatures; by the prefix argument it is enough that every
set enumerates its first ``d + 1`` in an order all sets share; with ``EXTRA`` more, linked sets meet in ``EXTRA + 1`` of them (in
``e - d`` if that is less), and pairs that meet in fewer need no test. That order puts signatures made only
of frequent shingles last, the most frequent at the end, so shared passages seldom become signatures; the order
decides cost, never results. With one range per shingle of the band's largest set, more than half of the signatures can
be left out that way. A set with no more than ``d`` non-empty ranges also enumerates the first
``m - ceil(0.75 m) + 1`` of its shingles: two such sets meet there.

**Cost.** Sets that are equal (128-bit digest) are one class and are joined through one representative.
Signatures travel as packed arrays, one row per batch and bucket, and buckets are numerous enough to hold
a bounded number of them. Classes that share a signature become a group; equal groups count
once. Only components are wanted, so most pairs need no test: first every class is
verified with the hub (the class that meets most others) that it shares most groups with. Groups that then still hold
several components are finished exactly: small ones pair by pair, large ones in blocks, members
outside the largest component against all, with sums over 0/1 matrices; no pairs are emitted there. Verifications read
the texts again and are exact; the work of a hub or a large group is spread over several tasks.

Defined results: null and empty texts and texts of white space have size 0 and link with nothing; fewer than
``N`` words make one shingle; repeated rows are copies and link; rows with one doc_id are one node with
several texts; rows with a null doc_id keep their size, link with nothing and have component null; empty tables
give empty results. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.llm.components import connected
from riverframe.llm.tables import pick_text
from riverframe.llm.textbuf import column_bytes, mix, row_slices, row_sums, shingles, split_words
from riverframe.operators.settle import settle

N = 5
PERCENT = 75
FREQUENT = 3  # a shingle of that many sets of one run of rows may be frequent
SURVEYED = 1 << 20  # shingles that are counted together
FREQUENT_KEPT = 500_000  # how many of the most frequent ones are told to the tasks; ordering only
PER_BUCKET = 300_000  # signatures of one bucket
PER_HUB = 500  # verifications of one class in one task
EXTRA = 5  # signatures beyond the first that linked sets must share
SMALL = 16  # groups up to this size are verified pair by pair, larger ones in blocks
ASKED, HELD = 256, 1024  # rows of a block
PACKED = 4 << 20  # bytes of text whose signatures are packed together
COMPARED = 1000  # texts unpacked at a time

_SEED = np.uint64(0xD6E8FEB86659FD93)
_PART, _WEAK = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC13FA9A902A6328F)


def bands(limit: int) -> np.ndarray:
    """Smallest sizes of the bands, up to one beyond ``limit``."""
    low = [1]
    while low[-1] <= limit * 2:
        low.append(max(low[-1] + 1, -(-low[-1] * 16 // 9)))
    return np.array(low + [max(low[-1] + 1, -(-low[-1] * 16 // 9))], np.int64)


def ranges(top: np.ndarray) -> np.ndarray:
    """Number of ranges of a band whose largest size is ``top``: about one shingle in each."""
    return top + 8


@dataclass
class Frequent:
    """Shingles that many documents share, sorted, and the power of two of how many do."""

    code: np.ndarray
    level: np.ndarray

    def of(self, code: np.ndarray) -> np.ndarray:
        if not len(self.code):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.level[at], 0)


@dataclass
class Sets:
    """Distinct shingles of each row in ascending order, and where each row's begin."""

    code: np.ndarray
    first: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.first)

    def pick(self, rows: np.ndarray) -> Sets:
        size = self.size[rows]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.first[rows] - first[:-1], size) + np.arange(first[-1])
        return Sets(self.code[at], first)


def shingle_sets(column: pa.Array, n: int = N) -> Sets:
    parts = [_shingle_sets(part, n) for part in row_slices(column)]
    if not parts:
        return Sets(np.zeros(0, np.uint64), np.zeros(1, np.int64))
    first = np.concatenate([[0], np.cumsum(np.concatenate([p.size for p in parts]))])
    return Sets(np.concatenate([p.code for p in parts]), first)


def _shingle_sets(column: pa.Array, n: int) -> Sets:
    raw, offsets = column_bytes(column)
    code, _, first = shingles(split_words(raw, offsets), n)
    for a, b in zip(first[:-1], first[1:], strict=True):
        code[a:b].sort()
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    new[first[:-1][first[:-1] < len(code)]] = True
    return Sets(code[new], np.concatenate([[0], np.cumsum(row_sums(new, first))]).astype(np.int64))


def digests(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set; 0 for the empty set."""
    out = []
    for seed in (_SEED, _SEED ^ _WEAK):
        total = np.zeros(len(sets.code) + 1, np.uint64)
        np.cumsum(mix(sets.code ^ seed), out=total[1:])
        out.append((total[sets.first[1:]] - total[sets.first[:-1]]).view(np.int64))
    return out[0], out[1]


def signatures(sets: Sets, frequent: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, row) of every set, and how many of them a set shares with any set it links with, at least.

    Signatures of ``frequent`` shingles alone go last, the most frequent at the end.
    """
    size = sets.size
    need = np.full(len(size), EXTRA + 1)
    if not len(sets.code):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), need
    low = bands(int(size.max()))
    band = np.searchsorted(low, size, side="right") - 1
    largest = size * 100 // PERCENT
    common = frequent.of(sets.code)
    codes, rows = [], []
    for step in (0, 1):
        chosen = np.flatnonzero((size > 0) & ((largest >= low[band + 1]) if step else True))
        if not len(chosen):
            continue
        part = sets.pick(chosen)
        level = band[chosen] + step
        top = low[level + 1] - 1
        many = ranges(top).astype(np.uint64)
        differ = (size[chosen] + np.minimum(largest[chosen], top)) * (100 - PERCENT) // (100 + PERCENT)
        row = np.repeat(np.arange(len(chosen)), part.size)
        cell = ((part.code >> np.uint64(32)) * many[row]) >> np.uint64(32)
        begin = np.ones(len(cell), bool)
        begin[1:] = (cell[1:] != cell[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(begin)
        value = np.add.reduceat(mix(part.code ^ _PART), start)
        of = row[start]
        sign = mix(value + mix(cell[start] * np.uint64(2654435761) + level[of].astype(np.uint64)))
        at = np.repeat(sets.first[chosen] - part.first[:-1], part.size) + np.arange(len(part.code))
        level_of = np.minimum.reduceat(common[at], start)
        first = np.searchsorted(of, np.arange(len(chosen) + 1))
        order = np.argsort((of << 6) | level_of, kind="stable")  # rows stay together
        keep = order[np.arange(len(of)) - first[of] <= differ[of] + EXTRA]
        need[chosen] = np.minimum(need[chosen], np.maximum(1, np.diff(first) - differ))
        codes.append(sign[keep]), rows.append(chosen[of[keep]])
        weak = np.flatnonzero(np.diff(first) <= differ)
        if len(weak):
            tail = part.pick(weak)
            prefix = tail.size - -(-tail.size * PERCENT // 100) + 1
            who = np.repeat(np.arange(len(weak)), tail.size)
            use = np.arange(len(tail.code)) - tail.first[who] < prefix[who]
            codes.append(mix(tail.code[use] ^ _WEAK)), rows.append(chosen[weak[who[use]]])
    return np.concatenate(codes), np.concatenate(rows), need


def _by_parts(sets: Sets, frequent: Frequent, limit: int = 400_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``signatures`` for runs of sets, so that the arrays in between stay small."""
    codes, rows, needs, a = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while a < len(sets.size):
        b = max(a + 1, int(np.searchsorted(sets.first, sets.first[a] + limit, side="right")) - 1)
        code, row, need = signatures(sets.pick(np.arange(a, b)), frequent)
        codes.append(code), rows.append(row + a), needs.append(need)
        a = b
    return np.concatenate(codes), np.concatenate(rows), np.concatenate(needs)


def _survey(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row per document (kind 0: id, size, digests) and per shingle frequent in a run of rows (kind 1)."""
    seen, codes, held = set(), [], 0
    for batch in batches:
        at = 0
        for part in row_slices(batch.column("text"), SURVEYED):
            sets = _shingle_sets(part, n)
            one, two = digests(sets)
            rows = len(one)
            yield pa.record_batch({"kind": pa.array(np.zeros(rows, np.int8)), "id": batch.column("doc_id").slice(at, rows), "size": pa.array(sets.size), "one": pa.array(one), "two": pa.array(two)})
            at += rows
            fresh = [i for i in np.unique(one, return_index=True)[1].tolist() if int(one[i]) not in seen]
            seen.update(one[fresh].tolist())
            codes.append(sets.pick(np.array(fresh, np.int64)).code)
            held += len(codes[-1])
            if held > SURVEYED:
                yield _often(codes)
                seen, codes, held = set(), [], 0
    if held:
        yield _often(codes)
    pa.default_memory_pool().release_unused()  # the worker lives on and takes other tasks


def _often(codes: list[np.ndarray]) -> pa.RecordBatch:
    """The shingles that at least ``FREQUENT`` of the sets have, with their counts."""
    code = np.concatenate(codes)
    codes.clear()
    code.sort()
    often = np.unique(code[FREQUENT - 1 :][code[FREQUENT - 1 :] == code[: len(code) - FREQUENT + 1]]) if len(code) >= FREQUENT else code[:0]
    count = np.searchsorted(code, often, side="right") - np.searchsorted(code, often)
    zero = pa.array(np.zeros(len(often), np.int64))
    return pa.record_batch({"kind": pa.array(np.ones(len(often), np.int8)), "id": pa.array(often.view(np.int64)), "size": pa.array(count.astype(np.int64)), "one": zero, "two": zero})


def _packed(batches: Iterator[pa.RecordBatch], n: int, frequent: Frequent, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket and batch: distinct sets' digests, and 32-bit signatures with their set's place."""
    for batch in batches:
        for part in (p.slice(lo, 1 << 15) for p in row_slices(batch.column("text"), PACKED) for lo in range(0, len(p), 1 << 15)):
            sets = shingle_sets(part, n)
            one, _ = digests(sets)
            rows = np.unique(one, return_index=True)[1]
            rows = rows[sets.size[rows] > 0]
            sign, row, need = _by_parts(sets.pick(rows), frequent)
            bucket = ((sign >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sign, row, bucket = sign[order], row[order], bucket[order]
            edge = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets + 1))
            out: dict[str, list] = {"bucket": [], "sets": [], "need": [], "sign": [], "place": []}
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                used, place = np.unique(row[a:b], return_inverse=True)
                out["bucket"].append(int(bucket[a]))
                out["sets"].append(one[rows[used]].tobytes())
                out["need"].append(need[used].astype(np.uint8).tobytes())
                out["sign"].append(sign[a:b].astype(np.uint32).tobytes())
                out["place"].append(place.astype(np.uint16).tobytes())
            yield pa.record_batch([pa.array(out["bucket"], pa.int64()), *(pa.array(out[c], pa.binary()) for c in ("sets", "need", "sign", "place"))], names=list(out))
    pa.default_memory_pool().release_unused()


def _groups(bucket: pa.Table) -> pa.Table:
    """Sets of one bucket that share signatures: (group, member, its need, how many signatures made the group)."""
    sign, member, need = [], [], []
    for sets, needs, signs, places in zip(*(bucket.column(c).to_pylist() for c in ("sets", "need", "sign", "place")), strict=True):
        place = np.frombuffer(places, np.uint16)
        sign.append(np.frombuffer(signs, np.uint32))
        member.append(np.frombuffer(sets, np.int64)[place])
        need.append(np.frombuffer(needs, np.uint8)[place])
    sign, member, need = np.concatenate(sign), np.concatenate(member), np.concatenate(need)
    ordered = np.sort(sign)
    shared = np.isin(sign, np.unique(ordered[1:][ordered[1:] == ordered[:-1]]))
    sign, member, need = sign[shared], member[shared], need[shared]
    order = np.lexsort((member, sign))
    sign, member, need = sign[order], member[order], need[order]
    new = np.ones(len(sign), bool)
    new[1:] = (sign[1:] != sign[:-1]) | (member[1:] != member[:-1])
    sign, member, need = sign[new], member[new], need[new]
    begin = np.ones(len(sign), bool)
    begin[1:] = sign[1:] != sign[:-1]
    start = np.flatnonzero(begin)
    count = np.diff(np.append(start, len(sign)))
    group = np.add.reduceat(mix(member.view(np.uint64)), start) if len(start) else np.zeros(0, np.uint64)
    _, first, at = np.unique(group, return_index=True, return_inverse=True)
    times = np.bincount(at, minlength=len(first)) if len(start) else np.zeros(0, np.int64)
    kept = np.zeros(len(start), np.int64)
    kept[first] = times
    use = np.repeat((kept > 0) & (count > 1), count)
    return pa.table({
        "gid": pa.array(np.repeat(group, count)[use].view(np.int64)), "one": pa.array(member[use]),
        "need": pa.array(need[use].astype(np.int32)), "k": pa.array(np.repeat(kept, count)[use]),
    })


def _shrunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames: they travel to a join, to a table and to their hubs."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array([pack((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())})


def _text_sets(column: pa.Array, n: int) -> Sets:
    """Shingle sets of texts that ``_shrunk`` has made."""
    unpack = zstandard.ZstdDecompressor().decompress
    return shingle_sets(pa.array([unpack(t) for t in column.to_pylist()], pa.binary()), n)


def _compare(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hub, salt and lead (hub first): the pairs that link."""
    hub, salt, known = None, None, []
    for whole in batches:
        for lo in range(0, whole.num_rows, COMPARED):
            batch = whole.slice(lo, COMPARED)
            sets = _text_sets(batch.column("text"), n)
            a, b = [], []
            for i, (h, s, lead, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("hub", "salt", "lead", "node")), strict=True)):
                own = sets.code[sets.first[i] : sets.first[i + 1]]
                if lead == 0:
                    if (h, s) != (hub, salt):
                        hub, salt, known = h, s, []
                    known.append(own.copy())
                elif (h, s) == (hub, salt):
                    for other in known:
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        if both and 100 * both >= PERCENT * (len(own) + len(other) - both):
                            a.append(node), b.append(h)
                            break
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    pa.default_memory_pool().release_unused()


def verify(pairs: DataFrame, texts: DataFrame, n: int = N) -> DataFrame:
    """The pairs (node, hub) of which some texts link, as edges (a, b)."""
    many = pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(PER_HUB)).cast("int").alias("salts"))
    spread = pairs.join(many, "hub").select("node", "hub", F.pmod(F.xxhash64("node"), F.col("salts").cast("long")).cast("int").alias("salt"), F.lit(1).alias("lead"))
    leads = many.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("lead"))
    rows = spread.unionAll(leads).join(texts, "node")
    return rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "lead").select("hub", "salt", "lead", "node", "text").mapInArrow(lambda b: _compare(b, n), "a long, b long")


def _with_hubs(members: DataFrame) -> DataFrame:
    """Add each group's size and its hub: the member that meets most others in all its groups."""
    sizes = members.groupBy("gid").agg(F.count("*").alias("g"))
    meets = members.join(sizes, "gid").groupBy("node").agg(F.sum(F.col("g") - 1).alias("meets"))
    hubs = members.join(meets, "node").groupBy("gid").agg(F.max_by(F.struct(F.col("node").alias("hub"), F.col("need").alias("hub_need")), F.struct("meets", -F.col("node"))).alias("h"), F.count("*").alias("g"))
    return members.join(hubs.select("gid", "g", "h.*"), "gid").withColumn("need", F.least("need", "hub_need")).drop("hub_need")


def _small_groups(left: DataFrame) -> DataFrame:
    """Pairs (node, hub) across components of groups of at most SMALL classes that may link.

    Their sizes must allow it, and they must share as many signatures as the one that needs fewer; a pair that shares a large
    group as well is tested there.
    """
    other = left.select("gid", F.col("node").alias("hub"), F.col("m").alias("hub_m"), F.col("part").alias("hub_part"), F.col("need").alias("hub_need"))
    fits = (F.col("part") != F.col("hub_part")) & (F.col("node") > F.col("hub")) & (F.lit(100) * F.least("m", "hub_m") >= F.lit(PERCENT) * F.greatest("m", "hub_m"))
    pairs = left.drop("hub").join(other, "gid").where(fits).groupBy("node", "hub")
    return pairs.agg(F.sum("k").alias("n"), F.min(F.least("need", "hub_need")).alias("need")).where("n >= need").select("node", "hub")


def _large_groups(left: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) across components of large groups.

    Groups with one hub are taken together, so that a family of near copies is met once. Members outside its
    largest component are held against all members, in blocks; a block gives back a spanning forest of the links.
    """
    family = left.select("hub", "node", "part").distinct()
    parts = family.groupBy("hub", "part").agg(F.count("*").alias("n"))
    main = parts.groupBy("hub").agg(F.max_by("part", F.struct("n", -F.col("part"))).alias("main"), F.max("n").alias("main_n"), F.sum("n").alias("n"))
    cuts = main.select("hub", "main", F.ceil((F.col("n") - F.col("main_n")) / ASKED).cast("int").alias("asks"), F.ceil(F.col("n") / HELD).cast("int").alias("holds")).where("asks > 0")
    family = family.join(cuts, "hub")
    own = lambda k: F.pmod(F.xxhash64("node"), F.col(k).cast("long")).cast("int")
    all_of = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    held = family.select("hub", "node", "part", all_of("asks").alias("ask"), own("holds").alias("hold"), F.lit(0).alias("role"))
    asked = family.where("part <> main").select("hub", "node", "part", own("asks").alias("ask"), all_of("holds").alias("hold"), F.lit(1).alias("role"))
    rows = held.unionAll(asked).join(texts, "node").select("hub", "ask", "hold", "role", "node", "part", "text")
    return rows.groupBy("hub", "ask", "hold").applyInArrow(lambda t: _block(t, n), "a long, b long")


def _block(rows: pa.Table, n: int) -> pa.Table:
    """Links across components between the asked (role 1) and the held members, as a spanning forest."""
    role, node, part = (rows.column(c).to_numpy() for c in ("role", "node", "part"))
    sets = _text_sets(rows.column("text"), n)
    ask, hold = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
    asked, held = sets.pick(ask), sets.pick(hold)
    codes, at = np.unique(asked.code, return_inverse=True)
    who = np.repeat(np.arange(len(ask)), asked.size)
    place = np.minimum(np.searchsorted(codes, held.code), max(len(codes) - 1, 0))
    known = codes[place] == held.code if len(codes) else np.zeros(0, bool)
    place, whom = place[known], np.repeat(np.arange(len(hold)), held.size)[known]
    both = np.zeros((len(ask), len(hold)), np.float32)
    for lo in range(0, len(codes), 2048):  # 0/1 matrices of some shingles at a time
        a, b = (at >= lo) & (at < lo + 2048), (place >= lo) & (place < lo + 2048)
        if not b.any():
            continue
        left, right = np.zeros((len(ask), 2048), np.float32), np.zeros((len(hold), 2048), np.float32)
        left[who[a], at[a] - lo] = 1
        right[whom[b], place[b] - lo] = 1
        both += left @ right.T
    union = asked.size[:, None] + held.size[None, :] - both
    i, j = np.nonzero((both > 0) & (100 * both >= PERCENT * union) & (part[ask][:, None] != part[hold][None, :]))
    a, b = node[ask[i]], node[hold[j]]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(part[ask[i]].tolist(), part[hold[j]].tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(k)
    return pa.table({"a": pa.array(a[kept], pa.int64()), "b": pa.array(b[kept], pa.int64())})


def components(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = docs.sparkSession
    source = pick_text(docs)
    survey = settle(source.mapInArrow(lambda b: _survey(b, n), "kind byte, id long, size long, one long, two long"), "shingle-survey")
    sizes = survey.where("kind = 0").select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "one", "two")
    linked = sizes.where("doc_id is not null and n_shingles > 0")
    classes = settle(linked.groupBy("n_shingles", "one", "two").agg(F.min("doc_id").alias("node")), "shingle-classes")
    often = survey.where("kind = 1").groupBy("id").agg(F.sum("size").alias("n")).orderBy(F.desc("n"), "id").limit(FREQUENT_KEPT).toArrow()
    code, order = np.unique(often.column("id").to_numpy().astype(np.int64).view(np.uint64), return_index=True)
    level = 1 + np.log2(np.maximum(often.column("n").to_numpy()[order], 1)).astype(np.int64)
    frequent = spark.sparkContext.broadcast(Frequent(code, level))
    del often
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(64, total // 2 // PER_BUCKET)
    packed = source.where("doc_id is not null").mapInArrow(lambda b: _packed(b, n, frequent.value, buckets), "bucket long, sets binary, need binary, sign binary, place binary")
    groups = packed.groupBy("bucket").applyInArrow(_groups, "gid long, one long, need int, k long").groupBy("gid", "one").agg(F.min("need").alias("need"), F.sum("k").alias("k"))
    members = settle(groups.join(classes.select("one", "node", F.col("n_shingles").alias("m")), "one").select("gid", "node", "m", "need", "k"), "shingle-groups")
    frequent.destroy()
    members = settle(_with_hubs(members), "shingle-groups")
    shared = members.where("node <> hub").groupBy("node", "hub").agg(F.sum("k").alias("n"), F.min("need").alias("need")).where("n >= need")
    nearest = settle(shared.groupBy("node").agg(F.min_by("hub", F.struct(-F.col("n"), F.col("hub"))).alias("hub")), "shingle-pairs")
    same = linked.join(classes, ["n_shingles", "one", "two"])  # every document with its representative
    wanted = members.select("node").distinct()
    # Both sides grow with the corpus: joined by sorting at every size.
    shrunk = source.where("doc_id is not null and text is not null").mapInArrow(_shrunk, "doc_id long, text binary")
    texts = settle(shrunk.join(wanted.hint("merge"), F.expr("doc_id = node")).select("node", "text"), "shingle-texts")
    copies = same.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    edges = settle(verify(nearest, texts, n), "shingle-edges")
    part = settle(connected(edges), "shingle-parts")
    placed = members.join(part, "node", "left").select("gid", "node", "m", "need", "k", "g", "hub", F.coalesce("component", "node").alias("part"))
    mixed = placed.groupBy("gid").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("gid")
    left = settle(placed.join(mixed, "gid"), "shingle-mixed")
    if not left.isEmpty():
        small = settle(_small_groups(left.where(F.col("g") <= SMALL)).join(nearest, ["node", "hub"], "left_anti"), "shingle-pairs")
        more = verify(small, texts, n).unionAll(_large_groups(left.where(F.col("g") > SMALL), texts, n))
        part = settle(connected(edges.unionAll(settle(more, "shingle-edges"))), "shingle-parts")
    return _labelled(sizes, same, copies, part)


def _labelled(sizes: DataFrame, same: DataFrame, copies: DataFrame, part: DataFrame) -> DataFrame:
    """Give every document its representative's component. An id with several texts joins their components."""
    repeated = same.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    if not repeated.isEmpty():
        part = connected(copies.unionAll(part.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        same = same.withColumn("node", F.col("doc_id"))
    roots = same.join(part, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    joined = sizes.select("doc_id", "n_shingles").join(roots, "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, n: int = N) -> DataFrame:
    """One document of each component (the smallest doc_id) with all its columns.

    Documents with a null id and documents without words stay; so do repeated rows of one id only once.
    """
    label = components(docs, n)
    key = F.col("doc_id").cast("long")
    stays = label.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n"))
    stays = settle(stays, "shingle-kept")
    # Both sides grow with the corpus: joined by sorting at every size.
    kept = docs.join(stays.where("__n = 1").hint("merge"), key == F.col("__id"), "left_semi").unionAll(docs.where(key.isNull()))
    repeated = stays.where("__n > 1")
    if repeated.isEmpty():
        return kept
    return kept.unionAll(docs.join(repeated, key == F.col("__id"), "left_semi").dropDuplicates(["doc_id"]))
