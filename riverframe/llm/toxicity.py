"""Toxicity by a weighted finite-state pattern grammar over clauses.

Three transducers are composed and run over the words of a clause that holds a cue:

1. the lexical transducer reads a word's first eight bytes and writes a symbol: insult, threat verb,
   target, negation, reporting verb, modal, or other;
2. the scope transducer reads symbols from left to right, keeps how far a negation reaches, whether speech is
   reported and whether a target was named, and writes one class for every cue: plain, targeted,
   negated or reported insult, or a complete threat (modal or first person, verb and target in one clause);
3. the weighing transducer maps the classes to learned weights; a document's score is the sigmoid of their
   sum over its clauses (counts enter as log(1 + n)).

Punctuation, spaces and symbols of all scripts separate words as the ASCII ones do (an apostrophe, too), quotation marks are
quotes and sentence marks end clauses; letters of alphabets other than the Latin one count as one byte each, and in scripts without
spaces every character starts a word.

Insult entries are prefixes of 4 to 8 bytes of the lower-cased word (the word's end counts as one
byte, so that a whole word is an entry too). They are learned from labelled texts: an entry must
explain toxic labels better than the base rate by a likelihood ratio that allows for the number of
candidates, counted over distinct contexts so that copies of one text count once. Entries that only
extend a chosen one are left out, and a prefix of a chosen one must earn its place on what remains. ``SEEDS``
join them unless the labels speak against them. At most ``SAMPLE`` labelled texts, chosen by hash of the
id, are learned from.

Defined results: null counts as empty; empty texts and texts without cues get the weight of no
clause; without training rows the seeds and prior weights score; rows are scored one by one, repeated ones alike; a
null id is held out and never learned from. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.llm.tables import fold, hash_share, pick_text
from riverframe.llm.textbuf import PIECE, column_bytes
from riverframe.operators.settle import settle

FOLDS = 4
CUT = 0.3
SAMPLE = 20_000
ENTRIES = 5_000
LENGTHS = (4, 5, 6, 7, 8)
CLASSES = ("plain", "targeted", "negated", "reported", "threat")
PRIOR = np.array([-3.0, 5.0, 6.0, 1.5, 2.0, 5.0])  # no clause, then CLASSES
REACH = 3

# Common words by role, English, German, French, Spanish.
SEEDS = "idiot moron imbecile stupid loser scum worthless pathetic disgusting bastard scumbag dumbass arschloch trottel connard gilipollas".split()
THREATS = "kill murder hurt stab shoot strangle destroy töten umbringen tuer frapper matar golpear".split()
MODALS = "will shall gonna i'll i we ich wir werde je nous vais yo voy vamos".split()
TARGETS = "you your yourself he she they them him her du dich euch ihr tu toi vous tú te ustedes usted él ella".split()
NEGATIONS = "not no never neither nor isn't aren't wasn't don't nicht kein keine nie pas jamais ni nunca".split()
REPORTS = "said says say called calls wrote writes told claimed claims quoted sagte sagt schrieb dit disait écrit dijo dice escribió".split()

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_MASK = {n: np.uint64((1 << (8 * n)) - 1) for n in LENGTHS}
_ENDS = frozenset(b".!?;\n")


def pack(word: bytes) -> int:
    """The first eight bytes of a word as one number, zero after its end."""
    return int.from_bytes(word[:8].ljust(8, b"\0"), "little")


# What a character does: 1 separates words, 2 ends a clause, 3 is a quotation mark, 4 vanishes, 5 stands in a script without spaces,
# 6 is a letter of another alphabet and travels as one byte.
_SINGLE = "\u2018\u2019\u201a\u201b\u02bc"
_ACTS = np.zeros(1 << 18, np.uint8)
for _c in range(128, 1 << 18):
    _kind = unicodedata.category(chr(_c))
    if _kind[0] in "PSZ" or _kind in ("Cc", "Cf") or chr(_c) in _SINGLE:
        _ACTS[_c] = 2 if chr(_c) in "…‥‼⁇⁈⁉。！？；｡؟؛۔।॥\u037e\u2028\u2029\x85" else 3 if _kind in ("Pi", "Pf") and chr(_c) not in _SINGLE + "‹›" or chr(_c) in "„‟＂「」『』" else 4 if chr(_c) in "\u00ad\u200c\u200d" else 1
    elif _kind[0] == "L" and 0x370 <= _c < 0x800:
        _ACTS[_c] = 6
for _a, _b in ((0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3040, 0x3100), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x40000)):
    _ACTS[_a:_b][_ACTS[_a:_b] == 0] = 5


def _plain(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets with the marks of all scripts as ASCII ones, and where characters of unspaced scripts begin."""
    at = np.flatnonzero(raw >= 0xC2)
    alone = np.zeros(len(raw), bool)
    if not len(at):
        return raw, offsets, alone
    raw = raw.copy()
    size = np.where(raw[at] < 0xE0, 2, np.where(raw[at] < 0xF0, 3, 4))
    code = raw[at].astype(np.int32) & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        code[more] = code[more] << 6 | (raw[at[more] + k] & 0x3F)
    act = _ACTS[np.minimum(code, len(_ACTS) - 1)]
    drop = np.zeros(len(raw), bool)
    for kind, byte in ((1, 32), (2, 46), (3, 34), (4, 32), (6, None)):
        here = act == kind
        raw[at[here]] = (code[here] & 0x7F) | 0x80 if byte is None else byte
        drop[at[here]] = kind == 4
        for k in range(1, 4):
            drop[at[here & (size > k)] + k] = True
    here = act == 5
    alone[at[here]] = True
    after = at[here] + size[here]
    alone[after[after < len(raw)]] = True
    before = np.concatenate([[0], np.cumsum(~drop)])
    return raw[~drop], before[offsets], alone[~drop]


def _runs(raw: np.ndarray, offsets: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and packed heads of all runs of letters; a row's end ends a run.

    In a script without spaces every character starts a word, whose head reads on to the end of the run.
    """
    letter = _LETTER[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    begin, stop = letter & cut[:-1], letter & cut[1:]
    begin[1:] |= letter[1:] & ~letter[:-1]
    stop[:-1] |= letter[:-1] & ~letter[1:]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    if alone.any():
        first, last = start, end
        begin |= alone & letter
        start = np.flatnonzero(begin)
        run = np.searchsorted(first, start, side="right") - 1
        size = last[run] - start
        end = np.minimum(np.append(start[1:], len(raw)), last[run])
    else:
        size = end - start
    head = np.zeros(len(start), np.uint64)
    for k in range(8):
        longer = np.flatnonzero(size > k) if k else slice(None)
        head[longer] |= raw[start[longer] + k].astype(np.uint64) << np.uint64(8 * k)
    return start, end, head


def _spans(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about PIECE bytes; one longer row makes its own run."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1)
        yield a, b
        a = b


@dataclass
class Grammar:
    entries: dict[int, frozenset[int]] = field(default_factory=dict)  # prefix length to packed prefixes
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def symbol(self, head: int) -> str:
        if any(head & ((1 << (8 * n)) - 1) in found for n, found in self.entries.items()):
            return "I"
        return _ROLES.get(head, "o")


_ROLES: dict[int, str] = {}
for _words, _symbol in ((MODALS, "M"), (TARGETS, "T"), (NEGATIONS, "N"), (REPORTS, "R"), (THREATS, "H")):
    for _word in _words:
        for _part in (_word, _word.split("'")[0]) if "'" not in _word or _symbol != "N" else (_word.split("'")[0],):
            _ROLES[pack(_part.encode())] = _symbol


def clause_classes(symbols: list[str], quoted: bool) -> list[int]:
    """Run the scope transducer over one clause: one class index for every cue."""
    target = "T" in symbols
    modal = "M" in symbols
    reach, reported, out = 0, quoted, []
    for s in symbols:
        if s == "N":
            reach = REACH + 1
        elif s == "R":
            reported = True
        elif s == "I":
            out.append(3 if reported else 2 if reach else 1 if target else 0)
        elif s == "H" and target and modal:
            out.append(3 if reported else 2 if reach else 4)
        reach = max(0, reach - 1)
    return out


def _lookup(grammar: Grammar) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
    """Which four leading bytes can begin a cue, the entries by length, and the threat verbs."""
    threats = np.array(sorted(h for h, s in _ROLES.items() if s == "H"), np.uint64)
    tables = {n: np.array(sorted(found), np.uint64) for n, found in grammar.entries.items() if found}
    first = np.zeros(1 << 16, bool)
    for values in (*tables.values(), threats):
        first[_first_slot(values)] = True
    return first, tables, threats


def _first_slot(head: np.ndarray) -> np.ndarray:
    return ((head & _MASK[4]).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(16)


def class_counts(grammar: Grammar, column: pa.Array) -> np.ndarray:
    """Cues of each class in every text (rows x CLASSES)."""
    out = np.zeros((len(column), len(CLASSES)))
    raw_all, offsets_all = column_bytes(pc.utf8_lower(column.fill_null("")))
    first, tables, threats = _lookup(grammar)
    for a, b in _spans(offsets_all):
        offsets = offsets_all[a : b + 1] - offsets_all[a]
        raw, offsets, alone = _plain(raw_all[offsets_all[a] : offsets_all[b]], offsets)
        start, end, head = _runs(raw, offsets, alone)
        maybe = np.flatnonzero(first[_first_slot(head)])
        hit = np.isin(head[maybe], threats)
        for n, values in tables.items():
            hit |= np.isin(head[maybe] & _MASK[n], values)
        done = -1
        for w in maybe[hit]:
            if w <= done:
                continue
            row = int(np.searchsorted(offsets, start[w], side="right")) - 1
            lo, hi = _clause(raw, start, end, int(w), int(offsets[row]), int(offsets[row + 1]))
            done = hi - 1
            symbols = [grammar.symbol(int(h)) for h in head[lo:hi]]
            quotes = int(np.count_nonzero(raw[end[lo] : start[w]] == 34)) if lo < w else 0
            for k in clause_classes(symbols, quotes % 2 == 1 and "R" in symbols):
                out[a + row, k] += 1
    return out


def _clause(raw: np.ndarray, start: np.ndarray, end: np.ndarray, w: int, row_start: int, row_end: int) -> tuple[int, int]:
    """Index range of the words of the clause around word ``w``."""
    lo = w
    while lo > 0 and start[lo - 1] >= row_start and not _ENDS.intersection(raw[end[lo - 1] : start[lo]].tobytes()):
        lo -= 1
    hi = w + 1
    while hi < len(start) and end[hi] <= row_end and not _ENDS.intersection(raw[end[hi - 1] : start[hi]].tobytes()):
        hi += 1
    return lo, hi


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def probability(grammar: Grammar, counts: np.ndarray) -> np.ndarray:
    return _sigmoid(grammar.weights[0] + np.log1p(counts) @ grammar.weights[1:])


def _heads(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, heads, context codes) of every text."""
    raw_all, offsets_all = column_bytes(pc.utf8_lower(column.fill_null("")))
    for a, b in _spans(offsets_all):
        offsets = offsets_all[a : b + 1] - offsets_all[a]
        raw, offsets, alone = _plain(raw_all[offsets_all[a] : offsets_all[b]], offsets)
        start, _, head = _runs(raw, offsets, alone)
        first = np.searchsorted(start, offsets)
        for i in range(b - a):
            h = head[first[i] : first[i + 1]]
            around = np.zeros(len(h) + 2, np.uint64)
            around[1:-1] = h
            yield a + i, h, (around[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (around[2:] * np.uint64(0xC2B2AE3D27D4EB4F))


def _stems(head: np.ndarray) -> np.ndarray:
    """Distinct (length << 64) free pairs: rows of (prefix, length) as structured values."""
    parts = []
    for n in LENGTHS:
        cut = head & _MASK[n]
        long = (head >> np.uint64(8 * (n - 2))) & np.uint64(255) > 0  # n - 1 letters at least; the last byte may be the end
        parts.append(np.stack([cut[long], np.full(int(long.sum()), n, np.uint64)], axis=1))
    return np.unique(np.concatenate(parts), axis=0) if parts else np.zeros((0, 2), np.uint64)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold each stem, summed over a batch."""
    for batch in batches:
        label = batch.column("y").to_numpy(zero_copy_only=False)
        stems, rows = [], []
        for row, head, _ in _heads(batch.column("text")):
            found = _stems(np.unique(head))
            stems.append(found), rows.append(np.full(len(found), label[row]))
        if not stems:
            continue
        every, at = np.unique(np.concatenate(stems), axis=0, return_inverse=True)
        y = np.concatenate(rows)
        toxic = np.bincount(at.ravel(), y, len(every)).astype(np.int64)
        total = np.bincount(at.ravel(), minlength=len(every))
        yield pa.record_batch({"stem": pa.array(every[:, 0].view(np.int64)), "size": pa.array(every[:, 1].astype(np.int32)), "toxic": pa.array(toxic), "clean": pa.array(total - toxic)})


def _gain(toxic: np.ndarray, clean: np.ndarray, base: float) -> np.ndarray:
    """Log-likelihood ratio of a stem's own toxic share against the base rate."""
    toxic, clean = np.maximum(np.asarray(toxic, float), 0), np.maximum(np.asarray(clean, float), 0)
    n = np.maximum(toxic + clean, 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(toxic > 0, toxic * np.log(toxic / (n * base)), 0)
        b = np.where(clean > 0, clean * np.log(clean / (n * (1 - base))), 0)
    return np.where(toxic / n > base, a + b, 0)


def choose_entries(found: pd.DataFrame, base: float, candidates: int) -> dict[int, frozenset[int]]:
    """Greedy choice of stems by gain; ``found`` has stem, size, toxic, clean."""
    level = np.log(max(candidates, 1)) + 5
    rows = [[int(np.uint64(np.int64(r.stem))), int(r.size_), float(r.toxic), float(r.clean)] for r in found.rename(columns={"size": "size_"}).itertuples()]
    ended = lambda r: r[0] >> (8 * (r[1] - 1)) & 255 == 0
    chosen: list[list] = []
    while rows:
        gains = _gain([r[2] for r in rows], [r[3] for r in rows], base)
        live = [(g, r) for g, r in zip(gains, rows, strict=True) if g > level and r[2] > r[3]]
        if not live:
            break
        _, best = max(live, key=lambda x: (x[0], not ended(x[1]), x[1][1], -x[1][0]))
        chosen.append(best)
        rest = []
        for _, r in live:
            n = min(r[1], best[1])
            if r[0] & ((1 << (8 * n)) - 1) == best[0] & ((1 << (8 * n)) - 1):
                if r[1] >= best[1]:
                    continue  # the same or an extension of it
                r = [r[0], r[1], r[2] - best[2], r[3] - best[3]]
            rest.append(r)
        rows = rest
    return {n: frozenset(r[0] for r in chosen if r[1] == n) for n in LENGTHS}


def _fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Newton steps of a logistic regression drawn towards PRIOR."""
    a, w = np.column_stack([np.ones(len(x)), np.log1p(x)]), PRIOR.copy()
    for _ in range(50):
        p = _sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * (w - PRIOR))
        w = w + np.clip(step, -2, 2)
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Learn entries and weights from labelled documents outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .where(fold(F.col("doc_id"), FOLDS) != 2)
        .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
    )
    count = known.count()
    if count > sample:
        known = known.where(hash_share("doc_id") < sample / count)
    seeds = {n: frozenset(pack(w.encode()[:n]) for w in SEEDS if min(len(w.encode()), 8) == n) for n in LENGTHS}
    if not count:
        return Grammar(seeds)
    # At most about ``sample`` ids and labels: 16 bytes each.
    texts = settle(pick_text(docs).join(F.broadcast(known), "doc_id").select("text", "y"), "toxic-sample")
    n, toxic = texts.agg(F.count("*"), F.sum("y")).first()
    if not n or not toxic or toxic == n:
        return Grammar(seeds)
    base = toxic / n
    stems = texts.mapInArrow(_document_counts, "stem long, size int, toxic long, clean long").groupBy("stem", "size").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    candidates = stems.count()
    level = (np.log(max(candidates, 1)) + 5) / -np.log(base)
    strong = stems.where((F.col("toxic") >= F.lit(float(level)) * 0.5) & (F.col("toxic") > F.col("clean"))).orderBy(F.desc("toxic"), "clean", "size", "stem").limit(ENTRIES).toPandas()
    grammar = Grammar({k: seeds[k] | v for k, v in choose_entries(_by_context(texts, strong), base, candidates).items()})
    against = {(int(np.uint64(np.int64(r["stem"]))), r["size"]) for r in stems.where("clean > toxic").where(F.col("stem").isin([int(np.int64(np.uint64(s))) for v in seeds.values() for s in v])).collect()}
    grammar.entries = {k: frozenset(s for s in v if (s, k) not in against) for k, v in grammar.entries.items()}
    rows = _sample_counts(texts, grammar)
    grammar.weights = _fit_weights(rows[list(CLASSES)].to_numpy(float), rows["y"].to_numpy(float))
    return grammar


def _by_context(texts: DataFrame, strong: pd.DataFrame) -> pd.DataFrame:
    """Replace the toxic document counts of the candidates by counts of distinct contexts."""
    if strong.empty:
        return strong
    wanted = {n: np.sort(strong.loc[strong["size"] == n, "stem"].to_numpy(np.int64).view(np.uint64)) for n in LENGTHS}
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, head, around in _heads(batch.column("text")):
                for n, values in shared.value.items():
                    cut = head & _MASK[n]
                    at = np.flatnonzero(np.isin(cut, values))
                    if len(at):
                        yield pa.record_batch({"stem": pa.array(cut[at].view(np.int64)), "size": pa.array(np.full(len(at), n, np.int32)), "around": pa.array(around[at].view(np.int64))})

    seen = texts.where("y = 1").mapInArrow(run, "stem long, size int, around long").distinct().groupBy("stem", "size").agg(F.count("*").alias("contexts")).toPandas()
    out = strong.merge(seen, on=["stem", "size"], how="left")
    out["toxic"] = np.minimum(out["toxic"], out["contexts"].fillna(0))
    return out[["stem", "size", "toxic", "clean"]]


def _sample_counts(texts: DataFrame, grammar: Grammar) -> pd.DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = class_counts(shared.value, batch.column("text"))
            yield pa.record_batch({"y": batch.column("y"), **{c: pa.array(counts[:, k]) for k, c in enumerate(CLASSES)}})

    return texts.mapInArrow(run, "y int, " + ", ".join(f"{c} double" for c in CLASSES)).toPandas()


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of cues of each class."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = class_counts(shared.value, batch.column("text"))
            p = probability(shared.value, counts)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(p), "predicted": pa.array((p >= CUT).astype(np.int32)),
                **{c: pa.array(counts[:, k].astype(np.int32)) for k, c in enumerate(CLASSES)},
            })

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == 2, F.lit(True)).alias("held_out")
    schema = "doc_id long, held_out boolean, score double, predicted int, " + ", ".join(f"{c} int" for c in CLASSES)
    return pick_text(docs).select("doc_id", "text", held).mapInArrow(run, schema)


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on labelled documents that are not held out, then score all documents."""
    return score(docs, train(docs, labels))
