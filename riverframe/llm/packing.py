"""Vector best-fit packing of tokenised documents into sequences.

``cut`` turns every text into token ids, ends it with ``END`` and cuts only what is longer than a sequence: the last
pieces are full, the first one has the rest. ``pack`` gives every piece a sequence and a place in it. A sequence has three
capacities, tokens, documents and attention cost (the sum of squared lengths), and no piece is put where one of them would
be passed.

Pieces of one length are alike, so the plan is made on the histogram of lengths (at most ``tokens`` rows, however
many documents there are). Lengths come in falling order. Sequences in the same state are one class with a count; a
length takes the feasible class that fits best and fills as many of its sequences as it has pieces, which splits the class in two
at most. ``dot`` fits by the smallest weighted dot product of what is left with what the piece takes, ``norm`` by the
smallest weighted norm of what would be left; both are planned and the one with fewer sequences is used. The numbers of classes
and steps depend on the number of lengths and not on that of documents.

Every task numbers its own pieces per length; the counts per task and length, summed up, turn that into a place
among all pieces of the length, and the place selects the step of the plan, hence sequence and offset. No length, however
frequent, meets in one task.

The ids are those that ``tokenizers`` gives for the file at ``path``. Where the file's ids rise with its merges, as in the public
one, they come from ``tiktoken`` with the same vocabulary, which is four times as fast (equal on every code point, see the tests).

Defined results: null and empty texts are the one id ``END``; null and repeated ids and repeated rows are packed like any
other; texts of any length are read whole; strings that look like special tokens are ordinary text; an empty table
gives an empty result. ``cut`` reads doc_id and text alone; ``pack`` passes all columns of the pieces on but ``sequence_id`` and
``offset``, which it replaces. A piece that no empty sequence can take is an error.
"""

from __future__ import annotations

import json
import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from riverframe.llm.tables import pick_text
from riverframe.llm.textbuf import row_slices
from riverframe.operators.settle import settle

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKENS = 2048
END = 0
WEIGHTS = (1.0, 1.0, 1.0)
PIECES = "doc_id long, piece int, start long, length long, tokens binary"


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, definition: str) -> None:
        model = json.loads(definition)["model"]
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        ids = model["vocab"]
        # Where ids rise with the merges, a merge's id is its rank, and the faster of the two public libraries gives the same ids.
        self.ranked = all(ids[m] == 256 + i for i, m in enumerate(joined))
        if self.ranked:
            raw = {bytes(_BYTE_OF[c] for c in m): ids[m] for m in [*_BYTE_OF, *joined]}
            self.encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=raw, special_tokens={})
        else:
            self.tokenizer = Tokenizer.from_str(definition)
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked:
            return [array("I", self.encoding.encode_ordinary(t)).tobytes() for t in texts]
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _visible_bytes() -> dict[str, int]:
    """The character by which files of byte-level vocabularies write each byte: itself where it prints, else 256 and up."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in prints)
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


_BYTE_OF = _visible_bytes()


def cut(docs: DataFrame, tokens: int = TOKENS, path: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, tokens (little-endian unsigned 32-bit ids) of every piece of every document."""
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    end = array("I", [END]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(definition.value)
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            for texts in row_slices(batch.column("text")):
                rows, number, start, length, data = [], [], [], [], []
                for i, code in enumerate(encoder.encode([t or "" for t in texts.to_pylist()]), at):
                    code += end
                    n = len(code) // 4
                    first = (n - 1) % tokens + 1
                    for k, a in enumerate([0, *range(first, n, tokens)]):
                        b = first if k == 0 else a + tokens
                        rows.append(i), number.append(k), start.append(a), length.append(b - a), data.append(code[4 * a : 4 * b])
                at += len(texts)
                yield pa.record_batch({
                    "doc_id": ids.take(pa.array(rows, pa.int64())), "piece": pa.array(number, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "tokens": pa.array(data, pa.binary()),
                })

    return pick_text(docs).mapInArrow(run, PIECES)


@dataclass
class Plan:
    """Step i places the pieces of ``length[i]`` numbered from ``rank[i]`` on: one each in the sequences from ``sequence[i]`` on."""

    sequences: int
    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def plan(counts: dict[int, int], tokens: int = TOKENS, documents: int | None = None, attention: int | None = None, weights=WEIGHTS, fit: str = "norm") -> Plan:
    """Best-fit of the histogram ``counts`` (pieces by length) under the three capacities."""
    caps = np.array([tokens, documents or tokens, attention or tokens * tokens], np.int64)
    scale = np.array(weights, float)
    # One row per class: what is left of each capacity; and its sequences [first, last).
    left, first, last = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    steps, made = [], 0
    for length in sorted(counts, reverse=True):
        takes, waiting, rank = np.array([length, 1, length * length], np.int64), counts[length], 0
        if (takes > caps).any() or length < 1:
            raise ValueError(f"a piece of {length} tokens fits in no sequence")
        while waiting:
            able = np.flatnonzero((left >= takes).all(1))
            if len(able):
                rest = left[able] / caps
                if fit == "norm":
                    cost = (scale * (rest - takes / caps) ** 2).sum(1)
                elif fit == "dot":
                    cost = (scale * rest * (takes / caps)).sum(1)
                else:
                    raise ValueError(f"unknown fit {fit!r}")
                k = able[cost.argmin()]
                n = min(waiting, int(last[k] - first[k]))
            else:
                # New sequences, each with as many pieces of this length as the later steps give it.
                each = int((caps // takes).min())
                n, k = -(-waiting // each), len(left)
                left, first, last = np.vstack([left, caps]), np.append(first, made), np.append(last, made + n)
                made += n
            steps.append((length, rank, first[k], tokens - left[k, 0]))
            rank, waiting = rank + n, waiting - n
            if n < last[k] - first[k]:
                left, first, last = np.vstack([left, left[k]]), np.append(first, first[k] + n), np.append(last, last[k])
                last[k] = first[k] + n
            left[k] = left[k] - takes
        # A class that the shortest length left cannot use is done.
        shorter = [x for x in counts if x < length]
        if shorter:
            low = min(shorter)
            open_ = (left >= np.array([low, 1, low * low])).all(1)
            left, first, last = left[open_], first[open_], last[open_]
    table = np.array(steps, np.int64).reshape(-1, 4)
    return Plan(made, *table.T)


def _numbered(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[pa.RecordBatch]:
    """Adds the number of the task and the place of each piece among the task's pieces of its length."""
    task, seen = TaskContext.get().partitionId(), np.zeros(tokens + 2, np.int64)
    for batch in batches:
        raw = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        length = np.where((raw < 1) | (raw > tokens), tokens + 1, raw)  # an error once the histogram is read
        order = np.argsort(length, kind="stable")
        n = np.bincount(length, minlength=tokens + 2)
        begin = np.cumsum(n) - n
        rank = np.empty(len(length), np.int64)
        rank[order] = np.arange(len(length)) - begin[length[order]]
        rank += seen[length]
        seen += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(rank)], [*batch.schema.names, "__task", "__rank"])


def _placed(batches: Iterator[pa.RecordBatch], steps: Plan, base: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts = base[steps.length] + steps.rank
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "__rank"))
        at = order[np.searchsorted(starts, base[length] + rank, side="right") - 1]
        sequence = steps.sequence[at] + rank - steps.rank[at]
        kept = [c for c in batch.schema.names if c != "__rank"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sequence), pa.array(steps.offset[at])], [*kept, "sequence_id", "offset"])


def pack(pieces: DataFrame, tokens: int = TOKENS, documents: int | None = None, attention: int | None = None, weights=WEIGHTS) -> DataFrame:
    """The pieces (any columns, ``length`` among them) with ``sequence_id`` and the gapless ``offset`` in that sequence.

    Without a number, the capacities for documents and attention are those that ``tokens`` implies.
    """
    spark = pieces.sparkSession
    rows = pieces.drop("sequence_id", "offset").withColumn("length", F.col("length").cast("long"))
    schema = T.StructType([*rows.schema.fields, T.StructField("__task", T.IntegerType()), T.StructField("__rank", T.LongType())])
    numbered = settle(rows.mapInArrow(lambda b: _numbered(b, tokens), schema), "pieces")
    counts = settle(numbered.groupBy("length", "__task").agg(F.count("*").alias("__n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    plans = [plan(histogram, tokens, documents, attention, weights, fit) for fit in ("norm", "dot")]
    best = min(plans, key=lambda p: p.sequences)
    base = np.zeros(tokens + 2, np.int64)
    base[1:] = np.cumsum([histogram.get(i, 0) for i in range(tokens + 1)])
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = settle(counts.select(F.col("length").alias("__length"), F.col("__task").alias("__of"), F.coalesce(before, F.lit(0)).alias("__before")), "piece-offsets")
    joined = numbered.join(offsets, (F.col("length") == F.col("__length")) & (F.col("__task") == F.col("__of")))
    ranked = joined.select(*rows.columns, (F.col("__rank") + F.col("__before")).alias("__rank"))
    shared = spark.sparkContext.broadcast((best, base))
    out = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(lambda b: _placed(b, *shared.value), out)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, tokens (all ids of the sequence, little-endian), doc_ids and offsets, in the order of the sequence."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "tokens")))
    held = packed.groupBy("sequence_id").agg(inside.alias("x"))
    return held.select("sequence_id", F.expr("aggregate(x, X'', (a, b) -> concat(a, b.tokens))").alias("tokens"), F.col("x.doc_id").alias("doc_ids"), F.col("x.offset").alias("offsets"))


def max_piece(tokens: int = TOKENS, attention: int | None = None) -> int:
    """The longest piece that an empty sequence takes: what to cut to."""
    return tokens if attention is None else min(tokens, math.isqrt(attention))
