"""Count-only Viterbi segmentation over a unigram vocabulary.

An Aho-Corasick automaton reports, for every end position, the vocabulary pieces that end there, longest first.
Dynamic programming carries two numbers per position, the best score and the pieces on that path;
no segmentation is kept. Ties follow the public unigram tokenizers: a later candidate must be strictly better, and
candidates for one end come in order of their start, so the longest last piece wins; a character that is no piece by
itself may be taken as unknown for ``UNKNOWN_PENALTY`` below the lowest score, after all others, and counts as its
UTF-8 bytes (byte fallback).

Spaces become ``MARK`` and the text is led by one. No piece holds a mark after another character, nor a character that
no piece knows, so texts fall apart into words that are counted once and remembered, up to
``REMEMBERED`` words a task. Scores are multiples of 1/1024, which makes sums exact, whatever they are summed with.

The vocabulary file is a parameter. Where it has ranks and no probabilities, as the public one used here, a
piece of rank r scores ``-ln(r + 1)`` (Zipf's law), so the counts are those of that unigram model and not of the merges
that made the vocabulary.

Defined results: null and empty texts have 0 tokens; every other text has at least one, white space included;
repeated rows are counted one by one; null ids pass through; empty tables give empty results. Columns besides doc_id
and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from riverframe.llm.tables import pick_text

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 200_000
LONGEST_REMEMBERED = 48


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of a vocabulary file, most frequent first; control, unknown and byte pieces left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [(piece, -round(1024 * math.log(rank + 1)) / 1024) for rank, piece in enumerate(pieces)]


class Counter:
    """Counts the pieces of texts under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = frozenset(piece for piece, _ in vocabulary if len(piece) == 1)
        self.ring = max(len(piece) for piece, _ in vocabulary) + 1
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        known = frozenset("".join(piece for piece, _ in vocabulary))
        self.newline = "\n" not in known
        self.marked = not any(MARK in piece[1:] and piece.strip(MARK) for piece, _ in vocabulary)
        self.memory: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces on the best path through ``word``. Scores are kept for the longest piece's reach alone."""
        if len(word) <= LONGEST_REMEMBERED and self.single.issuperset(word):
            score, pieces = [0.0, *[-math.inf] * len(word)], [0] * (len(word) + 1)
            for i, (size, value) in self.automaton.iter(word):
                start = i + 1 - size
                value += score[start]
                if value > score[i + 1]:
                    score[i + 1], pieces[i + 1] = value, pieces[start] + 1
            return pieces[-1]
        ring = self.ring
        score, pieces = [0.0] * ring, [0] * ring
        matches = self.automaton.iter(word)
        at, found = next(matches, (len(word), None))
        for i, c in enumerate(word):
            best, count = -math.inf, 0
            while at == i:
                size, value = found
                start = (i + 1 - size) % ring
                value += score[start]
                if value > best:
                    best, count = value, pieces[start] + 1
                at, found = next(matches, (len(word), None))
            if c not in self.single:
                value = score[i % ring] + self.unknown
                if value > best:
                    best, count = value, pieces[i % ring] + len(c.encode("utf-8", "surrogatepass"))
            score[(i + 1) % ring], pieces[(i + 1) % ring] = best, count
        return pieces[len(word) % ring]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.marked:
            return self.word(MARK + text.replace(" ", MARK))
        if MARK in text:
            text = text.replace(MARK, " ")
        lines = text.split("\n") if self.newline else [text]
        total, memory, lead = len(lines) - 1, self.memory, True
        for line in lines:
            words = line.split(" ")
            # A run of spaces is one word of marks, as pieces may join them.
            if "" in words[1:-1] or not lead or words[0] == "" or words[-1] == "":
                words = _runs((MARK if lead else "") + line.replace(" ", MARK))
            else:
                words = [MARK + w for w in words]
            lead = False
            for w in words:
                n = memory.get(w)
                if n is None:
                    n = self.word(w)
                    if len(w) <= LONGEST_REMEMBERED:
                        if len(memory) >= REMEMBERED:
                            memory.clear()
                        memory[w] = n
                total += n
        return total


def _runs(text: str) -> list[str]:
    """Cuts before every mark that follows another character."""
    out, begin, at = [], 0, text.find(MARK, 1)
    while at > 0:
        if text[at - 1] != MARK:
            out.append(text[begin:at])
            begin = at
        at = text.find(MARK, at + 1)
    if begin < len(text):
        out.append(text[begin:])
    return out


def count(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens of every document."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary.value)
        for batch in batches:
            tokens = [counter.text(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(tokens, pa.int64())})

    return pick_text(docs).mapInArrow(run, "doc_id long, n_tokens long")
