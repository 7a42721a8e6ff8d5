"""Token counts with a linear longest-match automaton.

Greedy word-piece splitting always takes the longest vocabulary piece that
starts the rest of the word. A trie of the vocabulary gets, at every node, a
failure link and the number of pieces popped on following it, so a word is
counted in one pass over its bytes without building a piece.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import text_batches

#: Ends a word in the vocabulary file.
END_MARK = "</w>"
END = 256
CACHE_RUNS = 300_000

#: Fixed value: the word pattern that goes with the vocabulary.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def vocabulary_pieces(path: str) -> list[tuple[int, ...]]:
    """Pieces as bytes, those that end a word with END after them."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    symbols, pieces = byte_symbols(), []
    for piece in vocabulary:
        stem = piece.removesuffix(END_MARK) if piece != END_MARK else piece
        if stem and all(c in symbols for c in stem):
            pieces.append(tuple(symbols[c] for c in stem) + ((END,) if stem != piece else ()))
    return pieces


class Automaton:
    """Counts greedy pieces; a word that the vocabulary cannot spell counts as one unknown."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.step: dict[int, int] = {}
        self.final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                node = self.step.setdefault(node << 9 | c, len(self.final))
                if node == len(self.final):
                    self.final.append(False)
            self.final[node] = True
        n = len(self.final)
        self.fail, self.pops = [-1] * n, [0] * n
        children: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for key, node in self.step.items():
            children[key >> 9].append((key & 511, node))
        layer = [0]
        while layer:
            below = []
            for parent in layer:
                for c, node in children[parent]:
                    below.append(node)
                    if self.final[node]:
                        self.fail[node], self.pops[node] = 0, 1
                        continue
                    z, popped = self.fail[parent], self.pops[parent]
                    while z >= 0 and z << 9 | c not in self.step:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[node], self.pops[node] = self.step[z << 9 | c], popped
            layer = below

    def count(self, word: bytes) -> int:
        step, fail, pops = self.step, self.fail, self.pops
        node = total = 0
        for c in (*word, END):
            while (after := step.get(node << 9 | c)) is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = after
        while node:
            total += pops[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


_automata: dict[str, tuple[Automaton, dict[str, tuple[int, int]]]] = {}


def _count_rows(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _automata:
            _automata[path] = Automaton(vocabulary_pieces(path)), {}
        automaton, known = _automata[path]
        for batch in batches:
            words, pieces = [], []
            for text in batch.column("text"):
                w = p = 0
                text = text.as_py() or ""
                for run_ in (text if text.isascii() else unicodedata.normalize("NFC", text)).lower().split():
                    both = known.get(run_)
                    if both is None:
                        found = WORD.findall(run_)
                        both = len(found), sum(automaton.count(x.encode()) for x in found)
                        if len(known) < CACHE_RUNS:
                            known[run_] = both
                    w += both[0]
                    p += both[1]
                words.append(w)
                pieces.append(p)
            rest = batch.drop_columns(["text"])
            yield pa.record_batch([*rest.columns, pa.array(words, pa.int64()), pa.array(pieces, pa.int64())], names=[*rest.schema.names, "n_words", "n_pieces"])

    return run


def piece_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Rows of ``docs`` without text, with n_words and n_pieces.

    Words are those of the vocabulary's pattern on the NFC, lower-cased text; a
    word that the vocabulary cannot spell counts as one piece, the unknown one. A
    null text has none. Columns n_words and n_pieces are replaced.
    """
    text_batches(docs)
    rest = [c for c in docs.columns if c not in ("n_words", "n_pieces", text)]
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{text}`").cast("string").alias("text"))
    schema = ", ".join([*(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)), "n_words long, n_pieces long"])
    out = own.mapInArrow(_count_rows(vocabulary), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "n_words", "n_pieces")
