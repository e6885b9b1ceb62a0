"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces, counted without building them. The vocabulary is a trie.
A node where no longer match goes on has a failure link to the node of what is left when
the pieces matched so far are popped, and the number of those pieces is worked out
beforehand. So each character of a word is read once, and a count is a sum of numbers.

Words stand between white space; A-Z count as a-z. Symbols are bytes, and the last byte of
a word is a symbol of its own, as vocabularies with word ends have it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.words import LOWER, fingerprints, slices, words

LAST = 256  # added to the last byte of a word
SYMBOLS = 512
NONE = -1  # no failure link: what is read so far starts no row of pieces
LONG = 200  # bytes; longer words are read one by one, shorter ones side by side


def vocabulary(path: str, end: str = "</w>") -> list[tuple[bytes, bool]]:
    """(bytes, whether it ends a word) of each piece of a tokenizer file in the byte alphabet."""
    # the alphabet shows bytes that do not print as the characters from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(b): b for b in shown}
    code.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    with open(path, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    out = []
    for piece in pieces:
        word = piece.removesuffix(end)
        if word and all(c in code for c in word):
            out.append((bytes(code[c] for c in word), word != piece))
    return out


class Automaton:
    """Trie with failure links and counts of popped pieces."""

    def __init__(self, pieces: list[tuple[bytes, bool]]):
        goto: dict[int, int] = {}
        is_piece, parent, symbol = [False], [0], [0]
        for data, ends in pieces:
            node = 0
            for k, byte in enumerate(data):
                key = node * SYMBOLS + byte + LAST * (ends and k == len(data) - 1)
                if key not in goto:
                    goto[key] = len(parent)
                    parent.append(node), symbol.append(key % SYMBOLS), is_piece.append(False)
                node = goto[key]
            is_piece[node] = True
        depth = np.zeros(len(parent), np.int64)
        for v in range(1, len(parent)):
            depth[v] = depth[parent[v]] + 1
        fail, popped = [NONE] * len(parent), [0] * len(parent)
        for v in np.argsort(depth, kind="stable")[1:].tolist():
            if is_piece[v]:
                fail[v], popped[v] = 0, 1
                continue
            n, z = popped[parent[v]], fail[parent[v]]
            while z != NONE and z * SYMBOLS + symbol[v] not in goto:
                n, z = n + popped[z], fail[z]
            if z != NONE:
                fail[v], popped[v] = goto[z * SYMBOLS + symbol[v]], n
        self.goto = goto
        self.keys = np.array(sorted(goto), np.int64)
        self.nodes = np.array([goto[k] for k in self.keys.tolist()], np.int64)
        self.fail, self.popped = np.array(fail), np.array(popped)

    def count(self, word: bytes) -> int:
        """Pieces of one word; a word that pieces cannot cover is one unknown piece."""
        goto, fail, popped, u, n = self.goto, self.fail, self.popped, 0, 0
        last = len(word) - 1
        for k, byte in enumerate(word):
            s = byte + LAST * (k == last)
            while (v := goto.get(u * SYMBOLS + s, NONE)) == NONE:
                if fail[u] == NONE:
                    return 1
                n, u = n + int(popped[u]), int(fail[u])
            u = v
        while u:
            if fail[u] == NONE:
                return 1
            n, u = n + int(popped[u]), int(fail[u])
        return n

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = state * SYMBOLS + symbol
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], NONE)

    def counts(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Pieces of each word; all words are read side by side, one symbol at a time."""
        size = stops - starts
        out = np.zeros(len(starts), np.int64)
        for w in np.flatnonzero(size > LONG):
            out[w] = self.count(data[starts[w] : stops[w]].tobytes())
        if not len(self.keys):
            return np.ones(len(starts), np.int64)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] <= LONG]
        state, unknown = np.zeros(len(out), np.int64), np.zeros(len(out), bool)
        for k in range(int(size[order].max(initial=0))):
            order = order[: np.searchsorted(-size[order], -k, "left")]  # words with a symbol k
            left = order[~unknown[order]]
            symbol = data[starts[left] + k].astype(np.int64) + LAST * (size[left] == k + 1)
            while len(left):
                to = self.step(state[left], symbol)
                found = to != NONE
                state[left[found]] = to[found]
                left, symbol = self._pop(left[~found], symbol[~found], state, out, unknown)
        left = np.flatnonzero((state > 0) & ~unknown)
        while len(left):
            left, _ = self._pop(left, left, state, out, unknown)
            left = left[state[left] > 0]
        out[unknown] = 1
        return out

    def _pop(self, left, symbol, state, out, unknown):
        """Follow the failure links of the states of some words; words without one are unknown."""
        lost = self.fail[state[left]] == NONE
        unknown[left[lost]] = True
        left, symbol = left[~lost], symbol[~lost]
        out[left] += self.popped[state[left]]
        state[left] = self.fail[state[left]]
        return left, symbol


_automata: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file; built once in each worker."""
    if path not in _automata:
        _automata[path] = Automaton(vocabulary(path))
    return _automata[path]


def counted(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_tokens.

    A null text counts as empty: no words, no tokens. A word that no row of pieces covers
    is one token. Null and repeated ids are kept. Other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton(path)
        for batch in batches:
            n_words, n_tokens = [], []
            for row, stop, offsets, data in slices(batch.column("text")):
                data = LOWER[data]
                text, starts, stops = words(offsets, data)
                # each distinct word of the slice is read once
                _, one, same = np.unique(fingerprints(data, starts, stops, 6), return_index=True, return_inverse=True)
                tokens = own.counts(data, starts[one], stops[one])[same]
                n_words.append(np.bincount(text, minlength=stop - row))
                n_tokens.append(np.bincount(text, tokens, stop - row).astype(np.int64))
            n_words, n_tokens = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n_words, n_tokens))
            arrays = [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_words", "n_tokens"])

    out = rows.mapInArrow(count, f"id {kind}, n_words long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
