"""Token counts by a finite-state transducer compiled from a merge-type piece vocabulary.

A state holds, for each start from which a piece may still reach on, its place in the prefix tree of
the pieces, the piece before it, and the count there against the count here. A character moves all
starts on; exactly one of the pieces that end there is compatible with the piece before it, and the
transition emits by how much that changes the count. States are made when they are first met.

Texts are cut into chunks where every state passes into the start state, so a chunk's state map is
constant: it sends all states to the start and adds the chunk's count. Maps of distinct chunks are
kept; composing those of a column of texts is a prefix sum, and a text's count is the difference of
the sums at its ends.

A chunk that is long all the same, as a text without blanks, is cut at fixed lengths. Its parts have real
state maps: an entry state goes to an exit state and a count. Maps are known at the entry states that a
short look back at the part before suggests, which are nearly always right; the scan that composes them
from the left adds what is missing. States are forgotten between parts as well, so they stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.pieces import PieceTable, piece_table, segment_hashes, segment_texts, segments, spaced
from quayside.llm.texts import BLOCK, text_blocks

#: States, and counts of chunks, that a worker keeps before it starts anew.
STATES = 150_000
CHUNKS = 2_000_000
#: Characters of a part of a long chunk, and of the look back from its begin.
PART, LOOK = 4096, 48
_counters: dict[str, TokenCounter] = {}

State = tuple[tuple[int, int, int], ...]


class TokenCounter:
    def __init__(self, table: PieceTable):
        self.table = table
        #: Children of each node of the prefix tree, and the piece that ends there or -1.
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for text, piece in table.ids.items():
            node = 0
            for char in text:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][char]
            self.ends[node] = piece
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.forget_states()

    def forget_states(self) -> None:
        self.numbers: dict[State, int] = {}
        self.states: list[State] = []
        #: Of each state, by character: the next state and the emitted count.
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.start = self._number(((0, -1, 0),))

    def _number(self, state: State) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
            self.moves.append({})
        return number

    def _move(self, number: int, char: str) -> tuple[int, int]:
        """Compile one transition."""
        table, alive, last, emitted = self.table, [], -1, 0
        if char not in table.chars:  # unknown: one token for each byte, and all starts end
            return self.moves[number].setdefault(char, (self.start, len(char.encode())))
        for node, before, count in self.states[number]:
            node = self.children[node].get(char, 0)
            if not node:
                continue
            piece = self.ends[node]
            if last < 0 <= piece and (table.compatible(before, piece) if before >= 0 else table.whole(piece)):
                last, emitted = piece, count + 1
            if self.children[node]:
                alive.append((node, before, count))
        state = tuple((node, before, count - emitted) for node, before, count in alive)
        return self.moves[number].setdefault(char, (self._number((*state, (0, last, 0))), emitted))

    def _run(self, state: int, text: str) -> tuple[int, int]:
        """The state behind a text, and the tokens counted up to there."""
        moves, total = self.moves, 0
        for char in text:
            state, emitted = moves[state].get(char) or self._move(state, char)
            total += emitted
        return state, total

    def count(self, text: str) -> int:
        """Tokens of one chunk, from the start state."""
        if len(text) <= PART:
            return self._run(self.start, text)[1]
        return self.composed([text[k : k + PART] for k in range(0, len(text), PART)])

    def mapped(self, entry: State, part: str) -> tuple[State, int]:
        """Where the state map of a part sends an entry state, and the count that it adds."""
        if len(self.states) > STATES:
            self.forget_states()
        state, count = self._run(self._number(entry), part)
        return self.states[state], count

    def composed(self, parts: list[str]) -> int:
        """Tokens of the parts of a chunk, by composing their state maps."""
        first = self.states[self.start]
        entries = [first] + [self.mapped(first, part[-LOOK:])[0] for part in parts[:-1]]
        maps = [{entry: self.mapped(entry, part)} for entry, part in zip(entries, parts, strict=True)]
        # Runs of parts whose exits are the next ones' entries add up; the others' maps are completed.
        scan = np.cumsum([0, *[of[entry][1] for of, entry in zip(maps, entries, strict=True)]])
        fits = np.array([maps[k][entries[k]][0] == entries[k + 1] for k in range(len(parts) - 1)] + [False])
        state, total, k = first, 0, 0
        while k < len(parts):
            if state == entries[k]:
                end = k + int(np.argmin(fits[k:])) + 1
                total += int(scan[end] - scan[k])
                state, k = maps[end - 1][entries[end - 1]][0], end
            else:
                if state not in maps[k]:
                    maps[k][state] = self.mapped(state, parts[k])
                state, count = maps[k][state]
                total, k = total + count, k + 1
        return total

    def counts_of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        data, offsets = spaced(data, offsets)
        starts = segments(data, offsets)
        unique, example, which = np.unique(segment_hashes(data, starts), return_index=True, return_inverse=True)
        if len(self.states) > STATES:
            self.forget_states()
        if len(self.keys) > CHUNKS:
            self.keys, self.counts = self.keys[:0], self.counts[:0]
        at = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != unique[inside]
        if new.any():
            found = [self.count(text) for text in segment_texts(data, starts, example[new])]
            self.counts = np.insert(self.counts, at[new], found)
            self.keys = np.insert(self.keys, at[new], unique[new])
            at = np.searchsorted(self.keys, unique)
        scan = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(self.counts[at][which], out=scan[1:])
        return np.diff(scan[np.searchsorted(starts, offsets)])


def token_counter(path: str) -> TokenCounter:
    """The transducer of a file, compiled once per worker."""
    if path not in _counters:
        _counters[path] = TokenCounter(piece_table(path))
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, *, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return id_col, n_bytes, n_tokens and over_limit (n_tokens > limit) for each row of ``docs``.

    The tokens are those of the piece file at ``path``, with no begin or end token. A null or empty
    text has none. Ids may be null or repeat; each row is counted for itself.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path)
        for batch in stream:
            for begin, end, data, offsets in text_blocks(batch.column(1), BLOCK):
                counts = [pa.array(np.diff(offsets)), pa.array(counter.counts_of(data, offsets))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), *counts], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(batches, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)
