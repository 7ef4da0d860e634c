"""Encoding into and decoding from a merge-type piece vocabulary, by a table over prefixes.

The encoding of a text, cut before its last piece, is the encoding of a prefix. So one unique last
piece per prefix is the whole encoding: an automaton finds the pieces that end at each place, the one
compatible with the last piece of the prefix before it is stored, and the ids are read off backwards.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.pieces import BLANK, PieceTable, piece_table, segment_hashes, segment_texts, segments, spaced
from quayside.llm.texts import BLOCK, row_blocks, text_blocks

#: Distinct segments whose ids a worker keeps before it starts anew.
SEGMENTS = 1_000_000
#: Ids, and segments, put together at a time.
STEP = 1 << 18
_encoders: dict[str, PieceEncoder] = {}

codecs.register_error("bytewise", lambda error: ("�" * (error.end - error.start), error.end))


class PieceEncoder:
    def __init__(self, table: PieceTable):
        import ahocorasick

        self.table = table
        self.automaton = ahocorasick.Automaton()
        for text, piece in table.ids.items():
            self.automaton.add_word(text, (piece, len(text)))
        self.automaton.make_automaton()
        self.lengths = [len(text) for text in table.texts]
        sizes = [len(x) for x in table.bytes_of]
        self.sizes, self.firsts = np.array(sizes), np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(table.bytes_of), np.uint8)
        silent = [not x for x in table.bytes_of]
        self.silent, self.blank = np.array(silent), np.array([text.startswith(BLANK) for text in table.texts])
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool, self.used = np.empty(1 << 16, np.int32), 0

    def encode_text(self, text: str) -> list[int]:
        """Ids of one segment or text, its blanks given as BLANK."""
        ids: list[int] = []
        for run in self.table.runs(text):
            if run in self.table.chars or len(run) > 1:
                ids += self._run(run)
            else:
                ids += [self.table.byte_ids[byte] for byte in run.encode()]
        return ids

    def _run(self, text: str) -> list[int]:
        last = [-1] * len(text)
        compatible, pairs, size = self.table.compatible, self.table._pairs, len(self.table.texts)
        for end, (piece, length) in self.automaton.iter(text):
            if last[end] < 0:
                before = end - length
                if before < 0:
                    if self.table.whole(piece):
                        last[end] = piece
                else:
                    known = pairs.get(last[before] * size + piece)
                    if known or (known is None and compatible(last[before], piece)):
                        last[end] = piece
        ids, at = [], len(text) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self.lengths[last[at]]
        return ids[::-1]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the offsets of each text's."""
        data, offsets = spaced(data, offsets)
        starts = segments(data, offsets)
        unique, example, which = np.unique(segment_hashes(data, starts), return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > SEGMENTS:
            self._forget()
        at = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != unique[inside]
        if new.any():
            self._learn(unique[new], segment_texts(data, starts, example[new]))
            at = np.searchsorted(self.keys, unique)
        first, count = self.first[at], self.count[at]
        totals = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(count[which], out=totals[1:])
        ids = np.empty(totals[-1], np.int32)
        for begin in range(0, len(starts), STEP):
            of = which[begin : begin + STEP]
            low, high = totals[begin], totals[begin + len(of)]
            shift = first[of] - (totals[begin : begin + len(of)] - low)
            ids[low:high] = self.pool[np.repeat(shift, count[of]) + np.arange(high - low)]
        return ids, totals[np.searchsorted(starts, offsets)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        found = [self.encode_text(text) for text in texts]
        count = np.array([len(x) for x in found], np.int64)
        total = int(count.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + total] = [x for ids in found for x in ids]
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.first = np.insert(self.first, at, self.used + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.used += total

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of ids: the blank put before a text goes, and each byte of no character is U+FFFD."""
        parts = []
        for begin in range(0, len(ids), STEP):
            of = ids[begin : begin + STEP]
            sizes = self.sizes[of]
            ends = np.cumsum(sizes)
            parts.append(self.bytes[np.repeat(self.firsts[of] - ends + sizes, sizes) + np.arange(ends[-1])])
        raw = np.concatenate([np.empty(0, np.uint8), *parts]).tobytes()
        places = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[ids], out=places[1:])
        texts = []
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            head = low
            while head < high and self.silent[ids[head]]:
                head += 1
            dropped = int(head < high and bool(self.blank[ids[head]]))
            texts.append(raw[places[low] + dropped : places[high]].decode("utf-8", "bytewise"))
        return texts


def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of a file, made once per worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(piece_table(path))
    return _encoders[path]


def encode_pieces(
    docs: DataFrame, path: str, *, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Return id_col and ``ids`` (array of int) of every row's whole text, without begin or end ids.

    With ``decoded``, also the ``text`` that the ids decode to, in the same pass. A null or empty text
    has no ids. Characters that no piece has become the ids of their bytes. Row ids may be null or
    repeat.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "ids"] + ["text"] * decoded

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in stream:
            for begin, end, data, offsets in text_blocks(batch.column(1), BLOCK):
                ids, ends = encoder.encode(data, offsets)
                columns = [batch.column(0).slice(begin, end - begin), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
                if decoded:
                    columns.append(pa.array(encoder.decode(ids, ends), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, ids array<int>" + ", text string" * decoded
    return rows.mapInArrow(batches, schema).withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Return id_col, ids and ``text`` of every row of ids; null ids have a null text.

    Begin and end ids are silent. Ids outside the vocabulary raise an IndexError.
    """
    kind = encoded.schema[id_col].dataType.simpleString()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in stream:
            ends = batch.column(1).offsets.to_numpy()
            for begin, end in row_blocks(ends - ends[0], BLOCK):
                part = batch.slice(begin, end - begin)
                lists = part.column(1)
                bounds = lists.offsets.to_numpy()
                ids = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
                texts = encoder.decode(ids, bounds - bounds[0])
                text = pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, text], ["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(batches, f"id {kind}, ids array<int>, text string").withColumnsRenamed({"id": id_col})


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids joined by commas and of the text decoded from them."""
    return encode_pieces(docs, path, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
