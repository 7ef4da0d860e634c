"""Packing of documents into sequences of bounded length, balanced by estimated attention cost.

A piece of n tokens costs ``linear * n + quadratic * n * n``. Documents longer than a sequence are cut
into whole sequences and a rest. Rests are dealt out by a hash to groups of bounded size; in each,
they go in falling order of cost to the sequence of lowest cost that has room for them, and are cut
where none has. A group has as few sequences as its tokens allow, so only its last tokens are padded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.texts import BLOCK, flat, text_blocks
from quayside.llm.word_ids import word_encoder

#: Pieces in a packing group, on average.
GROUP = 4096
#: Pieces that a packing group returns at a time.
SENT = 256


def tokenized_pieces(
    docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of (id_col, unit, start, ids, doc_tokens): each row's token ids and ``end_id``, cut every ``capacity``.

    ``ids`` are unsigned, 32 bits, little-endian. ``unit`` numbers the pieces: by task, and in a task in
    the order of its rows, so a task that is repeated numbers alike as long as its input comes in the same
    order, as files do. A null text is empty and has the end id alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    last = np.array([end_id], "<u4").tobytes()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, unit = word_encoder(path), TaskContext.get().partitionId() << 33
        for batch in stream:
            for begin, _, data, offsets in text_blocks(batch.column(1), BLOCK):
                of, start, parts, tokens = [], [], [], []
                for row, found in enumerate(encoder.encode(data, offsets), begin):
                    found += last
                    for at in range(0, len(found), 4 * capacity):
                        of.append(row)
                        start.append(at // 4)
                        parts.append(found[at : at + 4 * capacity])
                        tokens.append(len(found) // 4)
                columns = [
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(np.arange(unit, unit + len(of))),
                    pa.array(start, pa.int64()),
                    pa.array(parts, pa.binary()),
                    pa.array(tokens, pa.int64()),
                ]
                unit += len(of)
                yield pa.RecordBatch.from_arrays(columns, ["id", "unit", "start", "ids", "doc_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = rows.mapInArrow(batches, f"id {kind}, unit bigint, start bigint, ids binary, doc_tokens bigint")
    return cut.withColumnRenamed("id", id_col)


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces, given in falling order of length; returns (piece, start, length, sequence, offset).

    Each goes whole to the sequence of lowest cost with room for it, the first of equal ones; where
    none has room, as much as fits goes to the roomiest, and the rest is assigned anew.
    """
    cost = np.zeros(-(-sum(lengths) // capacity))
    room = np.full(len(cost), capacity)
    placed = []
    for piece, length in enumerate(lengths):
        start = 0
        while start < length:
            left = length - start
            fits = room >= left
            at = int(np.where(fits, cost, np.inf).argmin()) if fits.any() else int(room.argmax())
            taken = min(left, int(room[at]))
            placed.append((piece, start, taken, at, capacity - int(room[at])))
            room[at] -= taken
            cost[at] += linear * taken + quadratic * taken * taken
            start += taken
    return placed


def pack(
    pieces: DataFrame,
    *,
    groups: int,
    capacity: int = 2048,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    id_col: str = "doc_id",
) -> DataFrame:
    """Pack rows of ``tokenized_pieces``; returns id_col, start, length, ids, doc_tokens, sequence_id, offset.

    Every id lies in exactly one piece, every sequence is gapless from offset 0 and at most
    ``capacity`` long. Rows of equal or null ids are packed each for itself, and equal rows are dealt to
    many groups; equal lengths are ordered by id, start, content and unit, so a repeated task packs alike.
    An empty table has no pieces.
    """
    kind = pieces.schema[id_col].dataType.simpleString()

    def packed(key: tuple[pa.Scalar, ...], group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, units, starts, parts, tokens = [], [], [], [], []
        for batch in group:
            held.append(batch.column("id"))
            for known, name in ((units, "unit"), (starts, "start"), (tokens, "doc_tokens")):
                known += batch.column(name).to_pylist()
            data, offsets = flat(batch.column("ids"))
            parts += [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        ids = pa.concat_arrays(held)
        names = [str(name) for name in ids.to_pylist()]
        order = sorted(range(len(parts)), key=lambda k: (-len(parts[k]), names[k], starts[k]))
        # Contents are compared, and copied for it, only where all else is equal.
        runs = (list(run) for _, run in groupby(order, lambda k: (len(parts[k]), names[k], starts[k])))
        order = [k for run in runs for k in (sorted(run, key=lambda k: (parts[k].tobytes(), units[k])) if len(run) > 1 else run)]
        whole = [k for k in order if len(parts[k]) == 4 * capacity]
        rest = order[len(whole) :]
        placed = [(k, 0, capacity, at, 0) for at, k in enumerate(whole)]
        placed += [
            (rest[k], start, length, at + len(whole), offset)
            for k, start, length, at, offset in assign([len(parts[k]) // 4 for k in rest], capacity, linear, quadratic)
        ]
        base = key[0].as_py() << 32
        for begin in range(0, len(placed), SENT):
            some = placed[begin : begin + SENT]
            columns = [
                ids.take(pa.array([x[0] for x in some], pa.int64())),
                pa.array([starts[x[0]] + x[1] for x in some], pa.int64()),
                pa.array([x[2] for x in some], pa.int64()),
                pa.array([parts[x[0]][4 * x[1] : 4 * (x[1] + x[2])].tobytes() for x in some], pa.binary()),
                pa.array([tokens[x[0]] for x in some], pa.int64()),
                pa.array([base + x[3] for x in some], pa.int64()),
                pa.array([x[4] for x in some], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    pieces = pieces.select(F.col(id_col).alias("id"), "unit", "start", "ids", "doc_tokens")
    # Rows of one id, and equal rows, do not meet in one group.
    group = F.pmod(F.xxhash64("unit"), F.lit(groups))
    return (
        pieces.withColumn("group", group)
        .groupBy("group")
        .applyInArrow(
            packed,
            f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
        )
        .withColumnRenamed("id", id_col)
    )


def pack_documents(docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) by the file at ``path``, and pack them; see ``pack`` for what comes out.

    A null or empty text has the end id alone. Repeated rows are packed each for itself.
    """
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    # A token has four bytes or so; a piece has at most ``capacity`` tokens.
    pieces = size["rows"] + (size["bytes"] or 0) // (4 * capacity)
    groups = max(1, -(-pieces // GROUP))
    return pack(tokenized_pieces(docs, path, capacity=capacity, end_id=end_id), groups=groups, capacity=capacity)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
