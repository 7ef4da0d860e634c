"""Packing of tokenized documents into as few sequences as possible by a grouping genetic algorithm.

Documents longer than a sequence are cut into whole sequences and a first, shorter piece. Pieces below a
sequence are dealt by a hash to groups of bounded size. A plan of a group says which sequence each piece
goes to; each group has several islands, whose plans evolve in tasks of their own. Crossover injects
whole well-filled sequences of one plan into another, drops the other's sequences that hold any of their
pieces, and puts the displaced pieces back by best fit, the longest first. After each epoch the best plan
of an island moves to the next one. A group whose plan reaches a lower bound for its sequences is done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.chunk_ids import chunk_encoder
from quayside.llm.texts import text_blocks
from quayside.session import scratch_path

#: Pieces of a group, on average.
GROUP = 8192
#: Islands of a group, plans of an island, epochs, and children of an island in each.
ISLANDS, PLANS, EPOCHS, CHILDREN = 3, 4, 3, 12


def best_fit(lengths: list[int], order: list[int], rooms: list[int], capacity: int) -> list[int]:
    """Sequences for the pieces of ``order``, each the fullest with room for it, or a new one.

    ``rooms`` is the room left in the sequences that are there, and is brought up to date.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r is set where a sequence has room r
    for sequence, room in enumerate(rooms):
        by_room[room].append(sequence)
        some |= 1 << room
    chosen = []
    for piece in order:
        length = lengths[piece]
        fits = some >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            sequence = by_room[room].pop()
            if not by_room[room]:
                some ^= 1 << room
        else:
            room, sequence = capacity, len(rooms)
            rooms.append(capacity)
        rooms[sequence] = room - length
        by_room[room - length].append(sequence)
        some |= 1 << room - length
        chosen.append(sequence)
    return chosen


def fewest(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of the sequences that pieces need (that of Martello and Toth)."""
    count = np.bincount(lengths, minlength=capacity + 1)
    sums = np.cumsum(count * np.arange(capacity + 1))
    number, half = np.cumsum(count), capacity // 2
    least = np.arange(half + 1)  # pieces shorter than this are left out of account
    large = number[capacity] - number[capacity - least]
    middle = number[capacity - least] - number[half]
    room = middle * capacity - (sums[capacity - least] - sums[half])
    small = sums[half] - np.where(least > 0, sums[np.maximum(least - 1, 0)], 0)
    return int((large + middle + np.maximum(0, -(-(small - room) // capacity))).max())


def crossed(lengths: np.ndarray, one: np.ndarray, other: np.ndarray, share: float, capacity: int, random: np.random.Generator) -> np.ndarray:
    """Plan ``one`` with some well-filled sequences of plan ``other``; pieces are in falling order of length."""
    fill = np.bincount(other, lengths)
    well = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    injected = random.choice(well, max(1, int(len(fill) * share)), replace=False) if len(well) > 1 else well
    taken = np.zeros(len(fill), bool)
    taken[injected] = True
    return _refitted(lengths, one, taken[other], other, capacity)


def mutated(lengths: np.ndarray, plan: np.ndarray, share: float, capacity: int, random: np.random.Generator) -> np.ndarray:
    """The plan after its emptiest sequences and some others were broken up."""
    fill = np.bincount(plan, lengths)
    count = max(1, int(len(fill) * share))
    gone = np.zeros(len(fill), bool)
    gone[np.argsort(fill, kind="stable")[:count]] = True
    gone[random.integers(0, len(fill), count)] = True
    return _refitted(lengths, plan, np.zeros(len(plan), bool), plan, capacity, gone)


def _refitted(
    lengths: np.ndarray, plan: np.ndarray, fixed: np.ndarray, source: np.ndarray, capacity: int, gone: np.ndarray | None = None
) -> np.ndarray:
    """``plan`` without the sequences ``gone`` or holding a fixed piece; those go as in ``source``, displaced ones by best fit."""
    broken = np.zeros(plan.max() + 1, bool) if gone is None else gone.copy()
    broken[plan[fixed]] = True
    loose = np.flatnonzero(broken[plan] & ~fixed)
    placed = np.where(fixed, source + len(broken), plan)
    stays = np.ones(len(plan), bool)
    stays[loose] = False
    child = np.empty(len(plan), np.int32)
    _, child[stays] = np.unique(placed[stays], return_inverse=True)
    rooms = (capacity - np.bincount(child[stays], lengths[stays]).astype(np.int64)).tolist() if stays.any() else []
    child[loose] = best_fit(lengths.tolist(), loose.tolist(), rooms, capacity)
    return child


def _order(lengths: np.ndarray, plan: np.ndarray) -> tuple[int, int]:
    """The better plan has the lesser: fewer sequences, then fuller ones."""
    fill = np.bincount(plan, lengths).astype(np.int64)
    return len(fill), -int((fill * fill).sum())


def first_plans(lengths: np.ndarray, capacity: int, plans: int, random: np.random.Generator) -> list[np.ndarray]:
    """Best fit by falling length, and by falling length with some noise."""
    found = []
    for k in range(plans):
        noise = random.uniform(0, capacity / 16, len(lengths)) if k else 0
        order = np.argsort(-(lengths + noise), kind="stable").tolist()
        plan = np.empty(len(lengths), np.int32)
        plan[order] = best_fit(lengths.tolist(), order, [], capacity)
        found.append(plan)
    return found


def evolved(lengths: np.ndarray, plans: list[np.ndarray], capacity: int, children: int, random: np.random.Generator) -> list[np.ndarray]:
    """The best of the plans and their children, as many as there were, the best first."""
    size, least = len(plans), fewest(lengths, capacity)
    ranked = sorted(((_order(lengths, x), k, x) for k, x in enumerate(plans)), key=lambda x: x[:2])
    for turn in range(children):
        if ranked[0][0][0] == least:
            break
        one, other = random.choice(size, 2, replace=False) if size > 1 else (0, 0)
        child = crossed(lengths, ranked[one][2], ranked[other][2], random.uniform(0.05, 0.3), capacity, random)
        if turn % 3 == 2:
            child = mutated(lengths, child, 0.02, capacity, random)
        found = _order(lengths, child)
        if all(found != x[0] for x in ranked):  # not the same again
            ranked = sorted([*ranked, (found, size + turn, child)], key=lambda x: x[:2])[:size]
    return [x[2] for x in ranked]


def tokenized_units(
    docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(unit, id_col, piece, start, length, codes): each row's token ids and ``end_id`` in pieces of ``capacity``.

    The first piece of a longer row may be shorter. ``unit`` numbers all pieces, ``codes`` has 16 bits for
    an id if the vocabulary allows, else 32. A null text is empty and has the end id alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    width = code_width(path)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, unit = chunk_encoder(path), TaskContext.get().partitionId() << 33
        last = np.array([end_id], f"<u{width}").tobytes()
        for batch in stream:
            for begin, _, data, offsets in text_blocks(batch.column("text")):
                of, number, start, length, parts = [], [], [], [], []
                for row, found in enumerate(encoder.encode(data, offsets), begin):
                    codes = np.frombuffer(found, "<u4").astype(f"<u{width}").tobytes() + last
                    tokens = len(codes) // width
                    at, piece = 0, 0
                    end = (tokens - 1) % capacity + 1
                    while at < tokens:
                        of.append(row)
                        number.append(piece)
                        start.append(at)
                        length.append(end - at)
                        parts.append(codes[at * width : end * width])
                        at, end, piece = end, end + capacity, piece + 1
                columns = [
                    pa.array(np.arange(unit, unit + len(of))),
                    batch.column("id").take(pa.array(of, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(parts, pa.binary()),
                ]
                unit += len(of)
                yield pa.RecordBatch.from_arrays(columns, ["unit", "id", "piece", "start", "length", "codes"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = rows.mapInArrow(batches, f"unit long, id {kind}, piece int, start long, length long, codes binary")
    return cut.withColumnRenamed("id", id_col)


def code_width(path: str) -> int:
    """Bytes that hold an id of the file."""
    return 2 if chunk_encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4


_STATE = "group long, island int, units binary, lengths binary, plans binary, sequences int, squares long"


def _state(columns: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]
    names = [name.split()[0] for name in _STATE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*columns, strict=True), kinds, strict=True)], names)


def _row(group: int, island: int, units: np.ndarray, lengths: np.ndarray, plans: list[np.ndarray]) -> tuple:
    sequences, squares = _order(lengths, plans[0])
    packed = np.stack(plans).astype("<i4").tobytes()
    return group, island, units.astype("<i8").tobytes(), lengths.astype("<i4").tobytes(), packed, sequences, squares


def first_islands(units: DataFrame, *, groups: int, capacity: int, islands: int, plans: int) -> DataFrame:
    """The islands of every group of (unit, length), with their first plans; one where it has the fewest sequences."""

    def started(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        numbers, lengths = (group.column(name).to_numpy() for name in ("unit", "length"))
        order = np.lexsort((numbers, -lengths))
        numbers, lengths, found = numbers[order], lengths[order], []
        for island in range(islands):
            random = np.random.default_rng([key[0].as_py(), island])
            tried = first_plans(lengths, capacity, 1 if island == 0 else plans, random)
            if len(np.unique(tried[0])) == fewest(lengths, capacity):
                found = [(island, tried[:1])]
                break
            if island == 0:
                tried += first_plans(lengths, capacity, plans, random)[1:]
            found.append((island, sorted(tried, key=lambda x: _order(lengths, x))))
        return pa.Table.from_batches([_state([_row(key[0].as_py(), island, numbers, lengths, x) for island, x in found])])

    group = F.pmod(F.xxhash64("unit"), F.lit(groups))
    return units.select("unit", "length", group.alias("group")).groupBy("group").applyInArrow(started, _STATE)


def _epoch(state: DataFrame, epoch: int, *, capacity: int, children: int) -> DataFrame:
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in batch.to_pylist():
                units, lengths, plans = _read(row)
                random = np.random.default_rng([row["group"], row["island"], epoch])
                if len(plans) > 1:
                    plans = evolved(lengths, plans, capacity, children, random)
                yield _state([_row(row["group"], row["island"], units, lengths, plans)])

    return state.mapInArrow(batches, _STATE)


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
    plans = np.frombuffer(row["plans"], "<i4").reshape(-1, len(lengths))
    return np.frombuffer(row["units"], "<i8"), lengths, list(plans)


def _migrated(state: DataFrame, islands: int) -> DataFrame:
    """Each island with the best plan of the island before it in place of its own last one."""
    # Plans stand the best first, four bytes for each piece, and there are half as many as bytes of units.
    size = F.octet_length("lengths")
    elites = state.select("group", ((F.col("island") + 1) % islands).alias("island"), F.substring("plans", F.lit(1), size).alias("elite"))
    met = state.join(elites, ["group", "island"], "left")
    kept = F.substring("plans", F.lit(1), F.octet_length("plans") - size)
    plans = F.when(F.col("elite").isNull() | (F.octet_length("plans") == size), F.col("plans")).otherwise(F.concat(kept, "elite"))
    return met.select("group", "island", "units", "lengths", plans.alias("plans"), "sequences", "squares")


def _places(best: DataFrame) -> DataFrame:
    """(unit, sequence_id, offset) of every piece, by each group's best plan."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in batch.to_pylist():
                units, lengths, plans = _read(row)
                plan = plans[0].astype(np.int64)
                order = np.argsort(plan, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                own = plan[order]
                firsts = np.searchsorted(own, own)
                columns = [units[order], own + (row["group"] << 32), before - before[firsts]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["unit", "sequence_id", "offset"])

    return best.mapInArrow(batches, "unit long, sequence_id long, offset long")


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def plan_sequences(
    units: DataFrame,
    *,
    capacity: int = 2048,
    group: int = GROUP,
    islands: int = ISLANDS,
    plans: int = PLANS,
    epochs: int = EPOCHS,
    children: int = CHILDREN,
) -> DataFrame:
    """(unit, sequence_id, offset) for rows of (unit, length), units all different and lengths up to ``capacity``."""
    short = units.where(F.col("length") < capacity).select("unit", "length")
    groups = max(1, -(-short.count() // group))
    state = _written(first_islands(short, groups=groups, capacity=capacity, islands=islands, plans=plans), "islands")
    for epoch in range(epochs):
        if not state.where(F.octet_length("plans") > F.octet_length("lengths")).limit(1).count():
            break  # every group has its fewest sequences
        evolving = _epoch(state, epoch, capacity=capacity, children=children)
        state = _written(_migrated(evolving, islands) if epoch + 1 < epochs else evolving, f"islands-{epoch}")
    # Migration puts elites last, so the first plan is still the one that the figures are of.
    chosen = state.groupBy("group").agg(F.min(F.struct("sequences", "squares", "island")).alias("best"))
    chosen = chosen.select("group", F.col("best.island").alias("island"))
    best = state.join(chosen, ["group", "island"], "left_semi")
    full = units.where(F.col("length") == capacity)
    full = full.select("unit", (-1 - F.col("unit")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return _places(best).unionByName(full)


def pack_fewest(docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 0, **how: int) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) by the byte-level file at ``path``, and pack them into few sequences.

    Returns doc_id, piece, start, length, ids (unsigned, 32 bits, little-endian), sequence_id and offset for
    each piece. Only rows of more than ``capacity`` ids, with ``end_id`` behind each row's, are cut. Whole
    pieces have sequences of their own. Sequences are gapless from offset 0, their numbers any.

    A null text is empty: one piece of the end id. Rows of repeated or null doc_id are packed each for
    itself, equal rows dealt to many groups. An empty table has no pieces. ``how`` goes to ``plan_sequences``.
    """
    units = _written(tokenized_units(docs.select("doc_id", "text"), path, capacity=capacity, end_id=end_id), "units")
    packed = units.join(plan_sequences(units, capacity=capacity, **how), "unit")
    names = ["doc_id", "piece", "start", "length", "codes", "sequence_id", "offset"]
    return _widened(packed.select(names), code_width(path))


def _widened(packed: DataFrame, width: int) -> DataFrame:
    """The pieces with ids of 32 bits in place of codes."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            column = batch.column("codes")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.uint8)
            ids = raw.view(f"<u{width}").astype("<u4") if raw.flags.aligned else np.frombuffer(raw.tobytes(), f"<u{width}").astype("<u4")
            bounds = ((offsets - offsets[0]).astype(np.int64) // width * 4).astype(np.int32)
            wide = pa.BinaryArray.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(ids.tobytes())])
            columns = [wide if name == "codes" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, ["ids" if name == "codes" else name for name in batch.schema.names])

    fields = [f"{f.name} {f.dataType.simpleString()}" if f.name != "codes" else "ids binary" for f in packed.schema]
    return packed.mapInArrow(batches, ", ".join(fields))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
