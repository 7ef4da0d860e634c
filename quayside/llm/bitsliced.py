"""Exact top rows by integer inner product, on a bit-sliced index.

Components are integers, and every binary digit of a component is a bitmap over the rows of a block. A
query adds the slices of all components, each shifted by the set bits of its own component, by
carry-save additions of whole bitmaps; the sums come out as slices again. The best rows are then
selected from the most significant slice downward, and equal rows at the boundary by their ids.

Blocks are sliced once and written; bounded batches of queries are sent to them one after another, so that
no row moves for a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.vector_codes import narrow, whole, wide
from quayside.llm.vectors import matrix, usable
from quayside.session import scratch_path

#: Rows of a block of the index, and queries that are sent to all blocks at a time.
ROWS = 16_384
QUERIES = 8192
#: Digits of a component that are sliced together.
LIMB = 62
LARGEST = 1 << 63
_TURNED = str.maketrans("0123456789", "9876543210")
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class BitSlices:
    """Bitmaps of the binary digits of integer rows, in the order of their ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, rows = ids[order], rows[order]
        self.low = rows.min(axis=0).tolist()
        # Components within 61 bits differ by less than 2^62; wider ones are Python's integers.
        raised = rows - rows.min(axis=0)
        self.digits = max(int(raised.max()).bit_length(), 1)
        words = -(-len(ids) // 64)
        # slices[component * digits + digit] is a bitmap over the rows.
        self.slices = np.empty((rows.shape[1] * self.digits, words), np.uint64)
        for first in range(0, self.digits, LIMB):
            some = min(LIMB, self.digits - first)
            padded = np.zeros((words * 64, rows.shape[1]), np.uint64)
            padded[: len(ids)] = ((raised >> first) & ((1 << LIMB) - 1)).astype(np.uint64)
            for k in range(rows.shape[1]):
                bits = (padded[:, k, None] >> np.arange(some, dtype=np.uint64)) & np.uint64(1)
                at = k * self.digits + first
                self.slices[at : at + some] = np.packbits(bits, axis=0, bitorder="little").T.copy().view(np.uint64)
        self._present()

    def _present(self) -> None:
        words = -(-len(self.ids) // 64)
        self.present = np.packbits(np.arange(words * 64) < len(self.ids), bitorder="little").view(np.uint64)

    def to_fields(self) -> tuple[bytes, str, int, bytes]:
        """Ids, least components, digits and slices, for a row of a table."""
        return self.ids.astype("<i8").tobytes(), ",".join(map(str, self.low)), self.digits, self.slices.tobytes()

    @classmethod
    def from_fields(cls, ids: bytes, low: str, digits: int, slices: bytes) -> BitSlices:
        index = cls.__new__(cls)
        index.ids, index.low, index.digits = np.frombuffer(ids, "<i8"), [int(x) for x in low.split(",")], digits
        index.slices = np.frombuffer(slices, np.uint64).reshape(len(index.low) * digits, -1)
        index._present()
        return index

    def added(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices, least significant first, of every row's inner product plus a constant; the constant.

        A negative factor takes the digits' complement, and the constant makes up for it.
        """
        whole = (1 << self.digits) - 1
        constant = -sum(int(q) * int(low) for q, low in zip(query, self.low, strict=True))
        levels: dict[int, list[tuple[int, bool]]] = {}
        for component, factor in enumerate(query.tolist()):
            if factor < 0:
                constant += -factor * whole
            size = abs(factor)
            for shift in range(size.bit_length()):
                if size >> shift & 1:
                    for digit in range(self.digits):
                        levels.setdefault(shift + digit, []).append((component * self.digits + digit, factor < 0))
        sums, carried, level = [], np.empty((0, len(self.present)), np.uint64), 0
        while level <= max(levels, default=-1) or len(carried):
            own = levels.get(level, [])
            at = np.array([x[0] for x in own], np.intp)
            flip = np.where([x[1] for x in own], _ALL, np.uint64(0)).astype(np.uint64)
            column = np.concatenate([carried, self.slices[at] ^ flip[:, None]])
            carries = []
            while len(column) > 2:
                third = len(column) // 3
                a, b, c = column[:third], column[third : 2 * third], column[2 * third : 3 * third]
                both = a ^ b
                carries.append((a & b) | (both & c))
                column = np.concatenate([both ^ c, column[3 * third :]])
            if len(column) == 2:
                carries.append((column[:1] & column[1:]))
                column = column[:1] ^ column[1:]
            sums.append(column[0] if len(column) else np.zeros_like(self.present))
            carried = np.concatenate([np.empty((0, len(self.present)), np.uint64), *carries])
            level += 1
        return sums, constant

    def top(self, query: np.ndarray, count: int, without: int) -> list[tuple[int, int]]:
        """(id, score) of the best rows but those of id ``without``; of equal ones, the least ids."""
        sums, constant = self.added(query)
        left = self.present.copy()
        for row in range(int(np.searchsorted(self.ids, without)), int(np.searchsorted(self.ids, without, "right"))):
            left[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        chosen, sure = np.zeros_like(left), 0
        for piece in reversed(sums):
            high = left & piece
            more = int(np.bitwise_count(high).sum())
            if sure + more > count:
                left = high
            else:
                chosen |= high
                sure += more
                left &= ~piece
                if sure == count:
                    break
        rows = self._rows(chosen) + self._rows(left)[: count - sure]
        return [(int(self.ids[row]), self._value(sums, row) - constant) for row in rows]

    @staticmethod
    def _rows(bitmap: np.ndarray) -> list[int]:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")).tolist()

    @staticmethod
    def _value(sums: list[np.ndarray], row: int) -> int:
        return sum((int(piece[row // 64]) >> row % 64 & 1) << level for level, piece in enumerate(sums))


def _whole_rows(rows: DataFrame, scale: int) -> DataFrame:
    """(id, length, values) of rows (id, vector): floor(scale * x) of all components, exact at any size."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lengths = batch.column("vector").value_lengths().to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                values = [narrow(row) for row in whole(matrix(part.column("vector")), scale)]
                columns = [part.column("id"), pa.array([length] * len(part), pa.int32()), pa.array(values, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "length", "values"])

    return rows.mapInArrow(batches, "id long, length int, values binary")


def _sliced(rows: DataFrame, blocks: int) -> DataFrame:
    """(length, ids, low, digits, slices) of all blocks. Rows are dealt by their number, so copies go to all."""

    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        values = wide(group.column("values").to_pylist(), key[0].as_py())
        fields = BitSlices(group.column("id").to_numpy(), values).to_fields()
        return pa.table([pa.array([x], kind) for x, kind in zip((key[0].as_py(), *fields), kinds, strict=True)], names)

    names = ["length", "ids", "low", "digits", "slices"]
    kinds = [pa.int32(), pa.binary(), pa.string(), pa.int32(), pa.binary()]
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    dealt = rows.select("id", "length", "values", block)
    return dealt.groupBy("length", "block").applyInArrow(build, "length int, ids binary, low string, digits int, slices binary")


def _sortable(score: int) -> str:
    """A text whose order among others of its kind is that of the numbers."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):06d}{digits}"
    return f"0{999_999 - len(digits):06d}{digits.translate(_TURNED)}"


def _searched(index: DataFrame, queries: Broadcast, count: int) -> DataFrame:
    """The best rows of every block for each query of a batch; ``score`` is null beyond 64 bits, ``place`` is not."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in batch.to_pylist():
                mine = queries.value.get(row["length"])
                if mine is None:
                    continue
                numbers, ids, vectors = (x[row["share"] :: row["shares"]] for x in mine)
                block = BitSlices.from_fields(row["ids"], row["low"], row["digits"], row["slices"])
                found = []
                for number, query, vector in zip(numbers, ids, vectors, strict=True):
                    for other, score in block.top(vector, count, int(query)):
                        found.append((int(number), int(query), other, score if -LARGEST <= score < LARGEST else None, _sortable(score)))
                if found:
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["number", "query_id", "vec_id", "score", "place"])

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return index.mapInArrow(batches, "number long, query_id long, vec_id long, score long, place string")


def top_products(
    vectors: DataFrame, *, queries_each: int = 50, count: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Return query_id, rank, vec_id and score: the best rows for each id divisible by ``queries_each``.

    Components become floor(scale * x); the score is the inner product of those integers, exact at any
    size. All other rows are candidates, those of the query's own id left out; equal scores are ranked by
    id. Rows of null id, null or empty vectors, or null or non-finite components take no part, and vectors
    meet only vectors of their length. A query row that is repeated is answered once. A score beyond 64
    bits is ranked by its value and shown as null.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).withColumn("id", F.col("id").cast("long"))
    rows = _written(_whole_rows(rows, scale), "slice-rows")
    asked = rows.where(F.col("id") % queries_each == 0).distinct().withColumn("number", F.xxhash64("id", "length", "values"))
    total, questions = rows.count(), asked.count()
    blocks = max(1, -(-total // ROWS))
    index = _written(_sliced(rows, blocks), "slices")
    tasks = max(1, spark.sparkContext.defaultParallelism)
    # Few blocks are read by several tasks, each with a share of the queries.
    shares = max(1, -(-2 * tasks // blocks))
    index = index.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("shares", F.lit(shares))
    index = index.repartition(max(tasks, min(blocks * shares, 8 * tasks)), F.xxhash64("ids", "share"))
    path, batches = scratch_path(spark, "slice-tops"), max(1, -(-questions // QUERIES))
    for batch in range(batches):
        some = asked.where(F.pmod(F.xxhash64("number"), F.lit(batches)) == batch).toArrow().to_pandas()
        grouped = {
            int(length): (own["number"].to_numpy(), own["id"].to_numpy(), wide(own["values"].tolist(), int(length)))
            for length, own in some.sort_values(["id", "number"]).groupby("length")
        }
        sent = spark.sparkContext.broadcast(grouped)
        _searched(index, sent, count).write.mode("append").parquet(path)
        sent.destroy()
    partial = spark.read.parquet(path)
    best = Window.partitionBy("query_id", "number").orderBy(F.desc("place"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
