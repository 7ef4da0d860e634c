"""Product codes of vectors: exact integer means for each part, found on flat blocks along a Hilbert curve.

Components become integers, and vectors are cut into parts. The pieces of a part are put in the order of
a Hilbert curve and laid down in flat blocks, each with its box (least and greatest of every component)
and its sums. In a round, distances between boxes and codebook entries leave each block a shortlist: an
entry whose least distance to the box is beyond another's greatest is nearest to no piece in it. A block
with one entry left gives its sums as they are; blocks with the same shortlist are evaluated together by
an integer kernel, as narrow as the numbers allow. Sums and counts of all blocks are added up in Spark,
in digits of 32 bits, so that they are exact at any size. Only codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quayside.llm.vectors import finite, matrix
from quayside.session import scratch_path

#: Pieces in a flat block.
BLOCK = 128
#: Bits of a Hilbert key.
KEY_BITS = 62
#: Most labels whose sums are sent to all tasks.
SENT = 100_000
#: Salts of the labels beyond.
SALTS = 16
#: Bits of a digit in which sums go through Spark.
DIGIT = 32
_LONG = (1 << 63) - 1
#: codebooks[length][part] holds the entries of a part as rows.
Codebooks = dict[int, list[np.ndarray]]


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Where parts begin and end; equal ones, or as equal as the length allows."""
    return [(length * k // parts, length * (k + 1) // parts) for k in range(parts)]


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), in 64 bits where they do, else as Python's integers."""
    with np.errstate(over="ignore"):
        floors = np.floor(vectors * scale)
    if not floors.size or np.abs(floors).max() < 2.0**62:
        return floors.astype(np.int64)
    exact = [int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(vectors.ravel().tolist(), floors.ravel().tolist(), strict=True)]
    return np.array(exact, object).reshape(vectors.shape)


def narrow(values: np.ndarray) -> bytes:
    """Integers as bytes: a digit for the width of each, or ``t`` for text, then the values."""
    if values.dtype == object:
        return b"t" + ",".join(map(str, values.ravel().tolist())).encode()
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return b"%d" % width + values.astype(f"<i{width}").tobytes()


def wide(blobs: list[bytes], columns: int) -> np.ndarray:
    """Rows of integers out of bytes; Python's integers if any are text."""
    if columns == 0:
        return np.empty((len(blobs), 0), np.int64)
    kinds = {blob[:1] for blob in blobs}
    if kinds == {b"t"} or b"t" in kinds:
        rows = [
            [int(x) for x in blob[1:].decode().split(",")] if blob[:1] == b"t" else np.frombuffer(blob[1:], f"<i{int(blob[:1])}").tolist()
            for blob in blobs
        ]
        return np.array([x for row in rows for x in row], object).reshape(-1, columns)
    if len(kinds) == 1:
        kind = f"<i{int(next(iter(kinds)))}"
        return np.frombuffer(b"".join([blob[1:] for blob in blobs]), kind).astype(np.int64).reshape(-1, columns)
    parts = [np.frombuffer(blob[1:], f"<i{int(blob[:1])}").astype(np.int64) for blob in blobs]
    return np.concatenate([np.empty(0, np.int64), *parts]).reshape(-1, columns)


def _fitting(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in the narrowest type in which squared distances of their rows are exact."""
    if all(x.dtype != object for x in arrays):
        most = max((max(abs(int(x.min())), abs(int(x.max()))) for x in arrays if x.size), default=0)
        bound = 4 * most * most * max(1, arrays[0].shape[-1])
        if bound < 1 << 52:
            return [x.astype(np.float64) for x in arrays]
        if bound < 1 << 62:
            return list(arrays)
    return [x.astype(object) for x in arrays]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each point, and the squared distance; both exact."""
    p, e = _fitting(points, entries)
    if p.dtype == object:
        far = ((p[:, None] - e) ** 2).sum(axis=2)
        best = np.array([min(range(len(e)), key=row.__getitem__) for row in far.tolist()], np.int64)
        return best, far[np.arange(len(best)), best]
    far = (e * e).sum(axis=1) - 2 * (p @ e.T)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(best)), best] + (p * p).sum(axis=1)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box which entries may be nearest to a point in it."""
    low, high, entries = _fitting(low, high, entries)
    below, above = low[:, None] - entries, entries - high[:, None]
    gap = np.maximum(np.maximum(below, above), 0)
    reach = np.maximum(np.abs(below), np.abs(above))
    # With whole components: the farthest corner of the box has the greater of both per component.
    reach = np.maximum(reach, np.maximum(np.abs(high[:, None] - entries), np.abs(entries - low[:, None])))
    least, most = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
    return (least <= most.min(axis=1)[:, None]).astype(bool)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along a Hilbert curve of points whose coordinates have ``bits`` bits, by Skilling's method."""
    x = cells.T.astype(np.int64).copy()
    count = len(x)
    if not count or not bits:
        return np.zeros(len(cells), np.int64)
    top = 1 << bits - 1
    bit = top
    while bit > 1:
        rest = bit - 1
        for k in range(count):
            on = (x[k] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[k]) & rest)
            x[0] ^= np.where(on, rest, swap)
            x[k] ^= swap
        bit >>= 1
    for k in range(1, count):
        x[k] ^= x[k - 1]
    turn, bit = np.zeros(x.shape[1], np.int64), top
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    keys = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for k in range(count):
            keys = keys << 1 | (x[k] >> level & 1)
    return keys


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _kept(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(row, id, label, length, values) of the rows that take part; ``row`` numbers them without order."""
    kinds = [vectors.schema[name].dataType.simpleString() for name in (id_col, label_col)]
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    rows = rows.where(F.col("vector").isNotNull()).where(finite(F.col("vector")))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in stream:
            lengths = batch.column("vector").value_lengths().to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                values = whole(matrix(part.column("vector")), scale) if length else np.empty((len(part), 0), np.int64)
                columns = [
                    pa.array(np.arange(number, number + len(part))),
                    part.column("id"),
                    part.column("label"),
                    pa.array([length] * len(part), pa.int32()),
                    pa.array([narrow(row) for row in values], pa.binary()),
                ]
                number += len(part)
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "label", "length", "values"])

    return rows.mapInArrow(batches, f"row long, id {kinds[0]}, label {kinds[1]}, length int, values binary")


def _spreads(kept: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of every component, by length. They only order pieces, so doubles do."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for length, part in _by_length(stream):
            values = _floats(wide(part.column("values").to_pylist(), length))
            own = np.stack([np.full(length, len(values), float), values.sum(axis=0), (values**2).sum(axis=0)])
            sums[length] = sums.get(length, 0) + own
        for length, own in sums.items():
            columns = [pa.array([length] * length, pa.int32()), pa.array(np.arange(length, dtype=np.int32)), *map(pa.array, own)]
            yield pa.RecordBatch.from_arrays(columns, ["length", "place", "n", "total", "squares"])

    found = kept.mapInArrow(batches, "length int, place int, n double, total double, squares double")
    found = found.groupBy("length", "place").agg(*[F.sum(x).alias(x) for x in ("n", "total", "squares")]).toPandas()
    spreads = {}
    for length, rows in found.sort_values("place").groupby("length"):
        mean = (rows["total"] / rows["n"]).to_numpy()
        with np.errstate(invalid="ignore", over="ignore"):
            spread = np.sqrt(np.maximum((rows["squares"] / rows["n"]).to_numpy() - mean**2, 0))
        spreads[int(length)] = mean, np.nan_to_num(spread, nan=0.0, posinf=0.0)
    return spreads


def _floats(values: np.ndarray) -> np.ndarray:
    """About the values, held to a size whose square is finite."""
    if values.dtype == object:
        values = np.minimum(np.maximum(values, -(10**150)), 10**150)
    return values.astype(np.float64)


def _by_length(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in stream:
        lengths = batch.column("length").to_numpy()
        for length in np.unique(lengths).tolist():
            yield length, batch.filter(pa.array(lengths == length))


def _pieces(kept: DataFrame, parts: int, spreads: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(length, part, key, row, values): every part of every row, with its place on the part's curve."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in _by_length(stream):
            values = wide(batch.column("values").to_pylist(), length)
            for part, (begin, end) in enumerate(cuts(length, parts)):
                own = values[:, begin:end]
                mean, spread = (x[begin:end] for x in spreads.get(length, (np.empty(0), np.empty(0))))
                # The widest components, each on a grid over mean +- 2.5 deviations.
                used = np.sort(np.argsort(-spread, kind="stable")[:KEY_BITS])
                bits = KEY_BITS // len(used) if len(used) else 0
                bits = min(bits, 16)
                scaled = (_floats(own[:, used]) - mean[used]) / np.maximum(5 * spread[used], 1e-300) + 0.5
                cells = np.clip(np.nan_to_num(scaled) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
                columns = [
                    pa.array([length] * len(own), pa.int32()),
                    pa.array([part] * len(own), pa.int32()),
                    pa.array(hilbert_keys(cells, bits)),
                    batch.column("row"),
                    pa.array([narrow(row) for row in own], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["length", "part", "key", "row", "values"])

    return kept.mapInArrow(batches, "length int, part int, key long, row long, values binary")


def _blocks(pieces: DataFrame, parts: int) -> DataFrame:
    """(length, part, n, rows, points, low, high, sums): pieces along the curve in flat blocks.

    The rows' numbers are part of the order, so equal pieces are dealt to many tasks too.
    """
    names = ["length", "part", "n", "rows", "points", "low", "high", "sums"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            marks = np.stack([batch.column(name).to_numpy() for name in ("length", "part")], axis=1)
            ends = [*(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            rows, values, begin, found = batch.column("row").to_numpy(), batch.column("values").to_pylist(), 0, []
            for end in ends:
                if begin == end:
                    continue
                length, part = marks[begin].tolist()
                low, high = cuts(length, parts)[part]
                points = wide(values[begin:end], high - low)
                for at in range(0, end - begin, BLOCK):
                    some = points[at : at + BLOCK]
                    totals = some.astype(object).sum(axis=0) if some.dtype == object else _sums(some)
                    own = rows[begin + at : begin + at + len(some)]
                    boxes = [narrow(x) for x in (some, some.min(axis=0), some.max(axis=0), totals)]
                    found.append((length, part, len(some), own.tobytes(), *boxes))
                begin = end
            kinds = [pa.int32()] * 3 + [pa.binary()] * 5
            columns = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)] if found else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names)

    order = ["length", "part", "key", "row"]
    sorted_pieces = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = "length int, part int, n int, rows binary, points binary, low binary, high binary, sums binary"
    return sorted_pieces.mapInArrow(batches, kind)


def _sums(points: np.ndarray) -> np.ndarray:
    """Column sums, exact: in 64 bits if no sum can leave them."""
    most = max(abs(int(points.min())), abs(int(points.max()))) if points.size else 0
    return (points if most * len(points) < 1 << 62 else points.astype(object)).sum(axis=0)


def _shortlisted(
    stream: Iterator[pa.RecordBatch], books: Codebooks
) -> Iterator[tuple[int, int, np.ndarray, pa.RecordBatch]]:
    """(length, part, shortlist, blocks) for the blocks of each Arrow batch with the same shortlist."""
    for length, batch in _by_length(stream):
        parts = batch.column("part").to_numpy()
        for part in np.unique(parts).tolist():
            own, entries = batch.filter(pa.array(parts == part)), books[length][part]
            low, high = (wide(own.column(name).to_pylist(), entries.shape[1]) for name in ("low", "high"))
            short = shortlists(low, high, entries)
            # A row of the table of shortlists for each block; equal rows belong together.
            lists, of = np.unique(short, axis=0, return_inverse=True)
            for k, chosen in enumerate(lists):
                yield length, part, np.flatnonzero(chosen), own.filter(pa.array(of.ravel() == k))


def _round(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after every piece has gone to its nearest entry and the entries to the means."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for length, part, short, own in _shortlisted(stream, books):
            entries = books[length][part]
            columns = entries.shape[1]
            # The last column counts.
            sums = totals.setdefault((length, part), np.zeros((len(entries), columns + 1), object))
            if len(short) == 1:
                sums[short[0], :-1] += wide(own.column("sums").to_pylist(), columns).astype(object).sum(axis=0)
                sums[short[0], -1] += int(own.column("n").to_numpy().sum())
                continue
            points = wide(own.column("points").to_pylist(), columns)
            points = points if columns else np.empty((int(own.column("n").to_numpy().sum()), 0), np.int64)
            best, _ = nearest(points, entries[short])
            for k, entry in enumerate(short.tolist()):
                some = points[best == k]
                sums[entry, :-1] += _sums(some).astype(object)
                sums[entry, -1] += len(some)
        found = [
            (length, part, entry, place, digit, value)
            for (length, part), sums in totals.items()
            for (entry, place), total in np.ndenumerate(sums)
            for digit, value in enumerate(_digits(int(total)))
        ]
        names = ["length", "part", "entry", "place", "digit", "value"]
        for begin in range(0, len(found), 1 << 16):
            columns = zip(*found[begin : begin + (1 << 16)], strict=True)
            kinds = [pa.int32()] * 5 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names)

    kind = "length int, part int, entry int, place int, digit int, value long"
    summed = blocks.mapInArrow(batches, kind).groupBy("length", "part", "entry", "place", "digit").agg(F.sum("value").alias("value"))
    totals = {length: [np.zeros((len(x), x.shape[1] + 1), object) for x in book] for length, book in books.items()}
    for length, part, entry, place, digit, value in zip(*(x.to_pylist() for x in summed.toArrow().columns), strict=True):
        totals[length][part][entry, place] += value << DIGIT * digit
    return {length: [_means(x, y) for x, y in zip(book, totals[length], strict=True)] for length, book in books.items()}


def _digits(total: int) -> list[int]:
    """Digits of a whole number, least first, all with its sign."""
    sign, rest, digits = (-1 if total < 0 else 1), abs(total), []
    while rest:
        digits.append(sign * (rest & (1 << DIGIT) - 1))
        rest >>= DIGIT
    return digits


def _means(entries: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """floor(sum / count) of every entry that is used; the others stay."""
    rows = [[x // row[-1] for x in row[:-1]] if row[-1] else old for row, old in zip(totals.tolist(), entries.tolist(), strict=True)]
    return _array(rows, entries.shape[1])


def _array(rows: list[list[int]], columns: int) -> np.ndarray:
    """Rows of integers, in 64 bits where they do."""
    fits = all(abs(x) < 1 << 62 for row in rows for x in row)
    return np.array(rows, np.int64 if fits else object).reshape(len(rows), columns)


def _first_codebooks(kept: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the rows of least ids, of each length; the rows of equal ids by their content."""
    order = Window.partitionBy("length").orderBy(F.col("id").asc_nulls_last(), "values", "row")
    first = kept.withColumn("place", F.row_number().over(order)).where(F.col("place") <= entries)
    books: dict[int, list[bytes]] = {}
    for length, values, _ in sorted(first.select("length", "values", "place").collect(), key=lambda x: (x[0], x[2])):
        books.setdefault(length, []).append(bytes(values))
    found: Codebooks = {}
    for length, blobs in books.items():
        rows = wide(blobs, length)
        found[length] = [_array(rows[:, a:b].tolist(), b - a) for a, b in cuts(length, parts)]
    return found


def fit_codebooks(blocks: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """Codebooks after so many rounds over all blocks."""
    for _ in range(rounds):
        books = _round(blocks, books)
    return books


def _assigned(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(row, part, entry, distance): the nearest entry of every piece; a distance beyond 64 bits is null."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, part, short, own in _shortlisted(stream, books):
            entries = books[length][part]
            rows = np.frombuffer(b"".join(own.column("rows").to_pylist()), np.int64)
            points = wide(own.column("points").to_pylist(), entries.shape[1])
            points = points if entries.shape[1] else np.empty((len(rows), 0), np.int64)
            best, far = nearest(points, entries[short])
            if far.dtype == object:
                far = pa.array([x if x <= _LONG else None for x in map(int, far)], pa.int64())
            columns = [pa.array(rows), pa.array([part] * len(rows), pa.int32()), pa.array(short[best].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(far.astype(np.int64)) if isinstance(far, np.ndarray) else far], names)

    names = ["row", "part", "entry", "distance"]
    return blocks.mapInArrow(batches, "row long, part int, entry int, distance long")


def digest(book: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place, joined by commas."""
    numbers = (str(x) for entries in book for row in entries.tolist() for x in row)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def encode_vectors(
    vectors: DataFrame,
    *,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    look: Callable[[Codebooks], None] | None = None,
) -> DataFrame:
    """Return vec_id, code, error, label_error and codebooks_sha256 for every vector that takes part.

    Components become floor(scale * x). A part's codebook begins as that part of the ``entries`` rows of
    least id and goes through ``rounds`` of means, rounded down; entries that nothing goes to stay, and of
    equally near entries the first counts. ``code`` has two hexadecimal digits for each part (up to 256
    entries), ``error`` is the squared distance to the entries, ``label_error`` its sum over all rows of the
    label, nulls together. ``look`` is called with the final codebooks.

    Rows whose vector is null or holds a null or non-finite component are left out; all others stay, also
    repeated rows, and rows of null id, which are the last to begin a codebook. Vectors of each length have
    codebooks of their own; a length that ``parts`` does not divide is cut as equally as possible, and an
    empty vector has error 0. Sums are exact at any size; an error beyond 64 bits is null. With fewer rows
    than entries, there are as many entries as rows. An empty table returns no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits, so 1 to 256 entries")
    spark = vectors.sparkSession
    kept = _written(_kept(vectors, scale, id_col, vector_col, label_col), "code-rows")
    books = _first_codebooks(kept, parts, entries)
    blocks = _written(_blocks(_pieces(kept, parts, _spreads(kept)), parts), "code-blocks")
    books = fit_codebooks(blocks, books, rounds)
    if look:
        look(books)

    def of(part: int):
        return F.lower(F.lpad(F.hex(F.max(F.when(F.col("part") == part, F.col("entry"))).cast("long")), 2, "0"))

    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_row = _assigned(blocks, books).groupBy("row").agg(
        F.concat(*[of(part) for part in range(parts)]).alias("code"),
        F.when(F.count("distance") == parts, _long(total)).alias("error"),
    )
    hashes = spark.createDataFrame([(length, digest(book)) for length, book in books.items()], "length int, codebooks_sha256 string")
    coded = kept.select("row", "id", "label", "length").join(by_row, "row").join(F.broadcast(hashes), "length")
    coded = _written(coded.select("row", "id", "label", "code", "error", "codebooks_sha256"), "codes")
    summed = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = coded.groupBy("label").agg(F.when(F.count("error") == F.count(F.lit(1)), _long(summed)).alias("label_error"))
    by_label = _written(by_label.withColumnRenamed("label", "of"), "code-labels")
    if by_label.count() <= SENT:
        result = coded.join(F.broadcast(by_label), F.col("label").eqNullSafe(F.col("of")))
    else:  # a label may have a large share of all rows
        salted = by_label.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salts = coded.withColumn("of_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        result = salts.join(salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("of_salt") == F.col("salt")))
    return result.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _long(total):
    return F.when(total <= F.lit(_LONG).cast(T.DecimalType(38, 0)), total.cast("long"))
