"""Product codes against plain rounds of means in Python's integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from quayside.llm import vector_codes
from quayside.llm.vector_codes import cuts, encode_vectors, hilbert_keys, narrow, nearest, shortlists, whole, wide

SCHEMA = "vec_id long, embedding array<double>, label int, code int, error string, row long, length int, part int"


def plain(rows: list[tuple], parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> list[tuple]:
    kept = [x for x in rows if x[1] is not None and all(c is not None and math.isfinite(c) for c in x[1])]
    lengths = sorted({len(x[1]) for x in kept})
    coded, by_label = [], defaultdict(int)

    def exact(x: float) -> int:
        scaled = x * scale
        return math.floor(scaled) if math.isfinite(scaled) else int(x) * scale

    for length in lengths:
        own = [(x[0], [exact(c) for c in x[1]], x[2]) for x in kept if len(x[1]) == length]
        first = sorted(own, key=lambda x: (x[0] is None, x[0] or 0))[:entries]
        spans = cuts(length, parts)
        books = [[list(x[1][a:b]) for x in first] for a, b in spans]

        def near(book, piece):
            return min((sum((p - q) ** 2 for p, q in zip(piece, entry, strict=True)), k) for k, entry in enumerate(book))

        for _ in range(rounds):
            for part, (a, b) in enumerate(spans):
                goes = defaultdict(list)
                for _, values, _ in own:
                    goes[near(books[part], values[a:b])[1]].append(values[a:b])
                for k, pieces in goes.items():
                    books[part][k] = [sum(column) // len(pieces) for column in zip(*pieces, strict=True)]
        digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
        for name, values, label in own:
            found = [near(books[part], values[a:b]) for part, (a, b) in enumerate(spans)]
            error = sum(x[0] for x in found)
            by_label[label] += error
            coded.append((name, "".join(f"{x[1]:02x}" for x in found), error, label, digest))
    long = lambda x: x if x < 1 << 63 else None
    return sorted(((n, c, long(e), long(by_label[label]), d) for n, c, e, label, d in coded), key=repr)


def encoded(spark, rows, **how) -> list[tuple]:
    frame = spark.createDataFrame([(*x[:3], 1, "e", 2, 3, 4) for x in rows], SCHEMA).repartition(3)
    found = encode_vectors(frame, **how)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(x) for x in found.collect()), key=repr)


def drawn(seed: int, rows: int, length: int, size: float = 1.0) -> list[tuple]:
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, size, (6, length))
    return [(k, (centres[draw.integers(6)] + draw.normal(0, size / 5, length)).tolist(), int(draw.integers(3)) or None) for k in range(rows)]


def test_as_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 8)
    rows = drawn(1, 300, 16)
    assert encoded(spark, rows) == plain(rows)
    assert encoded(spark, rows, parts=3, entries=5, rounds=2, scale=10) == plain(rows, 3, 5, 2, 10)


def test_a_hot_vector_and_many_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "SENT", 2)
    rows = drawn(2, 60, 8)
    rows += [(1000 + k, rows[3][1], 7) for k in range(400)]
    assert encoded(spark, rows) == plain(rows)


def test_rows_that_take_no_part_and_odd_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = drawn(3, 40, 16) + [(100, None, 1), (101, [1.0, None] * 8, 1), (102, [nan] * 16, 1), (103, [inf] * 16, 1)]
    rows += [(200 + k, [float(k), 1.0, -2.5 * k], None) for k in range(5)] + [(300, [], 1), (301, [], None)]
    rows += [(None, drawn(4, 1, 16)[0][1], 2)]
    found = encoded(spark, rows)
    assert found == plain(rows)
    assert {100, 101, 102, 103}.isdisjoint({x[0] for x in found})
    assert ("300" in {str(x[0]) for x in found}) and len(found) == 40 + 5 + 2 + 1


def test_repeated_rows_each_count(spark):
    rows = drawn(5, 30, 8)
    rows += rows[:10]
    assert encoded(spark, rows) == plain(rows)


def test_sums_beyond_64_bits(spark):
    for size in (3e4, 1e8, 1e15, 1e200, 1e307):
        rows = drawn(6, 40, 8, size)
        assert encoded(spark, rows, entries=4) == plain(rows, entries=4)


def test_no_rows(spark):
    assert encoded(spark, []) == []
    assert encoded(spark, [(1, None, 1)]) == []


def test_too_many_entries(spark):
    with pytest.raises(ValueError, match="two hexadecimal digits"):
        encoded(spark, drawn(1, 3, 8), entries=257)


@pytest.mark.parametrize("size", [50, 1 << 28, 1 << 40])
def test_shortlists_hold_every_nearest_entry(size):
    draw = np.random.default_rng(7)
    for _ in range(20):
        points, entries = draw.integers(-size, size, (30, 4)), draw.integers(-size, size, (6, 4))
        centre = draw.integers(-size, size, 4)
        points = centre + points // 8
        short = shortlists(points.min(axis=0)[None], points.max(axis=0)[None], entries)[0]
        best, far = nearest(points, entries)
        exact = ((points.astype(object)[:, None] - entries.astype(object)) ** 2).sum(axis=2)
        assert best.tolist() == [row.index(min(row)) for row in exact.tolist()]
        assert [int(x) for x in far] == [min(row) for row in exact.tolist()]
        assert short[best].all()


def test_hilbert_keys_are_one_walk_through_neighbours():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_integers_as_bytes():
    for values in ([[1, -2]], [[300, -40_000]], [[1 << 40, 5]], [[-(1 << 61), 0]]):
        assert wide([narrow(np.array(values[0], np.int64))], 2).tolist() == values
    mixed = [narrow(np.array([1, 2])), narrow(np.array([1 << 20, 2])), narrow(np.array([10**30, -5], object))]
    assert wide(mixed[:2], 2).tolist() == [[1, 2], [1 << 20, 2]]
    assert wide(mixed, 2).tolist() == [[1, 2], [1 << 20, 2], [10**30, -5]]
    assert whole(np.array([[1.5, -0.1, 1e300]]), 10).tolist() == [[15, -1, int(np.floor(1e300 * 10))]]
