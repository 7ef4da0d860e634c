"""Vector searches against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from quayside.llm.bitsliced import BitSlices, top_products
from quayside.llm.posting_lists import nearest_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score int, list int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0, "x", 1, 2, 3) for k, v in rows], SCHEMA)


def usable(rows):
    return [(k, np.array(v, float)) for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v)]


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(1)
    rows = [(int(k), random.normal(size=8).astype(np.float32).tolist()) for k in range(400)]
    same = rows[17][1]
    rows += [(int(k), same) for k in range(400, 700)]  # one vector, many times
    odd = [(700, None), (701, []), (702, [1.0, None] + [0.0] * 6), (703, [float("nan")] * 8), (704, [float("inf")] * 8)]
    return rows + odd + [(None, same), (706, [0.0] * 8), (720, [0.0] * 8), (750, [1e20] * 8)]


def products(rows, each, count):
    kept = [(k, np.array([math.floor(256 * x) for x in v], object)) for k, v in usable(rows)]
    found = []
    for query, own in kept:
        if query % each == 0:
            best = sorted((-int(own @ other), k) for k, other in kept if k != query and len(other) == len(own))[:count]
            found += [(query, rank, k, -score if -(1 << 63) <= -score < 1 << 63 else None) for rank, (score, k) in enumerate(best, 1)]
    return sorted(found)


def test_products_are_exact(spark, rows):
    found = sorted(map(tuple, top_products(frame(spark, rows)).collect()))
    assert found == products(rows, 50, 5)


def test_products_over_several_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr("quayside.llm.bitsliced.ROWS", 100)
    monkeypatch.setattr("quayside.llm.bitsliced.QUERIES", 4)
    found = sorted(map(tuple, top_products(frame(spark, rows), queries_each=25, count=9).collect()))
    assert found == products(rows, 25, 9)


def test_products_of_large_components(spark):
    """Integers far beyond 2^31, whose products fit a long or do not."""
    few = [(0, [4e6, 1.0] + [0.0] * 62), (50, [3e6, 1.0] + [0.0] * 62), (100, [1.0, 4e6] + [-1.0] * 62), (150, [-5e14, 1e13] + [0.5] * 62)]
    few += [(k, [float(k) * 1e5, 1.0] + [0.0] * 62) for k in range(1, 20)] + [(200, [1e37, -1e37] + [1e-3] * 62), (250, [9e18, 1.0] * 32)]
    few = [(k, np.array(v, np.float32).tolist()) for k, v in few]
    found = sorted(map(tuple, top_products(frame(spark, few)).collect()))
    assert found == products(few, 50, 5)
    assert any(x[3] is None for x in found)


def test_a_row_repeated_many_times(spark, monkeypatch):
    monkeypatch.setattr("quayside.llm.bitsliced.ROWS", 500)
    random = np.random.default_rng(4)
    many = [(int(k), random.normal(size=4).tolist()) for k in range(200)] + [(207, [1.0, 2.0, 3.0, 4.0])] * 10_000
    found = sorted(map(tuple, top_products(frame(spark, many), count=3).collect()))
    assert found == products(many, 50, 3)


def test_fewer_candidates_than_asked(spark):
    few = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (3, [-1.0, 0.0]), (100, [1.0, 2.0, 3.0])]
    found = sorted(map(tuple, top_products(frame(spark, few)).collect()))
    assert found == [(0, 1, 50, 81920), (0, 2, 3, -65536), (50, 1, 0, 81920), (50, 2, 3, -65536)]
    near = sorted(map(tuple, nearest_vectors(frame(spark, few)).collect()))
    assert [x[:3] for x in near] == [(0, 1, 50), (0, 2, 3)]


def test_vectors_of_every_length_are_found(spark, monkeypatch):
    monkeypatch.setattr("quayside.llm.posting_lists.RARE", 60)
    random = np.random.default_rng(9)
    mixed = [(k, random.normal(size=length).tolist()) for length, first, rows in ((4, 0, 90), (6, 100, 70), (3, 200, 41), (2, 300, 1), (5, 400, 3)) for k in range(first, first + rows)]
    mixed += [(200, mixed[170][1]), (400, [1.0, 0.0, 0.0, 0.0, 0.5])]
    mixed = [(k, np.array(v, np.float32).tolist()) for k, v in mixed]
    found = nearest_vectors(frame(spark, mixed), count=3).toPandas()
    kept = [(k, np.array(v)) for k, v in mixed]
    hits = total = 0
    for query in sorted({k for k, _ in kept if k % 20 == 0}):
        scores: dict[int, float] = {}
        for own in (v for k, v in kept if k == query):
            for k, v in kept:
                if k != query and len(v) == len(own):
                    scores[k] = max(scores.get(k, -np.inf), float(own @ v))
        best = sorted(scores, key=lambda k: (-scores[k], k))[:3]
        got = found[found["query_id"] == query].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, len(best) + 1))
        assert all(abs(scores[k] - score) < 1e-9 for k, score in zip(got["vec_id"], got["score"], strict=True))
        hits, total = hits + len(set(best) & set(got["vec_id"])), total + len(best)
        if 200 <= query:
            assert got["vec_id"].tolist() == best
    assert total and hits / total >= 0.9


def test_slices_of_one_value():
    index = BitSlices(np.array([5, 3]), np.array([[7], [7]]))
    assert index.top(np.array([-2]), 5, 3) == [(5, -14)]
    assert index.top(np.array([0]), 1, 99) == [(3, 0)]


@pytest.mark.parametrize("search", [top_products, nearest_vectors])
def test_empty_tables(spark, search):
    assert search(frame(spark, [])).count() == 0
    assert search(frame(spark, [(0, None), (20, [float("nan")])])).count() == 0


def test_neighbours_of_odd_rows(spark, rows):
    some = [row for row in rows if row[0] != 750]
    kept = [(k, v) for k, v in usable(some) if v.any()]
    ids, matrix = np.array([k for k, _ in kept]), np.stack([v for _, v in kept])
    found = nearest_vectors(frame(spark, some)).toPandas()
    asked = [k for k in ids if k % 20 == 0]
    assert sorted(found["query_id"].unique()) == asked
    hits = 0
    for query in asked:
        own = found[found["query_id"] == query].sort_values("rank")
        scores = matrix @ matrix[ids == query][0]
        assert own["rank"].tolist() == list(range(1, 21))
        assert np.allclose(own["score"], [scores[ids == k][0] for k in own["vec_id"]], atol=1e-9)
        order = list(zip(-own["score"], own["vec_id"], strict=True))
        assert order == sorted(order)
        best = sorted(zip(-scores[ids != query], ids[ids != query], strict=True))[:20]
        hits += (own["score"] >= -best[-1][0] - 1e-9).sum()
    assert hits >= 0.9 * 20 * len(asked)


def test_recall_on_the_table(spark):
    from quayside.llm.queries import table

    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.toPandas().sort_values("vec_id")
    matrix, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    found = nearest_vectors(vectors).toPandas()
    hits = 0
    for query in ids[ids % 20 == 0]:
        scores = matrix @ matrix[ids == query][0]
        scores[ids == query] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]]) & set(found[found["query_id"] == query]["vec_id"]))
    assert hits >= 0.9 * len(found)


def test_recall_is_that_asked_for(spark):
    from quayside.llm.queries import table

    vectors = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = vectors.toPandas()
    ids, matrix = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    found = nearest_vectors(vectors).toPandas()
    hits = 0
    for query in ids[ids % 20 == 0]:
        scores = matrix @ matrix[ids == query][0]
        scores[ids == query] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]]) & set(found[found["query_id"] == query]["vec_id"]))
    assert hits >= 0.96 * 20 * (ids % 20 == 0).sum()


@pytest.mark.parametrize("equal", [True, False])
def test_a_repeated_id_takes_one_place(spark, equal):
    """Thirty rows of one id near all queries, as one vector and as different ones, in a single list."""
    random = np.random.default_rng(3)
    base = random.normal(size=8)
    some = [(k, base + random.normal(size=8)) for k in (0, 20, *range(1, 13))]
    some += [(777, base * 5 if equal else base * (5 + k / 100)) for k in range(30)]
    found = nearest_vectors(frame(spark, [(k, v.tolist()) for k, v in some]), count=5).toPandas()
    for query, vector in some[:2]:
        best = {}
        for k, v in some:
            if k != query:
                best[k] = max(best.get(k, -np.inf), v @ vector)
        own = found[found["query_id"] == query].sort_values("rank")
        assert own["vec_id"].tolist() == sorted(best, key=lambda k: (-best[k], k))[:5]
        assert np.allclose(own["score"], sorted(best.values())[:-6:-1])
