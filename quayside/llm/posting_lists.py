"""Approximate nearest neighbours by balanced posting lists.

Centroids of a bounded sample are balanced by splitting large clusters. Every vector goes to the list
of its nearest centroid, and vectors near a boundary also to further lists whose centroids are about
as near but lie in another direction. A query walks a neighbour graph of the centroids in memory and
reads the lists whose distance is within a ratio of the nearest one's; their vectors are scored
exactly. Inner products become distances by one more component that evens out all lengths.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.vectors import matrix, usable
from quayside.session import scratch_path

#: Vectors of a shelf, some lists that a task holds at a time; larger lists are split by a hash.
SHELF = 16_384
#: Most vectors of a length, other than the commonest, that are compared without an index.
RARE = 1024
#: Queries that read one copy of a shelf; more of them read further copies.
READERS = 4096
#: Queries that a task walks the graph for, if there are tasks enough.
WALKERS = 64


@dataclass
class Centroids:
    """Centroids of lists, their neighbour graph, and the length that evens vectors out."""

    points: np.ndarray
    graph: list[np.ndarray]
    longest: float

    def evened(self, vectors: np.ndarray) -> np.ndarray:
        vectors = vectors / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (vectors**2).sum(axis=1)))
        return np.hstack([vectors, rest[:, None]])

    def assigned(self, vectors: np.ndarray, replicas: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list, and up to ``replicas`` in all within ``ratio`` of its distance.

        A list is passed over if its centroid is nearer to a chosen one than to the vector.
        """
        far = _distances(self.evened(vectors), self.points)
        order = np.argsort(far, axis=1, kind="stable")[:, : 4 * replicas]
        near = np.take_along_axis(far, order, axis=1)
        between = _distances(self.points, self.points)
        rows, lists = [np.arange(len(vectors))], [order[:, 0]]
        chosen = [order[:, 0]]
        count = np.ones(len(vectors), int)
        for k in range(1, order.shape[1]):
            fits = (near[:, k] <= ratio**2 * near[:, 0] + 1e-12) & (count < replicas)
            for before in chosen:
                fits &= (before < 0) | (between[order[:, k], before] > near[:, k])
            rows.append(np.flatnonzero(fits))
            lists.append(order[fits, k])
            chosen.append(np.where(fits, order[:, k], -1))
            count += fits
        return np.concatenate(rows), np.concatenate(lists)

    def nearest(self, query: np.ndarray, width: int) -> list[tuple[float, int]]:
        """Centroids near a query, nearest first, by a best-first walk that keeps ``width`` of them."""
        seen = np.zeros(len(self.points), bool)
        entries = np.unique(np.linspace(0, len(self.points) - 1, 8).astype(int))
        seen[entries] = True
        far = ((self.points[entries] - query) ** 2).sum(axis=1)
        ahead = [(d, int(k)) for d, k in zip(far, entries, strict=True)]
        heapq.heapify(ahead)
        best = [(-d, k) for d, k in ahead]
        heapq.heapify(best)
        while ahead:
            d, k = heapq.heappop(ahead)
            if len(best) >= width and d > -best[0][0]:
                break
            new = self.graph[k][~seen[self.graph[k]]]
            seen[new] = True
            for e, j in zip(((self.points[new] - query) ** 2).sum(axis=1).tolist(), new.tolist(), strict=True):
                if len(best) < width or e < -best[0][0]:
                    heapq.heappush(ahead, (e, j))
                    heapq.heappush(best, (-e, j))
                    if len(best) > width:
                        heapq.heappop(best)
        return sorted((-d, k) for d, k in best)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T)


def _halves(points: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Halves of points, as equal as the distances to two means allow: cut at the median difference."""
    means = points[random.choice(len(points), 2, replace=False)]
    side = np.arange(len(points)) % 2 == 0
    for _ in range(6):
        gap = points @ (means[1] - means[0])
        order = np.argsort(gap, kind="stable")
        side = np.zeros(len(points), bool)
        side[order[len(points) // 2 :]] = True
        means = np.stack([points[~side].mean(axis=0), points[side].mean(axis=0)])
    return side


def fit_centroids(
    rows: DataFrame, *, replicas: int, boundary: float, sample: int = 20_000, most: int = 4096, links: int = 16, seed: int = 5
) -> tuple[Centroids, np.ndarray]:
    """Centroids for the vectors of ``rows`` (id, vector), and the vectors of the sample they come from.

    At most ``sample`` rows are drawn, by a hash. There are half as many lists as the root of the
    number of rows, ``most`` at most. Clusters of the sample are halved until there are so many, the
    largest first; a few rounds of means then move the centroids.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    stats = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(square).alias("square")).first()
    drawn = rows.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(sample).select("vector").toArrow()
    vectors = matrix(drawn.column("vector"))
    longest = max(float(stats["square"]) ** 0.5, 1e-300)
    points = np.unique(Centroids(vectors, [], longest).evened(vectors), axis=0)
    wanted = max(1, min(most, int(stats["rows"] ** 0.5 / 2), len(points) // 4))
    random = np.random.default_rng(seed)
    clusters = [(-len(points), 0, np.arange(len(points)))]
    for number in range(1, 2 * wanted, 2):
        if len(clusters) >= wanted or len(clusters[0][2]) < 2:
            break
        own = heapq.heappop(clusters)[2]
        side = _halves(points[own], random)
        for more, half in enumerate((own[side], own[~side])):
            heapq.heappush(clusters, (-len(half), number + more, half))
    centroids = np.stack([points[own].mean(axis=0) for _, _, own in clusters])
    for _ in range(4):
        near = _distances(points, centroids).argmin(axis=1)
        sums = np.stack([np.bincount(near, points[:, k], len(centroids)) for k in range(points.shape[1])], axis=1)
        count = np.bincount(near, minlength=len(centroids))
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
        # On the sphere of the evened vectors, where centroids are no nearer to each other than to them.
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    near = np.argsort(_distances(centroids, centroids), axis=1, kind="stable")[:, 1 : links + 1]
    graph = [set(row) for row in near.tolist()]
    for k, row in enumerate(near.tolist()):
        for other in row:  # both ways, so that every centroid can be reached
            graph[other].add(k)
    return Centroids(centroids, [np.array(sorted(x), np.intp) for x in graph], longest), vectors


def calibrated(index: Centroids, vectors: np.ndarray, *, count: int, replicas: int, boundary: float, target: float) -> tuple[float, int]:
    """The distance ratio that finds ``target`` of the sample's true neighbours, and the walk's width for it.

    Up to 256 different vectors ask, and different ones are found, whatever share one has of the rows;
    the sample is sparser than all rows, so its neighbours are farther.
    """
    vectors = np.unique(vectors, axis=0)
    asked = vectors[:: max(1, len(vectors) // 256)][:256]
    of, lists = index.assigned(vectors, replicas, boundary)
    queries = np.hstack([asked / index.longest, np.zeros((len(asked), 1))])
    far = np.sqrt(_distances(queries, index.points))
    nearest = np.maximum(far.min(axis=1), 1e-12)
    best = np.argsort(-(asked @ vectors.T), axis=1, kind="stable")[:, : count + 1]
    starts = np.searchsorted(of[order := np.argsort(of, kind="stable")], np.arange(len(vectors) + 1))
    lists = lists[order]
    needed = [min(far[q, lists[starts[row] : starts[row + 1]]]) / nearest[q] for q in range(len(asked)) for row in best[q]]
    ratio = float(np.quantile(needed, target)) + 1e-9
    return ratio, int(np.quantile((far <= ratio * nearest[:, None]).sum(axis=1), 0.95)) + 8


def nearest_vectors(
    vectors: DataFrame,
    *,
    queries_each: int = 20,
    count: int = 20,
    replicas: int = 4,
    boundary: float = 1.1,
    recall: float = 0.97,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Return query_id, rank, vec_id and score: near rows for each id divisible by ``queries_each``.

    Nearness is the inner product in double precision, added up in the order of the components. All
    rows are indexed; rows of the query's own id are no candidates, and of repeated ids the best row
    counts. Equal scores are ranked by id. Rows of null id, null, empty or zero vectors, or null or
    non-finite components take no part. Vectors meet only vectors of their length; the commonest length
    and every one of more than RARE rows has an index of its own, and the rows of a rarer one are compared
    with each other. A query reads the lists within a distance ratio calibrated to ``recall`` on the sample, and more
    until they hold eight times as many ids as it asks for, or all rows.
    """
    rows = usable(vectors, id_col, vector_col).withColumn("id", F.col("id").cast("long"))
    rows = rows.where(F.exists("vector", lambda x: x != 0)).withColumn("length", F.size("vector"))
    counted = rows.groupBy("length").count().orderBy(F.desc("count"), "length")
    commonest = counted.limit(1).collect()
    large = {row["length"] for row in commonest + counted.where(F.col("count") > RARE).collect()}
    rare = rows.where(~F.col("length").isin(large)) if large else rows
    partial = _compared(rare, queries_each, count)
    for length in sorted(large):
        own = rows.where(F.col("length") == length).select("id", "vector")
        partial = partial.unionByName(_found(own, queries_each, count, replicas, boundary, recall))
    once = partial.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _compared(rows: DataFrame, queries_each: int, count: int) -> DataFrame:
    """The best rows of every query among (id, vector, length), at most RARE of a length, by all inner products."""

    def search(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, points = group.column("id").to_numpy(), matrix(group.column("vector"))
        firsts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        asked = np.flatnonzero(ids % queries_each == 0)
        found: list[tuple] = []
        for begin in range(0, len(asked), 64):
            some = asked[begin : begin + 64]
            scores = np.zeros((len(some), len(ids)))
            for k in range(points.shape[1]):  # in the order of the components
                scores += points[some, k, None] * points[:, k]
            by_id = np.maximum.reduceat(scores, firsts, axis=1)
            for query, near in zip(ids[some].tolist(), by_id, strict=True):
                others = np.flatnonzero(ids[firsts] != query)
                best = others[np.argsort(-near[others], kind="stable")[:count]]
                found += [(query, other, score) for other, score in zip(ids[firsts][best].tolist(), near[best].tolist(), strict=True)]
        columns = list(zip(*found, strict=True)) or [()] * 3
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])

    kept = rows.select("length", "id", "vector")
    return kept.groupBy("length").applyInArrow(search, "query_id long, vec_id long, score double")


def _found(rows: DataFrame, queries_each: int, count: int, replicas: int, boundary: float, recall: float) -> DataFrame:
    """Near rows of every query among (id, vector) of one length, by posting lists."""
    spark = rows.sparkSession
    index, sample = fit_centroids(rows, replicas=replicas, boundary=boundary)
    pruning, width = calibrated(index, sample, count=count, replicas=replicas, boundary=boundary, target=recall)
    postings = _written(_posted(rows.distinct(), index, replicas, boundary), "postings")

    # Whole lists share a shelf, in the order of their numbers; a large one has shelves of its own.
    sizes, ids = np.zeros((2, len(index.points)), np.int64)
    counts = postings.groupBy("list", "id").count().groupBy("list").agg(F.sum("count"), F.count(F.lit(1)))
    for number, size, different in counts.toPandas().itertuples(index=False):
        sizes[number], ids[number] = size, different
    first, parts, filled, shelf = np.zeros_like(sizes), np.maximum(1, -(-sizes // SHELF)), 0, 0
    for number, size in enumerate(sizes.tolist()):
        if parts[number] > 1 or filled + size > SHELF:
            shelf, filled = shelf + 1, 0
        first[number] = shelf
        filled += size
        if parts[number] > 1:
            shelf, filled = shelf + int(parts[number]), 0
    # One row for each list, as many as fit_centroids allows.
    places = spark.createDataFrame(
        list(zip(range(len(sizes)), first.tolist(), parts.tolist(), strict=True)), "list int, first long, parts long"
    )
    shelved = postings.join(F.broadcast(places), "list").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).alias("shelf"), "id", F.array("list").alias("lists"), "vector"
    )
    asked = rows.where(F.col("id") % queries_each == 0).distinct()
    # Small as they are, the queries walk in many tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    asked = asked.repartition(max(1, min(tasks, -(-asked.count() // WALKERS))), "id", "vector")
    probes = _written(_probes(asked, index, ids, first, parts, pruning, width, 8 * count), "probes")

    copies = probes.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / READERS).cast("int").alias("copies"))
    read = probes.join(copies, "shelf").withColumn("copy", F.pmod(F.xxhash64("id", "vector"), F.col("copies")).cast("int"))
    kept = shelved.join(copies, "shelf").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    fields = ["shelf", "copy", "role", "id", "lists", "vector"]
    met = kept.withColumn("role", F.lit(0)).select(fields).unionByName(read.withColumn("role", F.lit(1)).select(fields))
    met = met.repartition("shelf", "copy").sortWithinPartitions("shelf", "copy", "role", "id")
    return _scored(met, count)


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _posted(rows: DataFrame, index: Centroids, replicas: int, boundary: float) -> DataFrame:
    """(list, id, vector) of every row, once for each of its lists."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for begin in range(0, len(batch), 2048):
                part = batch.slice(begin, 2048)
                of, lists = index.assigned(matrix(part.column("vector")), replicas, boundary)
                taken = part.take(pa.array(of))
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *taken.columns], ["list", "id", "vector"])

    return rows.mapInArrow(batches, "list int, id long, vector array<double>")


def _probes(
    asked: DataFrame, index: Centroids, sizes: np.ndarray, first: np.ndarray, parts: np.ndarray, pruning: float, width: int, least: int
) -> DataFrame:
    """(shelf, id, lists, vector): for each query the shelves to read, and the lists there."""

    def chosen(vector: np.ndarray) -> dict[int, list[int]]:
        query = np.append(vector / index.longest, 0.0)
        near = index.nearest(query, min(width, len(index.points)))
        if sizes[[k for _, k in near]].sum() < least:
            near = sorted(zip(_distances(query[None], index.points)[0].tolist(), range(len(index.points)), strict=True))
        held, shelves = 0, {}
        for distance, k in near:
            if distance > pruning**2 * near[0][0] and held >= least:
                break
            held += int(sizes[k])
            for shelf in range(int(first[k]), int(first[k] + parts[k])):
                shelves.setdefault(shelf, []).append(k)
        return shelves

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for begin in range(0, len(batch), 1024):
                some = batch.slice(begin, 1024)
                found = [(row, *x) for row, vector in enumerate(matrix(some.column("vector"))) for x in chosen(vector).items()]
                taken = some.take(pa.array([x[0] for x in found], pa.int64()))
                columns = [pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*columns, *taken.columns], ["shelf", "lists", "id", "vector"])

    return asked.mapInArrow(batches, "shelf long, lists array<int>, id long, vector array<double>")


def _firsts(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """True where an id stands for the first time in its row."""
    order = np.lexsort((ids, rows))
    new = np.ones(len(rows), bool)
    new[order[1:]] = (rows[order][1:] != rows[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    return new


def _scored(met: DataFrame, count: int) -> DataFrame:
    """The best rows of each query on each shelf; a shelf's vectors come before its queries."""

    def best_of(queries: pa.RecordBatch, ids: np.ndarray, lists: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
        asking, wanted = queries.column("id").to_numpy(), queries.column("lists")
        of = np.repeat(np.arange(len(queries)), np.diff(wanted.offsets.to_numpy()))
        wanted, points = wanted.flatten().to_numpy(), matrix(queries.column("vector"))
        # Matrix products may differ in the last bits; what they leave near the best is scored anew.
        slack = 1e-9 * (1 + np.abs(points).max()) * (1 + np.abs(vectors).max()) * points.shape[1]
        found: list[list[np.ndarray]] = [[], [], []]
        for number in np.unique(wanted):
            readers, own = of[wanted == number], np.flatnonzero(lists == number)
            near = points[readers] @ vectors[own].T
            near[asking[readers][:, None] == ids[own]] = -np.inf
            # The list's best ids, each by the best of its rows; a shelf is in the order of ids.
            firsts = np.flatnonzero(np.append(True, ids[own][1:] != ids[own][:-1])) if len(own) else own
            by_id = np.maximum.reduceat(near, firsts, axis=1) if len(firsts) < len(own) else near
            least = np.partition(by_id, -count, axis=1)[:, -count, None] if len(firsts) > count else -np.inf
            wide = np.repeat(by_id, np.diff(np.append(firsts, len(own))), axis=1) if len(firsts) < len(own) else near
            at = np.nonzero((near >= np.maximum(least, wide) - slack) & (near > -np.inf))
            for into, part in zip(found, (readers[at[0]], own[at[1]], near[at]), strict=True):
                into.append(part)
        rows, others, near = (np.concatenate(x) for x in found)
        order = np.lexsort((-near, rows))
        rows, others, near = rows[order], others[order], near[order]
        # An id may be there once for each of its lists and rows, so its first place counts.
        firsts = _firsts(rows, ids[others])
        places = np.flatnonzero(firsts)
        places = places[np.arange(len(places)) - np.searchsorted(rows[places], rows[places]) == count - 1]
        least = np.full(len(asking), -np.inf)
        least[rows[places]] = near[places]
        kept = near >= least[rows] - slack
        rows, others = rows[kept], others[kept]
        scores = np.zeros(len(rows))
        for k in range(points.shape[1]):
            scores += points[rows, k] * vectors[others, k]
        others = ids[others]
        order = np.lexsort((others, -scores, rows))
        rows, others, scores = rows[order], others[order], scores[order]
        firsts = _firsts(rows, others)
        rows, others, scores = rows[firsts], others[firsts], scores[firsts]
        best = np.arange(len(rows)) - np.searchsorted(rows, rows) < count
        return [asking[rows[best]], others[best], scores[best]]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        shelf: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        for batch in stream:
            marks = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in ("shelf", "copy", "role")], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                part, own = batch.slice(begin, end - begin), tuple(marks[begin, :2].tolist())
                if own != key:
                    key, held, shelf = own, [], None
                if marks[begin, 2] == 0:
                    held.append(part)
                    continue
                if shelf is None:
                    columns = [np.concatenate([x.column(name).flatten().to_numpy() for x in held]) for name in ("lists", "vector")]
                    ids = np.concatenate([x.column("id").to_numpy() for x in held])
                    shelf = (ids, columns[0], columns[1].reshape(len(ids), -1))
                for at in range(0, len(part), 256):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in best_of(part.slice(at, 256), *shelf)], ["query_id", "vec_id", "score"]
                    )

    return met.mapInArrow(batches, "query_id long, vec_id long, score double")
