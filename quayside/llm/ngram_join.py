"""Exact Jaccard join of documents on word shingles, in the metric space of Jaccard distance.

Equal sets are one node. Most nodes lie at distance 1 from any pivot, where distances tell nothing,
so nodes first meet in blocks: two sets within the distance share one of the shingles that come first
in an order from rare to frequent (the prefix filter). In each block one node is the pivot. Nodes
within the limit of the pivot are its region and are linked through it. What is left is joined across
regions: the nodes outside a block's largest region meet those of other regions whose distances to
the block's pivot differ by no more than the limit (the triangle inequality). Candidates are then
measured exactly. Components of the links come from alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.texts import mix, shingles, text_blocks, words
from quayside.session import scratch_path

#: Counters of shingles that several sets of one task share; the order from rare to frequent.
COUNTERS = 1 << 20
#: Shingles of different sets that a task holds at a time, to see which of them the sets share.
HELD = 1 << 21
#: Shingles of this class or higher, by the logarithm of their counter, may fill a whole task.
HOT_CLASS = 8
#: Fixed pivot sets, parts of all shingles by hash, whose shares of a set are known beforehand.
PARTS = 64
#: Most rows of candidates that are broadcast, at most 200 bytes each.
SENT = 200_000
#: Members that a task compares with one pivot at a time.
REGION = 512


def _needed(size: Column, other: Column, percent: int) -> Column:
    """Least common shingles of two linked sets: i >= p * (a + b) / (100 + p)."""
    return F.ceil((size + other) * percent / F.lit(100.0 + percent) - 1e-9)


def _sets(batch: pa.RecordBatch, column: str, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for begin, _, data, offsets in text_blocks(batch.column(column)):
        hashes, _, at = words(data, offsets)
        yield begin, shingles(hashes, at, size)


def _digest(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever the order."""
    spread = mix(found)
    sums = spread.sum(dtype=np.uint64), mix(spread + np.uint64(7)).sum(dtype=np.uint64)
    return tuple(int(x.astype(np.int64)) for x in sums)


def _profile(found: np.ndarray) -> bytes:
    """How many of a set's shingles lie in each of PARTS, held to 16 bits."""
    counts = np.bincount((found >> np.uint64(58)).astype(np.int64), minlength=PARTS)
    return np.minimum(counts, 65535).astype("<u2").tobytes()


def _written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage, and is computed once."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def document_sets(docs: DataFrame, size: int) -> DataFrame:
    """Rows of (id, mark, n, lo, hi, profile) of each row's set; beside them rows of (counter, count).

    A counter row says how many different sets, HELD together in a task, share its shingles.
    """
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "mark", "n", "lo", "hi", "profile", "counter", "count"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        none, held, size_held = None, {}, 0

        def count_shared() -> None:
            together = np.sort(np.concatenate([np.empty(0, np.uint64), *held.values()]))
            shared = together[1:][together[1:] == together[:-1]]
            np.add.at(counts, (shared >> np.uint64(44)).astype(np.int64), 1)
            held.clear()

        for batch in stream:
            none = pa.nulls(0, batch.column(0).type)
            for begin, found in _sets(batch, "text", size):
                digests = [_digest(x) for x in found]
                for digest, own in zip(digests, found, strict=True):
                    if digest not in held:
                        held[digest] = own
                        size_held += len(own)
                if size_held > HELD:
                    count_shared()
                    size_held = 0
                rows = [[len(x) for x in found], [x[0] for x in digests], [x[1] for x in digests]]
                nothing = [pa.nulls(len(found), pa.int32()), pa.nulls(len(found), pa.int64())]
                profiles = pa.array([_profile(x) for x in found], pa.binary())
                own = [batch.column(name).slice(begin, len(found)) for name in ("id", "mark")]
                columns = [*own, *(pa.array(x, pa.int64()) for x in rows), profiles, *nothing]
                yield pa.RecordBatch.from_arrays(columns, names)
        count_shared()
        used = np.flatnonzero(counts)
        if len(used):
            columns = [pa.nulls(len(used), none.type), *[pa.nulls(len(used), pa.int64())] * 4, pa.nulls(len(used), pa.binary())]
            columns += [pa.array(used.astype(np.int32)), pa.array(counts[used])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(batches, f"id {kind}, mark bigint, n bigint, lo bigint, hi bigint, profile binary, counter int, count bigint")


def _classes(sets: DataFrame) -> np.ndarray:
    """Rarity class of each counter: the binary logarithm of its count. At most COUNTERS rows come."""
    rows = sets.where("counter is not null").groupBy("counter").agg(F.sum("count").alias("count")).toArrow()
    classes = np.zeros(COUNTERS, np.uint8)
    classes[rows["counter"].to_numpy()] = np.log2(rows["count"].to_numpy() + 1).astype(np.uint8)
    return classes


def prefix_keys(docs: DataFrame, size: int, percent: int, classes: np.ndarray) -> DataFrame:
    """Rows of (lo, hi, n, keys, cold): each set's first shingles from rare to frequent.

    Linked sets of sizes a and b share at least p * max(a, b) / 100 shingles, so they share one of the
    first n - ceil(p * n / 100) + 1. The first ``cold`` of the keys are rare, the others frequent.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for _, found in _sets(batch, "text", size):
                rows: list[tuple] = []
                for x in found:
                    if not len(x):
                        continue
                    of = classes[(x >> np.uint64(44)).astype(np.int64)]
                    first = np.argsort(of, kind="stable")[: len(x) - -(-percent * len(x) // 100) + 1]
                    rows.append((*_digest(x), len(x), x[first].view(np.int64), int((of[first] < HOT_CLASS).sum())))
                if rows:
                    names = ["lo", "hi", "n", "keys", "cold"]
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32()]
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(batches, "lo bigint, hi bigint, n bigint, keys array<bigint>, cold int")


def _possible(n: Column, pos: Column, other_n: Column, other_pos: Column, percent: int) -> Column:
    """Sizes are near enough, and so many shingles can follow a first common one."""
    low, high = F.least(n, other_n), F.greatest(n, other_n)
    most = F.least(n - pos, other_n - other_pos)
    return (low * 100 >= high * percent) & (most >= _needed(n, other_n, percent))


def near_profiles(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose profiles allow a link.

    Two sets differ in at least as many shingles as their profiles do: the triangle inequality for
    the size of differences, in each of PARTS. Linked sets of sizes a and b with i in common differ in
    a + b - 2 i. Pairs are sent to all tasks if they are counted to be few; else both sides are shuffled.
    """
    pairs = _written(pairs, "candidates")
    few = pairs.count() <= SENT
    of_a, of_b = (
        nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("profile").alias(f"profile_{x}")) for x in ("a", "b")
    )

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            profiles = [
                np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u2").reshape(-1, PARTS).astype(np.int64)
                for name in ("profile_a", "profile_b")
            ]
            apart = np.abs(profiles[0] - profiles[1]).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(apart <= batch.column("most").to_numpy()))

    size = F.col("n_a") + F.col("n_b")
    most = (size - 2 * _needed(F.col("n_a"), F.col("n_b"), percent)).cast("long").alias("most")
    rows = (F.broadcast(pairs) if few else pairs).join(of_a, "a")
    rows = (F.broadcast(rows) if few else rows).join(of_b, "b").select("a", "b", "profile_a", "profile_b", most)
    return rows.mapInArrow(batches, "a bigint, b bigint")


def measured(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(a, b, common, n_a, n_b) of every pair: the sizes of two nodes' sets, and of what they have in common.

    Pairs meet by ``a``; one with many partners is read once for each REGION of them, in any task. The
    texts are those of the node's least id; a text whose set has another digest than the node belongs
    to another row of that id. Which text goes where is sent to all tasks if it is counted to be
    little; else both sides are shuffled.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / REGION).cast("int").alias("parts"))
    members = pairs.join(many, "a").select(
        "a", F.pmod(F.hash("b"), F.col("parts")).alias("part"), F.lit(1).alias("role"), F.col("b").alias("node")
    )
    pivots = many.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("node")
    )
    wanted = pivots.unionByName(members).join(nodes.withColumnRenamed("least", "id"), "node")
    wanted = _written(wanted.select("id", "a", "part", "role", "node", "lo", "hi"), "wanted")
    rows = docs.join(F.broadcast(wanted) if wanted.count() <= SENT else wanted, "id")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.empty(0, np.uint64)
        for batch in stream:
            a, b, role, lo, hi = (batch.column(name).to_numpy() for name in ("a", "node", "role", "lo", "hi"))
            for begin, found in _sets(batch, "text", size):
                out = []
                for k, own in enumerate(found, begin):
                    if _digest(own) != (lo[k], hi[k]):
                        continue
                    if role[k] == 0:
                        pivot = own
                    else:
                        at = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
                        out.append((a[k], b[k], int(np.count_nonzero(pivot[at] == own)), len(pivot), len(own)))
                if out:
                    columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "common", "n_a", "n_b"])

    rows = rows.select("a", "role", "node", "lo", "hi", "text")
    return rows.mapInArrow(batches, "a bigint, b bigint, common bigint, n_a bigint, n_b bigint").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) of every node with an edge; label is the least node of its component.

    Alternating large-star and small-star contractions; each round is written to the shared folder.
    """
    edges = _written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = _written(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    labelled = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labelled.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


def jaccard_components(
    docs: DataFrame, *, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Return id_col, n_shingles and component_id for each row of ``docs``.

    Words are runs of other bytes than blank and \\x09-\\x0D, A-Z lower-cased; a set holds the distinct
    shingles of ``size`` words, or the whole sequence if there are fewer. Rows link when 100 *
    intersection >= percent * union, and component_id is the smallest id reachable. A row without
    words or text has an empty set and its own id. Rows that repeat an id are nodes of their own;
    rows of null id take part in no link and have a null component.
    """
    found = _grouped(docs, size, percent, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _grouped(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, n, component, group) of each row: a hash of its text, and a number of its component, null for an empty set."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("mark", _mark(F.col("text")))
    sets = _written(document_sets(docs, size), "sets")
    docs = docs.drop("mark")
    classes = _classes(sets)
    rows = sets.where("counter is null")
    known = rows.where("id is not null and n > 0")
    # One node for each distinct set; monotonic ids are made once, as the table is written.
    nodes = known.groupBy("lo", "hi", "n").agg(F.min("id").alias("least"), F.first("profile").alias("profile"))
    nodes = _written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    keyed = prefix_keys(docs.where("id is not null"), size, percent, classes)
    keyed = keyed.groupBy("lo", "hi", "n").agg(F.first("keys").alias("keys"), F.first("cold").alias("cold"))
    keyed = keyed.join(nodes.select("lo", "hi", "n", "node"), ["lo", "hi", "n"])
    keyed = keyed.withColumn("n", F.col("n").cast("int"))
    entries = keyed.select("node", "n", "cold", F.posexplode("keys").alias("pos", "key"))
    entries = entries.select("key", "node", "n", "pos", (F.col("pos") >= F.col("cold")).alias("hot"))
    entries = _written(_blocks(entries), "blocks")

    # Each block's members against its pivot.
    pairs = entries.where("node <> pivot").where(
        _possible(F.col("n"), F.col("pos"), F.col("pivot_n"), F.col("pivot_pos"), percent)
    )
    pairs = pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = _written(near_profiles(pairs, nodes, percent), "pairs")
    first = _written(measured(pairs, docs, nodes, size), "measured")
    linked = _linked(percent)
    labels = components(first.where(linked))

    # What regions leave open.
    second = _open_pairs(entries, labels, first, percent)
    second = second.join(first.select("a", "b"), ["a", "b"], "left_anti")
    second = _written(near_profiles(second, nodes, percent), "open")
    more = _written(measured(second, docs, nodes, size).where(linked), "measured")
    if not more.isEmpty():
        labels = components(first.where(linked).unionByName(more))

    least = labels.join(nodes, "node").groupBy("label").agg(F.min("least").alias("component"))
    found = labels.join(least, "label").select("node", "label", "component")
    known = [F.coalesce("component", "least").alias("component"), F.coalesce("label", "node").alias("group")]
    found = nodes.join(found, "node", "left").select("lo", "hi", "n", *known)
    out = rows.join(found, ["lo", "hi", "n"], "left")
    own = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return out.select("id", "mark", "n", own.alias("component"), "group")


def _mark(text: Column) -> Column:
    return F.xxhash64(F.isnull(text), text)


def one_of_each_group(docs: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component of ``docs`` (doc_id, text, ..): one whose doc_id is the least; all columns stay.

    Rows that repeat doc_id and text are one document, of which one row stays. If a doc_id is repeated with
    other texts, each of them stands for itself: of several in one component one stays, and one in the
    component of a smaller id goes. Rows of null doc_id are in no group, and stay.
    """
    grouped = _grouped(docs, size, percent, "doc_id", "text").where("component = id")
    alone = F.when(F.col("group").isNull(), F.col("mark")).alias("alone")
    chosen = grouped.groupBy("id", "group", alone).agg(F.min("mark").alias("mark"), F.count(F.lit(1)).alias("rows"))
    kept = _written(chosen.groupBy("id", "mark").agg(F.max("rows").alias("rows")), "kept")
    size_of = kept.agg(F.count(F.lit(1)).alias("ids"), F.max("rows").alias("most")).first()
    chosen = kept.select(F.col("id").alias("kept_id"), F.col("mark").alias("kept_mark"))
    # By frame, as documents may have columns of any name.
    same = (docs["doc_id"] == chosen["kept_id"]) & (_mark(docs["text"]) == chosen["kept_mark"])
    stay = docs.join(F.broadcast(chosen) if size_of["ids"] <= SENT else chosen, same, "left_semi")
    if (size_of["most"] or 0) > 1:
        stay = stay.dropDuplicates(["doc_id", "text"])
    return stay.select(docs.columns).unionByName(docs.where("doc_id is null"))


def _blocks(entries: DataFrame) -> DataFrame:
    """(block, node, n, pos) of blocks with two nodes at least, with the block's pivot.

    It is the node with the fewest rarer shingles, the least of equal ones: among copies with edits of
    their own, the one nearest to all. Keys that the same nodes share make one block, told by a hash
    of its nodes, and a node's least position counts. Rare keys are gathered by a window. A frequent
    key may hold any share of the rows: what is known of it comes from pre-aggregated sums, and the
    join back may be split.
    """
    member, code = F.struct("pos", "node", "n"), F.xxhash64("node")
    by_key = Window.partitionBy("key")
    # Dealt out by key before what the window needs is computed from the columns.
    cold = entries.where("not hot").select("key", "node", "n", "pos").repartition("key")
    cold = cold.select(
        "node",
        "n",
        "pos",
        F.count(F.lit(1)).over(by_key).alias("members"),
        F.min(member).over(by_key).alias("pivot"),
        F.bit_xor(code).over(by_key).alias("code"),
    )
    hot = entries.where("hot").select("key", "node", "n", "pos")
    heads = hot.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min(member).alias("pivot"), F.bit_xor(code).alias("code")
    )
    both = cold.where("members > 1").unionByName(hot.join(heads.where("members > 1"), "key").drop("key"))
    block = F.xxhash64("code", "members", "pivot.node").alias("block")
    return both.groupBy(block, "node").agg(
        F.first("n").alias("n"),
        F.min("pos").alias("pos"),
        F.first("pivot.node").alias("pivot"),
        F.first("pivot.n").alias("pivot_n"),
        F.min("pivot.pos").alias("pivot_pos"),
    )


def _linked(percent: int) -> Column:
    return F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent


def _open_pairs(entries: DataFrame, labels: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Pairs of one block and different regions that neither sizes, positions nor windows rule out."""
    distance = 1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
    to_pivot = first.select(F.col("a").alias("pivot"), F.col("b").alias("node"), distance.alias("far"))
    members = (
        entries.join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .join(to_pivot, ["pivot", "node"], "left")
        .withColumn("far", F.when(F.col("node") == F.col("pivot"), 0.0).otherwise(F.col("far")))
    )
    regions = members.groupBy("block", "label").agg(F.count(F.lit(1)).alias("rows"))
    largest = regions.groupBy("block").agg(F.max(F.struct("rows", "label"))["label"].alias("largest"), F.count(F.lit(1)).alias("regions"))
    mixed = members.join(largest.where("regions > 1").select("block", "largest"), "block").where("node <> pivot")
    fields = ["node", "n", "pos", "far", "label"]
    outside = mixed.where("label <> largest").select("block", *[F.col(x).alias(f"x_{x}") for x in fields])
    inside = mixed.select("block", "largest", *[F.col(x).alias(f"y_{x}") for x in fields])
    window = F.coalesce(F.abs(F.col("x_far") - F.col("y_far")) <= 1 - percent / 100 + 1e-9, F.lit(True))
    met = outside.join(inside, "block").where("x_label <> y_label and (y_label = largest or x_node < y_node)").where(window)
    met = met.where(_possible(F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"), percent))
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
