"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams. Each n-gram's feature is the log of the ratio of
its smoothed shares among toxic and other texts; logistic regression weighs the scaled features.
The fit takes a bounded sample of labelled texts; scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.texts import bucket, flat, mix, row_blocks
from quayside.session import scratch_path

#: Hash buckets of n-grams.
BUCKETS = 1 << 21
SIZES = (4, 5, 6, 7)
#: Bytes of text whose n-grams are sent at a time; these take up to 16 times as many.
SENT = 1 << 18


def _folded() -> np.ndarray:
    """Characters below U+2000 lower-cased one to one, all white space and controls a blank."""
    table = np.arange(0x2000, dtype=np.uint32)
    for code in range(0x2000):
        lower = chr(code).lower()
        table[code] = 32 if chr(code).isspace() or code < 32 else ord(lower) if len(lower) == 1 else code
    return table


_FOLDED = _folded()


def _grams(text: bytes) -> np.ndarray:
    """Hash buckets of all n-grams of one text, with repeats; a blank is set before and after it."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    low = codes < len(_FOLDED)
    codes = np.where(low, _FOLDED[np.where(low, codes, 0)], codes).astype(np.uint64)
    found, rolled = [], codes[:0]
    for size in range(1, max(SIZES) + 1):
        count = max(len(codes) - size + 1, 0)
        if size == 1:
            rolled = codes + np.uint64(1)
        else:
            rolled = rolled[:count] * np.uint64(0x110001) + codes[size - 1 : size - 1 + count] + np.uint64(1)
        if size in SIZES:
            found.append((mix(rolled) % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(found)


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = flat(column)
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[begin:end].tobytes()


@dataclass(frozen=True)
class ToxicityModel:
    #: Weight per n-gram bucket, the log-count ratio already multiplied in.
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 for each text; a null or empty one has the prior's."""
        raw = np.full(len(column), self.bias)
        last = np.empty(BUCKETS, np.int32)
        for k, text in enumerate(_texts(column)):
            if text:
                grams = _grams(text)
                order = np.arange(len(grams), dtype=np.int32)
                last[grams] = order  # of equal n-grams, one stays
                raw[k] += self.weights[grams[last[grams] == order]].sum(dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def sample_labels(labels: DataFrame, label_col: str, held_out: tuple[int, int], most: int) -> DataFrame:
    """At most ``most`` labelled ids of either label, by the order of a hash, none of them held out."""
    modulus, remainder = held_out
    rows = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("doc_id is not null")
    rows = rows.where(F.col("label").isin(0, 1)).where(bucket("doc_id", modulus) != remainder)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [rows.where(F.col("label") == k).orderBy(order, "doc_id").limit(most) for k in (0, 1)]
    return chosen[0].unionByName(chosen[1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "toxic",
    held_out: tuple[int, int] = (3, 1),
    most: int = 1500,
    seen_in: int = 3,
    least_ratio: float = 1.5,
    penalty: float = 1.0,
    steps: int = 150,
) -> ToxicityModel:
    """Fit on at most ``most`` texts of either label; of rows that repeat an id, on one.

    N-grams seen in fewer than ``seen_in`` sampled texts, or whose log-count ratio is below
    ``least_ratio`` in size, have no weight. They are counted by Spark, and only the others of each
    text reach the driver. With no labelled text, or one label only, there are no weights, and the
    bias alone is the smoothed share of label 1 in the sample.
    """
    chosen = sample_labels(labels, label_col, held_out, most)
    # At most 2 * most rows of an id and a label.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "label", "text")

    def features(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for begin, end in row_blocks(flat(batch.column("text"))[1], SENT):
                part = batch.slice(begin, end - begin)
                grams = [np.unique(_grams(text)) for text in _texts(part.column("text"))]
                columns = [part.column("doc_id"), part.column("label"), pa.array(grams, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "grams"])

    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "grams")
    same_id = Window.partitionBy("doc_id").orderBy(F.hash("grams"))
    sampled = texts.mapInArrow(features, "doc_id string, label int, grams array<int>")
    sampled = sampled.withColumn("place", F.row_number().over(same_id)).where("place = 1")
    sampled.select("label", "grams").write.parquet(path)
    sampled = spark.read.parquet(path)

    sizes = sampled.agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("ones")).first()
    total, ones = sizes["rows"], sizes["ones"] or 0
    bias = float(np.log((ones + 0.5) / (total - ones + 0.5)))
    if not ones or ones == total:
        return ToxicityModel(np.zeros(BUCKETS, np.float32), bias)
    counts = sampled.select("label", F.explode("grams").alias("gram")).groupBy("gram")
    counts = counts.agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= seen_in)
    among_ones = F.log((F.col("ones") + 0.5) / (ones + 1))
    among_others = F.log((F.col("rows") - F.col("ones") + 0.5) / (total - ones + 1))
    kept = counts.select("gram", (among_ones - among_others).alias("ratio")).where(F.abs("ratio") >= least_ratio).toArrow()
    order = np.argsort(kept["gram"].to_numpy())
    own, scale = kept["gram"].to_numpy()[order], kept["ratio"].to_numpy()[order]

    def weighed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column("grams")
            grams, of = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(own, grams), max(len(own) - 1, 0))
            found = own[place] == grams if len(own) else np.zeros(len(grams), bool)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of[found], minlength=len(lists)))])
            columns = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[found], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), columns], ["label", "columns"])

    rows = sampled.mapInArrow(weighed, "label int, columns array<int>").toArrow()
    lists = rows["columns"].combine_chunks()
    of = np.repeat(np.arange(total, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    weights, offset = _logistic(of, lists.flatten().to_numpy(), scale, rows["label"].to_numpy().astype(float), penalty, steps)
    full = np.zeros(BUCKETS, np.float32)
    full[own] = weights * scale
    return ToxicityModel(full, offset)


def _logistic(
    of: np.ndarray, column: np.ndarray, scale: np.ndarray, y: np.ndarray, penalty: float, steps: int
) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by accelerated gradient steps with backtracking."""
    rows = len(y)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        raw = np.bincount(of, (theta[:-1] * scale)[column], rows) + theta[-1]
        error = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y
        value = float(np.logaddexp(0, np.where(y > 0, -raw, raw)).sum() + penalty / 2 * (theta[:-1] ** 2).sum())
        slope = np.bincount(column, error[of], len(scale)) * scale + penalty * theta[:-1]
        return value, np.append(slope, error.sum())

    at = ahead = np.zeros(len(scale) + 1)
    rate, since, reached = 1e-3, 0, np.inf
    for _ in range(steps):
        value, slope = loss(ahead)
        while True:
            new = ahead - rate * slope
            lower = loss(new)[0]
            if lower <= value - rate / 2 * (slope @ slope) or rate < 1e-9:
                break
            rate /= 2
        if lower > reached:  # the momentum leads uphill: start it anew from the best place
            ahead, since = at, 0
            continue
        ahead = new + since / (since + 3) * (new - at)
        at, reached, since = new, lower, since + 1
        rate *= 1.2
    return at[:-1], float(at[-1])


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score of a text column, computed in Arrow batches beside the other columns."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts))

    return score(text.cast("string"))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", held_out: tuple[int, int] = (3, 1), threshold: float = 0.7
) -> DataFrame:
    """Return doc_id, held_out, score and predicted for each document.

    Labels are learned from rows whose crc32(doc_id) modulo ``held_out[0]`` is not ``held_out[1]``.
    ``labels`` may lack documents, hold nulls, or repeat an id (then the larger label holds). Rows of
    null doc_id are scored, never learned from, and not held out. A null or empty text has the
    bias's score.
    """
    model = fit_toxicity(docs, labels, label_col=label_col, held_out=held_out)
    modulus, remainder = held_out
    return docs.select(
        "doc_id",
        F.coalesce(bucket("doc_id", modulus) == remainder, F.lit(False)).alias("held_out"),
        toxicity_score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
