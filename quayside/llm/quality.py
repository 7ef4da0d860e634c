"""Quality classifier: kernel ridge over document statistics, by random Fourier features.

A Gaussian kernel over standardised statistics of each text is approximated by random cosines. The
normal equations of the ridge fit are sums over rows, so Spark adds them up by partition and the
driver solves one small system. Raw scores become probabilities by isotonic regression over
out-of-fold scores, gathered into a fixed number of bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.texts import bucket, text_blocks, words
from quayside.session import scratch_path

#: Classes of bytes whose shares are statistics.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".?",
    "comma": b",;:",
    "loud": b"!",
    "bar": b"|/\\_-=+<>",
    "symbol": b"#$%&*@^~`{}[]()\"'",
    "line": b"\n",
    "wide": bytes(range(128, 256)),
    "control": bytes([*range(9), *range(14, 32), 127]),
}
STATISTICS = (
    "log_bytes",
    "log_words",
    "word_mean",
    "word_spread",
    "distinct_share",
    "distinct_pairs",
    "top_share",
    "letter_entropy",
    *_CLASSES,
)
_CLASS_OF = np.full(256, len(_CLASSES), np.intp)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    out = np.zeros((rows, len(STATISTICS)))
    hashes, lengths, at = words(data, offsets)
    sizes = np.diff(offsets)
    out[:, 0], out[:, 1] = np.log1p(sizes), np.log1p(np.diff(at))
    for k in range(rows):
        if not sizes[k]:
            continue
        own = np.bincount(data[offsets[k] : offsets[k + 1]], minlength=256)
        shares = np.bincount(_CLASS_OF, own, len(_CLASSES) + 1) / sizes[k]
        out[k, 8:] = np.sqrt(shares[:-1])
        letters = np.bincount(_LOWER, own, 256)
        letters = letters[letters > 0] / sizes[k]
        out[k, 7] = -(letters * np.log(letters)).sum()
        of = hashes[at[k] : at[k + 1]]
        if not len(of):
            continue
        long = lengths[at[k] : at[k + 1]]
        out[k, 2], out[k, 3] = np.log1p(long.mean()), np.log1p(long.std())
        ordered = np.sort(of)
        runs = np.diff(np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])))
        out[k, 4], out[k, 6] = len(runs) / len(of), runs.max() / len(of)
        pairs = np.sort(of[1:] * np.uint64(3) + of[:-1])
        out[k, 5] = (1 + np.count_nonzero(pairs[1:] != pairs[:-1])) / max(len(pairs), 1)
    return out


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``statistics``, an array of doubles in STATISTICS' order.

    A null or empty text has zeros throughout. Ids may be null or repeat; each row is kept.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for begin, end, data, offsets in text_blocks(batch.column(1)):
                values = _statistics(data, offsets)
                width = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(width), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), lists], ["id", "statistics"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, f"id {kind}, statistics array<double>").withColumnRenamed("id", id_col)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    #: Raw scores and the probabilities they stand for, both rising.
    knots: np.ndarray
    levels: np.ndarray

    def features(self, statistics: np.ndarray) -> np.ndarray:
        z = np.clip((statistics - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(z), 1))])

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.interp(self.features(statistics) @ self.weights, self.knots, self.levels)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _isotonic(scores: np.ndarray, ones: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: rising means of ``ones / rows`` over rising scores."""
    blocks: list[list[float]] = []
    for s, y, n in zip(scores, ones, rows, strict=True):
        blocks.append([s * n, y, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top, strict=True)]
    total = np.array(blocks)
    return total[:, 0] / total[:, 2], (total[:, 1] + 0.5) / (total[:, 2] + 1)


BINS = 1024


def fit_quality(
    labelled: DataFrame, *, features: int = 256, bandwidth: float = 5.0, ridge: float = 0.3, seed: int = 8
) -> QualityModel:
    """Fit on ``statistics`` and ``label`` (0 or 1) of all rows given; other labels are left out.

    Sums over the rows are all that reaches the driver: (features + 1)^2 / 2 numbers for each of two
    folds, and two for each of ``BINS`` score bins. Without labelled rows every score is 0.5; with
    one label only, it is that label's smoothed share.
    """
    rows = labelled.where(F.col("label").isin(0, 1)).select("statistics", F.col("label").cast("double").alias("label"))
    rows = rows.withColumn("fold", (F.abs(F.xxhash64("statistics")) % 2).cast("int"))
    size = len(STATISTICS)
    item = [F.element_at("statistics", k + 1) for k in range(size)]
    moments = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(x).alias(f"m{k}") for k, x in enumerate(item)],
        *[F.stddev_pop(x).alias(f"s{k}") for k, x in enumerate(item)],
    ).first()
    random = np.random.default_rng(seed)
    frequencies = random.normal(size=(size, features)) / bandwidth
    phases = random.uniform(0, 2 * np.pi, features)
    if not moments["rows"]:
        zeros = np.zeros(size)
        return QualityModel(zeros, zeros + 1, frequencies, phases, np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    mean = np.array([moments[f"m{k}"] for k in range(size)])
    scale = np.maximum([moments[f"s{k}"] for k in range(size)], 1e-6)
    blank = QualityModel(mean, scale, frequencies, phases, np.zeros(features + 1), np.zeros(1), np.zeros(1))
    upper = np.triu_indices(features + 2)

    def equations(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, features + 2, features + 2))
        for batch in stream:
            z, y = blank.features(_matrix(batch, "statistics")), batch.column("label").to_numpy()
            fold = batch.column("fold").to_numpy()
            z = np.hstack([z, y[:, None]])
            for k in (0, 1):
                sums[k] += z[fold == k].T @ z[fold == k]
        for k in (0, 1):
            if sums[k].any():
                cells = [np.full(len(upper[0]), k, np.int32), *(x.astype(np.int32) for x in upper), sums[k][upper]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cells], ["fold", "i", "j", "value"])

    summed = rows.mapInArrow(equations, "fold int, i int, j int, value double")
    cells = summed.groupBy("fold", "i", "j").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((2, features + 2, features + 2))
    total[cells["fold"], cells["i"], cells["j"]] = cells["value"]
    total[cells["fold"], cells["j"], cells["i"]] = cells["value"]

    def solve(sums: np.ndarray) -> np.ndarray:
        left = sums[:-1, :-1] + ridge * np.eye(features + 1)
        left[-1, -1] += 1e-6 - ridge
        return np.linalg.solve(left, sums[:-1, -1])

    # Each fold is scored by the other fold's fit, if there is one.
    others = [solve(total[1 - k] if total[1 - k].any() else total[k]) for k in (0, 1)]

    def binned(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            z, fold = blank.features(_matrix(batch, "statistics")), batch.column("fold").to_numpy()
            raw = np.clip(np.where(fold == 0, z @ others[0], z @ others[1]), -0.5, 1.5)
            at = np.minimum((raw + 0.5) / 2 * BINS, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw), batch.column("label")], ["bin", "raw", "label"])

    bins = (
        rows.mapInArrow(binned, "bin int, raw double, label double")
        .groupBy("bin")
        .agg(F.avg("raw").alias("raw"), F.sum("label").alias("ones"), F.count(F.lit(1)).alias("rows"))
        .toPandas()
        .sort_values("bin")
    )
    knots, levels = _isotonic(bins["raw"].to_numpy(), bins["ones"].to_numpy(), bins["rows"].to_numpy())
    return QualityModel(mean, scale, frequencies, phases, solve(total.sum(axis=0)), knots, levels)


def apply_quality(statistics: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``score``, the probability of label 1, for each row of statistics."""
    kind = statistics.schema[id_col].dataType.simpleString()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            scores = model.score(_matrix(batch, "statistics"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], ["id", "score"])

    rows = statistics.select(F.col(id_col).alias("id"), "statistics")
    return rows.mapInArrow(batches, f"id {kind}, score double").withColumnRenamed("id", id_col)


def statistics_of(text: Column) -> Column:
    """The statistics of a text column, measured in Arrow batches beside the other columns."""

    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        parts = [_statistics(data, offsets) for _, _, data, offsets in text_blocks(texts)]
        values = np.concatenate([np.empty((0, len(STATISTICS))), *parts])
        width = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(width), pa.array(values.ravel()))

    return measure(text.cast("string"))


def quality_score(model: QualityModel, statistics: Column) -> Column:
    """Score of a column of statistics, computed beside the other columns."""

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        values = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        return pa.array(model.score(values) if len(values) else np.empty(0))

    return score(statistics)


def stored_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Document statistics written once to the shared folder, so that no text is read twice."""
    spark = docs.sparkSession
    path = scratch_path(spark, "statistics")
    document_statistics(docs, id_col, text_col).write.parquet(path)
    return spark.read.parquet(path)


def quality_model(statistics: DataFrame, labels: DataFrame, *, label_col: str = "quality", held_out: tuple[int, int] = (4, 2)) -> QualityModel:
    """Fit on the labelled rows of ``statistics`` whose crc32(doc_id) modulo held_out[0] is not held_out[1]."""
    seen = labels.select("doc_id", F.col(label_col).alias("label")).where("doc_id is not null and label is not null")
    # Statistics are of fixed size, so the labels meet them and not the texts.
    return fit_quality(statistics.where(bucket("doc_id", held_out[0]) != held_out[1]).join(seen.distinct(), "doc_id"))


def score_quality(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", held_out: tuple[int, int] = (4, 2), threshold: float = 0.7
) -> DataFrame:
    """Return doc_id, held_out, score and predicted for each document.

    Labels are learned from rows whose crc32(doc_id) modulo ``held_out[0]`` is not ``held_out[1]``.
    ``labels`` may lack documents, hold nulls or repeat them; rows of null doc_id are scored, never
    learned from, and not held out. A null or empty text is scored like any other.
    """
    statistics = stored_statistics(docs.select("doc_id", "text"))
    model = quality_model(statistics, labels, label_col=label_col, held_out=held_out)
    return apply_quality(statistics, model).select(
        "doc_id",
        F.coalesce(bucket("doc_id", held_out[0]) == held_out[1], F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
