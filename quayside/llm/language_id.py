"""Language of texts by a convolutional network over bytes, trained and applied in numpy.

A window of fixed length is embedded byte by byte; filters of several widths slide over it, the
largest response of each is kept, and a softmax over those names the language. A text's probability
of a language is the mean over all its windows, each weighted by its letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.texts import BLOCK, bucket, text_blocks

WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
_REACH = max(WIDTHS)
#: Windows convolved at a time.
_BATCH = 128
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_FOLDED[:32] = 32
_LETTER = np.zeros(256, np.float32)
_LETTER[[*range(97, 123), *range(128, 256)]] = 1


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as rows of lower-cased bytes, blanks behind the end; offsets of each text's.

    An empty text has one window of blanks.
    """
    sizes = np.diff(offsets)
    each = np.maximum(1, -(-sizes // WINDOW))
    first = np.concatenate([[0], np.cumsum(each)])
    of = np.repeat(np.arange(len(sizes)), each)
    starts = offsets[of] + (np.arange(first[-1]) - first[of]) * WINDOW
    # Padded behind, so that the last windows can be taken whole.
    padded = np.concatenate([_FOLDED[data], np.full(WINDOW, 32, np.uint8)])
    found = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts]
    short = np.flatnonzero(starts + WINDOW > offsets[of + 1])
    keep = np.arange(WINDOW) < (offsets[of[short] + 1] - starts[short])[:, None]
    found[short] = np.where(keep, found[short], 32)
    return found, first


@dataclass
class ByteNetwork:
    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    @staticmethod
    def new(classes: int, random: np.random.Generator) -> ByteNetwork:
        total = FILTERS * len(WIDTHS)
        net = ByteNetwork(
            random.normal(0, 0.5, (256, EMBEDDING)),
            random.normal(0, (2 / (_REACH * EMBEDDING)) ** 0.5, (_REACH * EMBEDDING, total)),
            np.zeros(total),
            random.normal(0, total**-0.5, (total, classes)),
            np.zeros(classes),
        )
        for name, value in vars(net).items():
            setattr(net, name, value.astype(np.float32))
        net.filters *= net.shape()
        return net

    @staticmethod
    def shape() -> np.ndarray:
        """1 where a filter reaches, 0 behind its width."""
        at = np.repeat(np.arange(_REACH), EMBEDDING)
        return (at[:, None] < np.repeat(WIDTHS, FILTERS)).astype(np.float32)

    def _columns(self, rows: np.ndarray) -> np.ndarray:
        embedded = self.embedding[rows].reshape(len(rows), -1)
        view = np.lib.stride_tricks.sliding_window_view(embedded, _REACH * EMBEDDING, axis=1)[:, ::EMBEDDING]
        return np.ascontiguousarray(view)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        parts = []
        for begin in range(0, len(rows), _BATCH):
            pooled = (self._columns(rows[begin : begin + _BATCH]) @ self.filters).max(axis=1)
            parts.append(_softmax(np.maximum(pooled + self.filter_bias, 0) @ self.output + self.output_bias))
        return np.concatenate(parts)

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        columns = self._columns(rows)
        responses = columns @ self.filters
        best = responses.argmax(axis=1)
        pooled = np.take_along_axis(responses, best[:, None], axis=1)[:, 0] + self.filter_bias
        hidden = np.maximum(pooled, 0)
        error = _softmax(hidden @ self.output + self.output_bias)
        error[np.arange(len(rows)), labels] -= 1
        error /= len(rows)
        back = (error @ self.output.T) * (pooled > 0)
        # Only the place of the largest response learns.
        seen = columns[np.arange(len(rows))[:, None], best]
        filters = np.einsum("bf,bfk->kf", back, seen) * self.shape()
        to_input = (back[:, :, None] * self.filters.T[None]).reshape(-1, EMBEDDING)
        reached = rows[np.arange(len(rows))[:, None, None], best[:, :, None] + np.arange(_REACH)].reshape(-1)
        embedding = np.stack([np.bincount(reached, to_input[:, k], 256) for k in range(EMBEDDING)], axis=1)
        return [embedding, filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: np.ndarray, labels: np.ndarray, classes: int, *, steps: int = 500, batch: int = 256, seed: int = 4) -> ByteNetwork:
    """Adam on batches in which every class is as frequent."""
    random = np.random.default_rng(seed)
    net = ByteNetwork.new(classes, random)
    names = list(vars(net))
    mean = [np.zeros_like(getattr(net, name)) for name in names]
    spread = [np.zeros_like(getattr(net, name)) for name in names]
    of = [np.flatnonzero(labels == k) for k in range(classes)]
    for step in range(1, steps + 1):
        drawn = np.concatenate([random.choice(x, -(-batch // classes)) for x in of])
        shifted = rows[drawn]
        # Part of a window only, so that short texts are known too.
        length = random.integers(12, WINDOW + 1, len(drawn))
        length[random.random(len(drawn)) < 0.5] = WINDOW
        shifted = np.where(np.arange(WINDOW) < length[:, None], shifted, 32).astype(np.uint8)
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for k, slope in enumerate(net.gradients(shifted, labels[drawn])):
            mean[k] += 0.1 * (slope - mean[k])
            spread[k] += 0.01 * (slope**2 - spread[k])
            change = rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-8)
            setattr(net, names[k], (getattr(net, names[k]) - change).astype(np.float32))
    return net


@dataclass
class LanguageModel:
    network: ByteNetwork | None
    languages: list[str]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and its probability for each text; ``und`` and 0 without a letter or a model."""
        rows = len(offsets) - 1
        lettered = _has_letter(data, offsets)
        if self.network is None or not len(data):
            return ["und"] * rows, np.zeros(rows)
        found, first = windows(data, offsets)
        weight = _LETTER[found].sum(axis=1) + 1e-3
        summed = np.add.reduceat(self.network.probabilities(found) * weight[:, None], first[:-1], axis=0)
        chances = summed / summed.sum(axis=1, keepdims=True)
        best = chances.argmax(axis=1)
        names = [self.languages[k] if letter else "und" for k, letter in zip(best, lettered, strict=True)]
        return names, np.where(lettered, chances[np.arange(rows), best], 0.0)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = np.concatenate([[0], np.cumsum((_FOLDED[data] >= 97) & (_FOLDED[data] <= 122))])
    found = np.diff(plain[offsets]) > 0
    for k in np.flatnonzero(~found):
        text = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")
        found[k] = any(char.isalpha() for char in text)
    return found


def fit_language(
    docs: DataFrame, *, held_out: tuple[int, int] = (5, 0), texts: int = 600, windows_each: int = 8, steps: int = 500
) -> LanguageModel:
    """Train on windows of about ``texts`` texts of each language, ``windows_each`` of a text at most.

    The texts are drawn by a hash of their ids from those with a language and not held out; each
    language is drawn at its own rate, so a frequent one is never gathered in one place. Without any
    such text there is no model. The names of the languages are all that grows on the driver.
    """
    modulus, remainder = held_out
    rows = docs.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null and lang <> 'und'")
    rows = rows.where((bucket("doc_id", modulus) != remainder) & (F.length(F.trim("text")) > 0))
    counts = dict(rows.groupBy("lang").count().toPandas().itertuples(index=False, name=None))
    if not counts:
        return LanguageModel(None, [])
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rates = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, 1.2 * texts / counts[name]))])
    drawn = rows.where(draw < rates[F.col("lang")])
    # The draw bounds the rows of the window to some 1.2 * texts for each language.
    order = Window.partitionBy("lang").orderBy(draw, "doc_id")
    drawn = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= texts)

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for begin, end, data, offsets in text_blocks(batch.column("text"), BLOCK):
                found, first = windows(data, offsets)
                chosen, of = [], []
                for row in range(end - begin):
                    each = np.unique(np.linspace(first[row], first[row + 1] - 1, windows_each).astype(int))
                    chosen += each.tolist()
                    of += [begin + row] * len(each)
                bytes_of = pa.array([found[k].tobytes() for k in chosen], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(of, pa.int64())), bytes_of], ["lang", "window"])

    sample = drawn.select("lang", "text").mapInArrow(cut, "lang string, window binary").orderBy("lang", "window").toPandas()
    rows_of = np.frombuffer(b"".join(sample["window"]), np.uint8).reshape(-1, WINDOW)
    names = sorted(set(sample["lang"]))
    labels = np.searchsorted(names, sample["lang"].to_numpy(str))
    return LanguageModel(train(rows_of, labels, len(names), steps=steps), names)


def identify_languages(docs: DataFrame, *, held_out: tuple[int, int] = (5, 0)) -> DataFrame:
    """Return doc_id, held_out, lang_pred and score for each row of ``docs``.

    Learned from text and lang of rows whose crc32(doc_id) modulo ``held_out[0]`` is not
    ``held_out[1]``. A null text, one without a letter, and every text if nothing could be learned,
    is ``und`` with score 0. Rows of null doc_id are never learned from, and not held out.
    """
    model = fit_language(docs, held_out=held_out)
    modulus, remainder = held_out

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for begin, end, data, offsets in text_blocks(batch.column(1), BLOCK):
                names, scores = model.predict(data, offsets)
                columns = [batch.column(0).slice(begin, end - begin), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(batches, f"doc_id {kind}, lang_pred string, score double")
    kept_out = F.coalesce(bucket("doc_id", modulus) == remainder, F.lit(False))
    return found.select("doc_id", kept_out.alias("held_out"), "lang_pred", "score")
