"""Cross-entropy difference of a target and a background bigram model, for every document.

Both models are matched: one vocabulary, all words of all documents (the background), the same order
and smoothing, exact counts of words and of bigrams. A word's probability after its history is smoothed
towards its share: (count + smoothing * share) / (history + smoothing). A document's score is the mean,
over its words, of the target model's loss less the background's: the lower, the more it is like the target.

No task holds a model. Bigrams of two frequent words are counted in a small table that all tasks get.
Every other bigram of a document goes to the part its word belongs to, once with its count. The bigrams of
frequent and of heavy words are dealt out by the word before too: heavy words are all with many
occurrences, whose counts all tasks get. A part so has all that its losses need: the counts of its bigrams
and words, and of its words as histories, that is where no text ends. It returns sums by document. The
number of parts follows the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quayside.llm.texts import mix, text_blocks, words
from quayside.session import scratch_path

#: Words whose bigrams with each other are counted in a table sent to all tasks, of about 2^20 cells.
FREQUENT = 1022
#: Words for each of the parts that the other bigrams are dealt to.
PART = 1 << 20
#: Occurrences from which on a word is heavy, if so few words have them that they can be sent.
HEAVY = 256
#: Buckets by which bigrams are dealt to parts, and so the most parts.
BUCKETS = 1 << 20
#: Bytes of text whose bigrams go out together.
SENT_TOGETHER = 2 << 20
#: Distinct words that a task gathers before it hands them on.
GATHERED = 1 << 20
#: Most target ids, and most heavy words, that are sent to all tasks.
SENT = 500_000


@dataclass(frozen=True)
class FrequentWords:
    #: Hashes of the frequent words, sorted; ids are places here, then any other word, then the start.
    keys: np.ndarray
    #: For target and background: words and distinct words and one, share of each id, count as a
    #: history, count after each history.
    totals: np.ndarray
    shares: np.ndarray
    histories: np.ndarray
    pairs: np.ndarray
    smoothing: float
    #: Hashes of the heavy words, sorted, and for either model their shares and counts as a history.
    heavy: np.ndarray
    heavy_shares: np.ndarray
    heavy_histories: np.ndarray

    def heavy_places(self, hashes: np.ndarray) -> np.ndarray:
        """Places among the heavy words, -1 for others."""
        if not len(self.heavy):
            return np.full(len(hashes), -1, np.int64)
        place = np.minimum(np.searchsorted(self.heavy, hashes), len(self.heavy) - 1)
        return np.where(self.heavy[place] == hashes, place, -1)

    def losses(self, count: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Loss of bigrams without the share of their histories, which ``started`` gives."""
        return -np.log(count + self.smoothing * share)

    def started(self, history: np.ndarray) -> np.ndarray:
        return np.log(history + self.smoothing)


def word_ids(keys: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words and of the words before them; ``at`` are the offsets of the texts' words."""
    if len(keys):
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        ids = np.where(keys[place] == hashes, place, len(keys))
    else:
        ids = np.zeros(len(hashes), np.int64)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[at[:-1][at[:-1] < at[1:]]] = len(keys) + 1
    return ids, before


def bigram_buckets(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Buckets that deal bigrams to parts; nothing is counted by them."""
    joint = (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)
    return (mix(joint + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)


_COUNTS = ("target", "background", "target_ends", "background_ends")


def _counted(rows: DataFrame) -> DataFrame:
    """Counts of every word of ``target`` and ``text`` rows, by its hash: in either model, and where it ends a text."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in stream:
            flags = batch.column("target").to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in text_blocks(batch.column("text")):
                hashes, _, at = words(data, offsets)
                own, which = np.unique(hashes, return_inverse=True)
                wanted = np.repeat(flags[begin:end], np.diff(at))
                last = np.zeros(len(hashes), bool)
                last[at[1:][np.diff(at) > 0] - 1] = True
                counts = [np.bincount(which[chosen], minlength=len(own)) for chosen in (wanted, slice(None), wanted & last, last)]
                parts.append((own, np.stack(counts).astype(np.int32)))
            if sum(len(x[0]) for x in parts) > GATHERED:
                parts = [_merged(parts)]
                if len(parts[0][0]) > GATHERED // 2:
                    yield batch_of(*parts.pop())
        if parts:
            yield batch_of(*_merged(parts))

    def batch_of(own: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [own.view(np.int64), *counts.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["word", *_COUNTS])

    found = rows.mapInArrow(batches, "word long, " + ", ".join(f"{name} long" for name in _COUNTS))
    return found.groupBy("word").agg(*[F.sum(name).alias(name) for name in _COUNTS])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    own, which = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
    counts = [np.bincount(which, np.concatenate([x[1][k] for x in parts]), len(own)) for k in range(len(_COUNTS))]
    return own, np.stack(counts).astype(np.int64)


def fit_frequent(rows: DataFrame, *, frequent: int = FREQUENT, heavy: int = HEAVY, smoothing: float = 4.0) -> FrequentWords:
    """What all tasks get of both models, from rows of ``target`` (boolean) and ``text``.

    The driver gets the counts of at most ``frequent`` words and of their pairs, and those of the heavy
    words: all with ``heavy`` occurrences, or twice or four times as many and so on, until they are at most
    SENT. Frequent words are the first of them. A model without any word has equal shares and no counts.
    """
    # Distinct words are counted in the job that keeps the heavy ones; it ends in that stage.
    seen, spark = Observation(), rows.sparkSession
    path = scratch_path(spark, "heavy-words")
    _counted(rows).observe(seen, F.count(F.lit(1)).alias("words")).where(F.col("background") >= heavy).write.parquet(path)
    kept = spark.read.parquet(path)
    while kept.where(F.col("background") >= heavy).count() > SENT:
        heavy *= 2
    kept = kept.where(F.col("background") >= heavy).select("word", *_COUNTS).toArrow()
    table = np.stack([column.to_numpy() for column in kept.columns], axis=1) if len(kept) else np.empty((0, 1 + len(_COUNTS)), np.int64)
    table = table[np.lexsort((table[:, 0], -table[:, 2]))]
    top, table = table[:frequent, :3], table[frequent:]
    table = table[np.argsort(table[:, 0].astype(np.uint64))]
    keys = top[:, 0].astype(np.uint64)
    order = np.argsort(keys)
    keys, size = keys[order], len(keys)
    known = top[order, 1:].T.astype(np.float64)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, (size + 2) * (size + 1)), np.int64)
        for batch in stream:
            flags = batch.column("target").to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in text_blocks(batch.column("text")):
                hashes, _, at = words(data, offsets)
                ids, before = word_ids(keys, hashes, at)
                pair, wanted = before * (size + 1) + ids, np.repeat(flags[begin:end], np.diff(at))
                np.add.at(sums[1], pair, 1)
                np.add.at(sums[0], pair[wanted], 1)
        used = np.flatnonzero(sums[1])
        for begin in range(0, len(used), 1 << 16):
            some = used[begin : begin + (1 << 16)]
            columns = [some.astype(np.int32), sums[0, some], sums[1, some]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["pair", "target", "background"])

    gathered = rows.mapInArrow(batches, "pair int, target long, background long")
    gathered = gathered.groupBy("pair").agg(F.sum("target").alias("target"), F.sum("background").alias("background")).toArrow()
    pairs = np.zeros((2, (size + 2) * (size + 1)))
    for k, name in enumerate(("target", "background")):
        pairs[k, gathered["pair"].to_numpy()] = gathered[name].to_numpy()
    pairs = pairs.reshape(2, size + 2, size + 1)
    # One more count for every word, and for one that no text has.
    totals = pairs.sum(axis=(1, 2))[:, None] + seen.get["words"] + 1
    others = table[:, 1:3].T.astype(np.float64)
    return FrequentWords(
        keys, totals, (known + 1) / totals, pairs.sum(axis=2), pairs, smoothing,
        table[:, 0].astype(np.uint64), (others + 1) / totals, others - table[:, 3:].T,
    )


def _dealt(rows: DataFrame, models: FrequentWords, parts: int) -> DataFrame:
    """Bigrams by block of texts and part, and for each block its ids and the losses known at once.

    ``words`` and ``before`` hold a hash, or a number: the id of a frequent word or of the start, behind
    them the place of a heavy word. ``rows`` holds the text's place in the block; ``counts`` four times the
    count, 2 if one of them ends the text, 1 if a target.
    """
    size = len(models.keys)
    first_heavy = size + 2

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in stream:
            flags = batch.column("target").to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in text_blocks(batch.column("text"), SENT_TOGETHER):
                hashes, _, at = words(data, offsets)
                count = np.diff(at)
                owner = np.repeat(np.arange(len(count)), count)
                ids, before = word_ids(models.keys, hashes, at)
                last = np.zeros(len(hashes), bool)
                last[at[1:][count > 0] - 1] = True
                here = (ids != size) & (before != size)
                near = np.flatnonzero(here)
                known = models.losses(models.pairs[:, before[near], ids[near]], models.shares[:, ids[near]])
                known += np.where(last[near], 0, models.started(models.histories[:, ids[near]]))
                sums = [np.bincount(owner[near], known[k], len(count)) for k in (0, 1)]
                sums = [x + np.where(count > 0, models.started(models.histories[k, size + 1]), 0) for k, x in enumerate(sums)]
                head = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), *map(pa.array, (count, *sums))], ["doc_id", "n_words", "target", "background"]
                )
                written = pa.BufferOutputStream()
                with pa.ipc.new_stream(written, head.schema) as sink:
                    sink.write_batch(head)
                yield of([block % parts], block, [b""], [b""], [b""], [b""], [written.getvalue().to_pybytes()])
                far = np.flatnonzero(~here)
                others = np.flatnonzero(ids == size)
                heavy = models.heavy_places(hashes[others])
                code = ids.astype(np.uint64)
                code[others] = np.where(heavy >= 0, (heavy + first_heavy).astype(np.uint64), hashes[others])
                rare = np.zeros(len(code), bool)
                rare[others] = heavy < 0
                previous = np.where(before[far] == size + 1, np.uint64(size + 1), code[far - 1])
                word, rare, place = code[far], rare[far], owner[far]
                del hashes, here, others, heavy, code, ids, before
                part = bigram_buckets(np.where(rare, np.uint64(0), previous), word) % parts
                order = np.lexsort((place, previous, word, part))
                columns = [x[order] for x in (part, word, previous, place)]
                starts = np.flatnonzero(_changes(*columns))
                part, word, previous, place = (x[starts] for x in columns)
                codes = 4 * np.diff(np.append(starts, len(far))) + flags[begin:end][place]
                if len(far):
                    codes += 2 * np.maximum.reduceat(last[far][order], starts)
                cuts = np.flatnonzero(_changes(part))
                place = place.astype(np.uint16 if len(count) <= 1 << 16 else np.uint32)
                fields = [[y.tobytes() for y in np.split(x, cuts[1:])] for x in (word, previous, place, codes.astype(np.uint32))]
                if len(cuts):
                    yield of(part[cuts].tolist(), block, *fields, [None] * len(cuts))
                block += 1

    def of(part: list[int], block: int, *fields: list[bytes | None]) -> pa.RecordBatch:
        columns = [pa.array(part, pa.int32()), pa.array([block] * len(part), pa.int64()), *(pa.array(x, pa.binary()) for x in fields)]
        return pa.RecordBatch.from_arrays(columns, ["part", "block", "words", "before", "rows", "counts", "head"])

    return rows.mapInArrow(batches, "part int, block long, words binary, before binary, rows binary, counts binary, head binary")


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it, and at the first."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return new


def _runs(stream: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key in turn, of a stream that is sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in stream:
        keys = batch.column(key).to_numpy()
        cuts = [*np.flatnonzero(_changes(keys)).tolist(), len(batch)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(key)[0].as_py() != keys[begin]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _part_losses(models: FrequentWords, word: np.ndarray, before: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Summed losses of each row of a part, under the target and under the background."""
    order = np.lexsort((before, word))
    word, before, codes = word[order], before[order], codes[order].astype(np.int64)
    number, ends, target = codes >> 2, codes >> 1 & 1, codes & 1
    new = _changes(word)
    words_at, pairs_at = np.flatnonzero(new), np.flatnonzero(new | _changes(before))
    own, pair = np.cumsum(new) - 1, np.repeat(np.arange(len(pairs_at)), np.diff(np.append(pairs_at, len(word))))
    names = word[words_at]
    first_heavy = len(models.keys) + 2
    known = np.flatnonzero(names < len(models.keys))
    wide = np.flatnonzero((names >= first_heavy) & (names < first_heavy + len(models.heavy)))
    heavy = (names[wide] - np.uint64(first_heavy)).astype(np.int64)
    sums = np.empty((2, len(word)))
    for k, wanted in enumerate((target, 1)):
        count = np.add.reduceat(number * wanted, words_at)
        history = (count - np.add.reduceat(ends * wanted, words_at)).astype(np.float64)
        share = (count + 1) / models.totals[k]
        share[known], history[known] = (x[k, names[known].astype(np.int64)] for x in (models.shares, models.histories))
        share[wide], history[wide] = models.heavy_shares[k, heavy], models.heavy_histories[k, heavy]
        loss = models.losses(np.add.reduceat(number * wanted, pairs_at), share[own[pairs_at]])
        sums[k, order] = number * loss[pair] + (number - ends) * models.started(history)[own]
    return sums


def _summed(dealt: DataFrame, models: FrequentWords) -> DataFrame:
    """(block, part, rows, sums, head): sums of the losses of a part's bigrams by text."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(stream, "part"):
            blocks, number = run["block"].to_pylist(), run["part"][0].as_py()
            heads = [(b, x) for b, x in zip(blocks, run["head"].to_pylist(), strict=True) if x is not None]
            for block, head in heads:
                yield of([block], number, [b""], [b""], [head])
            lists = [[x.as_buffer() for x in run[name]] for name in ("words", "before", "rows", "counts")]
            sizes = np.array([x.size // 8 for x in lists[0]])
            if not sizes.sum():
                continue
            word, before = (np.concatenate([np.frombuffer(x, np.uint64) for x in lists[k]]) for k in (0, 1))
            codes = np.concatenate([np.frombuffer(x, np.uint32) for x in lists[3]])
            kinds = [np.uint16 if x.size == 2 * n else np.uint32 for x, n in zip(lists[2], sizes.tolist(), strict=True)]
            place = np.concatenate([np.frombuffer(x, kind).astype(np.int64) for x, kind in zip(lists[2], kinds, strict=True)])
            place |= np.repeat(np.arange(len(sizes)), sizes) << 32
            del run, lists
            losses = _part_losses(models, word, before, codes)
            texts, which = np.unique(place, return_inverse=True)
            sums = np.stack([np.bincount(which, x, len(texts)) for x in losses], axis=1)
            cuts = np.flatnonzero(_changes(texts >> 32))
            used = [blocks[k] for k in (texts[cuts] >> 32).tolist()]
            rows = [x.tobytes() for x in np.split((texts & 0xFFFFFFFF).astype(np.uint32), cuts[1:])]
            for begin in range(0, len(cuts), 256):
                some = slice(begin, begin + 256)
                yield of(used[some], number, rows[some], [x.tobytes() for x in np.split(sums, cuts[1:])[some]], [None] * len(used[some]))

    def of(block: list[int], part: int, *fields: list[bytes | None]) -> pa.RecordBatch:
        columns = [pa.array(block, pa.int64()), pa.array([part] * len(block), pa.int32()), *(pa.array(x, pa.binary()) for x in fields)]
        return pa.RecordBatch.from_arrays(columns, ["block", "part", "rows", "sums", "head"])

    met = dealt.repartition("part").sortWithinPartitions("part", "block")
    return met.mapInArrow(batches, "block long, part int, rows binary, sums binary, head binary")


def score_bigrams(rows: DataFrame, models: FrequentWords, *, part_words: int = PART) -> DataFrame:
    """Return doc_id, n_words, target_loss, background_loss and difference for each of ``rows`` (doc_id, target, text)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "target_loss", "background_loss", "difference"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(stream, "block"):
            head = next(x for x in run["head"].to_pylist() if x is not None)
            head = pa.ipc.open_stream(head).read_next_batch()
            count = head.column("n_words").to_numpy()
            sums = np.stack([head.column(name).to_numpy() for name in ("target", "background")])
            for rows_of, of in zip(run["rows"], run["sums"], strict=True):
                # A text is there once at most.
                sums[:, np.frombuffer(rows_of.as_buffer(), np.uint32)] += np.frombuffer(of.as_buffer(), np.float64).reshape(-1, 2).T
            target, background = sums / np.maximum(count, 1)
            means = [pa.array(x, pa.float64(), mask=count == 0) for x in (target, background, target - background)]
            yield pa.RecordBatch.from_arrays([head.column("doc_id"), head.column("n_words"), *means], names)

    # The background's words, as totals have them with the distinct ones.
    parts = min(BUCKETS, 1 + int(models.totals[1, 0]) // part_words)
    met = _summed(_dealt(rows, models, parts), models).repartition("block").sortWithinPartitions("block", "part")
    return met.mapInArrow(batches, f"doc_id {kind}, n_words long, target_loss double, background_loss double, difference double")


def cross_entropy_difference(
    docs: DataFrame,
    target_ids: DataFrame,
    *,
    frequent: int = FREQUENT,
    heavy: int = HEAVY,
    part_words: int = PART,
    smoothing: float = 4.0,
) -> DataFrame:
    """Score all ``docs`` (doc_id, text) against those whose doc_id is in ``target_ids``.

    Counts cover every row: repeated rows count each time, and rows of null id are background only.
    ``target_ids`` may repeat ids, hold nulls, or name no document; with no target the target model
    has equal shares. A text without words has n_words 0 and null losses. The ids are sent to all
    tasks if they are counted to be few; else both sides are shuffled.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    ids = target_ids.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(True))
    few = ids.count() <= SENT
    rows = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left")
    rows = rows.select("doc_id", F.coalesce("target", F.lit(False)).alias("target"), "text")
    models = fit_frequent(rows.select("target", "text"), frequent=frequent, heavy=heavy, smoothing=smoothing)
    return score_bigrams(rows, models, part_words=part_words)
