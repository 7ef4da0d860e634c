"""Phrases whose words stand together more often than their parts would by chance, for each language.

Frequent phrases are found level by level. A double-array trie of all phrases found so far goes to every
task, which moves the states of all text positions at once, a word at a time. A position is then at a
candidate of the next length if the states of its first words and of its last words both accept: no other
phrase can be frequent (the Apriori rule). Each task counts its own candidates, as edges that leave an
accepting state; the counts are summed over all tasks, and the frequent edges extend the trie.

The trie is bounded. Where a corpus has more frequent phrases than that, the levels found by then stay, and
the longer phrases are counted by shuffles of their hashes. By the same rule, only those are whose first and
last words pass a sieve of bounded size, made of the phrases one word shorter. What it lets through by chance
is counted too and found too rare, so the result is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.texts import mix, text_blocks, word_places
from quayside.session import scratch_path

#: Language of rows without one.
UNKNOWN = "und"
#: Most words and phrases of the trie that all tasks get; some 30 bytes each there.
MOST = 2_000_000
#: Places of the trie at which a state's children are tried.
TRIES = 128
#: Distinct candidates that a task gathers before it hands them on.
GATHERED = 1 << 20
#: Most blocks, of 64 bits, of the sieve that all tasks get, and the parts in which it is made.
BLOCKS, PARTS = 1 << 22, 64

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPACE = _BREAKS.copy()
_SPACE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _upper(keys: np.ndarray, size: int) -> np.ndarray:
    """The upper bits of hashes: numbers below ``size``, a power of two of 2 or more."""
    return (keys >> np.uint64(65 - size.bit_length())).view(np.int64)


@dataclass
class Trie:
    """A double-array trie over word numbers: the child of state s by word w is slot ``base[s] + w``,
    if ``check`` there is s. State 0 is the root, and word w alone has state 1 + w."""

    #: Hashes of (language, word), sorted, and the words' numbers. Words that often stand together should
    #: have near numbers, so that the children of a state are near each other.
    keys: np.ndarray
    numbers: np.ndarray
    base: np.ndarray = field(init=False)
    check: np.ndarray = field(init=False)
    #: For each value of the hashes' upper bits, the place of the first one that is not below it.
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        size = len(self.keys)
        bits = size.bit_length() + 1
        self.first = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
        self.base, self.check = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)
        self.base[0], self.check[0] = 1, -2  # nothing leads to the root

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        end = len(self.keys) - 1
        place = np.minimum(self.first[_upper(hashes, len(self.first))], end)
        low = np.flatnonzero(self.keys[place] < hashes)
        while len(low):  # a few steps, as hashes spread evenly
            low = low[place[low] < end]
            place[low] += 1
            low = low[self.keys[place[low]] < hashes[low]]
        return np.where(self.keys[place] == hashes, self.numbers[place], -1)

    def step(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none; states are not -1, words may be."""
        slots = self.base[states] + words
        inside = (words >= 0) & (slots > 0) & (slots < len(self.check))
        slots = np.where(inside, slots, 0)
        return np.where(self.check[slots] == states, slots, -1)

    def extend(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Give leaf states children; returns the new states in the order of the edges."""
        order = np.lexsort((words, states))
        parents, cuts, sizes = np.unique(states[order], return_index=True, return_counts=True)
        words, slots = words[order], np.empty(len(order), np.int64)
        used, random = len(self.check), np.random.default_rng(TRIES)
        check = np.concatenate([self.check, np.full(len(words), -1, np.int32)])
        base = np.concatenate([self.base, np.zeros(len(words), np.int32)])
        for k in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
            own = words[cuts[k] : cuts[k] + sizes[k]]
            if len(check) < used + own[-1] + 1:
                more = int(own[-1]) + 1 + len(check) // 4
                check = np.concatenate([check, np.full(more, -1, np.int32)])
                base = np.concatenate([base, np.zeros(more, np.int32)])
            # The earliest of some places where all children fall into gaps; behind the last slot they do.
            starts = np.append(np.sort(random.integers(1, used + 1, TRIES)), used) - own[0]
            some = max(1, GATHERED // len(own))
            for begin in range(0, len(starts), some):
                fits = (check[starts[begin : begin + some, None] + own] == -1).all(axis=1)
                if fits.any():
                    break
            start = int(starts[begin + fits.argmax()])
            own = start + own
            base[parents[k]], check[own] = start, parents[k]
            slots[cuts[k] : cuts[k] + sizes[k]] = own
            used = max(used, int(own[-1]) + 1)
        # Single children fill the gaps, all at once.
        single = np.flatnonzero(sizes == 1)
        gaps = np.flatnonzero(check[:used] == -1)[: len(single)]
        gaps = np.concatenate([gaps, np.arange(used, used + len(single) - len(gaps))])
        used = max(used, int(gaps[-1]) + 1 if len(gaps) else 0)
        if used > len(check):
            more = used - len(check)
            check = np.concatenate([check, np.full(more, -1, np.int32)])
            base = np.concatenate([base, np.zeros(more, np.int32)])
        at = cuts[single]
        base[parents[single]], check[gaps], slots[at] = gaps - words[at], parents[single], gaps
        self.base, self.check = base[:used], check[:used]
        found = np.empty_like(slots)
        found[order] = slots
        return found


@dataclass
class Known:
    """Frequent phrases of one length in a trie: their states, rising, their hashes, and the states of all
    words but the first; None for single words."""

    states: np.ndarray
    keys: np.ndarray
    tails: np.ndarray | None = None

    def ends(self, trie: Trie, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the phrases at edges that leave these: where those without the last and without the first word
        stand here, and the states of the latter."""
        head, last = np.searchsorted(self.states, edges >> 32), edges & 0xFFFFFFFF
        states = 1 + last if self.tails is None else trie.step(self.tails[head], last)
        return head, np.searchsorted(self.states, states), states


@dataclass
class Sieve:
    """A set of hashes that may hold others too: each has up to four bits in one of the blocks, 2^n of them."""

    blocks: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        marks = _marks(keys)
        return self.blocks[_upper(keys, len(self.blocks))] & marks == marks


def _marks(keys: np.ndarray) -> np.ndarray:
    """Four of 64 bits, by the lower bits of hashes."""
    return reduce(np.bitwise_or, [np.uint64(1) << (keys >> np.uint64(6 * k) & np.uint64(63)) for k in range(4)])


def _sieve(level: DataFrame) -> Sieve:
    """A sieve with the column ``key``: some 16 bits for each, as far as BLOCKS goes."""
    size = min(max(PARTS, 1 << (level.count() // 4).bit_length()), BLOCKS)

    def part(keys: pa.Table) -> pa.Table:
        own = keys["key"].to_numpy().view(np.uint64)
        blocks = np.zeros(size // PARTS, np.uint64)
        np.bitwise_or.at(blocks, _upper(own, size) % len(blocks), _marks(own))
        return pa.table({"part": keys["part"][:1], "blocks": pa.array([blocks.tobytes()], pa.binary())})

    keys = level.select(F.shiftrightunsigned("key", 65 - PARTS.bit_length()).alias("part"), "key")
    blocks = np.zeros((PARTS, size // PARTS), np.uint64)
    for row in keys.groupBy("part").applyInArrow(part, "part long, blocks binary").collect():
        blocks[row.part] = np.frombuffer(row.blocks, np.uint64)
    return Sieve(blocks.ravel())


def _texts(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks of (language, text) rows: languages, each word's place in them, its hash with the language,
    whether it opens a piece, and the lower-cased bytes with its first and the one after its last."""
    for batch in stream:
        coded = batch.column("lang").dictionary_encode()
        names, of = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        salts = np.array([_salt(name) for name in names], np.uint64)
        for begin, end, data, offsets in text_blocks(batch.column("text")):
            hashes, starts, ends = word_places(data, offsets, _SPACE)
            at = np.searchsorted(starts, offsets)
            lang = np.repeat(of[begin:end], np.diff(at))
            breaks = np.zeros(len(data) + 1, np.int32)
            np.cumsum(_BREAKS[data], out=breaks[1:])
            opens = np.ones(len(starts), bool)
            opens[1:] = breaks[starts[1:]] > breaks[ends[:-1]]
            opens[at[:-1][at[:-1] < at[1:]]] = True
            yield names, lang, mix(hashes ^ salts[lang]), opens, _LOWER[data], starts, ends


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts of spans as a column."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    raw = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes()))


def _key(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those without the last and without the first word."""
    return mix(heads * np.uint64(0x9E3779B97F4A7C15) + tails)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each stands first, and their summed counts."""
    own, first, which = np.unique(keys, return_index=True, return_inverse=True)
    sums = np.zeros(len(own), np.int64)
    np.add.at(sums, which, counts)
    return own, first, sums


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, word, key, n) for every word of rows (lang, text), and one row of null word with the sum of each language."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
        for names, lang, keys, _, data, starts, ends in _texts(stream):
            for name, count in zip(names, np.bincount(lang, minlength=len(names)).tolist(), strict=True):
                totals[name] = totals.get(name, 0) + count
            own, first, counts = np.unique(keys, return_index=True, return_counts=True)
            held.append((own, counts, pa.array(names).take(pa.array(lang[first])), _spans(data, starts[first], ends[first])))
            if sum(len(x[0]) for x in held) > GATHERED:
                held = [joined(held)]
                if len(held[0][0]) > GATHERED // 2:
                    yield of(*held.pop())
        if held:
            yield of(*joined(held))
        if totals:
            found = np.zeros(len(totals), np.uint64), np.array(list(totals.values()))
            yield of(*found, pa.array(list(totals)), pa.nulls(len(totals), pa.string()))

    def joined(held: list[tuple]) -> tuple:
        own, first, counts = _merged(*(np.concatenate([x[k] for x in held]) for k in (0, 1)))
        at = pa.array(first)
        return own, counts, *(pa.concat_arrays([x[k] for x in held]).take(at) for k in (2, 3))

    def of(keys: np.ndarray, counts: np.ndarray, langs: pa.Array, words: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [langs, words, pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "word", "key", "n"]
        )

    found = rows.mapInArrow(batches, "lang string, word string, key long, n long")
    return found.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _edges(rows: DataFrame, trie, length: int) -> DataFrame:
    """(edge, n): counts of all candidates of ``length`` words; an edge is a state and a word, 32 bits each.

    ``trie`` is the broadcast of the trie of all frequent phrases of fewer words.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Trie = trie.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, _, keys, opens, *_ in _texts(stream):
            words = tree.words(keys)
            at = np.flatnonzero(words >= 0)
            states = 1 + words[at]
            for ahead in range(1, length - 1):  # all positions that are still alive, a word further
                inside = at + ahead < len(words)
                at, states = at[inside], states[inside]
                goes = ~opens[at + ahead]
                at, states = at[goes], states[goes]
                states = tree.step(states, words[at + ahead])
                at, states = at[states >= 0], states[states >= 0]
            # The phrase without its first word has to be frequent too, that is, accepted at the next position.
            whole = np.flatnonzero((at[1:] == at[:-1] + 1) & ~opens[at[1:]])
            edges = states[whole] << 32 | words[at[whole] + length - 1]
            held.append(np.unique(edges, return_counts=True))
            if sum(len(x[0]) for x in held) > GATHERED:
                held = [joined(held)]
                if len(held[0][0]) > GATHERED // 2:
                    yield of(*held.pop())
        if held:
            yield of(*joined(held))

    def joined(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        own, _, counts = _merged(*(np.concatenate([x[k] for x in held]) for k in (0, 1)))
        return own, counts

    def of(edges: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(edges), pa.array(counts.astype(np.int64))], ["edge", "n"])

    return rows.mapInArrow(batches, "edge long, n long").groupBy("edge").agg(F.sum("n").alias("n"))


#: Columns of a level: key, head and tail tell phrases apart; lefts and rights are the counts of the first
#: 1, 2, .. words and of the last 1, 2, .. words, all but the whole.
_LEVEL = "lang string, phrase string, key long, head long, tail long, a long, lefts array<long>, rights array<long>"


def _levels_by_trie(
    rows: DataFrame, vocabulary: DataFrame, least: int, longest: int, most: int
) -> tuple[list[DataFrame], bool]:
    """Frequent phrases of 2, 3, .. words, and whether these are all of up to ``longest``: the length at which
    words and phrases come to be more than ``most`` is the last one here."""
    spark = rows.sparkSession
    known = vocabulary.count()
    if known > most:
        return [], False
    words = vocabulary.select("lang", "word", "key", "n").toArrow()
    # Numbers by language and falling count; frequent words follow one another most.
    words = words.sort_by([("lang", "ascending"), ("n", "descending"), ("word", "ascending")])
    keys = words["key"].to_numpy().view(np.uint64)
    del words
    order = np.argsort(keys)
    trie = Trie(keys[order], order)
    last = Known(1 + np.arange(len(keys)), keys)  # the last level found
    levels = [_single(vocabulary)]
    for length in range(2, longest + 1):
        shared = [spark.sparkContext.broadcast(x) for x in (trie, last)]
        frequent = _written(_edges(rows, shared[0], length).where(F.col("n") >= least), f"edges-{length}")
        size = frequent.count()
        known += size
        if size:
            levels.append(_joined(_edge_keys(frequent, *shared), levels[-1], length))
        for sent in shared:
            sent.destroy()
        if known > most:
            return levels[1:], length == longest
        if not size or length == longest:
            break
        edge = np.sort(frequent.select("edge").toArrow()["edge"].to_numpy())
        head, tail, tails = last.ends(trie, edge)
        states = trie.extend(edge >> 32, edge & 0xFFFFFFFF)
        order = np.argsort(states)
        last = Known(states[order], _key(last.keys[head], last.keys[tail])[order], tails[order])
    return levels[1:], True


def _edge_keys(edges: DataFrame, trie, last) -> DataFrame:
    """(key, head, tail, a) of edges (edge, n), by hashes; ``last`` is the broadcast of the level they leave."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            head, tail, _ = last.value.ends(trie.value, batch.column("edge").to_numpy())
            yield _keyed(last.value.keys[head], last.value.keys[tail], batch.column("n"))

    return edges.mapInArrow(batches, _KEYED)


#: Columns of counted phrases: hashes of the whole, and without the last and the first word.
_KEYED = "key long, head long, tail long, a long"


def _keyed(heads: np.ndarray, tails: np.ndarray, counts: pa.Array) -> pa.RecordBatch:
    columns = [pa.array(x.view(np.int64)) for x in (_key(heads, tails), heads, tails)]
    return pa.RecordBatch.from_arrays([*columns, counts], ["key", "head", "tail", "a"])


def _phrase_keys(rows: DataFrame, sieve, length: int) -> DataFrame:
    """(head, tail, a): counts of all candidates of ``length`` words, by hashes.

    ``sieve`` is the broadcast of the sieve of all frequent phrases one word shorter.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for _, _, keys, opens, *_ in _texts(stream):
            pieces = np.cumsum(opens)
            inside = pieces[: 1 - length] == pieces[length - 1 :]
            for _ in range(length - 2):
                keys = _key(keys[:-1], keys[1:])
            known = sieve.value.has(keys)
            at = np.flatnonzero(inside & known[:-1] & known[1:])
            held.append(joined([(keys[at], keys[at + 1], np.ones(len(at), np.int64))]))
            if sum(len(x[0]) for x in held) > GATHERED:
                held = [joined(held)]
                if len(held[0][0]) > GATHERED // 2:
                    yield of(*held.pop())
        if held:
            yield of(*joined(held))

    def joined(held: list[tuple]) -> tuple[np.ndarray, ...]:
        heads, tails, counts = (np.concatenate([x[k] for x in held]) for k in range(3))
        _, first, sums = _merged(_key(heads, tails), counts)
        return heads[first], tails[first], sums

    def of(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in columns], ["head", "tail", "a"])

    return rows.mapInArrow(batches, "head long, tail long, a long").groupBy("head", "tail").agg(F.sum("a").alias("a"))


def _with_keys(found: DataFrame) -> DataFrame:
    """(key, head, tail, a) of (head, tail, a)."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            heads, tails = (batch.column(x).to_numpy().view(np.uint64) for x in ("head", "tail"))
            yield _keyed(heads, tails, batch.column("a"))

    return found.mapInArrow(batches, _KEYED)


def _single(vocabulary: DataFrame) -> DataFrame:
    """The words as a level."""
    nothing = F.array().cast("array<long>")
    return vocabulary.select("lang", F.col("word").alias("phrase"), "key", F.col("n").alias("a"), nothing.alias("lefts"), nothing.alias("rights"))


def _joined(found: DataFrame, before: DataFrame, length: int) -> DataFrame:
    """The level of phrases (key, head, tail, a), from the level of one word less."""
    heads = before.select("lang", F.col("key").alias("head"), F.col("phrase").alias("first"), F.concat("lefts", F.array("a")).alias("lefts"))
    word = F.substring_index("phrase", " ", -1).alias("word")  # words have no blanks
    tails = before.select(F.col("key").alias("tail"), word, F.concat("rights", F.array("a")).alias("rights"))
    level = found.join(heads, "head").join(tails, "tail").withColumn("phrase", F.concat_ws(" ", "first", "word"))
    return _written(level.select([name.split()[0] for name in _LEVEL.split(", ")]), f"phrases-{length}")


def _levels_by_shuffle(rows: DataFrame, vocabulary: DataFrame, levels: list[DataFrame], least: int, longest: int) -> list[DataFrame]:
    """The levels given and all longer ones, counted by shuffles; no phrases are held in the driver or sent to all tasks."""
    spark, levels = rows.sparkSession, [*levels]
    for length in range(len(levels) + 2, longest + 1):
        before = levels[-1] if levels else _single(vocabulary)
        sieve = spark.sparkContext.broadcast(_sieve(before))
        found = _written(_with_keys(_phrase_keys(rows, sieve, length).where(F.col("a") >= least)), f"keys-{length}")
        sieve.destroy()
        if found.isEmpty():
            break
        levels.append(_joined(found, before, length))
    return levels


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _whole_phrases(levels: list[DataFrame]) -> DataFrame:
    """All levels' phrases but those that always stand inside the same longer one.

    A phrase and a longer one of equal count have one between them at each length, of that count too.
    """
    phrases = reduce(DataFrame.unionByName, [level.withColumn("length", F.lit(k)) for k, level in enumerate(levels)])
    ends = F.explode(F.array("head", "tail")).alias("key")
    inner = phrases.select(ends, "a", (F.col("length") - 1).alias("length")).where("length >= 0")
    return phrases.join(inner.distinct(), ["length", "key", "a"], "left_anti").select("lang", "phrase", "a", "lefts", "rights")


def mine_phrases(
    docs: DataFrame, *, least: int = 100, longest: int = 5, best: int = 2000, most: int = MOST, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """Return lang, rank, phrase, a, l, r, n and score: the best phrases of each language.

    Texts, A-Z lower-cased, are cut at ``. , ; : ! ?`` and \\x0A-\\x0D into pieces, these at blanks and tabs
    into words. n counts a language's words, a a phrase's occurrences inside pieces, overlaps included.
    Phrases of 2 to ``longest`` words with a >= ``least`` count; one cut in two, with counts l and r, scores
    floor(1000 * a * n / (l * r)), and the lowest score of all cuts counts, of equal ones the first. A
    phrase that always stands inside the same longer one is left out. The first ``best`` of a language by
    score, a (both falling) and phrase (by UTF-8 bytes) are ranked from 1.

    A null text is empty, a null language ``und``. Every row counts, repeated ones each time. Empty tables,
    and languages without frequent phrases, return no rows. Beyond ``most`` frequent words and phrases the
    longer ones are counted by shuffles. Words and phrases are told apart by 64-bit hashes.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = _written(count_words(rows).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    vocabulary = words.where(F.col("word").isNotNull())
    levels, whole = _levels_by_trie(rows, vocabulary, least, longest, most)
    if not whole:
        levels = _levels_by_shuffle(rows, vocabulary, levels, least, longest)
    spark: SparkSession = docs.sparkSession
    found = _whole_phrases(levels or [spark.createDataFrame([], _LEVEL)])
    totals = words.where(F.col("word").isNull()).select("lang", "n")
    # Both sides of a cut after k + 1 words; whole numbers of up to 38 digits, as products pass 64 bits.
    exact = """array_min(transform(lefts, (l, k) -> struct(
        (1000 * cast(a as decimal(19, 0)) * cast(n as decimal(18, 0)))
            div (cast(l as decimal(19, 0)) * cast(element_at(rights, size(lefts) - k) as decimal(19, 0))) as score,
        k, l, element_at(rights, size(lefts) - k) as r)))"""
    scored = found.join(totals, "lang").withColumn("cut", F.expr(exact))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
