"""Phrase mining against plain counting, on tiny corpora and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quayside.llm import phrases
from quayside.llm.phrases import Trie, mine_phrases


def plain(rows: list[tuple[str | None, str | None]], least: int, longest: int, best: int) -> list[tuple]:
    totals: Counter = Counter()
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(words[i : i + size] for i in range(len(words) - size + 1))
    found = []
    for lang, count in counts.items():
        frequent = {words: f for words, f in count.items() if f >= least}
        hidden = set()
        for words, f in frequent.items():
            for size in range(2, len(words)):
                hidden |= {words[i : i + size] for i in range(len(words) - size + 1) if frequent[words[i : i + size]] == f}
        lines = []
        for words, a in frequent.items():
            if len(words) < 2 or words in hidden:
                continue
            cuts = [(1000 * a * totals[lang] // (frequent[words[:k]] * frequent[words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            lines.append((" ".join(words), a, frequent[words[:k]], frequent[words[k:]], totals[lang], score))
        lines.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        found += [(lang, rank, *line) for rank, line in enumerate(lines[:best], 1)]
    return sorted(found)


def mined(spark, rows, **how) -> list[tuple]:
    docs = spark.createDataFrame(rows, "lang string, text string, phrase int, n int, key string, score string, word string").repartition(3)
    found = mine_phrases(docs, **how)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(x) for x in found.collect())


def corpus(seed: int, texts: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["the", "The", "of", "cat", "dog", "é", "中", "x\x00y", "don't", "a-b", "zz"]
    signs = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ! ", ":"]
    rows = []
    for k in range(texts):
        text = "".join(draw.choice(words) + draw.choice(signs) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "de", None, "und"]), text if k % 17 else None, 1, 2, "k", "s", "w"))
    return rows


@pytest.mark.parametrize(("least", "longest", "best"), [(2, 5, 2000), (3, 4, 7), (1, 2, 50), (25, 5, 2000)])
def test_as_plain_counting(spark, least, longest, best):
    rows = corpus(least, 120)
    expected = plain([x[:2] for x in rows], least, longest, best)
    assert expected
    assert mined(spark, rows, least=least, longest=longest, best=best) == expected


@pytest.mark.parametrize("most", [0, 40, 150])
def test_beyond_the_trie_shuffles_give_the_same(spark, most):
    rows = corpus(5, 120)
    assert mined(spark, rows, least=2, most=most) == plain([x[:2] for x in rows], 2, 5, 2000)


def test_small_buffers_and_blocks(spark, monkeypatch):
    rows = corpus(6, 120)
    monkeypatch.setattr(phrases, "GATHERED", 3)
    assert mined(spark, rows, least=2) == plain([x[:2] for x in rows], 2, 5, 2000)


def test_overlaps_and_phrases_inside_longer_ones(spark):
    rows = [("en", "a a a a b, a a a a b, q r s t u, q r s t u q", 1, 1, "", "", "")] * 3
    found = mined(spark, rows, least=3)
    assert found == plain([x[:2] for x in rows], 3, 5, 2000)
    kept = {x[2] for x in found}
    assert "q r s t u" in kept and "r s t" not in kept and "a a" in kept


def test_odd_rows(spark, odd, odd_rows):
    found = sorted(tuple(x) for x in mine_phrases(odd, least=2).collect())
    assert found == plain([(lang, text) for _, text, lang, *_ in odd_rows], 2, 5, 2000)
    assert found


def test_no_rows(spark, no_docs, odd):
    assert mine_phrases(no_docs).collect() == []
    assert mine_phrases(odd, least=10**6).collect() == []


def test_trie_finds_what_was_put_in():
    draw = np.random.default_rng(1)
    size = 300
    keys = np.sort(draw.integers(0, 1 << 63, size).astype(np.uint64))
    trie = Trie(keys, draw.permutation(size))
    assert sorted(trie.words(keys).tolist()) == list(range(size))
    assert trie.words(np.array([1], np.uint64)).tolist() == [-1]
    level = np.arange(1, size + 1)
    known: set[tuple[int, int]] = set()
    for _ in range(3):
        edges = np.unique(draw.choice(level, 900) * size + np.minimum(draw.pareto(0.7, 900) * 3, size - 1).astype(int))
        states, words = edges // size, edges % size
        level = trie.extend(states, words)
        known |= set(zip(states.tolist(), words.tolist(), strict=True))
        assert (trie.step(states, words) == level).all()
        assert len(set(level.tolist())) == len(level)
    asked = draw.integers(0, len(trie.check), 5000), draw.integers(-1, size, 5000)
    found = trie.step(*asked) >= 0
    roots = asked[0] == 0
    expected = np.array([(s, w) in known for s, w in zip(*(x.tolist() for x in asked), strict=True)])
    assert (found[~roots] == expected[~roots]).all()


@pytest.mark.parametrize("most", [0, 40, 150])
def test_beyond_the_trie_each_length_is_counted_once(spark, monkeypatch, most):
    counted = []
    for name in ("_edges", "_phrase_keys"):

        def spy(rows, *more, of=getattr(phrases, name), name=name):
            counted.append((name, more[-1]))
            return of(rows, *more)

        monkeypatch.setattr(phrases, name, spy)
    rows = corpus(5, 120)
    assert mined(spark, rows, least=2, most=most) == plain([x[:2] for x in rows], 2, 5, 2000)
    assert [length for _, length in counted] == [2, 3, 4, 5]
    assert counted[-1][0] == "_phrase_keys"


def test_beyond_the_trie_rare_words_make_no_candidates(spark, monkeypatch):
    sizes = []

    def spy(*given, of=phrases._phrase_keys):
        found = of(*given)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(phrases, "_phrase_keys", spy)
    rows = [("en", f"p q r s{k % 3} t p q rare{k} odd{k} few{k}", 1, 1, "", "", "") for k in range(300)]
    assert mined(spark, rows, least=50, most=0) == plain([x[:2] for x in rows], 50, 5, 2000)
    assert len(sizes) == 4 and max(sizes) < 50  # of some 2,000 of any length


def test_a_full_sieve_changes_nothing(spark, monkeypatch):
    rows = corpus(7, 120) + [("en", " ".join(f"w{k * j % 89}" for j in range(80)), 1, 1, "", "", "") for k in range(90)]
    expected = plain([x[:2] for x in rows], 3, 5, 10**6)
    monkeypatch.setattr(phrases, "BLOCKS", phrases.PARTS)
    assert mined(spark, rows, least=3, best=10**6, most=0) == expected
    monkeypatch.setattr(phrases.Sieve, "has", lambda self, keys: np.ones(len(keys), bool))
    monkeypatch.setattr(phrases, "GATHERED", 3)
    assert mined(spark, rows, least=3, best=10**6, most=0) == expected


def test_sieve_holds_its_keys_and_few_others(spark):
    keys = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 5000, np.int64)
    sieve = phrases._sieve(spark.createDataFrame([(int(k),) for k in keys[:3000]], "key long"))
    known = sieve.has(keys.view(np.uint64))
    assert known[:3000].all() and known[3000:].sum() < 200
    assert not phrases._sieve(spark.createDataFrame([], "key long")).has(keys.view(np.uint64)).any()


@pytest.mark.parametrize("size", [0, 1, 2, 3, 1000])
def test_words_of_a_trie(size):
    draw = np.random.default_rng(size)
    keys = np.unique(np.append(draw.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2), [np.uint64(0), ~np.uint64(0)][:size]))
    trie = Trie(keys, draw.permutation(len(keys)))
    asked = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), np.array([0, 5, 2**64 - 1], np.uint64)])
    numbers = dict(zip(keys.tolist(), trie.numbers.tolist(), strict=True))
    assert trie.words(asked).tolist() == [numbers.get(k, -1) for k in asked.tolist()]
