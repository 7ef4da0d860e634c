"""Trained scores: held-out accuracy on the tables, and their parts against plain versions."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm.language_id import ByteNetwork, identify_languages, windows
from quayside.llm.lm_scoring import cross_entropy_difference
from quayside.llm.quality import STATISTICS, _isotonic, _statistics, score_quality
from quayside.llm.queries import table
from quayside.llm.texts import flat, shingles, text_blocks, words
from quayside.llm.toxicity import score_toxicity

SF_DIR = "/root/testdata/sf0.01"


def held_out(spark, scored, label):
    rows = scored.where("held_out").join(table(spark, SF_DIR, "labels"), "doc_id").toPandas()
    good, bad = (rows[rows[label] == k]["score"].to_numpy() for k in (1, 0))
    return (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2


def test_quality_tells_held_out_texts(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    assert held_out(spark, score_quality(docs, labels), "quality") > 0.95


def test_toxicity_tells_held_out_texts(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    scored = score_toxicity(docs, labels)
    assert held_out(spark, scored, "toxic") > 0.85
    # Clean held-out documents are left alone.
    assert scored.where("held_out and predicted = 1").join(labels.where("toxic = 0"), "doc_id").count() <= 1


def test_languages_of_held_out_texts(spark):
    docs = table(spark, SF_DIR, "documents")
    found = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found["lang_pred"] == found["lang"]).mean() > 0.95
    assert found["score"].between(0, 1).all()


def test_labels_of_held_out_rows_do_not_matter(spark):
    """Turning the labels that may not be learned changes no score."""
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    before, after = (score_quality(docs, x).toPandas().sort_values("doc_id") for x in (labels, turned))
    assert np.allclose(before["score"], after["score"], atol=1e-6)


def test_words_and_shingles():
    texts = ["The quick\tBROWN fox", None, "", " \n ", "a b c d e f a b c d e", "the QUICK brown fox", "É é x\x00y"]
    data, offsets = flat(pa.array(texts))
    hashes, lengths, at = words(data, offsets)
    expected = [(text or "").encode().lower().split() for text in texts]
    assert np.diff(at).tolist() == [len(x) for x in expected]
    assert lengths.tolist() == [len(x) for row in expected for x in row]
    names = [x for row in expected for x in row]
    assert len(set(zip(names, hashes.tolist(), strict=True))) == len(set(names)) == len(set(hashes.tolist()))
    sets = shingles(hashes, at, 5)
    assert [len(x) for x in sets] == [1, 0, 0, 0, 6, 1, 1]
    assert sets[0].tolist() == sets[5].tolist()


def test_statistics_of_plain_texts():
    texts = ["", "one two two", "A|B!\n1"]
    data, offsets = flat(pa.array(texts))
    rows = _statistics(data, offsets)
    assert not rows[0].any()
    named = dict(zip(STATISTICS, rows[1], strict=True))
    assert named["log_words"] == math.log1p(3)
    assert named["distinct_share"] == pytest.approx(2 / 3)
    assert named["top_share"] == pytest.approx(2 / 3)
    named = dict(zip(STATISTICS, rows[2], strict=True))
    for kind in ("bar", "loud", "line", "digit"):
        assert named[kind] == pytest.approx((1 / 6) ** 0.5)
    assert named["upper"] == pytest.approx((2 / 6) ** 0.5)


def test_isotonic_levels_rise():
    knots, levels = _isotonic(np.arange(5.0), np.array([1.0, 0, 2, 1, 4]), np.array([4, 4, 4, 4, 4]))
    assert (np.diff(levels) > 0).all()
    assert len(knots) == 3


def test_network_gradients():
    random = np.random.default_rng(2)
    net = ByteNetwork.new(3, random)
    for name, value in vars(net).items():
        setattr(net, name, value.astype(np.float64))
    rows, labels = random.integers(32, 120, (6, 96)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -np.log(net.probabilities(rows)[np.arange(6), labels]).mean()

    for name, slope in zip(vars(net), net.gradients(rows, labels), strict=True):
        value = getattr(net, name)
        at = np.unravel_index(np.abs(slope).argmax(), value.shape)
        value[at] += 1e-6
        above = loss()
        value[at] -= 2e-6
        assert slope[at] == pytest.approx((above - loss()) / 2e-6, rel=1e-3)
        value[at] += 1e-6


def test_windows_hold_whole_texts():
    texts = ["", "Ab", "x" * 96, "y" * 97, None, "z" * 300]
    for _, _, data, offsets in text_blocks(pa.array(texts)):
        rows, first = windows(data, offsets)
        joined = [rows[a:b].tobytes().decode() for a, b in zip(first[:-1], first[1:], strict=True)]
        assert [x.rstrip() for x in joined] == [(text or "").lower() for text in texts]


@pytest.mark.parametrize("options", [{}, {"heavy": 1}, {"heavy": 2, "frequent": 1}, {"heavy": 1, "frequent": 0, "part_words": 2}])
def test_losses_by_plain_counting(spark, options):
    texts = [(0, "a b a c"), (1, "a b"), (2, "c c d"), (3, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    target = spark.createDataFrame([(1,), (2,), (77,)], "doc_id long")
    found = {row.doc_id: row for row in cross_entropy_difference(docs, target, **options).collect()}
    vocabulary = {w for _, text in texts for w in text.split()}

    def model(rows):
        single, history, pair = Counter(), Counter(), Counter()
        for row in (text.split() for text in rows):
            before = [None, *row][: len(row)]
            single.update(row)
            history.update(before)
            pair.update(zip(before, row, strict=True))
        total = single.total() + len(vocabulary) + 1

        def loss(text):
            row = text.split()
            shares = [(single[w] + 1) / total for w in row]
            pairs = zip([None, *row], row, shares, strict=False)
            return -sum(math.log((pair[x, y] + 4 * share) / (history[x] + 4)) for x, y, share in pairs) / len(row)

        return loss

    of_target, of_all = model(["a b", "c c d"]), model([text for _, text in texts])
    for k, text in texts[:3]:
        assert found[k].target_loss == pytest.approx(of_target(text))
        assert found[k].background_loss == pytest.approx(of_all(text))
        assert found[k].difference == pytest.approx(of_target(text) - of_all(text))


def test_losses_of_many_words_are_exact(spark):
    """More words than 2^16, and more bigrams than 2^16: no word is unknown, no counts are shared."""
    random = np.random.default_rng(4)
    drawn = [[f"w{k}" for k in random.permutation(70_000)[:35_000]] for _ in range(4)]
    texts = [(k, " ".join(row)) for k, row in enumerate(drawn)]
    texts += [(4, "the end of the end of the text"), (5, " ".join(f"the w{k}" for k in range(200)) + " w7 the"), (5, "w7 the"), (None, "w7")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    wanted = {1, 5}
    single, history, pair = ([Counter(), Counter()] for _ in range(3))
    for doc, text in texts:
        row = text.split()
        for k in (0, 1) if doc in wanted else (1,):
            single[k].update(row)
            history[k].update([None, *row[:-1]])
            pair[k].update(zip([None, *row[:-1]], row, strict=True))
    assert len(single[1]) > 1 << 16

    def losses(text):
        row, sums = text.split(), []
        for k in (0, 1):
            total = single[k].total() + len(single[1]) + 1
            smoothed = [
                (pair[k][x, y] + 4 * (single[k][y] + 1) / total) / (history[k][x] + 4) for x, y in zip([None, *row[:-1]], row, strict=True)
            ]
            sums.append(-sum(map(math.log, smoothed)) / len(row))
        return sums

    target = spark.createDataFrame([(k,) for k in wanted], "doc_id long")
    expected = sorted((-1 if k is None else k, len(text.split()), *losses(text)) for k, text in texts)
    # As registered, with few frequent words and many parts, and with heavy words.
    for options in ({}, {"frequent": 5, "part_words": 10_000}, {"frequent": 5, "heavy": 3, "part_words": 10_000}):
        found = cross_entropy_difference(docs, target, **options).collect()
        found = sorted((-1 if row.doc_id is None else row.doc_id, *row[1:]) for row in found)
        assert [row[:2] for row in found] == [row[:2] for row in expected]
        for own, (_, _, of_target, of_all) in zip(found, expected, strict=True):
            assert own[2:] == pytest.approx((of_target, of_all, of_target - of_all), rel=1e-9)
