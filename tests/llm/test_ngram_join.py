"""The Jaccard join and the pipeline against brute force."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from odd_texts import prose

import corpus_pipeline
from quayside.llm import ngram_join
from quayside.llm.ngram_join import components, jaccard_components, one_of_each_group
from quayside.llm.quality import score_quality
from quayside.llm.queries import table
from quayside.llm.toxicity import score_toxicity

SF_DIR = "/root/testdata/sf0.001"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def groups(rows):
    sets = {k: shingle_set(text) for k, text in rows}
    least = {k: k for k in sets}

    def top(k):
        while least[k] != k:
            k = least[k]
        return k

    order = sorted(sets)
    for a in order:
        for b in order:
            if a < b and (sets[a] & sets[b]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                least[high] = low
    return sorted((k, len(sets[k]), top(k)) for k in sets)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10_000)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_CLASS", 3)
    monkeypatch.setattr(ngram_join, "REGION", 7)
    draw = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    texts = []
    for cluster in range(4):  # one dense group, chains of edits, and a passage in all of one cluster
        base = [f"c{cluster}x{draw.randrange(400)}" for _ in range(90)]
        if cluster == 3:
            base = passage + base[:15]
        for _ in range(25):
            texts.append(edited(draw, base, draw.randint(0, 6)))
            if cluster == 1:
                base = texts[-1].split()
    texts += [" ".join(passage + [f"u{k}y{j}" for j in range(draw.randint(5, 60))]) for k in range(40)]
    texts += ["a b c", "A  b C", "a b", "", None, "x y z q r", "x y z q r s"]
    draw.shuffle(texts)
    rows = list(enumerate(texts, 5))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, found.collect())) == groups(rows)


def test_components_of_a_long_chain(spark):
    chain = list(range(200))
    random.Random(4).shuffle(chain)
    edges = [*zip(chain[:-1], chain[1:], strict=True), (500, 501), (501, 502), (502, 500), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(k, 0) for k in range(200)] + [(500, 500), (501, 500), (502, 500)]


def test_a_repeated_id_with_other_texts(spark):
    base, other = prose(50, 40), prose(51, 40)
    rows = [(1, base), (5, base + " x"), (5, other), (7, other + " y"), (7, base), (8, None), (8, ""), (9, prose(52, 3)), (9, prose(52, 3))]
    docs = spark.createDataFrame([(*x, "s", 2) for x in rows], "doc_id long, text string, mark string, kept_id int")
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((x.doc_id, x.text or "") for x in kept.collect()) == sorted([(1, base), (5, other), (8, ""), (8, ""), (9, prose(52, 3))])
    # Two texts of one id in one component: one of them stays.
    twice = spark.createDataFrame([(3, base), (3, base + " x"), (4, base)], "doc_id long, text string")
    assert [x.doc_id for x in one_of_each_group(twice).collect()] == [3]


def test_one_of_each_group(odd):
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    ids = sorted((row.doc_id for row in kept.collect()), key=lambda k: (k is None, k or 0))
    assert ids == [0, 3, 4, 5, 6, 8, 9, 10, 10, 11, 12, 13, None, None]


def test_pipeline_against_its_parts(spark):
    """Each stage's rows from the operators' own results, and near copies by brute force."""
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    good = {row.doc_id for row in score_quality(docs, labels).where("predicted = 1").collect()}
    after = docs.where(docs.doc_id.isin(sorted(good)))
    clean = {row.doc_id for row in score_toxicity(after, labels).where("predicted = 0").collect()}
    rows = [(row.doc_id, row.text) for row in after.collect() if row.doc_id in clean]
    kept = {k: text for k, text in rows if k in {component for _, _, component in groups(rows)}}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {row.doc_id for row in found} == set(kept)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    import numpy as np

    whole = {}
    for row in sorted(found, key=lambda row: (row.doc_id, row.start)):
        whole.setdefault(row.doc_id, []).extend(np.frombuffer(row.ids, "<u4").tolist())
    for k, text in kept.items():
        assert whole[k] == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_on_no_rows(spark, odd, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    found = stage(spark, odd, SF_DIR)
    if name != "packing":
        assert found.columns == odd.columns
    assert found.count() > 0
    assert stage(spark, no_docs, SF_DIR).count() == 0
