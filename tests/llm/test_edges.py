"""Every operator on odd rows and on empty tables: one defined result for each row."""

from __future__ import annotations

import public_tokenizers
import pytest

from quayside.llm.language_id import identify_languages
from quayside.llm.lm_scoring import cross_entropy_difference
from quayside.llm.ngram_join import jaccard_components
from quayside.llm.packing import digests, pack_documents
from quayside.llm.quality import score_quality
from quayside.llm.sentence_pieces import piece_digests
from quayside.llm.token_counts import count_tokens
from quayside.llm.toxicity import score_toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

BY_ROW = {
    "lm_scoring": lambda docs, labels: cross_entropy_difference(docs, labels.where("quality = 1")),
    "toxicity": score_toxicity,
    "language_id": lambda docs, _: identify_languages(docs),
    "sentence_pieces": lambda docs, _: piece_digests(docs, PIECES),
    "ngram_join": lambda docs, _: jaccard_components(docs),
    "quality": score_quality,
    "token_counts": lambda docs, _: count_tokens(docs, PIECES),
}


def by_id(frame):
    rows = [tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in frame.collect()]
    return sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, repr(row)))


@pytest.mark.parametrize("name", BY_ROW)
def test_one_result_for_every_row(odd, odd_labels, odd_rows, name):
    found = by_id(BY_ROW[name](odd, odd_labels))
    ids = sorted((row[0] for row in odd_rows), key=lambda k: (k is None, k or 0))
    assert [row[0] for row in found] == ids
    assert found == by_id(BY_ROW[name](odd.repartition(5), odd_labels))


@pytest.mark.parametrize("name", BY_ROW)
def test_no_rows(no_docs, no_labels, odd_labels, name):
    assert BY_ROW[name](no_docs, no_labels).count() == 0
    assert BY_ROW[name](no_docs, odd_labels).count() == 0


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_scores_without_labels(odd, no_labels, score):
    rows = score(odd, no_labels).collect()
    assert {row.score for row in rows} == {0.5}
    assert {row.predicted for row in rows} == {0}


def test_und_without_letters(odd):
    found = {row.doc_id: row for row in identify_languages(odd).where("doc_id is not null").collect()}
    assert {k for k, row in found.items() if row.lang_pred == "und"} == {3, 4, 5, 11}
    assert all(row.score == 0 for row in found.values() if row.lang_pred == "und")


def test_losses_of_texts_without_words(odd, no_labels):
    found = {row.doc_id: row for row in cross_entropy_difference(odd, no_labels).collect()}
    for k in (3, 4, 5):
        assert found[k].n_words == 0
        assert found[k].difference is None
    assert found[6].difference == pytest.approx(found[7].difference)


def test_groups_of_odd_rows(odd):
    found = {(row.doc_id, row.n_shingles): row.component_id for row in jaccard_components(odd).where("doc_id is not null").collect()}
    by_doc = {k: component for (k, _), component in found.items()}
    assert [by_doc[k] for k in (0, 1, 2, 14)] == [0] * 4
    assert [by_doc[k] for k in (3, 4, 5)] == [3, 4, 5]
    assert [by_doc[k] for k in (6, 7, 9)] == [6, 6, 9]
    assert jaccard_components(odd).where("doc_id is null and component_id is null").count() == 2


def test_packing_covers_odd_rows(odd, odd_rows, no_docs):
    rows = digests(pack_documents(odd, WORDS)).collect()
    total = sum(row.length for row in rows)
    expected = {}
    for row in rows:
        expected.setdefault((row.doc_id, row.doc_tokens), 0)
    assert {k for k, _ in expected} == {row[0] for row in odd_rows}
    empty = [row for row in rows if row.doc_id in (3, 4, 5)]
    assert [(row.start, row.length, row.doc_tokens) for row in empty] == [(0, 1, 1)] * 3
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == -(-total // 2048)
    assert pack_documents(no_docs, WORDS).count() == 0
