"""Pieces, counts and packing against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm.packing import assign, digests, pack_documents
from quayside.llm.pieces import PieceTable
from quayside.llm.sentence_pieces import PieceEncoder, decode_pieces, encode_pieces, piece_digests
from quayside.llm.texts import text_blocks
from quayside.llm.token_counts import TokenCounter, count_tokens
from quayside.llm.word_ids import WordEncoder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [*"aA éßİΣς'’`.,!?-—_1２٣½\t\r\x0b\x1c\x85\x00  ́क़ﬁ中😀<|>ſKÅ▁​", "<|endoftext|>", "'s", "'LL", "the", "ing", " ", "\n", "   ", " " * 17, "<s>"]
texts = st.lists(st.sampled_from(SIGNS), max_size=14).map("".join) | st.text(max_size=20)


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(PieceTable(PIECES))


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PieceTable(PIECES))


@pytest.fixture(scope="module")
def words():
    return WordEncoder(WORDS)


def blocks(some):
    return text_blocks(pa.array(some, pa.string()), 1 << 10)


@settings(max_examples=150, deadline=None)
@given(st.lists(texts, max_size=6))
def test_pieces_are_the_librarys(library, encoder, counter, some):
    for begin, end, data, offsets in blocks(some):
        ids, at = encoder.encode(data, offsets)
        expected = library.encode(some[begin:end])
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == expected
        assert encoder.decode(ids, at) == [library.decode(x) for x in expected]
        assert counter.counts_of(data, offsets).tolist() == [len(x) for x in expected]


def test_long_runs(library, encoder, counter):
    some = [" " * k + tail for k in range(40) for tail in ("", "a", "the")] + ["a" * k for k in range(0, 300, 7)] + ["é" * 2_000_000]
    for begin, end, data, offsets in blocks(some):
        ids, at = encoder.encode(data, offsets)
        expected = library.encode(some[begin:end])
        assert np.diff(at).tolist() == [len(x) for x in expected] == counter.counts_of(data, offsets).tolist()
        assert ids.tolist() == [x for row in expected for x in row]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(3, 31_999) | st.integers(3, 258), max_size=8))
def test_any_ids_decode_like_the_library(library, encoder, ids):
    assert encoder.decode(np.array(ids, np.int32), np.array([0, len(ids)])) == [library.decode(ids)]


@pytest.mark.parametrize(("part", "look"), [(7, 3), (7, 0), (64, 16), (1, 1)])
def test_parts_of_long_chunks_compose(library, monkeypatch, part, look):
    """Texts without blanks, cut at any length; wrong guesses of entry states are made up for."""
    monkeypatch.setattr("quayside.llm.token_counts.PART", part)
    monkeypatch.setattr("quayside.llm.token_counts.LOOK", look)
    monkeypatch.setattr("quayside.llm.token_counts.STATES", 200)
    counter, draw = TokenCounter(PieceTable(PIECES)), random.Random(part)
    some = ["a" * 300, "ab" * 200, "the" * 100, "=" * 257, "".join(draw.choices("etaoin1=é中\x01", k=700)), "internationalization" * 20, "x", ""]
    for begin, end, data, offsets in text_blocks(pa.array(some)):
        expected = [len(x) for x in library.encode(some[begin:end])]
        assert counter.counts_of(data, offsets).tolist() == expected


def test_forgetting_changes_nothing(library, monkeypatch):
    import quayside.llm.sentence_pieces as S
    import quayside.llm.token_counts as C

    monkeypatch.setattr(C, "STATES", 50)
    monkeypatch.setattr(C, "CHUNKS", 20)
    monkeypatch.setattr(S, "SEGMENTS", 40)
    encoder, counter = PieceEncoder(PieceTable(PIECES)), TokenCounter(PieceTable(PIECES))
    draw = random.Random(3)
    some = [" ".join("".join(draw.choices(["the", "ing", "on", "q", "é"], k=4)) for _ in range(8)) for _ in range(60)]
    expected = [len(x) for x in library.encode(some)]
    counted, encoded = [], []
    for _, _, data, offsets in text_blocks(pa.array(some), 200):
        counted += counter.counts_of(data, offsets).tolist()
        encoded += np.diff(encoder.encode(data, offsets)[1]).tolist()
    assert counted == encoded == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(texts, max_size=6))
def test_word_ids_are_the_librarys(words, some):
    for begin, end, data, offsets in blocks(some):
        expected = [x.ids for x in words.tokenizer.encode_batch(some[begin:end], add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(data, offsets)] == expected


def test_queries_agree_with_the_library(spark, odd, odd_rows, library):
    found = sorted(map(tuple, piece_digests(odd.where("doc_id is not null"), PIECES).collect()))
    counted = sorted(map(tuple, count_tokens(odd.where("doc_id is not null"), PIECES, limit=50).collect()))
    expected, sizes = [], []
    for k, text in [(row[0], row[1] or "") for row in odd_rows if row[0] is not None]:
        ids = library.encode(text)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        expected.append((k, len(ids), *digest))
        sizes.append((k, len(text.encode()), len(ids), len(ids) > 50))
    assert found == sorted(expected)
    assert counted == sorted(sizes)


def test_decoding_is_an_operator_of_its_own(odd, odd_rows):
    decoded = decode_pieces(encode_pieces(odd, PIECES), PIECES)
    found = {row.doc_id: row.text for row in decoded.where("doc_id < 9").collect()}
    assert found == {row[0]: row[1] or "" for row in odd_rows if row[0] is not None and row[0] < 9}


def test_ids_of_pieces(odd, odd_rows, words):
    expected = {}
    for row in odd_rows:
        ids = np.array([*words.tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1], "<u4")
        expected.setdefault(row[0], []).append(ids)
    for row in digests(pack_documents(odd, WORDS)).collect():
        fits = [x for x in expected[row.doc_id] if len(x) == row.doc_tokens]
        assert row.ids_crc32 in [zlib.crc32(x[row.start : row.start + row.length].tobytes()) for x in fits]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=60))
def test_assignment(lengths):
    lengths = sorted(lengths, reverse=True)
    placed = assign(lengths, 2048, 1.0, 1 / 2048)
    filled = {}
    for _, _, length, sequence, offset in placed:
        assert offset == filled.get(sequence, 0)
        filled[sequence] = offset + length
    assert all(x <= 2048 for x in filled.values())
    assert len(filled) <= -(-sum(lengths) // 2048)
    for piece, length in enumerate(lengths):
        own = [(x[1], x[2]) for x in placed if x[0] == piece]
        assert [a for a, _ in own] == [sum(b for _, b in own[:k]) for k in range(len(own))]
        assert sum(b for _, b in own) == length


def test_costs_are_balanced():
    lengths = sorted([random.Random(5).randint(50, 600) for _ in range(2000)], reverse=True)
    cost = {}
    for _, _, length, sequence, _ in assign(lengths, 2048, 1.0, 1 / 2048):
        cost[sequence] = cost.get(sequence, 0) + length + length * length / 2048
    costs = sorted(cost.values())[5:]
    assert costs[-1] < 1.5 * costs[0]
