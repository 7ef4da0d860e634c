"""Packing into fewest sequences: every id in one place, few sequences, plans that stay whole."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import island_packing
from quayside.llm.chunk_ids import ChunkEncoder
from quayside.llm.island_packing import best_fit, crossed, evolved, fewest, first_plans, mutated, pack_fewest, piece_digests, plan_sequences
from quayside.llm.queries import tokenizer
from quayside.llm.texts import text_blocks

PATH = "byte_bpe_50k.json"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(PATH))


def check(pieces, capacity: int) -> int:
    """Sequences are gapless and not too long; returns their number."""
    filled: dict[int, int] = {}
    for sequence, offset, length in sorted((x.sequence_id, x.offset, x.length) for x in pieces):
        assert offset == filled.get(sequence, 0) and length > 0
        filled[sequence] = offset + length
    assert all(x <= capacity for x in filled.values())
    return len(filled)


def test_chunks_have_the_ids_of_the_library():
    draw = random.Random(2)
    signs = [*" \n\t\r\x0b\x0c\x1c\x85  　abcDE'sréñßΩж中1٣.,!-_<>|😀\x00", "  ", "'s", "'LL", "<|endoftext|>", " the", "n't", "\n\n"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(4000)]
    encoder, found = ChunkEncoder(tokenizer(PATH)), []
    encoder.kept = 5000  # forgets now and then
    for _, _, data, offsets in text_blocks(pa.array(texts), 1 << 12):
        found += encoder.encode(data, offsets)
    expected = library().encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x.ids for x in expected]


def test_documents_come_back_whole(spark, odd, odd_rows):
    pieces = pack_fewest(odd, tokenizer(PATH), capacity=64).collect()
    check(pieces, 64)
    texts = library()
    expected = sorted((str(k), texts.encode(text or "", add_special_tokens=False).ids + [0]) for k, text, *_ in odd_rows)
    # Rows of equal ids are told apart by the order in which pieces follow one another.
    joined, parts = [], sorted(pieces, key=lambda x: (str(x.doc_id), x.piece))
    by_id: dict[str, list] = {}
    for x in parts:
        ids = np.frombuffer(x.ids, "<u4").tolist()
        assert len(ids) == x.length and x.length <= 64
        by_id.setdefault(str(x.doc_id), []).append((x.piece, x.start, ids))
    for name, own in by_id.items():
        whole = [ids for k, ids in expected if k == name]
        assert sorted(i for _, _, ids in own for i in ids) == sorted(i for ids in whole for i in ids)
        if len(whole) == 1:
            assert [start for _, start, _ in own] == np.cumsum([0, *[len(x) for _, _, x in own]])[:-1].tolist()
            assert [i for _, _, ids in own for i in ids] == whole[0]
            assert [k for k, _, _ in own] == list(range(len(own)))
            assert all(len(x) == 64 for _, _, x in own[1:])
        joined.append(name)
    assert set(joined) == {k for k, _ in expected}
    # Only longer rows are cut.
    assert all(x.piece == 0 for x in pieces if len(next(ids for k, ids in expected if k == str(x.doc_id))) <= 64 and str(x.doc_id) not in ("10", "None"))


def test_digests(spark, odd):
    found = piece_digests(pack_fewest(odd, tokenizer(PATH)))
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert all(0 <= x.ids_crc32 < 1 << 32 for x in found.collect())


def test_no_rows(spark, no_docs):
    assert pack_fewest(no_docs, tokenizer(PATH)).collect() == []


def test_equal_rows_go_to_many_groups(spark):
    docs = spark.createDataFrame([(1, "the same words in every row")], "doc_id long, text string")
    docs = docs.crossJoin(spark.range(3000)).select("doc_id", "text")
    pieces = pack_fewest(docs, tokenizer(PATH), capacity=64, group=200).collect()
    assert len(pieces) == 3000 and len({x.sequence_id >> 32 for x in pieces}) > 5
    length = pieces[0].length
    assert check(pieces, 64) <= -(-3000 // (64 // length)) + 20


@pytest.mark.parametrize("seed", range(4))
def test_plans_stay_whole_and_get_no_worse(seed):
    draw = np.random.default_rng(seed)
    lengths = np.sort(draw.integers(1, 100, 300))[::-1].astype(np.int64)
    plans = first_plans(lengths, 100, 4, draw)
    best = evolved(lengths, plans, 100, 30, draw)
    children = [crossed(lengths, plans[1], plans[2], 0.2, 100, draw), mutated(lengths, plans[0], 0.05, 100, draw)]
    for plan in [*plans, *best, *children]:
        fill = np.bincount(plan, lengths)
        assert (fill <= 100).all() and (fill > 0).all() and len(plan) == 300
    assert len(best) == 4
    assert best[0].max() <= min(x.max() for x in plans)
    assert fewest(lengths, 100) <= best[0].max() + 1


def test_crossover_keeps_the_injected_sequences():
    lengths = np.array([7, 6, 5, 5, 4, 3], np.int64)
    one, other = np.array([0, 1, 2, 2, 1, 0]), np.array([0, 1, 2, 2, 1, 0])
    other = np.array([0, 1, 2, 3, 1, 0])
    child = crossed(lengths, one, other, 0.5, 10, np.random.default_rng(0))
    fill = np.bincount(child, lengths)
    assert fill.max() <= 10 and fill.sum() == lengths.sum() and len(fill) == 3


def test_evolution_beats_best_fit():
    # Three or four pieces fill a sequence, so best fit by falling length leaves much room.
    draw = np.random.default_rng(1)
    lengths = np.sort(draw.integers(200, 350, 900))[::-1].astype(np.int64)
    plans = first_plans(lengths, 1000, 4, draw)
    better = evolved(lengths, plans, 1000, 200, draw)
    assert better[0].max() <= min(x.max() for x in plans) - 2


def test_lower_bound():
    assert fewest(np.array([60, 60, 60]), 100) == 3
    assert fewest(np.array([51, 51, 49, 49]), 100) == 2
    assert fewest(np.array([60, 60, 45, 45]), 100) == 3
    assert fewest(np.array([100, 1]), 100) == 2
    for seed in range(20):
        lengths = np.random.default_rng(seed).integers(1, 30, 8)
        assert -(-lengths.sum() // 30) <= fewest(lengths, 30) <= len(set(best_fit(lengths.tolist(), list(range(8)), [], 30)))


def test_islands_exchange_and_every_unit_is_placed(spark, monkeypatch):
    draw = np.random.default_rng(1)
    lengths = [int(x) for x in draw.integers(300, 700, 900)] + [1000] * 5
    units = spark.createDataFrame(list(enumerate(lengths)), "unit long, length long").repartition(4)
    found = plan_sequences(units, capacity=1000, group=300, islands=3, epochs=3, children=6).collect()
    assert sorted(x.unit for x in found) == list(range(len(lengths)))
    used: dict[int, list] = {}
    for x in found:
        used.setdefault(x.sequence_id, []).append((x.offset, lengths[x.unit]))
    for own in used.values():
        own.sort()
        assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]
        assert sum(x[1] for x in own) <= 1000
    again = plan_sequences(units, capacity=1000, group=300, islands=3, epochs=3, children=6).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    monkeypatch.setattr(island_packing, "fewest", lambda lengths, capacity: 0)
    longer = plan_sequences(units, capacity=1000, group=300, islands=3, epochs=2, children=6).collect()
    assert len({x.sequence_id for x in longer}) <= len(used) + 3
