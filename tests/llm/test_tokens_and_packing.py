from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st

from cohortline.llm.pattern_packing import best_fit, pack_patterns, patterns, plan_packing, slots
from cohortline.llm.token_matrix import RoomTree, best_fit_decreasing, matrix_pieces, pack_matrix
from cohortline.llm.tokens import cut_lengths, cut_pieces, encoder, tokenizer_path

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_parts_give_the_ids_of_the_whole_text(whole):
    rng = random.Random(3)
    bits = ["a", "b ", "  ", " ", "\n", "\t", "é", "'s", "'", "12", "!", " ", "　", "<|endoftext|>", "Ab", "\x1c", "\r\n", "中", "😀", "́", "\x85", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    made = encoder(tokenizer_path()).encode([t.encode() for t in texts])
    for text, ids in zip(texts, made):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text), text


def test_strings_of_special_tokens_are_these_tokens(whole):
    end = "<|endoftext|>"
    texts = [f"hi {end} there", end, f"{end}a", f"a  {end}", f"{end}  {end} b", f"  {end}\n c", "a\x00 b", "\x00", f"\x00{end} \x00", ""]
    ids, bounds = encoder(tokenizer_path()).encode_column(pa.array(texts), 2)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*whole(text), 2], text
    assert 50256 in whole(texts[0])


def test_only_the_first_piece_may_be_shorter():
    assert cut_lengths(2048, 1024) == [1024, 1024]
    assert cut_lengths(2050, 1024) == [2, 1024, 1024]
    assert cut_lengths(1, 1024) == [1]
    sizes = [1, 1024, 1025, 2048, 2050, 7]
    doc, piece, start, length = cut_pieces(np.concatenate(([0], np.cumsum(sizes))), 1024)
    for i, n in enumerate(sizes):
        own = length[doc == i].tolist()
        assert own == cut_lengths(n, 1024) and piece[doc == i].tolist() == list(range(len(own)))
        assert start[doc == i].tolist() == [sum(own[:k]) for k in range(len(own))]


@examples(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=12))
@settings(max_examples=60, deadline=None)
def test_plan_uses_every_piece_once_and_no_more_room_than_there_is(histogram):
    plan = plan_packing(histogram, 32)
    used = defaultdict(int)
    for kind, times in plan:
        assert 0 < sum(kind) <= 32 and times > 0
        for x in kind:
            used[x] += times
    assert used == histogram
    sequences = sum(times for _, times in plan)
    total = sum(k * n for k, n in histogram.items())
    assert sequences <= 2 * -(-total // 32)
    table = slots(plan)
    for length, n in histogram.items():
        own = table[table[:, 0] == length]
        assert own[0, 1] == 0 and own[-1, 1] < n


def test_plan_is_near_the_least_number_for_many_documents():
    rng = random.Random(1)
    histogram = defaultdict(int)
    for _ in range(100_000):
        histogram[min(1024, int(rng.lognormvariate(5, 1)) + 1)] += 1
    least = -(-sum(k * n for k, n in histogram.items()) // 1024)
    assert sum(n for _, n in plan_packing(histogram)) <= 1.01 * least


def test_patterns_fill_a_sequence():
    found = patterns([2, 3, 5, 10], 10)
    assert {tuple(x) for x in found.tolist()} == {(10, 0, 0), (5, 5, 0), (5, 3, 2)}
    assert sorted(best_fit({3: 4}, 10)) == [((3,), 1), ((3, 3, 3), 1)]


def check_pieces(rows, texts, whole, id_bytes):
    """Pieces rebuild all documents; sequences are gapless and not too long. ``texts`` may repeat ids."""
    ends = defaultdict(list)
    for r in rows:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    wanted, got = defaultdict(int), defaultdict(int)
    for doc_id, text in texts:
        ids = [*whole(text or ""), 2]
        start = 0
        for piece, length in enumerate(cut_lengths(len(ids), 1024)):
            data = np.array(ids[start : start + length], id_bytes).tobytes()
            wanted[doc_id, piece, start, length, zlib.crc32(data)] += 1
            start += length
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))] += 1
    assert got == wanted


def test_pattern_packing_is_lossless(docs, whole):
    rows = pack_patterns(docs).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], whole, "<u4")


def test_matrix_is_lossless_and_positions_start_again(docs, whole):
    matrix = pack_matrix(docs)
    pieces = matrix_pieces(matrix).collect()
    check_pieces(pieces, [(r["doc_id"], r["text"]) for r in docs.collect()], whole, "<u2")
    for r in pieces:
        assert np.frombuffer(bytes(r["positions"]), "<u2").tolist() == list(range(r["length"]))
    for r in matrix.collect():
        assert len(r["ids"]) == len(r["positions"]) == 2048
        assert r["cu_seqlens"][0] == 0 and len(r["cu_seqlens"]) == len(r["doc_ids"]) + 1


def test_empty_tables(no_docs):
    assert pack_patterns(no_docs).collect() == []
    assert matrix_pieces(pack_matrix(no_docs)).collect() == []


@examples(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=80, deadline=None)
def test_segment_tree_finds_the_fullest_sequence(lengths):
    rooms: list[int] = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms[rooms.index(min(fits))] -= x
        else:
            rooms.append(50 - x)
    packed = best_fit_decreasing(lengths, 50)
    assert sorted(i for s in packed for i in s) == list(range(len(lengths)))
    assert sorted(50 - sum(lengths[i] for i in s) for s in packed) == sorted(rooms)


def test_room_tree_takes_nothing_too_small():
    tree = RoomTree(8)
    tree.add(3, 0)
    tree.add(7, 1)
    assert tree.take(8) is None
    assert tree.take(4) == (7, 1)
    assert tree.take(1) == (3, 0)
    assert tree.take(0) is None
