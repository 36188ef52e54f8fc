"""Packing: laws that hold for every result, and distance from the lower bound."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm import packing
from quillspark.llm.queries import op9_packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def check_laws(rows, capacity):
    """Pieces fill their sequences without gaps; returns the number of sequences."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_local_search_keeps_items_and_never_adds_bins(lengths):
    first = packing.best_fit(lengths, 100)
    count = len(first)
    bins = packing.local_search([list(b) for b in first], lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= count


def test_exchange_beats_best_fit():
    lengths = [6, 5, 5, 4, 4, 3, 3]  # best fit descending needs 4 bins of 10, three hold all
    lengths = [5, 5, 4, 4, 3, 3, 3, 3]
    assert len(packing.best_fit(lengths, 15)) >= len(packing.pack(lengths, 15)) == 2


def brute_gain(donor, target, room, lengths):
    """The best gain over every move, one-for-one and two-for-one exchange, item by item."""
    gains = [lengths[x] for x in donor]
    for y in target:
        gains += [lengths[x] - lengths[y] for x in donor]
        gains += [lengths[x] + lengths[z] - lengths[y] for x, z in itertools.combinations(donor, 2)]
    return max((g for g in gains if 0 < g <= room), default=0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=12), st.lists(st.integers(1, 30), max_size=8), st.integers(0, 40))
def test_step_finds_the_best_exchange(donor, target, room):
    lengths = donor + target
    mine, theirs = list(range(len(donor))), list(range(len(donor), len(lengths)))
    gain, change = packing._step(mine, theirs, room, lengths)
    assert gain == brute_gain(mine, theirs, room, lengths)
    if gain:
        give, back = change
        assert len(set(give)) == len(give) <= (2 if back is not None else 1) and set(give) <= set(mine)
        assert sum(lengths[x] for x in give) - (lengths[back] if back is not None else 0) == gain


def test_two_for_one_in_bins_of_many_items():
    lengths = [3] * 120 + [5]  # a room of 1 takes no item of 3, but two of them for the one of 5
    gain, (give, back) = packing._step(list(range(120)), [120], 1, lengths)
    assert gain == 1 and len(give) == 2 and back == 120


def optimum(lengths, capacity):
    """The least number of bins, by trying every place of every item."""

    def fits(items, rooms):
        if not items:
            return True
        tried = set()
        for i, r in enumerate(rooms):
            if r >= items[0] and r not in tried:
                tried.add(r)
                if fits(items[1:], [*rooms[:i], r - items[0], *rooms[i + 1 :]]):
                    return True
        return False

    bins = -(-sum(lengths) // capacity)
    while not fits(sorted(lengths, reverse=True), [capacity] * bins):
        bins += 1
    return bins


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=10))
def test_small_cases_are_near_the_optimum(lengths):
    least = optimum(lengths, 20)
    assert least <= len(packing.pack(lengths, 20)) <= least + 1


def test_query(spark, sf_dir):
    rows = op9_packing(spark, sf_dir).collect()
    library = Tokenizer.from_file(WORD)
    library.encode_special_tokens = True
    total = 0
    want = {}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[d.doc_id, piece] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    assert check_laws(rows, 2048) <= -(-total // 2048) + 1


@pytest.mark.parametrize("group_rows", [3, 1000])
def test_odd_rows(spark, group_rows):
    texts = [None, "", "a", "a b c", "word " * 50, "word " * 9, "many words here " * 7]
    docs = spark.createDataFrame(
        [(1 if i % 3 else None, t, i, 0) for i, t in enumerate(texts * 5)], "doc_id long, text string, row int, length int"
    )
    rows = packing.pack_documents(docs, WORD, capacity=8, group_rows=group_rows).collect()
    check_laws(rows, 8)
    whole = packing.tokenised_pieces(docs, WORD, capacity=8).collect()
    assert len(rows) == len(whole) and sum(r.length for r in rows) == sum(len(r.ids) // 4 for r in whole)
    assert all(r.length == 8 for r in whole if (r.start + r.length) % 8 == 0)


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words " * (i + 1)) for i in range(12)], "doc_id long, text string")
    plan, pieces = packing.pack_documents(docs, WORD, 16), packing.tokenised_pieces(docs, WORD, 16)
    found = {r.sequence_id: r.ids for r in packing.sequences(plan, pieces).collect()}
    by_piece = {(r.doc_id, r.piece): r.ids for r in pieces.collect()}
    for r in plan.collect():
        assert found[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == by_piece[r.doc_id, r.piece]


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORD).count() == 0
