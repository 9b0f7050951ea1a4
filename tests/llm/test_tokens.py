"""Packing and token counts against the tokenizers applied directly."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from recall_lens.llm import packing, queries, token_counts
from recall_lens.llm.vocabulary import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def rooms_of(runs, capacity):
    used = Counter()
    for length, _, count, sequence, each, _ in runs.tolist():
        for k in range(count):
            used[sequence + k // each] += length
    return sorted(capacity - x for x in used.values())


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_placing_equals_plain_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for _ in range(40):
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        assert rooms_of(packing.place(Counter(lengths), capacity), capacity) == plain_best_fit(lengths, capacity)


def test_tightest_room_is_the_least_that_holds():
    tree, rng = packing.OpenRoom(50), random.Random(1)
    has = set()
    for _ in range(500):
        room, need = rng.randint(0, 50), rng.randint(0, 50)
        has ^= {room}
        tree.set(room, room in has)
        assert tree.tightest(need) == min((r for r in has if r >= need), default=None)


def checked_packing(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    expected = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4").tobytes()
            expected[doc, k, start, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in rows) == expected
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) == len(plain_best_fit([r["length"] for r in rows], capacity))


@pytest.mark.parametrize("capacity", [16, 4096])
def test_awkward_documents_pack(spark, awkward, capacity):
    rows = packing.pack_documents(awkward, capacity).collect()
    checked_packing(rows, [(r.doc_id, r.text) for r in awkward.collect()], capacity)


def test_ids_come_with_the_pieces(awkward):
    for r in packing.cut(awkward, 64, with_ids=True).collect():
        assert len(r.ids) == r["length"] and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_packing_query(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    checked_packing(queries.op1_packing(spark, FOLDER).collect(), texts, 4096)


def test_nothing_packs_to_nothing(nothing):
    assert packing.pack_documents(nothing).count() == 0
    assert token_counts.count_tokens(nothing).count() == 0


def checked_counts(rows, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    expected = Counter()
    for doc, text in texts:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected[doc, len((text or "").encode()), n, n > 512] += 1
    assert Counter(tuple(r) for r in rows) == expected


def test_counts_equal_the_library(spark, awkward, monkeypatch):
    checked_counts(token_counts.count_tokens(awkward).collect(), [(r.doc_id, r.text) for r in awkward.collect()])
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    checked_counts(queries.op5_token_counts(spark, FOLDER).collect(), texts)


def test_parts_and_groups_lose_nothing():
    counter = token_counts.PieceCounts(tokenizer_path("byte_bpe_50k.json"))
    text = "ab  cd\n ef gh.\nij " * 400
    cut = token_counts.parts(text, 50, counter)
    assert "".join(cut) == text and len(cut) > 50
    assert sum(counter.count(cut)) == len(counter.tokenizer.encode(text).ids)
    assert list(token_counts.groups([5, 5, 30, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(token_counts.groups([], 10)) == []
