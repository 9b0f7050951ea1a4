"""Near duplicates against all pairs, and their parts against plain ones."""

import random
from collections import Counter

import numpy as np
import pytest

from recall_lens.llm import near_duplicates, queries
from recall_lens.llm.components import components
from recall_lens.llm.staging import Staging


def plain_set(text):
    words = [w for w in (text or "").encode().lower().split()]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def plain(rows):
    """Counter of (doc_id, n_shingles, component_id, kept), by comparing all pairs that share a shingle."""
    sets, root, holders = [plain_set(t) for _, t in rows], list(range(len(rows))), {}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((doc, len(s), least.get(find(i)), doc == least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


def collected(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_all_pairs(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").collect()
    assert collected(queries.op8_near_duplicates(spark, f"/root/testdata/{size}")) == plain([(r.doc_id, r.text) for r in docs])


def edited(words, share, rng):
    return [f"e{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("tile", [near_duplicates.TILE, 7])
def test_stars_chains_and_texts_that_nearly_match(spark, monkeypatch, tile):
    """Copies that link to their source only, chains of small steps, and a large bucket in which little links."""
    monkeypatch.setattr(near_duplicates, "TILE", tile)
    rng, rows = random.Random(4), []
    base = [f"b{k}" for k in range(400)]
    rows += [" ".join(edited(base, 0.02, rng)) for _ in range(60)] + [" ".join(base)]
    chain = [f"c{k}" for k in range(300)]
    for _ in range(15):
        rows.append(" ".join(chain))
        chain = chain[12:] + [f"n{rng.randrange(10**9)}" for _ in range(12)]
    other = [f"o{k}" for k in range(300)]
    rows += [" ".join(edited(other, 0.05, rng)) for _ in range(40)]
    rows += [rows[3]] * 30 + ["few words"] * 2 + ["Few Words", "few words more"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(near_duplicates.group(docs)) == plain(rows)


def test_awkward_documents(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert collected(near_duplicates.group(awkward)) == plain(rows)
    assert near_duplicates.group(nothing).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l"), (7, "g h i j k l")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates.group(nameless).collect()), key=str)
    assert got == sorted([(None, None, True), (None, None, True), (None, 7, False), (7, 7, True)], key=str)


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    n, width = 20_000, near_duplicates.BANDS * near_duplicates.ROWS
    one = rng.integers(0, 256, (n, width), np.uint8)
    for similarity, low, high in ((0.75, 0.999, 1), (0.3, 0, 0.01)):
        two = np.where(rng.random((n, width)) < similarity, one, rng.integers(0, 256, (n, width), np.uint8))
        assert low <= near_duplicates.survives(one, two).mean() <= high
    assert (1 - 0.75**near_duplicates.ROWS) ** near_duplicates.BANDS <= near_duplicates.MISS


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "u long, v long"), Staging(spark, "test"), "edges").collect()
    assert {(r.node, r.root) for r in got} == {(x, find(x)) for x in list(root) if find(x) != x}
