"""Repeated passages against a plain index of all windows."""

import hashlib
import random

import numpy as np
import pytest

from recall_lens.llm import queries, repeats


def plain(rows):
    """Sorted (doc_id, n_words, n_removed, kept_sha256) by comparing every window with all others."""
    first = {}
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    for doc, words in split:
        if doc is not None:
            for i in range(len(words) - 49):
                w = tuple(words[i : i + 50])
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, words in split:
        gone = [False] * len(words)
        if doc is not None:
            for i in range(len(words) - 49):
                if first[tuple(words[i : i + 50])] < doc:
                    gone[i : i + 50] = [True] * 50
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    rows = df.collect()
    if "text" in df.columns:
        return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in rows), key=str)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_all_windows(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").collect()
    got = collected(queries.op2_repeats(spark, f"/root/testdata/{size}"))
    assert got == plain([(r.doc_id, r.text) for r in docs])
    assert sum(r[2] for r in got) > 0


def test_passages_of_any_edge(spark, monkeypatch):
    """Passages cut at random places from few sources, edited copies, runs of one word, and short repeats."""
    monkeypatch.setattr(repeats, "SHARD_BYTES", 20_000)
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    sources = [[word() for _ in range(260)] for _ in range(5)]
    rows = []
    for _ in range(70):
        words = []
        for _ in range(rng.randrange(1, 5)):
            s = rng.choice(sources)
            i = rng.randrange(0, 200)
            words += s[i : i + rng.randrange(30, 130)] + [word() for _ in range(rng.randrange(0, 40))]
        rows.append(" ".join(words))
    for s in sources:
        rows += ["\n".join(x if rng.random() > 0.01 else word() for x in s) for _ in range(4)] + [" ".join(s)] * 2
    rows += ["a " * 49, "a " * 50, "a " * 120, "b a " * 70, "a b " * 60]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(repeats.remove_repeats(docs)) == plain(rows)


def test_awkward_documents(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert collected(repeats.remove_repeats(awkward)) == plain(rows)
    assert repeats.remove_repeats(nothing).count() == 0
    carried = repeats.remove_repeats(awkward, ("lang", "n_chars", "words_"))
    assert carried.columns == ["doc_id", "text", "lang", "n_chars", "words_", "n_words", "n_removed"] and carried.count() == len(rows)
    nameless = [(None, "x y " * 40), (None, "x y " * 40), (9, "x y " * 40), (9, "x y " * 40), (12, "x y " * 40)]
    assert collected(repeats.remove_repeats(spark.createDataFrame(nameless, "doc_id long, text string"))) == plain(nameless)


def test_equal_windows_name_the_same_gram():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 40, 500, np.uint64)
    one = repeats.stretches(words)
    two = repeats.stretches(words[100:400])
    grams = lambda s, shift: {int(a) + k + shift: g for a, n, g in zip(s[0], s[1], s[2]) for k in range(n)}
    whole, part = grams(one, 0), grams(two, 100)
    assert len(whole) == 451 and len(part) == 251 and all(whole[k] == g for k, g in part.items())


def test_rows_of_one_doc_id_with_other_texts(spark, monkeypatch):
    """Passages come from the row that holds them, and the rows of one doc_id go to several shards."""
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, other = words(120), words(30)
    rows = [(1, " ".join(passage)), (1, " ".join(other))]  # the slice of a passage in `other` is shorter than a window
    rows += [(2, " ".join(words(20) + passage + words(20) + other + words(20))), (3, " ".join(other + words(40)))]
    rows += [(4, " ".join(words(150) + passage[:60])) for _ in range(30)] + [(None, "same text " * 40)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(repeats.remove_repeats(docs)) == plain(rows)
    classes = spark.createDataFrame([(5, 7, 1, 0, 20, True, False)], "gram long, stretch long, owner long, start int, n int, later boolean, mixed boolean")
    assert repeats.read_passages(docs, classes).count() == 0  # no row of document 1 has that stretch
    assert spark.range(1).select(repeats.salts(docs).alias("m")).first().m.keys() == {4}
