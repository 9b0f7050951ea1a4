"""Quotient filters as exact counters, and collocations against a plain count and the query's SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from recall_lens.llm import collocations, queries
from recall_lens.llm import quotient_filter as qf


@pytest.mark.parametrize(("bits", "words", "split"), [(1, 2, 0), (5, 2, 3), (17, 2, 4), (32, 2, 0), (12, 4, 2), (16, 4, 0), (17, 4, 5), (32, 4, 0), (32, 4, 7)])
def test_filters_hold_every_key_and_count(bits, words, split):
    rng = np.random.default_rng(bits * words)
    keys = qf.Keys(bits, words, split)
    pool = rng.integers(0, 1 << bits, (200, words))
    shards = [pool[rng.integers(0, 200, n)] for n in (0, 1, 5000, 300)]
    shards.append(np.repeat(pool[:2], [700, 254 + 3], axis=0))
    truth = Counter(tuple(row) for rows in shards for row in rows.tolist())
    by_part: dict[int, list] = {}
    for s, rows in enumerate(shards):
        left, right, counts, which = qf.counted(keys, *keys.of(rows))
        assert (keys.numbers(left, right)[which] == rows).all()
        for part, data in qf.write(keys, left, right, counts):
            by_part.setdefault(part, []).append((s, data))
    found = Counter()
    for part, filters in by_part.items():
        left, right, counts, places = qf.merged(keys, part, [d for _, d in filters])
        found.update({tuple(row): n for row, n in zip(keys.numbers(left, right).tolist(), counts.tolist(), strict=True)})
        for (_, data), which in zip(filters, places, strict=True):
            own = keys.numbers(*qf.read(keys, part, data)[:2])
            assert (keys.numbers(left, right)[which] == own).all()
    assert found == truth


def test_keys_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        qf.Keys(33, 4, 0)


def plain(rows, least, top):
    """The contract, word by word."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if a < least or len(p) < 2:
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        inside = [b for (other, q), b in f.items() if other == lang and b >= least and len(q) > len(p) and p in [q[i : i + len(p)] for i in range(len(q))]]
        if not any(100 * b >= 80 * a for b in inside):
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, best in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1)
    }


def some_rows(rng, documents):
    words = ["the", "of", "The", "é", "É", "naïve", "x1", "<|a|>", "b", "c\x00", "日本"]
    rows = []
    for _ in range(documents):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(["of the x1 b", "b c\x00", " ".join(rng.choices(words, k=3)), rng.choice(words)]))
            parts.append(rng.choice([" ", " ", "\t ", ". ", "\n", ";", "\x0b", "\r\n", " , "]))
        rows.append((rng.choice(["en", "de", None]), "".join(parts)))
    return [*rows, ("en", None), (None, ""), ("fr", " . ;\n"), ("en", "of the x1 b " * 50), ("en", "of the x1 b " * 50)]


@pytest.mark.parametrize(("shard_words", "least", "top"), [(64, 5, 2000), (1 << 20, 12, 7)])
def test_mine_against_a_plain_count(spark, monkeypatch, shard_words, least, top):
    monkeypatch.setattr(collocations, "RANGE_WORDS", shard_words)
    rows = some_rows(random.Random(3), 90)
    docs = spark.createDataFrame([(*r, 1, "c", "w") for r in rows], "lang string, text string, n int, phrase string, word string").repartition(5)
    found = collocations.mine(docs, least, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found.count() > 10
    assert {tuple(r) for r in found.collect()} == plain(rows, least, top)


def test_shards_are_cut_between_pieces():
    text = ("a b c. " * 10 + "d " * 30 + ".").encode()
    shard, cut = collocations._Shard(), 0
    size, collocations.SHARD_WORDS = collocations.SHARD_WORDS, 8
    try:
        streams = []
        for _ in shard.add("en", text):
            streams.append(list(shard.ids))
            shard.__init__()
            cut += 1
        streams.append(list(shard.ids))
    finally:
        collocations.SHARD_WORDS = size
    assert cut == 6
    assert [s[-1] for s in streams if s] == [0] * cut
    assert sum(sum(x > 0 for x in s) for s in streams) == 60


def test_no_documents(spark):
    assert collocations.mine(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert collocations.mine(spark.createDataFrame([("en", "only once")], "lang string, text string")).count() == 0


def test_query_against_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    found = queries.op13_collocations(spark, folder)
    expected = con.execute(queries.ORACLE["op13_collocations"])
    assert [d[0] for d in expected.description] == found.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())
