"""Periodic runs against the definition, word by word, and the query against the contract read literally."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from recall_lens.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_definition(words, least=12):
    """(start, length, period) of all maximal stretches, every period tried at every place."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def rows_of(texts):
    lists = [t.encode().split() for t in texts]
    return [([(r["start"], r["length"], r["period"]) for r in runs], text.decode()) for runs, text in periodic._collapsed(lists, 12)]


def random_words(rng):
    letters = rng.choice([1, 2, 2, 3, 4, 8])
    words = [str(rng.randrange(letters)) for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 3) if len(words) > 10 else 0):
        a = rng.randrange(len(words))
        p = rng.randint(1, max(1, (len(words) - a) // 2))
        for i in range(a, rng.randint(a, len(words))):
            words[i] = words[a + (i - a) % p]
    return words


def test_random_words_against_the_definition():
    rng = random.Random(5)
    for _ in range(400):
        texts = [" ".join(random_words(rng)) for _ in range(rng.randint(1, 4))] + ["x"]
        for text, (runs, left) in zip(texts, rows_of(texts), strict=True):
            words = text.split()
            assert runs == by_definition(words)
            assert left == collapsed(words, runs)


def test_fibonacci_word_and_squares_of_squares():
    a, b = "0", "01"
    while len(b) < 400:
        a, b = b, b + a
    texts = [" ".join(b), " ".join("aab" * 20 + "c" + "aba" * 20), " ".join(("aabaabaabaa" * 2 + "b") * 3), "a " * 500]
    for text, (runs, _) in zip(texts, rows_of(texts), strict=True):
        assert runs == by_definition(text.split())


def test_long_documents_are_read_off_their_making():
    rng = random.Random(2)
    head, unit, tail = ([f"{k}{rng.random()}" for _ in range(n)] for k, n in (("h", 1000), ("u", 70_000), ("t", 5)))
    runs, left = rows_of([" ".join(head + unit * 4 + unit[:9] + tail)])[0]
    assert runs == [(1000, 280_009, 70_000)]
    assert left == " ".join(head + unit + tail)


def test_successors_against_a_scan():
    rng = np.random.default_rng(1)
    for _ in range(50):
        values = rng.permutation(rng.integers(1, 60))
        tree = periodic.WaveletTree(values.astype(np.int64))
        left, right = np.sort(rng.integers(0, len(values) + 1, (2, 40)), axis=0)
        x = rng.integers(0, 130, 40)
        expected = [min((v for v in values[low:high] if v >= y), default=-1) for low, high, y in zip(left, right, x, strict=True)]
        assert tree.successor(left, right, x, -1).tolist() == expected


def test_short_runs_are_refused(spark):
    with pytest.raises(ValueError):
        periodic.find_runs(spark.createDataFrame([], "doc_id long, text string"), least=6)


def contract(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_definition(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    first = (None, None, None, None) if best is None else (*best, 1000 * best[1] // best[2])
    digests = "".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(words, runs)
    return doc_id, len(runs), *first, *(hashlib.sha256(d.encode()).hexdigest() for d in digests)


def test_query_against_the_contract(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "a " * 30), (503, "é " * 20 + " x"), (503, "é " * 20 + " x"), (504, "ab\n" * 13)]
    docs = spark.createDataFrame([(*r, 7, "z", 1) for r in rows], "doc_id long, text string, n_words int, runs string, h int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    as_text = lambda rows: sorted(map(repr, rows))
    assert as_text(tuple(r) for r in found.collect()) == as_text(contract(*r) for r in rows)
    assert sum(r[1] for r in map(tuple, found.collect())) > 20


def test_no_documents(spark):
    assert periodic.find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
