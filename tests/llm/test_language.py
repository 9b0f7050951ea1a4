"""Cross-parsing against a plain parser, and held-out accuracy of the query."""

import random

import numpy as np
from pyspark.sql import functions as F

from recall_lens.llm import language, queries

FOLDER = "/root/testdata/sf0.01"


def plain_phrases(text, sample):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        n, i = n + 1, i + k
    return n


def test_automaton_holds_all_substrings_and_no_others():
    rng = random.Random(3)
    text = [rng.randrange(3) for _ in range(60)]
    goes = language.suffix_automaton(text, 3)
    inside = {tuple(text[i:j]) for i in range(60) for j in range(i, min(60, i + 6) + 1)}
    for _ in range(500):
        word, state = [rng.randrange(3) for _ in range(rng.randrange(7))], 0
        for c in word:
            state = goes[state][c] if state >= 0 else -1
        assert (state >= 0) == (tuple(word) in inside)


def test_phrases_equal_a_plain_parse():
    rng = random.Random(5)
    samples = tuple((name, "".join(rng.choice(letters) for _ in range(300))) for name, letters in (("a", "abc "), ("b", "bcde ")))
    model = language.Languages(samples)
    texts = ["".join(rng.choice("abcdexy .") for _ in range(rng.randrange(700))) for _ in range(30)] + ["", "zzz", "a" * 600]
    symbols = [model.symbols(t) for t in texts]
    got = model.phrases(symbols)
    for k, (_, sample) in enumerate(samples):
        own = model.symbols(sample).tobytes()
        for j, s in enumerate(symbols):
            chunks = [s[i : i + language.CHUNK].tobytes() for i in range(0, len(s), language.CHUNK)]
            assert got[k, j] == sum(plain_phrases(c, own) for c in chunks)


def test_held_out_accuracy(spark):
    rows = queries.op3_language(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 200 < len(held) < 300
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_awkward_documents(spark, awkward, nothing):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.learn(docs)
    got = {r.doc_id: r for r in language.identify(awkward, model).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {1, 2, 3}
    assert got[5].lang_pred in model.names and got[1].score == 0
    assert language.identify(nothing, model).count() == 0
    untaught = language.learn(nothing)
    assert {r.lang_pred for r in language.identify(awkward, untaught).collect()} == {"und"}
    assert language.learn(docs.withColumn("lang", F.lit(None).cast("string"))).samples == ()


def test_all_of_many_languages_are_learnt_and_found(spark):
    rng = random.Random(7)
    words = {k: ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(30)] for k in range(230)}
    text = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    docs = spark.createDataFrame([(k, text(k, 900), f"l{k:03}") for k in words], "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert model.names == [f"l{k:03}" for k in words]
    assert min(len(t) for _, t in model.samples) > 4000  # as many characters each as of a language alone
    asked = spark.createDataFrame([(k, text(k, 30)) for k in words], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.identify(asked, model).collect()}
    assert got == {k: f"l{k:03}" for k in words}


def test_a_language_of_few_long_documents_has_a_sample(spark):
    docs = spark.createDataFrame([(k, "word " * 2000, f"l{k % 40}") for k in range(200)], "doc_id long, text string, lang string")
    assert len(language.learn(docs, 50).samples) == 40


def test_groups_of_languages_parse_as_one(spark, awkward, monkeypatch):
    rng = random.Random(8)
    samples = tuple((name, "".join(rng.choice("abcdef ") for _ in range(300))) for name in "pqrst")
    texts = ["".join(rng.choice("abcdefg ") for _ in range(400)) for _ in range(20)]
    one = language.Languages(samples)
    whole = one.judge(texts)
    monkeypatch.setattr(language, "GROUP_CHARS", 650)
    many = language.Languages(samples)
    assert [len(g) for g in one.groups] == [5] and [len(g) for g in many.groups] == [2, 2, 1]
    assert all(np.array_equal(a, b) for a, b in zip(whole, many.judge(texts), strict=True))


def test_a_sample_is_taken_from_all_over_a_long_document(spark):
    opening = "licence " * 600  # 4,800 characters
    docs = spark.createDataFrame([(k, opening + f"body{k} " * 6000, "x") for k in range(5)] + [(9, "short", "y")], "doc_id long, text string, lang string")
    samples = dict(language.learn(docs).samples)
    assert samples["y"] == "short" and all(samples["x"].count(f"body{k}") > 400 for k in range(5))
    assert len(samples["x"]) <= 5 * language.DOCUMENT_CHARS + 4
    assert samples["x"].count("licence") < 0.25 * samples["x"].count("body")
    edge = [(k, "ab" * (language.DOCUMENT_CHARS // 2) + "c" * k, "x") for k in range(1, 20)]
    edge = spark.createDataFrame(edge, "doc_id long, text string, lang string")
    assert len(language.learn(edge).samples[0][1]) > language.DOCUMENT_CHARS // 2
