"""Quality measures against plain Python, and the cascade's order."""

import re
from collections import Counter

from pyspark.sql import functions as F

from recall_lens.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def base_failed(m):
    return m[0] < 20 or 100 * m[4] > 30 * m[0]


def test_measures_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op6_quality_rules(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        m = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == base_failed(m) and not (r.base_failed and r.kept)
    assert sum(r.kept for r in rows) > 0.8 * len(rows)


def test_awkward_documents(awkward, nothing):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judge(awkward).collect())
    assert got == Counter((r.doc_id, *plain(r.text)) for r in awkward.collect())
    assert quality.judge(nothing).count() == 0


def test_repeats_that_touch_and_overlap(spark):
    a, b = " ".join(f"w{i}" for i in range(9)), " ".join(f"v{i}" for i in range(12))
    texts = [f"{a} {b} {a}", f"{a} {a} {a}", f"{a} x {a[:-3]} y {b} {b}", "z " * 40, f"{a}\n{a}\n \n{a}\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.measure(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(r.text)


def test_cascade_order_changes_the_named_rule_only(spark):
    docs = quality.measure(spark.createDataFrame([(1, "#"), (2, "plain words " * 3)], "doc_id long, text string"))
    few, symbols = quality.Rule("few", F.col("n_words") >= 2), quality.Rule("symbols", F.col("n_symbols") == 0)
    one, two = (quality.cascade(docs, x).orderBy("doc_id").collect() for x in ([few, symbols], [symbols, few]))
    assert [r.kept for r in one] == [r.kept for r in two] == [False, True]
    assert (one[0].failed_rule, two[0].failed_rule) == ("few", "symbols")
    assert quality.order([(few, 1.0, 0.1), (symbols, 0.1, 0.1)]) == [symbols, few]


def test_costs_are_those_of_the_rules(spark):
    rules = quality.standard_rules()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = {r.name: (cost, share) for r, cost, share in quality.estimate(docs, rules)}
    assert all(cost >= quality.LEAST_SECONDS for cost, _ in found.values())
    assert found["repeated_words"][0] > 2 * found["word_count"][0]  # windows are dearer than words
    bad = quality.measure(docs).agg(*[(F.count_if(~r.holds) / F.count("*")).alias(r.name) for r in rules]).first()
    assert {name: share for name, (_, share) in found.items()} == bad.asDict()
    assert {share for _, _, share in quality.estimate(docs.limit(0), rules)} == {0.0}
