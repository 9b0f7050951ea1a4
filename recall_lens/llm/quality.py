"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition on the text's measures that must hold. On a bounded sample every rule is timed and its share of
rejected rows counted; the cascade asks the rules by rejection per cost, highest first, and stops at the first that
fails, so dear rules see few rows. The order never changes which rows are kept, only what it costs and which failed
rule a row names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recall_lens.llm.staging import Staging

#: Rows on which cost and selectivity are estimated, about.
SAMPLE_ROWS = 2_000
#: Times that each text of the sample is measured for a rule's cost, and the least cost told apart from none.
REPEATS = 3
LEAST_SECONDS = 1e-3
WINDOW = 8
_BLANK = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column
    needs: tuple[str, ...] = ()


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\x09-\\x0D]+"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_keys(words_: Column) -> Column:
    """A 64-bit hash of each run of WINDOW words."""
    n = F.size(words_) - WINDOW + 1
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words_, i, WINDOW)))


def repeated_words(keys: Column) -> Column:
    """Words covered by windows whose key comes twice or more.

    Most texts have no such window and are done after one hash set; for the others, (key, place) pairs are sorted, those
    with an equal neighbour are kept, and the union of the places they cover is summed.
    """
    pairs = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

    def places(p: Column) -> Column:
        last = F.size(p)
        same = lambda x, j, d: F.when((j + d >= 0) & (j + d < last), F.get(p, j + d)["k"] == x["k"]).otherwise(False)
        return F.array_sort(F.transform(F.filter(p, lambda x, j: same(x, j, -1) | same(x, j, 1)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        )["n"]

    # a one-element array holds a value that the inner functions use more than once
    once = lambda value, then: F.get(F.transform(F.array(value), then), 0)
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(once(pairs, lambda p: once(places(p), covered)))


def measure(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", "text", words(F.col("text")).alias("words_")).withColumn("keys_", window_keys(F.col("words_")))
    return read.select(
        "doc_id",
        "text",
        F.size("words_").cast("long").alias("n_words"),
        F.length(F.array_join("words_", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("keys_")).alias("n_repeat_words"),
    )


def standard_rules() -> list[Rule]:
    """Rules of the query: lenient enough to leave plain prose alone."""
    n, chars, symbols, lines = F.col("n_words"), F.col("word_chars"), F.col("n_symbols"), F.col("n_dup_lines")
    text = F.coalesce(F.col("text"), F.lit(""))
    return [
        Rule("word_count", n >= 20, ("n_words",)),
        Rule("repeated_words", 100 * F.col("n_repeat_words") <= 30 * n, ("n_words", "n_repeat_words")),
        Rule("symbols", 100 * symbols <= 10 * chars, ("n_symbols", "word_chars")),
        Rule("word_length", (chars >= 2 * n) & (chars <= 15 * n), ("n_words", "word_chars")),
        Rule("duplicate_lines", 2 * lines <= 1 + F.regexp_count(text, F.lit("\n")), ("n_dup_lines",)),
        Rule("letters", 2 * F.regexp_count(text, F.lit("\\p{L}")) >= chars, ("word_chars",)),
    ]


def estimate(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """Each rule with its cost, in seconds, and the share it rejects of `sample` (doc_id, text), a few documents.

    Each rule computes the measures that it needs, and no others, from the texts, REPEATS times over. What a job that only
    reads the same texts takes is subtracted: start and end of a job cost every rule the same. Of two runs the quicker counts.
    An empty sample gives every rule a share of 0.
    """
    often = sample.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))).drop("turn")

    def timed(rows: DataFrame, bad: Column) -> tuple[float, float]:
        seconds = []
        for _ in range(2):
            began = time.perf_counter()
            got = rows.agg(F.count_if(bad).alias("bad"), F.count("*").alias("n")).first()
            seconds.append(time.perf_counter() - began)
        return min(seconds), got.bad / got.n if got.n else 0.0

    measured = measure(often)
    idle, _ = timed(often, F.length("text") < 0)
    found = [(rule, *timed(measured, ~F.coalesce(rule.holds, F.lit(False)))) for rule in rules]
    return [(rule, max(seconds - idle, LEAST_SECONDS), share) for rule, seconds, share in found]


def order(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejection per cost, highest first; ties by name."""
    return [r for r, cost, share in sorted(estimates, key=lambda x: (-x[2] / x[1], x[0].name))]


def cascade(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """`measured` with failed_rule, the first rule of the given order that does not hold (null if all do), and kept."""
    failed = F.lit(None).cast("string")
    for rule in reversed(rules):
        failed = F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)).otherwise(failed)
    return measured.withColumn("failed_rule", failed).withColumn("kept", F.col("failed_rule").isNull())


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the measures, failed_rule and kept of every row of `docs` (doc_id, text).

    Null, empty and blank texts have no words and fail the word count. Repeated rows and rows without a doc_id are
    judged like others; no rows give no rows.
    """
    rules = rules or standard_rules()
    staging = Staging(docs.sparkSession, "quality")
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = staging.table(docs.select("doc_id", "text").sample(share, seed=1), "sample")
    ordered = order(estimate(sample, rules))
    return cascade(measure(docs.select("doc_id", "text")), ordered).drop("text")
