"""Phrases whose words keep together, counted in quotient filters.

1. Every task reads its documents into shards of about SHARD_WORDS words: a shard has its own numbers for its words, and
   its text as those numbers. Words are counted per language; those that come often enough get numbers for all shards
   (a word of two languages gets two), since a frequent phrase has frequent words only.
2. Each shard swaps its numbers for the common ones and counts its pairs of neighbours in filters, one for each range of
   keys. The filters of a range are merged by one task, which keeps the frequent keys and tells each shard, bit by bit in
   the order of the shard's own filter, which of its pairs are frequent.
3. Phrases of three and four words are counted in the same way, where all pairs in them are frequent.
4. What is left, frequent phrases with exact counts, is scored with joins and aggregates.

Nothing is sent whole to the driver or to one task: texts are read once, shards travel as compressed numbers, and a key
is sent once by each shard, however often it occurs. The number of ranges grows with the corpus. A filter is exact, so
counts are.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recall_lens.llm import quotient_filter as qf
from recall_lens.llm.staging import Staging, small_batches
from recall_lens.llm.text import batch, texts_of

LEAST = 30
TOP = 2000
WORDS = 4
#: Words of a shard; a document is cut between pieces, so only a longer piece makes a larger shard.
SHARD_WORDS = 1 << 20
#: Words of the corpus for each range of keys.
RANGE_WORDS = 1 << 20
#: Buckets in which frequent words are numbered.
NUMBERED_IN = 1024
#: Top lists of a language before the last one.
LISTS = 64
UNKNOWN = "und"

_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)

_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("local", pa.int32()), ("n", pa.int64()), ("ids", pa.binary())])
_SHARD_SPARK = "shard long, lang string, word string, local int, n long, ids binary"
_FILTER = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("data", pa.binary())])
_FILTER_SPARK = "shard long, part long, data binary"
_MERGED = pa.schema([("ids", pa.list_(pa.int64())), ("f", pa.int64()), ("shard", pa.int64()), ("part", pa.int64()), ("data", pa.binary())])
_MERGED_SPARK = "ids array<long>, f long, shard long, part long, data binary"


class _Numbers(dict):
    """Numbers of the words of one language, handed out by the shard from 1 on."""

    def __init__(self, words: list[tuple[str, bytes]], lang: str) -> None:
        self.words, self.lang = words, lang

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = value = len(self.words)
        return value


class _Shard:
    """Words of a shard as numbers, a 0 after every piece."""

    def __init__(self) -> None:
        self.words: list[tuple[str, bytes]] = []
        self.by_lang: dict[str, _Numbers] = {}
        self.ids = array("i")

    def add(self, lang: str, text: bytes) -> Iterator[None]:
        """Take in the pieces of a text; pauses after each piece that fills the shard."""
        numbers = self._numbers(lang)
        for piece in text.lower().translate(_ENDS).split(b"\n"):
            if words := piece.split():
                self.ids.extend(map(numbers.__getitem__, words))
                self.ids.append(0)
                if len(self.ids) >= SHARD_WORDS:
                    yield
                    numbers = self._numbers(lang)

    def _numbers(self, lang: str) -> _Numbers:
        if lang not in self.by_lang:
            self.by_lang[lang] = _Numbers(self.words, lang)
        return self.by_lang[lang]

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        n, ids = len(self.words), np.frombuffer(self.ids, np.int32)
        langs, words = zip(*self.words, strict=True)
        counts = np.bincount(ids, minlength=n + 1)[1:]
        yield batch(_SHARD, [[shard] * n, langs, [w.decode() for w in words], range(1, n + 1), counts, [None] * n])
        yield batch(_SHARD, [[shard], [None], [None], [None], [None], [_packed(ids)]])


def _packed(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.astype("<i4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i4")


def _shards(docs: DataFrame) -> DataFrame:
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = _Shard(), TaskContext.get().partitionId() << 24
        for rows in batches:
            for lang, text in zip(rows.column(0).to_pylist(), texts_of(rows.column(1)), strict=True):
                for _ in shard.add(lang, text):
                    yield from shard.rows(number)
                    number += 1
                    shard.__init__()
        if shard.ids:
            yield from shard.rows(number)

    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)), "text").mapInArrow(read, _SHARD_SPARK)


def _joined(stream: np.ndarray) -> np.ndarray:
    """The numbers without those that have no neighbour, and one 0 between stretches."""
    some = np.concatenate(([0], stream, [0])) > 0
    stream = np.where(some[:-2] | some[2:], stream, 0)
    some = stream > 0
    return stream[some | np.concatenate(([False], some[:-1]))]


def _pairs(stream: np.ndarray, keys: qf.Keys) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Places of pairs of neighbours, and the pairs' distinct keys with their counts."""
    at = np.flatnonzero((stream[:-1] > 0) & (stream[1:] > 0))
    return at, qf.counted(keys, *keys.of(np.stack((stream[at], stream[at + 1]), 1)))


def _first_round(keys: qf.Keys):
    """Cogroup of a shard's numbers and the common numbers of its words: its text in those, and its filters of pairs."""

    def count(key: tuple[pa.Scalar, ...], texts: pa.Table, codes: pa.Table) -> pa.Table:
        shard, streams, rows = key[0].as_py(), [], []
        local = codes.column("local").to_numpy()
        code = np.zeros(int(local.max(initial=0)) + 1, np.int64)
        code[local] = codes.column("id").to_numpy()
        for data in texts.column("ids").to_pylist():
            ids = _unpacked(data)
            streams.append(_joined(np.where(ids < len(code), code[np.minimum(ids, len(code) - 1)], 0)))
        stream = np.concatenate(streams) if streams else np.empty(0, np.int64)
        if len(stream):
            _, (left, right, counts, _) = _pairs(stream, keys)
            rows = [(-1, zstandard.compress(stream.astype("<i8").tobytes(), 1)), *qf.write(keys, left, right, counts)]
        return pa.table([pa.array([shard] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=_FILTER)

    return count


def _second_round(keys: qf.Keys, longer: qf.Keys):
    """Cogroup of a shard's text and of what was found about its pairs: its filters of phrases of three and four words."""

    def count(key: tuple[pa.Scalar, ...], texts: pa.Table, found: pa.Table) -> pa.Table:
        shard, rows = key[0].as_py(), []
        if texts.num_rows and found.num_rows:
            stream = np.frombuffer(zstandard.decompress(texts.column("data")[0].as_py()), "<i8")
            at, (left, _, _, which) = _pairs(stream, keys)
            frequent = np.zeros(len(left), bool)
            ranges = keys.ranges(left)
            for part, bits in zip(found.column("part").to_pylist(), found.column("data").to_pylist(), strict=True):
                i, j = np.searchsorted(ranges, np.uint64(part)), np.searchsorted(ranges, np.uint64(part), "right")
                frequent[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i)
            pair = np.zeros(len(stream), bool)
            pair[at] = frequent[which]
            three = np.flatnonzero(pair[:-1] & pair[1:])
            four = three[pair[np.minimum(three + 2, len(pair) - 1)] & (three + 2 < len(pair))]
            ends = np.concatenate((np.zeros(len(three), np.int64), stream[np.minimum(four + 3, len(stream) - 1)]))
            starts = np.concatenate((three, four))
            numbers = np.stack((stream[starts], stream[starts + 1], stream[starts + 2], ends), 1)
            left, right, counts, _ = qf.counted(longer, *longer.of(numbers))
            rows = list(qf.write(longer, left, right, counts))
        return pa.table([pa.array([shard] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=_FILTER)

    return count


def _merge(keys: qf.Keys, least: int):
    """The filters of one range: frequent phrases, and for each shard which keys of its filter are frequent."""

    def merge(key: tuple[pa.Scalar, ...], filters: pa.Table) -> pa.Table:
        part = key[0].as_py()
        left, right, counts, places = qf.merged(keys, part, filters.column("data").to_pylist())
        frequent = counts >= least
        numbers = keys.numbers(left[frequent], right[frequent])
        ids = [[x for x in row if x] for row in numbers.tolist()]
        told = [(s, np.packbits(frequent[which]).tobytes()) for s, which in zip(filters.column("shard").to_pylist(), places, strict=True) if frequent[which].any()]
        n, m = len(ids), len(told)
        columns = [
            ids + [None] * m,
            counts[frequent].tolist() + [None] * m,
            [None] * n + [s for s, _ in told],
            [None] * n + [part] * m,
            [None] * n + [d for _, d in told],
        ]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MERGED, strict=True)], schema=_MERGED)

    return merge


def _merged(staging: Staging, filters: DataFrame, keys: qf.Keys, least: int, name: str) -> DataFrame:
    parts = filters.where("part >= 0").groupBy("part").applyInArrow(_merge(keys, least), _MERGED_SPARK)
    return staging.table(parts, name)


def _frequent_words(staging: Staging, words: DataFrame, least: int) -> DataFrame:
    """lang, word, f and a number, unique and not much above the number of words."""
    often = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    dealt = often.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(NUMBERED_IN)))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    return staging.table(dealt.select("lang", "word", "f", ((place - 1) * NUMBERED_IN + F.col("bucket") + 1).alias("id")), "words")


def _spelled(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, words and f of phrases given by the numbers of their words."""
    each = phrases.select("ids", "f", F.posexplode("ids").alias("at", "id"))
    named = each.join(words.select("id", "lang", "word"), "id")
    parts = F.sort_array(F.collect_list(F.struct("at", "word")))
    return named.groupBy("ids").agg(F.first("lang").alias("lang"), F.first("f").alias("f"), F.transform(parts, lambda p: p["word"]).alias("words")).drop("ids")


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Two tables: lang, words (array of 1 to 4) and f of every phrase that occurs `least` times or more in its language,
    and lang and n, the number of words, of every language.

    `docs` has lang and text. A-Z become lower-case; phrases stay within pieces, which end at `.,;:!?`, line feeds,
    vertical tabs, form feeds and carriage returns. A null or empty text has no words, a null lang is `und`. Repeated rows
    count each time. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    staging = Staging(spark, "collocations")
    shards = staging.table(_shards(docs), "shards")
    counted = shards.where("word IS NOT NULL")
    words = _frequent_words(staging, counted.select("lang", "word", "n"), least)
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    size = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    highest = words.agg(F.coalesce(F.max("id"), F.lit(1)).alias("id")).first().id
    bits, split = int(highest).bit_length(), max(size // RANGE_WORDS, 0).bit_length()
    pairs, longer = (qf.Keys(bits, n, min(split, bits * n // 2)) for n in (2, WORDS))

    codes = counted.select("shard", "lang", "word", "local").join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("shard").alias("owner"), "local", "id")
    texts = shards.where("ids IS NOT NULL").select("shard", "ids")
    first = staging.table(texts.groupBy("shard").cogroup(codes.groupBy("owner")).applyInArrow(_first_round(pairs), _FILTER_SPARK), "pair_filters", "none")
    two = _merged(staging, first, pairs, least, "pairs")
    told = two.where("shard IS NOT NULL").select(F.col("shard").alias("owner"), "part", "data")
    streams = first.where("part < 0").select("shard", "data")
    second = staging.table(streams.groupBy("shard").cogroup(told.groupBy("owner")).applyInArrow(_second_round(pairs, longer), _FILTER_SPARK), "longer_filters", "none")
    more = _merged(staging, second, longer, least, "longer")
    phrases = two.where("f IS NOT NULL").select("ids", "f").unionByName(more.where("f IS NOT NULL").select("ids", "f"))
    found = _spelled(words, phrases).unionByName(words.select("lang", "f", F.array("word").alias("words")))
    return staging.table(found, "phrases"), total


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's `top` phrases of 2 to 4 words that occur `least` times or more: lang, rank, phrase, a (occurrences),
    l and r (those of the two parts at the weakest cut), n (words of the language) and score floor(2000000 a / (l + r)).

    A phrase inside a longer frequent one that has 80 % of its occurrences or more is left out. Ranked by score and a,
    both descending, then by phrase. What `docs` may hold is said at count_phrases; no documents give no rows.
    """
    phrases, total = count_phrases(docs, least)
    known = phrases.select("lang", _phrase(F.col("words")).alias("part"), F.col("f").alias("of_part"))
    size = F.size("words")
    candidates = phrases.where(size >= 2).select("lang", "words", _phrase(F.col("words")).alias("phrase"), F.col("f").alias("a"))

    cut = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = cut.select("lang", "phrase", "a", "k", _phrase(F.slice("words", F.lit(1), F.col("k"))).alias("front"), _phrase(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("back"))
    front = known.withColumnsRenamed({"part": "front", "of_part": "l"})
    back = known.withColumnsRenamed({"part": "back", "of_part": "r"})
    both = sides.join(front, ["lang", "front"]).join(back, ["lang", "back"])
    score = F.expr("(2000000 * cast(a AS decimal(30, 0))) div cast(l + r AS decimal(30, 0))")
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.explode(F.sequence(F.lit(2), size - 1)).alias("length")
    within = candidates.where(size >= 3).select("lang", "words", "a", inner)
    within = within.select("lang", "a", "words", "length", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)).alias("at"))
    within = within.groupBy("lang", _phrase(F.slice("words", F.col("at"), F.col("length"))).alias("phrase")).agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    whole = scored.join(within, ["lang", "phrase"], "left").where(F.coalesce(100 * wide("longer") < 80 * wide("a"), F.lit(True)))
    rows = whole.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    dealt = rows.withColumn("list", F.pmod(F.xxhash64("phrase"), F.lit(LISTS)))
    dealt = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "list").orderBy(*best))).where(F.col("place") <= top)
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
