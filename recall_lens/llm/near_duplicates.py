"""Near-duplicate documents by MinHash, with candidates verified one after the other.

1. Each text becomes its set of word shingles, a MinHash signature of it and the keys of its bands. Texts with equal sets
   are one class from here on, whatever their number.
2. Classes that share a band key are in one bucket. First the leader of each bucket, the class that shares most buckets
   with others, is compared with its members: a group of copies of one text joins up through that text. A bucket whose
   members are all in one component is done.
3. A pair is compared by batches of its signatures (sequential Bayesian verification): after each batch it is dropped if
   the posterior chance that its similarity reaches the threshold is below the chosen miss probability. Survivors are
   verified on their full sets, read from the whole texts.
4. The buckets that are left are settled exactly, in tiles of bounded size: in a task, all pairs of the tile that are
   not joined yet are compared and verified in the same way, and only links that join something come out. So every
   candidate pair is either verified or already joined through others, and no list of pairs is ever written.
5. Components of the links are found by star contractions.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from recall_lens.llm.components import components
from recall_lens.llm.staging import Staging, small_batches
from recall_lens.llm.text import batch, mixed, texts_of, window_hashes, word_hashes

WORDS = 5
#: A pair is linked from this many hundredths of similarity on.
PERCENT = 75
#: Rows of a band, and the chance that a pair right at the threshold shares no band.
ROWS = 4
MISS = 1e-5
#: Chance at which a pair that reaches the threshold may be dropped by its signature.
PRUNE = 1e-6
BANDS = math.ceil(math.log(MISS) / math.log(1 - (PERCENT / 100) ** ROWS))
#: Members that one task verifies against a leader at a time.
GROUP = 256
#: Members of a bucket in each half of a tile.
TILE = 768

_rng = np.random.default_rng(11)
_TIMES = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2)
_BLOCK = 512
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of WORDS words of a text, A-Z lower-cased; a shorter text that has words is
    one run."""
    words = word_hashes(text.lower().split())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(WORDS, len(words))))


def signature(sets: np.ndarray) -> np.ndarray:
    """BANDS * ROWS least values of 32 bits."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(sets), _BLOCK):
        np.minimum(least, (sets[i : i + _BLOCK, None] * _TIMES + _PLUS).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(sign: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, different between bands."""
    rows = sign.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


@lru_cache
def least_matches(seen: int, percent: int = PERCENT, prune: float = PRUNE) -> int:
    """Matches among `seen` values below which P(similarity >= threshold) < prune, for a uniform prior.

    The posterior of the similarity is Beta(m + 1, seen - m + 1); its upper tail from t on is the chance of at most m
    successes in seen + 1 draws of chance t.
    """
    t, tail = percent / 100, 0.0
    for m in range(seen + 1):
        tail += math.comb(seen + 1, m) * t**m * (1 - t) ** (seen + 1 - m)
        if tail >= prune:
            return m
    return seen


def survives(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which pairs (rows of bytes, one of each hash) are left after all batches. One byte of unequal values agrees with
    chance 1/256, which only ever keeps a pair."""
    alive, matches = np.arange(len(one)), np.zeros(len(one), int)
    for stop in [*range(4 * ROWS, BANDS * ROWS, 4 * ROWS), BANDS * ROWS]:
        start = max(0, (stop - 1) // (4 * ROWS) * 4 * ROWS)
        matches = matches + (one[alive, start:stop] == two[alive, start:stop]).sum(1)
        keep = matches >= least_matches(stop)
        alive, matches = alive[keep], matches[keep]
    out = np.zeros(len(one), bool)
    out[alive] = True
    return out


def sign(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, key of the set, bands, signature (a byte of each value), and the columns of `carry`; key,
    bands and signature are null where there are no words."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text", *carry)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in texts_of(b.column(1)):
                s = shingles(text)
                if len(s):
                    values = signature(s)
                    rows.append((len(s), xxh3_128_digest(s.tobytes()), band_keys(values), values.astype(np.uint8).tobytes()))
                else:
                    rows.append((0, None, None, None))
            own = batch(_ARROW, [b.column(0), *(zip(*rows, strict=True) if rows else [[]] * 4)])
            yield pa.RecordBatch.from_arrays([*own.columns, *b.columns[2:]], names=[*_ARROW.names, *carry])

    out = T.StructType.fromDDL("doc_id long, n_shingles long, key binary, bands array<long>, signature binary")
    return docs.mapInArrow(compute, T.StructType([*out, *docs.select(*carry).schema]))


def compared(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """Of `pairs` (leader, key) those that survive the comparison of their signatures."""
    one = signs.select(F.col("key").alias("leader"), F.col("signature").alias("one_"))
    two = signs.select("key", F.col("signature").alias("two_"))
    joined = pairs.join(one, "leader").join(two, "key").select("leader", "key", "one_", "two_")
    width = BANDS * ROWS

    def prune(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, width) for i in (2, 3))
            yield b.select([0, 1]).filter(pa.array(survives(one, two), pa.bool_()))

    return joined.mapInArrow(prune, "leader binary, key binary")


def linked(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(one), len(two)) < PERCENT * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= PERCENT * (len(one) + len(two) - both)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of `pairs` (leader, key) those whose full sets of shingles reach the threshold; `texts` has key and text.

    A leader's text goes to as many groups as keep its members few in each.
    """
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("n"))
    spread = pairs.join(sizes, "leader").select("leader", "key", F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("part"))
    members = spread.join(texts, "key").select("leader", "part", "key", "text")
    leaders = sizes.select("leader", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"))
    leaders = leaders.join(texts.select(F.col("key").alias("leader"), F.col("text").alias("lead_text")), "leader")
    leaders = leaders.select(F.col("leader").alias("lead"), F.col("part").alias("lead_part"), "lead_text")

    def check(m: pd.DataFrame, lead: pd.DataFrame) -> pd.DataFrame:
        if not len(m) or not len(lead):
            return m[["leader", "key"]].head(0)
        own = shingles(lead["lead_text"].iloc[0].encode())

        return m.loc[[linked(own, shingles(t.encode())) for t in m["text"]], ["leader", "key"]]

    return members.groupBy("leader", "part").cogroup(leaders.groupBy("lead", "lead_part")).applyInPandas(check, "leader binary, key binary")


def settled(members: DataFrame, roots: DataFrame, signs: DataFrame, texts: DataFrame, staging: Staging) -> DataFrame:
    """u and v, roots that links join, of the buckets of `members` whose members have different `roots`.

    A bucket is dealt into parts of about TILE members, and each pair of parts is a tile, so every pair of members meets
    in one. Within a tile pairs of one root are skipped, and what links join counts as one root from then on.
    """
    placed = members.join(roots, "key")
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    rows = placed.join(open_, "bucket").withColumn("parts", F.ceil(F.col("n") / TILE).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    rows = rows.withColumn("other", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(others)))
    rows = rows.select("bucket", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "key", "root")
    full = rows.join(signs.select("key", "signature"), "key").join(texts, "key")

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", ignore_index=True)
        signatures = np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(len(rows), -1)
        sets: dict[int, np.ndarray] = {}
        names, at = np.unique(rows["root"].to_numpy(), return_inverse=True)
        group = at.copy()  # the group each row is in by now
        across, part, first = rows["a"].iloc[0] != rows["b"].iloc[0], rows["part"].to_numpy(), rows["a"].iloc[0]
        out = []

        def set_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(rows["text"].iloc[i].encode())
            return sets[i]

        for i in range(len(rows)):
            if across and part[i] != first:
                continue
            later = part != first if across else np.arange(len(rows)) > i
            others = np.flatnonzero(later & (group != group[i]))
            if len(others):
                others = others[survives(np.broadcast_to(signatures[i], (len(others), signatures.shape[1])), signatures[others])]
            for j in others:
                if group[i] != group[j] and linked(set_of(i), set_of(int(j))):
                    out.append((names[at[i]], names[at[j]]))
                    group[group == group[j]] = group[i]
        return pd.DataFrame(out, columns=["u", "v"])

    return staging.table(full.groupBy("bucket", "a", "b").applyInPandas(settle, "u binary, v binary").distinct(), "joins")


def group(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included), kept (whether that
    is its own doc_id), and the columns of `carry`, of every row of `docs` (doc_id, text).

    Null, empty and blank texts have no shingles, are linked with nothing and kept. A row without a doc_id takes part;
    its component_id is null, and it is kept, only where no linked row has one. Rows that repeat are linked like others.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "near-duplicates")
    signed = staging.table(sign(docs, carry), "signed")
    per_class = signed.where("key IS NOT NULL").groupBy("key")
    classes = staging.table(per_class.agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "classes")

    places = classes.select("key", F.explode("bands").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = staging.table(places.join(shared, "bucket"), "members")
    weights = members.groupBy("key").agg(F.sum(F.col("n") - 1).alias("weight"))
    signs = staging.table(classes.select("key", "doc", "signature").join(weights, "key"), "signs")
    texts = staging.table(_texts(docs, signs), "texts")

    weighed = members.join(signs.select("key", "weight"), "key")
    leaders = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "key"))["key"].alias("leader"))
    pairs = members.join(leaders, "bucket").where("key <> leader").select("leader", "key").distinct()
    links = verified(staging.table(compared(pairs, signs), "pairs"), texts)
    links = staging.table(links.select(F.col("leader").alias("u"), F.col("key").alias("v")), "links")
    found = components(links, staging, "edges")
    roots = signs.select("key").join(found.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("root"))
    roots = staging.table(roots, "roots")

    more = settled(members, roots, signs, texts, staging)
    if not more.isEmpty():
        found = components(more, staging, "more-edges")
        joined = roots.join(found.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
        roots = joined.select("key", F.coalesce("new", "root").alias("root"))

    rooted = classes.select("key", "doc").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_key = rooted.join(least, "root").select("key", "component_id")
    out = signed.select("doc_id", "n_shingles", "key", *carry).join(of_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *carry)


def _texts(docs: DataFrame, signs: DataFrame) -> DataFrame:
    """key and text of every class of `signs` (key, doc). Rows of one doc_id may differ in text, so the key is checked."""
    wanted = signs.select("key", "doc")
    found = docs.select(F.col("doc_id").cast("long").alias("own"), "text").where("text IS NOT NULL")
    joined = found.join(wanted, F.col("own").eqNullSafe(F.col("doc"))).select("key", "text")

    def same(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [xxh3_128_digest(shingles(t).tobytes()) for t in texts_of(b.column(1))]
            yield b.filter(pa.array([k == x for k, x in zip(b.column(0).to_pylist(), keys, strict=True)], pa.bool_()))

    return joined.mapInArrow(same, "key binary, text string").dropDuplicates(["key"])
