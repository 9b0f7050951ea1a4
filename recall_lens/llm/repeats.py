"""Removal of passages that an earlier document holds too.

A window is SPAN consecutive words of one document. A word goes if a window over it also starts in a document with a
smaller doc_id. Four steps find them:

1. Every window names the least hashed gram within it. Equal windows name the same gram at the same place, so only
   windows under a gram that comes in two documents can recur. Consecutive windows that name the same gram are one
   stretch; documents with the same gram and equal stretches are one class, owned by its smallest document.
2. Recurring passages are confirmed: a class with a later document recurs as a whole. Classes that share only the gram
   are read from their owners' texts and compared window by window, by a 128-bit hash of the words.
3. The confirmed passages, as words taken from the owners' texts, are compiled into Aho-Corasick automata, one for each
   shard of documents, with the passages that documents of the shard may hold.
4. All documents stream through the automaton of their shard. It locates every occurrence of its passages by the words
   themselves, and the words of those whose owner is smaller go.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recall_lens.llm.staging import Carried, Staging, small_batches
from recall_lens.llm.text import batch, mixed, texts_of, window_hashes, word_hashes

SPAN = 50
GRAM = 8
#: Bytes of documents that share an automaton.
SHARD_BYTES = 6 << 20

#: Low bits of a gram's hash that give way to its place, so that the leftmost of equal ones is the least.
_PLACE = np.uint64((1 << 24) - 1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STRETCH = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("gram", pa.int64()), ("stretch", pa.int64())])


class _Powers:
    """Powers of the base and of its inverse, as far as they have been asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, x)))) for x in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def least_grams(grams: np.ndarray) -> np.ndarray:
    """For every window, the place of its least gram, by the hash without its low bits; the leftmost of several."""
    width = SPAN - GRAM + 1
    if len(grams) > _PLACE:
        return np.lib.stride_tricks.sliding_window_view(grams & ~_PLACE, width).argmin(1) + np.arange(len(grams) - width + 1)
    run, size = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64), 1
    while 2 * size <= width:  # the least of `size` neighbours, doubled
        run = np.minimum(run[:-size], run[size:])
        size *= 2
    rest = width - size
    return ((np.minimum(run[:-rest], run[rest:]) if rest else run) & _PLACE).astype(np.int64)


def stretches(words: np.ndarray) -> tuple[np.ndarray, ...]:
    """start, n (windows), gram and hash of the words of each stretch of a document given as word hashes."""
    n = len(words) - SPAN + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int32, np.int32, np.int64, np.int64))
    grams = window_hashes(words, GRAM)
    least = least_grams(grams)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    many = np.diff(starts, append=n)
    stop = starts + many + SPAN - 1
    up, down = _POWERS.first(len(words))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(words) * up)])
    whole = mixed((sums[stop] - sums[starts]) * down[starts] + many.astype(np.uint64))
    return starts.astype(np.int32), many.astype(np.int32), grams[least[starts]].view(np.int64), whole.view(np.int64)


def find_stretches(docs: DataFrame) -> DataFrame:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), 100):
                part = b.slice(i, 100)
                found = [stretches(word_hashes(t.split())) for t in texts_of(part.column(1))]
                ids = np.repeat(np.array(part.column(0).to_pylist(), np.int64), [len(f[0]) for f in found])
                yield batch(_STRETCH, [ids, *(np.concatenate(c) for c in zip(*found, strict=True))])

    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(find, "doc_id long, start int, n int, gram long, stretch long")


def read_passages(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """gram, stretch, owner, later, mixed_ and words of each of `classes`, from its owner's text. Rows of one doc_id may
    differ in text, so there the stretch is checked."""
    per_doc = classes.groupBy("owner").agg(F.collect_list(F.struct("start", "n", "gram", "stretch", "later", "mixed")).alias("wanted"))
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("owner"), "text")
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("owner"))  # without the text, which would have to be read
    repeated = ids.agg((F.count("*") > 1).alias("repeated")).where("repeated")
    per_doc = per_doc.join(repeated, "owner", "left")
    schema = pa.schema([("owner", pa.int64()), ("gram", pa.int64()), ("stretch", pa.int64()), ("later", pa.bool_()), ("mixed", pa.bool_()), ("words", pa.string())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for owner, text, wanted, repeated in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = text.encode().split()
                if repeated:
                    own = set(zip(*(c.tolist() for c in stretches(word_hashes(words))), strict=True))
                    wanted = [w for w in wanted if (w["start"], w["n"], w["gram"], w["stretch"]) in own]
                rows = [(owner, w["gram"], w["stretch"], w["later"], w["mixed"], b" ".join(words[w["start"] : w["start"] + w["n"] + SPAN - 1]).decode()) for w in wanted]
                if rows:
                    yield batch(schema, zip(*rows, strict=True))

    return texts.join(per_doc, "owner").mapInArrow(read, "owner long, gram long, stretch long, later boolean, mixed boolean, words string")


def shared_parts(passages: DataFrame, staging: Staging) -> DataFrame:
    """owner, words and source of the parts of `passages` whose windows all start in documents before the owner;
    source is the largest of those documents."""
    keyed = passages.where("mixed").select("owner", "gram", "stretch", "words")

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("owner", pa.int64()), ("gram", pa.int64()), ("stretch", pa.int64()), ("at", pa.int32()), ("one", pa.int64()), ("two", pa.int64())])
        for b in batches:
            hashes = [word_hashes(t.split()) for t in texts_of(b.column(3))]
            one, two = ([window_hashes(h, SPAN, k).view(np.int64) for h in hashes] for k in (0, 1))
            many = [len(x) for x in one]
            if sum(many):
                ids = [np.repeat(b.column(k).to_numpy(), many) for k in range(3)]
                yield batch(schema, [*ids, np.concatenate([np.arange(m, dtype=np.int32) for m in many]), np.concatenate(one), np.concatenate(two)])

    rows = staging.table(keyed.mapInArrow(windows, "owner long, gram long, stretch long, at int, one long, two long"), "windows")
    first = rows.groupBy("one", "two").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first < last").drop("last")
    late = rows.join(first, ["one", "two"]).where("owner > first")
    covered = late.groupBy("owner", "gram", "stretch").agg(F.collect_list(F.struct("at", "first")).alias("at"))
    schema = pa.schema([("owner", pa.int64()), ("words", pa.string()), ("source", pa.int64())])

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for owner, text, covered in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words, at = text.encode().split(), sorted((x["at"], x["first"]) for x in covered)
                i = 0
                while i < len(at):
                    j = i
                    while j + 1 < len(at) and at[j + 1][0] <= at[j][0] + 1:
                        j += 1
                    rows.append((owner, b" ".join(words[at[i][0] : at[j][0] + SPAN]).decode(), max(f for _, f in at[i : j + 1])))
                    i = j + 1
            yield batch(schema, zip(*rows, strict=True) if rows else [[]] * 3)

    joined = keyed.join(covered, ["owner", "gram", "stretch"]).select("owner", "words", "at")
    return joined.mapInArrow(parts, "owner long, words string, source long")


class _Numbered(dict):
    """Numbers of words, and one number for all others."""

    def __init__(self, numbers: dict[bytes, int], none: int) -> None:
        super().__init__(numbers)
        self.none = none

    def __missing__(self, word: bytes) -> int:
        return self.none


class Automaton:
    """Locates passages, given as words, in documents: (source, words) with the smallest source of equal words."""

    def __init__(self, passages: Iterable[tuple[int, bytes]]) -> None:
        self.numbers: dict[bytes, int] = {}
        self.search = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for source, text in passages:
            words = text.split()
            key = tuple(self.numbers.setdefault(w, len(self.numbers)) for w in words)
            known = self.search.get(key, None)
            self.search.add_word(key, (len(key), source if known is None else min(source, known[1])))
        self.none = len(self.numbers)
        self.get = _Numbered(self.numbers, self.none).__getitem__
        if len(self.search):
            self.search.make_automaton()

    def covered(self, doc_id: int, words: list[bytes]) -> np.ndarray:
        """Which words lie in an occurrence of a passage from a smaller document. A passage is made of known words, so the
        automaton reads the stretches of SPAN known words or more."""
        steps = np.zeros(len(words) + 1, np.int64)
        if len(self.search) and len(words) >= SPAN:
            numbers = list(map(self.get, words))
            unknown = np.flatnonzero(np.array(numbers) == self.none)
            edges = np.concatenate(([-1], unknown, [len(words)]))
            for k in np.flatnonzero(np.diff(edges) > SPAN).tolist():
                first = int(edges[k]) + 1
                for end, (length, source) in self.search.iter(tuple(numbers[first : edges[k + 1]])):
                    if source < doc_id:
                        steps[first + end - length + 1] += 1
                        steps[first + end + 1] -= 1
        return np.cumsum(steps[:-1]) > 0


def salts(docs: DataFrame) -> Column:
    """Shards that the rows of a repeated doc_id are dealt over, as a map; it holds only doc_ids whose rows fill more than
    one, which are fewer than the documents have SHARD_BYTES."""
    known = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    sizes = known.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("n")).where((F.col("rows") > 1) & (F.col("n") > SHARD_BYTES))
    found = sizes.select("id", F.least(F.ceil(F.col("n") / SHARD_BYTES), "rows").cast("int").alias("n")).collect()
    pairs = [F.lit(x).cast(t) for r in found for x, t in ((r.id, "long"), (r.n, "int"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<bigint,int>")


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), whole_as_is: bool = False) -> DataFrame:
    """doc_id, text (the kept words, joined by one space), n_words, n_removed, and the columns of `carry`, of every row
    of `docs` (doc_id, text). `whole_as_is` leaves the text of rows that lose nothing as it is, null included.

    Null, empty and blank texts have no words and come back empty. A row without a doc_id is before and after no other:
    it comes back whole, and takes nothing from others. Rows that repeat a doc_id take nothing from each other. A carried
    column that has the name of one of the first four comes back as `<name>_carried`.
    """
    spark = docs.sparkSession
    small_batches(spark)
    staging = Staging(spark, "repeats")
    found = staging.table(find_stretches(docs), "stretches")
    grams = found.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("gram")
    found = staging.table(found.join(grams, "gram"), "recurring")
    owned = found.groupBy("gram", "stretch").agg(F.min(F.struct("doc_id", "start")).alias("own"), F.max("doc_id").alias("last"), F.min("n").alias("n"))
    classes = staging.table(owned.select("gram", "stretch", "n", F.col("own.doc_id").alias("owner"), F.col("own.start").alias("start"), (F.col("last") > F.col("own.doc_id")).alias("later")), "classes")
    several = classes.groupBy("gram").agg(F.min("owner").alias("low"), F.max("owner").alias("high")).select("gram", (F.col("low") < F.col("high")).alias("mixed"))
    asked = classes.join(several, "gram").where("later OR mixed")
    passages = staging.table(read_passages(docs, asked), "passages")
    parts = staging.table(shared_parts(passages, staging), "parts")

    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    shards = max(1, -(-size // SHARD_BYTES))
    shard = lambda c, salt: F.pmod(F.xxhash64(c, F.lit("shard"), salt), F.lit(shards)).cast("int").alias("shard")
    dealt = salts(docs)
    salted = lambda c: F.explode(F.sequence(F.lit(0), F.coalesce(F.element_at(dealt, c), F.lit(1)) - 1)).alias("salt")
    later = found.join(classes.where("later").select("gram", "stretch", "owner"), ["gram", "stretch"]).where("doc_id > owner")
    needed = later.select("doc_id", "gram", "stretch", salted(F.col("doc_id"))).select(shard(F.col("doc_id"), F.col("salt")), "gram", "stretch").distinct()
    whole = needed.join(passages.where("later").select("gram", "stretch", "owner", "words"), ["gram", "stretch"])
    parts = parts.select("owner", "source", "words", salted(F.col("owner"))).select(shard(F.col("owner"), F.col("salt")), "source", "words")
    phrases = whole.select("shard", F.col("owner").alias("source"), "words").union(parts)
    phrases = phrases.select(F.col("shard").alias("to"), F.col("source"), F.col("words").alias("phrase"))
    own, row = F.col("doc_id").cast("long"), F.monotonically_increasing_id()
    salt = F.pmod(F.xxhash64(row), F.coalesce(F.element_at(dealt, own), F.lit(1)).cast("long")).cast("int")
    out = ["doc_id", "text", "n_words", "n_removed"]
    carried = Carried([c for c in carry if c not in ("doc_id", "text")], out)
    taken = carried.inner()
    rows = docs.select(shard(F.coalesce(own, F.xxhash64(row)), salt), own.alias("doc_id"), "text", *carried.held())
    kept = rows.drop("shard")

    def remove(docs: pa.Table, phrases: pa.Table) -> pa.Table:
        automaton = Automaton(zip(phrases["source"].to_pylist(), texts_of(phrases["phrase"]), strict=True))
        texts, words_, removed = [], [], []
        for doc_id, text in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True):
            words = (text or "").encode().split()
            gone = automaton.covered(doc_id, words) if doc_id is not None else np.zeros(len(words), bool)
            lost = int(gone.sum())
            if lost:
                words = list(compress(words, (~gone).tolist()))
            if lost or not whole_as_is:
                text = b" ".join(words).decode()
            texts.append(text)
            words_.append(len(gone))
            removed.append(lost)
        columns = [docs["doc_id"], pa.array(texts, pa.string()), *[docs[c] for c in taken], pa.array(words_, pa.int64()), pa.array(removed, pa.int64())]
        return pa.table(columns, names=["doc_id", "text", *taken, "n_words", "n_removed"])

    schema = kept.schema.add("n_words", "long").add("n_removed", "long")
    done = rows.groupBy("shard").cogroup(phrases.groupBy("to")).applyInArrow(remove, schema)
    return done.select("doc_id", "text", *carried.back(), "n_words", "n_removed")
