"""Best-fit packing of documents into token sequences.

Documents become pieces of at most `capacity` ids. Best-fit decreasing then gives every piece a sequence: pieces are
taken from the longest to the shortest, and each goes to the open sequence with the least room that still holds it,
found by a segment tree over remaining capacities.

Pieces of one length are alike, so the placing needs only the number of pieces of each length: at most `capacity` rows,
whatever the size of the corpus. It yields runs: so many pieces of a length go, so many each, to consecutive sequences.
A run takes sequences from remaining room r to at most r mod length < r / 2, and each length makes at most five new
groups of sequences, so there are at most 5 * capacity * log2(capacity) runs. Spark numbers the pieces of each length
and looks its run up. The result is the one best-fit decreasing gives over the whole corpus, not one per partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recall_lens.llm.staging import Staging, small_batches
from recall_lens.llm.text import batch
from recall_lens.llm.vocabulary import WordIds, loaded, tokenizer_path

CAPACITY = 4096
END_ID = 1
#: Parts in which the pieces of one length are numbered, so that a common length is no single task's work.
PARTS = 64

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenRoom:
    """Segment tree over remaining capacities 0..capacity: which of them some open sequence has."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.has = bytearray(2 * self.leaves)

    def set(self, room: int, open_: bool) -> None:
        i = self.leaves + room
        self.has[i] = open_
        while i := i >> 1:
            self.has[i] = self.has[2 * i] | self.has[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The least room of at least `need`, in logarithmic time."""
        i = self.leaves + need
        if self.has[i]:
            return need
        while i > 1:
            if not i & 1 and self.has[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return None
        while i < self.leaves:
            i = 2 * i + (not self.has[2 * i])
        return i - self.leaves


def place(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first, count, sequence, each, offset) of best-fit decreasing, by length and first.

    Pieces first..first+count of a length go, `each` at a time, to the sequences from `sequence` on, side by side from
    `offset`. Counts of no pieces give no run.
    """
    rooms, tree = [[] for _ in range(capacity + 1)], OpenRoom(capacity)
    runs, sequences = [], 0

    def put(room: int, first: int, many: int) -> None:
        if many:
            rooms[room].append((first, many))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, many = capacity, -(-left // (capacity // length))
                put(room, sequences, many)
                sequences += many
            first, many = rooms[room].pop()
            if not rooms[room]:
                tree.set(room, False)
            each = room // length
            if full := min(many, left // each):
                runs.append((length, rank, full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = many - full
            if rest and left:  # fewer than `each` are left: they go together into one
                runs.append((length, rank, left, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                full, rest, left = full + 1, rest - 1, 0
            put(room, first + full, rest)
    return np.array(sorted(runs), np.int64).reshape(-1, 6)


def cut(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and with_ids the ids.

    A null or empty text is the end id alone. Rows with a null doc_id, and rows that repeat, are documents like others.
    """
    path, schema = tokenizer or tokenizer_path("word_bpe_49k.json"), _PIECES + ", ids array<int>" * with_ids
    small_batches(docs.sparkSession)
    end = np.array([END_ID], "<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema([*fields, *[("ids", pa.list_(pa.int32()))] * with_ids])

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(WordIds, path)
        for b in batches:
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), words.encode(b.column(1)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), *[np.frombuffer(part, "<u4").astype(np.int32)] * with_ids))
            yield batch(arrow, zip(*rows) if rows else [[] for _ in arrow])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


def pack(pieces: DataFrame, staging: Staging, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (at least doc_id, piece, length of 1 to capacity) with sequence_id and offset, gapless from 0.

    Reads `pieces` twice, so give it as a written table. Pieces of equal length may change places between runs; their
    sequences are as full either way. No pieces give no rows.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = place(counts, capacity)
    shared = spark.sparkContext.broadcast(runs)
    parted = pieces.withColumn("part_", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)))
    sizes = parted.groupBy("length", "part_").agg(F.count("*").alias("n_"))
    before = F.sum("n_").over(Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("length", "part_", F.coalesce(before, F.lit(0)).alias("first_"))
    rank = F.row_number().over(Window.partitionBy("length", "part_").orderBy("doc_id", "piece")) - 1
    ranked = parted.withColumn("rank_", rank).join(firsts, ["length", "part_"]).withColumn("rank_", F.col("rank_") + F.col("first_"))
    out = ranked.select(*pieces.columns, "rank_")
    schema = pieces.select("*").schema.add("sequence_id", "long").add("offset", "long")
    at_length, at_rank = out.columns.index("length"), len(pieces.columns)

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_, first, _, sequence, each, offset = shared.value.T
        keys = length_ << 44 | first
        for b in batches:
            length, rank = b.column(at_length).to_numpy(), b.column(at_rank).to_numpy()
            i = np.searchsorted(keys, length << 44 | rank, "right") - 1
            k = rank - first[i]
            new = [pa.array(sequence[i] + k // each[i]), pa.array(offset[i] + k % each[i] * length)]
            yield pa.RecordBatch.from_arrays([*b.columns[:at_rank], *new], names=[f.name for f in schema])

    return staging.table(out, "ranked").mapInArrow(look_up, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of `docs` (doc_id, text) in as few sequences of `capacity` ids as best-fit decreasing needs."""
    staging = Staging(docs.sparkSession, "packing")
    return pack(staging.table(cut(docs, capacity, tokenizer, with_ids), "pieces"), staging, capacity)
