"""Numbers of tokens, counted in Arrow functions that return lengths only.

A worker takes the documents of an Arrow batch in groups of about GROUP_BYTES. A longer text is split at safe
boundaries, where the vocabulary starts a new token whatever came before, and its parts join the groups like documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recall_lens.llm.staging import small_batches
from recall_lens.llm.text import batch
from recall_lens.llm.vocabulary import PieceCounts, loaded, tokenizer_path

#: Bytes of text encoded together; longer texts are split.
GROUP_BYTES = 4 << 20
LIMIT = 512

_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def parts(text: str, most: int, counter: PieceCounts) -> list[str]:
    """The text in parts of about `most` characters, cut before safe spaces; one part if there is none."""
    if len(text) <= most:
        return [text]
    out, start = [], 0
    while len(text) - start > most and (found := counter._safe.search(text, start + most)):
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def groups(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to `most` at most, or that hold one item."""
    first = total = 0
    k = -1
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if k >= first:
        yield first, k + 1


def count_tokens(docs: DataFrame, limit: int = LIMIT, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row of `docs` (doc_id, text).

    Null text counts as empty: no bytes, no tokens. Special strings inside a text count as the library counts them. A
    row comes out for every row that goes in, repeated ones and those without a doc_id included.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    small_batches(docs.sparkSession)

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(PieceCounts, path)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            cut = [(k, p) for k, t in enumerate(texts) for p in parts(t, GROUP_BYTES // 4, counter)]
            counts, sizes, of_part = [0] * len(texts), [0] * len(texts), [len(p.encode()) for _, p in cut]
            for (k, _), n in zip(cut, of_part, strict=True):
                sizes[k] += n
            for i, j in groups(of_part, GROUP_BYTES):
                for (k, _), n in zip(cut[i:j], counter.count([p for _, p in cut[i:j]]), strict=True):
                    counts[k] += n
            yield batch(_ARROW, [b.column(0), sizes, counts])

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lengths, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
