"""SentencePiece encoding and decoding, giant documents by a max-plus scan over chunks.

The vocabulary is a byte-pair one. A sequence of pieces is its encoding of a text exactly if each neighbouring pair is
what it encodes the pair's own text to, so encoding is a search for the one path through the pieces found in the text
whose neighbours all agree; a path weighs 0 if they do and minus infinity if not.

A document of more than CHUNK characters is split into chunks at any place. The states at a boundary are the pieces that
hold the character before it, up to some way into the next chunk. Each chunk yields the matrix of best weights from the
states at its left to those at its right, in max-plus algebra. The matrices of a document are combined by an associative
scan; the end of the text fixes the last state and so, backwards, the state at every boundary, and each chunk is then
traced back on its own, between its two states.

No piece holds a blank or line feed after another character, so words are encoded one by one: inside a chunk a path can
only matter before the first and after the last such place, and shorter documents need no scan at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recall_lens.llm.staging import Staging, small_batches
from recall_lens.llm.vocabulary import REMEMBERED, loaded, tokenizer_path

#: Characters of a chunk; longer documents are scanned.
CHUNK = 32_768
BLANK = "▁"
NEVER = -np.inf

Piece = tuple[int, int]  # first and last-but-one place in the text


class Pieces:
    """The vocabulary, and the words a worker has met (about 75 MB)."""

    _units = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n[^{BLANK}\n]*")
    _odd = re.compile(f"  | \n|^ | $|^\n|{BLANK}")

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.vocab_size()
        self.ids = {self.library.id_to_piece(i): i for i in range(n) if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))}
        self.score = {p: self.library.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [p.replace(BLANK, " ").encode() if (p := self.library.id_to_piece(i)) in self.ids else b"" for i in range(n)]
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        self.known: dict[str, bytes] = {}

    # whole words, by the library

    def units(self, text: str) -> list[str]:
        """The text in parts that are encoded one by one: a blank (or more) and what follows, or a line feed and what
        follows. One blank is left out."""
        if self._odd.search(text) or not text:
            return [u if u[0] == "\n" else u[1:].replace(BLANK, " ") if u != BLANK else BLANK for u in self._units.findall((BLANK + text.replace(" ", BLANK)) if text else "")]
        return text.replace("\n", " \n").split(" ")

    def learn(self, lists: list[list[str]]) -> None:
        words = set().union(*lists)
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new = list(words.difference(self.known))
        for word, ids in zip(new, self.library.encode(new, num_threads=1), strict=True):
            self.known[word] = np.array(ids[1:] if word[:1] == "\n" else ids, "<i4").tobytes()
        self.known[BLANK] = np.array([self.ids[BLANK]], "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes, as by the library."""
        lists = [self.units(t) for t in texts]
        self.learn(lists)
        get = self.known.__getitem__
        return [b"".join(map(get, units)) for units in lists]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; one leading blank is the encoder's own. Bytes that are no UTF-8 are replaced."""
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    # paths between boundary states

    @cached_property
    def merged(self):
        """Pieces of a short text by merging, best score first, leftmost of equals."""

        @lru_cache(200_000)
        def merge(text: str) -> tuple[str, ...]:
            parts = list(text)
            while len(parts) > 1:
                scores = [(-self.score[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.score]
                if not scores:
                    break
                i = min(scores)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            return tuple(parts)

        return merge

    @cached_property
    def agree(self):
        """Whether two pieces stay as they are when their texts meet."""

        @lru_cache(500_000)
        def agree(one: str, two: str) -> bool:
            if two[0] in (BLANK, "\n") and one[-1] not in (BLANK, "\n") or one == "\n":
                return True
            return self.merged(one + two) == (one, two)

        return agree

    def starting(self, text: str, at: int) -> list[Piece]:
        """Pieces that can start at a place: any single character, and longer ones that merging can make."""
        out = [(at, at + 1)]
        for stop in range(at + 2, min(len(text), at + self.longest) + 1):
            if (p := text[at:stop]) in self.ids and self.merged(p) == (p,):
                out.append((at, stop))
        return out

    def states(self, text: str, at: int) -> list[Piece]:
        """Pieces that hold the character before the place."""
        return [p for start in range(max(0, at - self.longest), at) for p in self.starting(text, start) if p[1] >= at]

    def paths(self, text: str, left: list[Piece], start: int, stop: int) -> dict[Piece, tuple[int, Piece | None]]:
        """Pieces from `left` on that a path of agreeing neighbours reaches, up to those that start before `stop`: with
        the bits of the left states it comes from, and one piece before it."""
        ends: dict[int, list[tuple[Piece, int]]] = {}
        for k, p in enumerate(left):
            ends.setdefault(p[1], []).append((p, 1 << k))
        found: dict[Piece, tuple[int, Piece | None]] = {p: (1 << k, None) for k, p in enumerate(left)}
        for at in range(start, stop):
            before = ends.pop(at, None)
            if not before:
                continue
            for p in self.starting(text, at):
                mask, last = 0, None
                for q, m in before:
                    if q[0] == q[1] or self.agree(text[q[0] : q[1]], text[p[0] : p[1]]):
                        mask, last = mask | m, q
                if mask:
                    found[p] = mask, last
                    ends.setdefault(p[1], []).append((p, mask))
        return found

    def breaks(self, text: str, start: int, stop: int) -> tuple[int, int] | None:
        """The first and last place in (start, stop) that no piece reaches across, or None."""
        inner = [m.start() + 1 for m in re.finditer(f"[^{BLANK}\n](?=[{BLANK}\n])", text[start:stop])]
        inner = [start + i for i in inner if start + i < stop]
        return (inner[0], inner[-1]) if inner else None

    def transfer(self, text: str, start: int, stop: int) -> np.ndarray:
        """Best weights from the states at `start` to those at `stop` (the text before `start` and after `stop` is
        context). At the start of a document there is one state, the empty piece."""
        left, right = self.states(text, start) or [(start, start)], self.states(text, stop)
        cut = self.breaks(text, start, stop)
        first, last = cut or (stop, start)
        head = self.paths(text, left, start, first)
        out = np.full((len(left), len(right)), NEVER)
        if cut:
            arrive = 0
            for p, (mask, _) in head.items():
                arrive |= mask if p[1] == first else 0
            tail = self.paths(text, [(last, last)], last, stop)
            rows = np.array([arrive >> k & 1 for k in range(len(left))], bool)
            columns = np.array([p in tail for p in right], bool)
            out[np.ix_(rows, columns)] = 0
        else:
            for j, p in enumerate(right):
                if p in head:
                    for k in range(len(left)):
                        if head[p][0] >> k & 1:
                            out[k, j] = 0
        return out

    def trace(self, text: str, start: int, stop: int, i: int, j: int) -> bytes:
        """Ids of the pieces that start in [start, stop) on the path from left state `i` to right state `j`."""
        left, right = self.states(text, start) or [(start, start)], self.states(text, stop)
        cut = self.breaks(text, start, stop)
        if not cut:
            return self._walk(text, left[i], right[j], start, stop)
        first, last = cut
        head = self.paths(text, [left[i]], start, first)
        final = next(p for p in head if p[1] == first) if left[i][1] < first else left[i]
        middle = text[first:last]
        inner = self._units.findall(middle)
        words = [u if u[0] == "\n" else u[1:].replace(BLANK, " ") if u != BLANK else BLANK for u in inner]
        self.learn([words])
        return self._walk(text, left[i], final, start, first) + b"".join(self.known[w] for w in words) + self._walk(text, (last, last), right[j], last, stop)

    def _walk(self, text: str, one: Piece, two: Piece, start: int, stop: int) -> bytes:
        found = self.paths(text, [one], start, stop)
        out, at = [], two
        while at is not None and at != one:
            out.append(at)
            at = found[at][1]
        ids: list[int] = []
        for a, b in reversed(out):
            piece = text[a:b]
            ids += [self.ids[piece]] if piece in self.ids else [self.byte[x] for x in piece.encode()]
        return np.array(ids, "<i4").tobytes()


def product(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The max-plus product of two matrices."""
    return (one[:, :, None] + two[None]).max(1)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, by doubling: as many rounds as the logarithm of their number."""
    out, step = list(matrices), 1
    while step < len(out):
        out = [product(out[k - step], out[k]) if k >= step else out[k] for k in range(len(out))]
        step *= 2
    return out


def boundary_states(matrices: list[np.ndarray], last: int) -> list[int]:
    """The state at every boundary of a document whose last state is known."""
    whole, states = scan(matrices), [last]
    for k in range(len(matrices) - 1, 0, -1):
        states.append(int((whole[k - 1][0] + matrices[k][:, states[-1]]).argmax()))
    return [0, *reversed(states)]


def _ids(parts: list[bytes]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _scanned(giants: DataFrame, staging: Staging, path: str, chunk: int) -> DataFrame:
    """doc_id and ids of `giants` (row, doc_id, text), by the scan."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = loaded(Pieces, path).longest
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = BLANK + text.replace(" ", BLANK)
                for k, at in enumerate(range(0, len(s), chunk)):
                    low, stop = max(0, at - 2 * context), min(len(s), at + chunk)
                    part = [row], [k], [s[low : stop + context]], [at - low], [stop - low]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(part, (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()), strict=True)], names=["row", "k", "part", "start", "stop"])

    chunks = staging.table(giants.select("row", "text").mapInArrow(split, "row long, k int, part string, start int, stop int").repartition("row", "k"), "chunks")

    def transfer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(Pieces, path)
        for b in batches:
            found, lasts = [], []
            for part, start, stop in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                found.append(pieces.transfer(part, start, stop))
                ends = [p[1] for p in pieces.states(part, stop)]
                lasts.append([j for j, e in enumerate(ends) if e == len(part)] if stop == len(part) else [])
            out = [b.column(0), b.column(1), pa.array([len(m) for m in found], pa.int32()), pa.array([m.ravel() for m in found], pa.list_(pa.float64())), pa.array(lasts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(out, names=["row", "k", "height", "weights", "lasts"])

    matrices = chunks.mapInArrow(transfer, "row long, k int, height int, weights array<double>, lasts array<int>")

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        held = [np.asarray(w).reshape(h, -1) for w, h in zip(rows["weights"], rows["height"], strict=True)]
        final = scan(held)[-1][0]
        last = next(j for j in rows["lasts"].iloc[-1] if final[j] > NEVER)
        states = boundary_states(held, int(last))
        return pd.DataFrame({"row": rows["row"], "k": rows["k"], "i": states[:-1], "j": states[1:]})

    ends = matrices.groupBy("row").applyInPandas(combine, "row long, k int, i int, j int")

    def trace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(Pieces, path)
        for b in batches:
            parts = [pieces.trace(*x) for x in zip(*(b.column(c).to_pylist() for c in range(2, 7)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _ids(parts)], names=["row", "k", "ids"])

    traced = chunks.join(ends, ["row", "k"]).select("row", "k", "part", "start", "stop", "i", "j").mapInArrow(trace, "row long, k int, ids array<int>")
    whole = traced.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    return giants.select("row", "doc_id").join(whole, "row").select("doc_id", "ids")


def encode(docs: DataFrame, model: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id and ids of every row of `docs` (doc_id, text), as the library gives them.

    Null text counts as empty and has no ids. Repeated rows and rows without a doc_id are encoded like others.
    """
    path = model or tokenizer_path("piece_bpe_32k.model")
    small_batches(docs.sparkSession)
    staging = Staging(docs.sparkSession, "sentencepieces")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def direct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(Pieces, path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _ids(pieces.encode(b.column(1).to_pylist()))], names=["doc_id", "ids"])

    short = rows.where(F.length("text") < chunk).mapInArrow(direct, "doc_id long, ids array<int>")
    giants = staging.table(rows.where(F.length("text") >= chunk).withColumn("row", F.monotonically_increasing_id()), "giants")
    return short.union(_scanned(giants, staging, path, chunk))


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids and the text of the ids, of every row of `encoded` (doc_id, ids). Null ids give empty text."""
    path = model or tokenizer_path("piece_bpe_32k.model")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(Pieces, path)
        for b in batches:
            texts = [pieces.decode(x.values.to_numpy()) if x.is_valid else "" for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(read, "doc_id long, ids array<int>, text string")
