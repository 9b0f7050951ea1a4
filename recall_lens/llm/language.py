"""Language of a text by cross-parsing entropy.

A suffix automaton holds all substrings of a bounded sample of labelled text of one language. A text is cut into
phrases, each the longest match from its start on in that sample; few phrases mean that the sample predicts the text
well. phrases * log2(sample length) / text length estimates the cross entropy in bits per symbol, and the language with
the least wins.

Symbols are classes of letters: upper and lower case are one, the most frequent letters of the samples have a class
each, rarer ones share one, and a run of anything else is one blank. A worker parses the texts of an Arrow batch
against all languages in step, in chunks of CHUNK symbols; a phrase ends with its chunk.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recall_lens.llm.staging import Carried, small_batches
from recall_lens.llm.text import batch
from recall_lens.llm.worker import kept

#: Characters of labelled text that are learnt of a language at most, and from one document at most.
SAMPLE_CHARS = 65_536
DOCUMENT_CHARS = 4_096
#: Stretches that are learnt of a longer document, one from each of so many equal parts of it.
STRETCHES = 8
#: Characters of the samples whose automata a worker holds at a time, and of the texts it parses against each such group
#: where there are several.
GROUP_CHARS = 400_000
HELD_CHARS = 16_000_000
#: Letters with a class of their own.
LETTERS = 44
CHUNK = 256
UNKNOWN = "und"

_ARROW = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_symbol", pa.float64()), ("n_symbols", pa.int64())])
_SCHEMA = "doc_id long, lang_pred string, score double, bits_per_symbol double, n_symbols long"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions (states, width) of the automaton of all substrings; -1 where there is none, state 0 is the start."""
    blank = array("i", [-1]) * width
    goes, link, length, last = blank[:], [-1], [0], 0  # the transitions of a state are `width` neighbours
    for c in symbols:
        state = len(link)
        goes += blank
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and goes[p * width + c] < 0:
            goes[p * width + c] = state
            p = link[p]
        if p >= 0:
            q = goes[p * width + c]
            if length[q] != length[p] + 1:
                copy = len(link)
                goes += goes[q * width : (q + 1) * width]
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and goes[p * width + c] == q:
                    goes[p * width + c] = copy
                    p = link[p]
                link[q] = q = copy
            link[state] = q
        last = state
    return np.frombuffer(goes, np.int32).reshape(-1, width)


@dataclass(frozen=True)
class Languages:
    """Samples of labelled text by language; automata are built where they are used, from these alone."""

    samples: tuple[tuple[str, str], ...]

    @cached_property
    def names(self) -> list[str]:
        return [name for name, _ in self.samples]

    @cached_property
    def classes(self) -> np.ndarray:
        """Class of each code point: 0 a blank, then the frequent letters, then all other letters."""
        seen = Counter("".join(t.lower() for _, t in self.samples))
        common = sorted((c for c in seen if c.isalpha()), key=lambda c: (-seen[c], c))[:LETTERS]
        table = np.where(_letters(), len(common) + 1, 0).astype(np.uint8)
        for k, c in enumerate(common, 1):
            for form in {c, c.upper()}:
                if len(form) == 1:
                    table[ord(form)] = k
        return table

    @property
    def pad(self) -> int:
        return int(self.classes.max()) + 1

    def symbols(self, text: str) -> np.ndarray:
        s = self.classes[code_points(text)]
        if len(s):
            keep = s != 0
            keep[1:] |= s[:-1] != 0
            s = s[keep]
        return s

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([max(2, len(self.symbols(t))) for _, t in self.samples], float)

    @cached_property
    def groups(self) -> list[range]:
        """Neighbouring languages whose automata are held together."""
        out, first, chars = [], 0, 0
        for k, (_, text) in enumerate(self.samples):
            if k > first and chars + len(text) > GROUP_CHARS:
                out.append(range(first, k))
                first, chars = k, 0
            chars += len(text)
        return [*out, range(first, len(self.samples))] if self.samples else []

    def steps(self, group: range) -> tuple[np.ndarray, np.ndarray]:
        """One table for the languages of a group, and where each starts. An entry is twice the place of the next state's
        row, plus one if a phrase starts with the symbol. The group built last is remembered."""
        held = self.__dict__.get("_held")
        if held and held[0] == group:
            return held[1]
        self.__dict__.pop("_held", None)
        width, tables, starts, at = self.pad + 1, [], [], 0
        for _, text in self.samples[group.start : group.stop]:
            # an automaton has two states a symbol at most, so 32 bits hold the places of a group
            table = suffix_automaton(self.symbols(text).tolist(), width).copy()
            fresh = np.maximum(table[0], 0)  # where a phrase goes that starts with the symbol
            for rows in (table[i : i + 4096] for i in range(0, len(table), 4096)):
                new = rows < 0
                np.copyto(rows, fresh, where=new)
                rows += at
                rows *= width * 2
                rows += new
            table[0] |= 1
            table[:, self.pad] = (np.arange(len(table), dtype=np.int32) + at) * (width * 2)
            starts.append(at * width)
            at += len(table)
            tables.append(table)
        self.__dict__["_held"] = group, (np.concatenate(tables).ravel() if len(tables) > 1 else tables[0].ravel(), np.array(starts, np.int32))
        return self.__dict__["_held"][1]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases (languages, texts) of texts given as symbols."""
        n_chunks = np.array([-(-len(s) // CHUNK) for s in texts])
        out = np.zeros((len(self.samples), len(texts)), np.int64)
        if not n_chunks.sum():
            return out
        grid = np.full(n_chunks.sum() * CHUNK, self.pad, np.uint8)
        for first, s in zip((np.cumsum(n_chunks) - n_chunks) * CHUNK, texts, strict=True):
            grid[first : first + len(s)] = s
        grid = np.ascontiguousarray(grid.reshape(-1, CHUNK).T).astype(np.int32)
        ends = np.cumsum(n_chunks)
        for group in self.groups:
            table, starts = self.steps(group)
            for k, start in zip(group, starts, strict=True):  # one language's table at a time stays near the processor
                state = np.full(grid.shape[1], start, np.int32)
                found = np.zeros(grid.shape[1], np.int32)
                for symbols in grid:
                    state += symbols
                    state = table.take(state)
                    found += state & 1
                    state >>= 1
                whole = np.concatenate([[0], np.cumsum(found)])
                out[k] = whole[ends] - whole[ends - n_chunks]
        return out

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, posterior share of the winner, its bits per symbol, and symbols of each text."""
        symbols = [self.symbols(t) for t in texts]
        size = np.array([len(s) for s in symbols])
        known = np.array([bool(len(s)) and bool(s.any()) for s in symbols], bool)
        if not self.samples or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), size
        bits = self.phrases(symbols) * np.log2(self.lengths)[:, None]
        best = bits.argmin(0)  # languages are in order of name, so ties go to the first name
        least = bits.min(0)
        share = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(0)
        names = [self.names[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
        return names, np.where(known, share, 0.0), np.where(known, least / np.maximum(size, 1), 0.0), size


def _stretches() -> Column:
    """At most DOCUMENT_CHARS characters of a text: a longer one's STRETCHES, from places chosen by hash."""
    width = DOCUMENT_CHARS // STRETCHES - 1  # and a blank
    n = F.length("text").cast("long")

    def stretch(k: int) -> Column:
        first = F.floor(n * k / STRETCHES)
        room = F.floor(n * (k + 1) / STRETCHES) - first - width + 1
        return F.substring("text", (first + F.pmod(F.xxhash64("doc_id", F.lit(k)), room) + 1).cast("int"), F.lit(width))

    return F.when(n <= DOCUMENT_CHARS, F.col("text")).otherwise(F.concat_ws(" ", *map(stretch, range(STRETCHES))))


def learn(docs: DataFrame, chars: int = SAMPLE_CHARS) -> Languages:
    """Samples of at most `chars` characters a language from `docs` (doc_id, text, lang).

    Rows without text, lang or doc_id teach nothing. All other languages are learnt. Of each, about four times the sample
    is gathered, the documents with the smallest hashes and one at least, and equal texts count once; what is gathered
    depends on the number of languages, not of documents.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL AND lang <> 'und' AND text <> ''")
    known = known.select("doc_id", "text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("place"))
    sizes = known.groupBy("lang").agg(F.sum(F.least(F.length("text"), F.lit(DOCUMENT_CHARS))).alias("n"), F.min("place").alias("least"))
    bounds = sizes.select("lang", F.greatest("least", F.lit(4.0 * chars * (1 << 30)) / F.col("n")).alias("bound"))
    picked = known.join(F.broadcast(bounds), "lang").where("place <= bound")
    rows = picked.select("lang", "doc_id", _stretches().alias("text")).distinct().collect()
    samples: dict[str, dict[str, None]] = {}
    taken: Counter[str] = Counter()
    for r in sorted(rows, key=lambda r: (r.lang, hash((r.doc_id, 1)), r.text)):
        if taken[r.lang] < chars and r.text not in samples.setdefault(r.lang, {}):
            samples[r.lang][r.text[: chars - taken[r.lang]]] = None
            taken[r.lang] += len(r.text)
    return Languages(tuple((lang, " ".join(texts)) for lang, texts in sorted(samples.items())))


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of HELD_CHARS bytes of text or more."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.column(1).nbytes
        if size >= HELD_CHARS:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def identify(docs: DataFrame, languages: Languages, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), bits_per_symbol, n_symbols and the columns of `carry` of every row of `docs`
    (doc_id, text).

    Null text, text without a letter, and any text when nothing was learnt get `und`, with score 0. Nothing but the
    text is looked at. Repeated rows and rows without a doc_id are judged like others. A carried column that has the name
    of one of the first five comes back as `<name>_carried`.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(languages)
    carried = Carried(carry, _ARROW.names)
    names_ = [*_ARROW.names, *carried.inner()]

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept("language", shared.value, lambda: shared.value)  # automata are built once a worker
        for b in batches if len(model.groups) < 2 else _gathered(batches):
            names, score, bits, size = model.judge([x or "" for x in b.column(1).to_pylist()])
            own = batch(_ARROW, [b.column(0), names, score, bits, size])
            yield pa.RecordBatch.from_arrays([*own.columns, *b.columns[1 if carried.text else 2 :]], names=names_)

    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.col("text").alias("own_text"), *carried.held())
    taken = rows.schema.fields[1 if carried.text else 2 :]
    schema = T.StructType([*T.StructType.fromDDL(_SCHEMA), *[T.StructField(n, f.dataType) for n, f in zip(carried.inner(), taken, strict=True)]])
    return rows.mapInArrow(predict, schema).select(*_ARROW.names, *carried.back())


def with_letter(docs: DataFrame) -> DataFrame:
    """Rows of `docs` whose text has a letter, as `identify` sees letters."""
    small_batches(docs.sparkSession)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([bool(_letters()[code_points(t or "")].any()) for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
