"""Public tokenizers applied word by word.

Both vocabularies split text into pre-tokens that never reach across white space between two other characters, so the
ids of a text are those of its words, one after the other. A worker remembers the ids of words it has met and encodes new
ones in bulk. When it holds too many it forgets those that have not come again for a while; which words are remembered never
changes a result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402

from recall_lens.llm.worker import kept, uncollected  # noqa: E402

#: Words remembered by one worker: about 90 MB.
REMEMBERED = 300_000
#: Words of a generation where there are two: about 65 MB each.
GENERATION = 225_000
#: Words encoded as one text.
JOINED = 200


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Remembered[Word, Value]:
    """Values of words met lately. Of two generations the elder goes when the younger is full; a word that comes again moves
    to the younger, so frequent words stay."""

    def __init__(self) -> None:
        self.younger: dict[Word, Value] = {}
        self.elder: dict[Word, Value] = {}

    def of(self, lists: list[list[Word]], learn: Callable[[list[Word]], Mapping[Word, Value]]) -> list[list[Value]]:
        """The value of every word of these lists; those not remembered are learnt."""
        if len(self.younger) > GENERATION:
            self.younger, self.elder = {}, self.younger
        get = self.younger.get
        found = [list(map(get, words)) for words in lists]
        gaps = [(values, words, [i for i, v in enumerate(values) if v is None]) for values, words in zip(found, lists, strict=True) if None in values]
        if gaps:
            unknown = {words[i] for _, words, at in gaps for i in at}
            missing = unknown.difference(self.elder)
            self.younger.update((w, self.elder[w]) for w in unknown - missing)
            if missing:
                with uncollected():
                    self.younger.update(learn(list(missing)))
            for values, words, at in gaps:
                for i in at:
                    values[i] = self.younger[words[i]]
        return found


def _each(column: pa.StringArray) -> list[bytes]:
    """The UTF-8 bytes of every text of a column without nulls."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]


class WordIds:
    """Ids by the word-level vocabulary, as little-endian unsigned 32-bit bytes.

    Its normalizer lower-cases and its pre-tokenizer drops white space, so ASCII letters are lower-cased first (fewer
    words to remember), except in a text that may hold a special token, which is matched before normalizing.
    """

    #: A line of letters, with a stop or without; a line of anything else gives two empty groups.
    _lines = re.compile(r"^([a-zà-öø-ÿß]+)([.,]?)$|^.*$", re.MULTILINE)

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        # words of Latin-1 letters, lower-cased, need no normalizing and no pattern: the same vocabulary and merges without them
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: Remembered[bytes, bytes] = Remembered()
        self.stops = {p: self._alone([p])[0] for p in ".,"} | {"": b""}

    def _alone(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words. One of letters alone, a stop behind them or not, is looked up by its letters in lower case."""
        words = [w for w in words if w]
        if not words:
            return {b"": b""}
        parts = self._lines.findall(b"\n".join(words).decode("utf-8", "replace").lower())
        plain = list({stem for stem, _ in parts if stem})
        ids_of: dict[str, bytes] = {}
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        for group, encoded in zip(groups, self.letters.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, "<u4")
            data = ids.tobytes()
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            ids_of.update(zip(group, [data[i:j] for i, j in zip([0, *stops], stops)], strict=True))
        stops_ = self.stops
        found = {b"": b""} | {w: ids_of[stem] + stops_[stop] for w, (stem, stop) in zip(words, parts, strict=True) if stem}
        odd = [w for w, (stem, _) in zip(words, parts, strict=True) if not stem]
        found.update(zip(odd, self._alone([w.decode("utf-8", "replace") for w in odd]), strict=True))
        return found

    def encode(self, texts: pa.Array | list[bytes]) -> list[bytes]:
        """Ids of each text, as by the tokenizer without added special tokens; null is empty. Every distinct word is looked up
        once; the ids of the texts are gathered from those of the words."""
        column = texts.fill_null("") if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).cast(pa.string())
        column = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
        lists = pc.ascii_split_whitespace(column)
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return [b""] * len(texts)
        (values,) = self.known.of([_each(words.dictionary)], self._learn)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        firsts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(values), "<u4")
        word = words.indices.to_numpy()
        n = sizes[word]
        ends = np.concatenate(([0], np.cumsum(n)))
        found = ids[np.arange(ends[-1]) + np.repeat(firsts[word] - ends[:-1], n)]
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        return [found[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


class PieceCounts:
    """Numbers of ids by the byte-level vocabulary.

    A space or line feed between two characters that are not white space always starts a pre-token, so a text may be
    cut before it; longer runs of white space stay with the text around them.
    """

    _odd = re.compile(r"[^\S \n]|\s\s|^\s|\s$")
    _safe = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.starts = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.starts[i] = token[0] in "ĠĊ"
        self.known: Remembered[str, int] = Remembered()

    def pieces(self, text: str) -> list[str]:
        """The text cut before every safe space or line feed; the cut character is kept, as a leading blank or feed."""
        if not text:
            return []
        if self._odd.search(text):
            return self._safe.split(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return [first, *[x if x[0] == "\n" else " " + x for x in rest]]

    def _learn(self, pieces: list[str]) -> dict[str, int]:
        plain, odd = [], []
        for p in pieces:
            (plain if p[0] in " \n" and "<|" not in p and len(p) > 1 and not self._odd.search(p[1:]) and " " not in p[1:] and "\n" not in p[1:] else odd).append(p)
        found = {p: len(e) for p, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True)}
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        encoded_groups = self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, encoded_groups, strict=True):
            ids = np.array(e.ids, np.int64)
            starts = np.flatnonzero(self.starts[ids])
            if len(starts) != len(group):
                for p, one in zip(group, self.tokenizer.encode_batch_fast(group, add_special_tokens=False), strict=True):
                    found[p] = len(one)
                continue
            found.update(zip(group, np.diff(starts, append=len(ids)).tolist(), strict=True))
        return found

    def count(self, texts: list[str]) -> list[int]:
        return [sum(values) for values in self.known.of([self.pieces(t) for t in texts], self._learn)]


def loaded(kind: type, path: str):
    """The one instance of a worker."""
    return kept(kind.__name__, path, lambda: kind(path))
