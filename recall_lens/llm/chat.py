"""Conversations rendered by a template, as token ids with an exact loss mask.

A turn becomes `<|im_start|>role<|im_sep|>text<|im_end|>`. The three marks are special tokens of their own, so no token
reaches from a mark into a text. Inside roles and texts a backslash is put after every `<` that would open a control
string, behind which any backslashes may stand; taking one away gives the original back.

A conversation is rendered whole and encoded once. The vocabulary's tokens are strings of bytes that together are the
text, so their lengths give the offsets of all tokens, in bytes. Which tokens count for the loss comes from a binary search
of their offsets in the sorted spans of the assistant's texts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import AddedToken, Tokenizer  # noqa: E402

from recall_lens.llm.staging import Staging, small_batches  # noqa: E402
from recall_lens.llm.text import batch  # noqa: E402
from recall_lens.llm.vocabulary import loaded, tokenizer_path  # noqa: E402

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Characters and turns of a part; only a conversation beyond them comes in several.
PART_CHARS = 1 << 20
PART_TURNS = 4096
#: Characters encoded together.
GROUP_CHARS = 1 << 21
ORDER = ("turn", "role", "text")

_FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))]
)
_FORMATTED_SPARK = "conv_id long, part long, whole boolean, n_turns long, text string, ids array<int>, loss array<boolean>"
_READ = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.string()), ("loss_text", pa.string()), ("formatted_chars", pa.int64())]
)
_READ_SPARK = "conv_id long, part long, n_turns long, turns string, loss_text string, formatted_chars long"
_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
_DIGEST_SPARK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    return _OPENS.sub(r"<\\\1|", text) if "|" in text else text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for themselves, the
    characters from 256 on for the other bytes in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ChatTokenizer:
    """A byte-level vocabulary with the template's marks added after its last id."""

    _safe = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (START, SEP, END)])
        byte = _byte_of_character()
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(map(byte.__getitem__, token))
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            self.bytes[i] = added.content.encode()
        self.lengths = np.array([len(b) for b in self.bytes])

    def cut(self, text: str) -> list[str]:
        """The text in parts of about GROUP_CHARS, cut before single spaces, where a token starts in any case."""
        out, start = [], 0
        while len(text) - start > GROUP_CHARS and (found := self._safe.search(text, start + GROUP_CHARS)):
            out.append(text[start : found.start()])
            start = found.start()
        return [*out, text[start:]]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        parts = [self.cut(t) for t in texts]
        found = iter(self.tokenizer.encode_batch_fast([p for of_text in parts for p in of_text], add_special_tokens=False))
        for of_text in parts:
            yield np.concatenate([np.array(next(found).ids, np.int32) for _ in of_text])

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """For each token the places of its first byte and of the one after its last."""
        ends = np.cumsum(self.lengths[ids])
        return np.stack((ends - self.lengths[ids], ends), 1)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def under(spans: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the spans (rows of start and end, sorted, apart from each other)."""
    if not len(spans):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 0], "right") - 1
    return (at >= 0) & (offsets[:, 1] <= spans[np.maximum(at, 0), 1])


def _size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


@dataclass
class _Part:
    """Turns of one conversation, rendered."""

    conv_id: int | None
    whole: bool
    number: int
    pieces: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    chars: int = 0
    bytes: int = 0
    turns: int = 0

    def add(self, role: str | None, text: str | None, answering: str) -> None:
        head = START + escaped(role or "") + SEP
        body = escaped(text or "")
        self.pieces += (head, body, END)
        start = self.bytes + _size(head)
        end = start + _size(body)
        if role == answering and body:
            self.spans.append((start, end))
        self.bytes = end + len(END)
        self.chars += len(head) + len(body) + len(END)
        self.turns += 1


def _parts(batches: Iterable[pa.RecordBatch], answering: str, part_chars: int, part_turns: int) -> Iterator[_Part]:
    """Parts from rows sorted by conversation, then turn."""
    first, part = TaskContext.get().partitionId() << 32, None
    for rows in batches:
        for conv_id, large, role, text in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "large", "role", "text")), strict=True):
            full = part is not None and large and (part.chars >= part_chars or part.turns >= part_turns)
            if part is None or part.conv_id != conv_id or full:
                if part is not None:
                    yield part
                number = (part.number + 1 if full and part.conv_id == conv_id else first) if large else 0
                part = _Part(conv_id, not large, number)
            part.add(role, text, answering)
    if part is not None:
        yield part


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(values), kind))


def _grouped(parts: Iterable[_Part]) -> Iterator[list[_Part]]:
    group: list[_Part] = []
    chars = 0
    for part in parts:
        if group and chars + part.chars > GROUP_CHARS:
            yield group
            group, chars = [], 0
        group.append(part)
        chars += part.chars
    if group:
        yield group


def format_conversations(
    conversations: DataFrame, answering: str = ASSISTANT, tokenizer: str | None = None, part_chars: int = PART_CHARS, part_turns: int = PART_TURNS
) -> DataFrame:
    """The conversations of `conversations` (conv_id, turn, role, text) as the template's text, token ids and loss mask.

    A row for each conversation: conv_id, part (0), whole (true), n_turns, text, ids and loss (whether a token belongs to
    a text of the role `answering`). A conversation of more than `part_chars` characters or `part_turns` turns comes in
    several rows, with `whole` false and the order of its turns in `part`; no turn is cut or left out.

    Turns are taken by turn, then role, then text, nulls first; repeated rows are turns of their own. Null roles and texts
    are empty. Rows without a conv_id form one conversation, whose conv_id is null. Other columns are not read.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    rows = conversations.select("conv_id", *ORDER)
    size = F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    large = rows.groupBy("conv_id").agg((F.count(F.lit(1)) > part_turns).alias("many"), (size > part_chars).alias("long"))
    large = large.where(F.col("many") | F.col("long")).select(F.col("conv_id").alias("large_id"), F.lit(True).alias("large"))
    marked = rows.join(large, rows.conv_id.eqNullSafe(large.large_id), "left").select("conv_id", *ORDER, F.coalesce("large", F.lit(False)).alias("large"))
    # a conversation stays in one range of rows unless it is large; then its ranges follow each other
    inside = F.when(F.col("large"), F.struct("turn", "role", F.substring("text", 1, 64).alias("text")))
    dealt = marked.withColumn("inside", inside).repartitionByRange("conv_id", "inside").sortWithinPartitions("conv_id", *ORDER)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat: ChatTokenizer = loaded(ChatTokenizer, path)
        for group in _grouped(_parts(batches, answering, part_chars, part_turns)):
            texts = ["".join(p.pieces) for p in group]
            ids, loss = [], []
            for part, of_text in zip(group, chat.encode(texts), strict=True):
                ids.append(of_text)
                loss.append(under(np.array(part.spans, np.int64).reshape(-1, 2), chat.offsets(of_text)))
            columns = [[p.conv_id for p in group], [p.number for p in group], [p.whole for p in group], [p.turns for p in group]]
            yield batch(_FORMATTED, [*columns, texts, _lists(ids, pa.int32()), _lists(loss, pa.bool_())])

    return dealt.select("conv_id", "large", "role", "text").mapInArrow(write, _FORMATTED_SPARK)


def _masked(offsets: np.ndarray, loss: np.ndarray, data: bytes) -> Iterator[str]:
    """The text of each stretch of tokens under the mask."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], loss.astype(np.int8), [0])))).reshape(-1, 2)
    for first, end in edges.tolist():
        yield data[offsets[first, 0] : offsets[end - 1, 1]].decode()


def read_back(formatted: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """From the ids and the mask alone, for each row of `formatted`: its conv_id, part and n_turns, turns (role, line
    feed, text and line feed of every turn, one after the other), loss_text (what is under the mask) and formatted_chars.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat: ChatTokenizer = loaded(ChatTokenizer, path)
        for rows in batches:
            columns: list[list] = [[], [], [], []]
            for row_ids, row_loss in zip(rows.column(2), rows.column(3), strict=True):
                ids = row_ids.values.to_numpy()
                data = chat.decode(ids)
                text = data.decode()
                turns = [turn.removesuffix(END).split(SEP) for turn in text.split(START)[1:]]
                spoken = _masked(chat.offsets(ids), np.asarray(row_loss.values), data)
                said = "".join(f"{unescaped(role)}\n{unescaped(body)}\n" for role, body in turns)
                for column, value in zip(columns, (len(turns), said, "".join(map(unescaped, spoken)), len(text)), strict=True):
                    column.append(value)
            yield batch(_READ, [rows.column(0), rows.column(1), *columns])

    return formatted.select("conv_id", "part", "ids", "loss").mapInArrow(read, _READ_SPARK)


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their parts in order, which are forgotten as they come."""
    now: list | None = None

    def row() -> pa.RecordBatch:
        return batch(_DIGEST, [[now[0]], [now[1]], [now[2].hexdigest()], [now[3]], [now[4].hexdigest()], [now[5]]])

    for rows in batches:
        for conv_id, n_turns, turns, loss, chars in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "n_turns", "turns", "loss_text", "formatted_chars")), strict=True):
            if now is None or now[0] != conv_id:
                if now is not None:
                    yield row()
                now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            now[1] += n_turns
            now[2].update(turns.encode())
            now[3] += len(loss)
            now[4].update(loss.encode())
            now[5] += chars
    if now is not None:
        yield row()


def _sha256(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def digests(conversations: DataFrame, **options: int) -> DataFrame:
    """What the formatted conversations hold, read back from their ids and masks: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars of every conversation. Parts of a large one are hashed as they stream through a task. `options` are those
    of format_conversations.
    """
    staging = Staging(conversations.sparkSession, "chat")
    formatted = staging.table(format_conversations(conversations, **options), "formatted")
    whole = read_back(formatted.where("whole")).select(
        "conv_id", "n_turns", _sha256("turns").alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), _sha256("loss_text").alias("loss_sha256"), "formatted_chars"
    )
    ordered = read_back(formatted.where("NOT whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(ordered.select("conv_id", "n_turns", "turns", "loss_text", "formatted_chars").mapInArrow(_hashed, _DIGEST_SPARK))
