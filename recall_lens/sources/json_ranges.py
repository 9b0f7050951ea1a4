"""One large JSON document, cut into the members of its `results` array by many tasks.

Spark reads the document as text that ends lines at `}`, so its ranges of bytes are split among tasks like those of any text
file. Whether a range begins inside a string, and how deep, is not known from the range alone. So each range is scanned
for both beginnings, and what it does is noted: whether it ends inside a string, how many open brackets of earlier ranges
it closes, and which brackets it leaves open. Such notes combine associatively, and those of one document, a short row for
each range, give the state at the beginning of each. In a second scan every range cuts its members by itself; only those
that reach into another range are put together from their pieces.

Nothing but pieces is shuffled. The document is read once for the notes, and in the second scan once for whole members and
once for pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A string (with its end, if it has one) or a bracket.
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*("?)|[\[\]{}]', re.DOTALL)
_STRING_END = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*("?)', re.DOTALL)
_COLON = re.compile(rb"\s*:\s*\Z")

#: The array of members under the key of the document, any other array, an object.
MEMBERS, ARRAY, OBJECT = "R", "[", "{"
_INSIDE = OBJECT + MEMBERS

_NOTE = pa.schema([("path", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("ends_inside", pa.bool_()), ("closes", pa.int64()), ("opens", pa.string())])
_NOTE_SPARK = "path string, block long, inside boolean, ends_inside boolean, closes long, opens string"
_STATE = pa.schema([("path", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("open", pa.string()), ("origin", pa.int64())])
_STATE_SPARK = "path string, block long, inside boolean, open string, origin long"
_MEMBER = pa.schema([("path", pa.string()), ("origin", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("value", pa.string())])
_MEMBER_SPARK = "path string, origin long, block long, whole boolean, value string"


def _brackets(line: bytes, inside: bool, key: bytes) -> Iterator[tuple[int, str]]:
    """(offset, kind) of the brackets outside strings; closing ones have kind `]`. The last item is (-1, whether the line
    ends inside a string, as `"` or empty)."""
    at = 0
    if inside:
        end = _STRING_END.match(line)
        if not end[1]:
            yield -1, '"'
            return
        at = end.end()
    last, open_string = b"", False
    before = at
    for token in _TOKEN.finditer(line, at):
        text = token[0]
        if text[:1] == b'"':
            last, before, open_string = text, token.end(), not token[1]
        elif text == b"[":
            yield token.start(), MEMBERS if last == key and _COLON.match(line, before, token.start()) else ARRAY
        else:
            yield token.start(), OBJECT if text == b"{" else "]"
    yield -1, '"' if open_string else ""


class _Note:
    """What a range does, for one beginning."""

    def __init__(self, inside: bool) -> None:
        self.began_inside = self.inside = inside
        self.closes = 0
        self.opens: list[str] = []

    def add(self, line: bytes, key: bytes) -> None:
        for at, kind in _brackets(line, self.inside, key):
            if at < 0:
                self.inside = bool(kind)
            elif kind != "]":
                self.opens.append(kind)
            elif self.opens:
                self.opens.pop()
            else:
                self.closes += 1


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
    """Consecutive lines of one range, with the other columns of the first of them."""
    for rows in batches:
        lines = rows.column("value").to_pylist()
        rest = rows.drop_columns(["value"])
        ends = {len(lines)}
        for column in ("path", "block"):
            ends.update(pc.run_end_encode(rows.column(column)).run_ends.to_pylist())
        start = 0
        for end in sorted(ends):
            if end > start:
                yield rest.slice(start, 1).to_pylist()[0], [line + b"}" for line in lines[start:end]]
            start = end


def _notes(key: bytes):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, notes = None, ()

        def rows() -> pa.RecordBatch:
            columns = zip(*[(*place, n.began_inside, n.inside, n.closes, "".join(n.opens)) for n in notes], strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NOTE, strict=True)], schema=_NOTE)

        for row, lines in _runs(batches):
            if (row["path"], row["block"]) != place:
                if place is not None:
                    yield rows()
                place, notes = (row["path"], row["block"]), (_Note(False), _Note(True))
            for note in notes:
                for line in lines:
                    note.add(line, key)
        if place is not None:
            yield rows()

    return scan


def _states(notes: pa.Table) -> pa.Table:
    """The state in which each range of a document begins: inside a string or not, the open brackets, and the range in
    which the member that is open began."""
    by_place = {(n["block"], n["inside"]): n for n in notes.to_pylist()}
    inside, stack, origin, rows = False, "", -1, []
    for block in sorted({b for b, _ in by_place}):
        note = by_place[block, inside]
        rows.append((note["path"], block, inside, stack, origin))
        left = len(stack) - note["closes"]
        stack = stack[: max(left, 0)] + note["opens"]
        if left <= len(_INSIDE):
            origin = block
        inside = note["ends_inside"]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _STATE, strict=True)], schema=_STATE)


class _Cutter:
    """Cuts the members of one range, given the state in which it begins."""

    def __init__(self, row: dict) -> None:
        if row["open"] is None:
            raise ValueError(f"{row['path']} was cut into other ranges than in the first scan")
        self.place = row["path"], row["block"]
        self.inside, self.stack, self.origin = row["inside"], list(row["open"]), row["origin"]
        self.pieces: list[bytes] | None = [] if self._in_member() and self.stack[2] == OBJECT else None
        self.whole = False

    def _in_member(self) -> bool:
        return len(self.stack) > 2 and self.stack[0] + self.stack[1] == _INSIDE

    def _row(self, value: bytes) -> tuple:
        return self.place[0], self.origin, self.place[1], self.whole, value.decode("utf-8", "replace")

    def add(self, line: bytes, key: bytes) -> Iterator[tuple]:
        start = 0
        for at, kind in _brackets(line, self.inside, key):
            if at < 0:
                self.inside = bool(kind)
            elif kind == "]":
                if self.stack:
                    self.stack.pop()
                if self.pieces is not None and not self._in_member():
                    self.pieces.append(line[start : at + 1])
                    yield self._row(b"".join(self.pieces))
                    self.pieces = None
            else:
                self.stack.append(kind)
                if len(self.stack) == 3 and kind == OBJECT and self._in_member():
                    self.pieces, start, self.whole, self.origin = [], at, True, self.place[1]
        if self.pieces is not None:
            self.pieces.append(line[start:])

    def rest(self) -> Iterator[tuple]:
        """The piece of a member that ends in a later range."""
        if self.pieces:
            self.whole = False
            yield self._row(b"".join(self.pieces))


#: Members handed on together.
_TOGETHER = 1000


def _members(key: bytes):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter: _Cutter | None = None
        found: list[tuple] = []
        for row, lines in _runs(batches):
            if cutter is None or cutter.place != (row["path"], row["block"]):
                if cutter is not None:
                    found += cutter.rest()
                cutter = _Cutter(row)
            for line in lines:
                found += cutter.add(line, key)
                if len(found) >= _TOGETHER:
                    yield _member_rows(found)
                    found = []
        if cutter is not None:
            found += cutter.rest()
        if found:
            yield _member_rows(found)

    return cut


def _member_rows(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _MEMBER, strict=True)], schema=_MEMBER)


def members(spark: SparkSession, path: str, key: str = "results") -> DataFrame:
    """`value`, the JSON text of every object that is a member of the array under `key` of a document under `path`.

    Members that are not objects are left out, as are documents without such an array; arrays of that name deeper in a
    document are not taken. A file holds one document in UTF-8, on one line or many.
    """
    quoted = f'"{key}"'.encode()
    place = F.col("_metadata")
    lines = spark.read.option("lineSep", "}").text(path)
    lines = lines.select(place["file_path"].alias("path"), place["file_block_start"].alias("block"), F.col("value").cast("binary").alias("value"))
    notes = lines.mapInArrow(_notes(quoted), _NOTE_SPARK)
    # a row for each range that Spark reads, some hundred bytes for the megabytes of a range
    states = F.broadcast(notes.groupBy("path").applyInArrow(_states, _STATE_SPARK))
    known = lines.join(states, ["path", "block"], "left").select("path", "block", "value", "inside", "open", "origin")
    cut = known.mapInArrow(_members(quoted), _MEMBER_SPARK)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("block", "value"))), lambda p: p["value"])
    pieces = cut.where("NOT whole").groupBy("path", "origin").agg(F.array_join(in_order, "").alias("value"))
    return cut.where("whole").select("value").unionByName(pieces.select("value"))
