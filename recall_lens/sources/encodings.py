"""The encoding of each file: the first of a list under which all its lines decode.

Files are read as raw lines, split like any text; a line is tested with built-in functions and a file is one row of an
aggregate. UTF-8 is tested as such. A single-byte encoding rules out the bytes that mean nothing in it, and differs from
Latin-1, which Spark reads everywhere, by a table of at most 128 characters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.sinks.files import BYTE_ORDER_MARK

UTF_8, LATIN_1 = "UTF-8", "ISO-8859-1"
#: The order in which files of unknown origin are tried.
USUAL = ("utf-8", "utf-8-sig", "cp1252", "latin1")
_UTF_8 = ("utf8", "utf8sig")


@dataclass(frozen=True)
class SingleByte:
    """How the bytes of an encoding differ from Latin-1."""

    undefined: str
    as_latin_1: str
    meant: str

    def decoded(self, text: Column) -> Column:
        """What text read as Latin-1 says."""
        return F.translate(text, self.as_latin_1, self.meant) if self.as_latin_1 else text

    def decode(self, text: str) -> str:
        return text.translate(str.maketrans(self.as_latin_1, self.meant))

    def encoded(self, text: Column) -> Column:
        """Text that, written as Latin-1, gives this encoding's bytes."""
        return F.translate(text, self.meant, self.as_latin_1) if self.meant else text


@dataclass(frozen=True)
class Layout:
    """Files of one encoding and one header line."""

    encoding: str
    header: bytes
    paths: tuple[str, ...]

    @property
    def read_as(self) -> str:
        return UTF_8 if is_utf_8(self.encoding) else LATIN_1


def is_utf_8(name: str) -> bool:
    return name.lower().replace("-", "").replace("_", "") in _UTF_8


def single_byte(name: str) -> SingleByte:
    """The table of a single-byte encoding that holds ASCII; any other raises ValueError."""
    undefined, changed = [], {}
    for value in range(256):
        try:
            char = bytes([value]).decode(name)
        except UnicodeDecodeError:
            undefined.append(value)
            continue
        if char != chr(value):
            changed[chr(value)] = char
    pairs = [bytes([first, second]) for first in undefined for second in (0x40, 0x80, 0xA1)]
    if any(v < 128 for v in undefined) or any(ord(c) < 128 for c in changed) or any(_decodes(p, name) for p in pairs):
        raise ValueError(f"{name} is neither UTF-8 nor a single-byte encoding that holds ASCII")
    return SingleByte("".join(map(chr, undefined)), "".join(changed), "".join(changed.values()))


def _decodes(data: bytes, name: str) -> bool:
    try:
        data.decode(name)
    except UnicodeDecodeError:
        return False
    return True


def _valid(line: Column, name: str) -> Column:
    if is_utf_8(name):
        return F.is_valid_utf8(line)
    undefined = single_byte(name).undefined
    if not undefined:
        return F.lit(True)
    text = F.decode(line.cast("binary"), LATIN_1)
    return F.length(F.translate(text, undefined, "")) == F.length(text)


def _reachable(encodings: Sequence[str]) -> list[str]:
    """The encodings up to the first that decodes everything; what follows it is never asked."""
    tried: list[str] = []
    for name in encodings:
        tried.append(name)
        if not is_utf_8(name) and not single_byte(name).undefined:
            break
    return tried


def probe(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str] = USUAL) -> DataFrame:
    """path, encoding and first line (bytes) of every file that has a line.

    The encoding is the first of `encodings` under which every line decodes; UTF-8 with replacement characters, where none
    does. Encodings behind one that decodes everything, like Latin-1, need not be known here.
    """
    tried = _reachable(encodings)
    place = F.col("_metadata")
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        place["file_path"].alias("path"), place["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    first = F.min_by(F.col("value").cast("binary"), F.when(F.col("block") == 0, F.col("at")))
    fits = [F.bool_and(_valid(F.col("value"), name)).alias(f"fits_{i}") for i, name in enumerate(tried)]
    files = lines.groupBy("path").agg(first.alias("header"), *fits)
    chosen = F.coalesce(*[F.when(F.col(f"fits_{i}"), F.lit(name)) for i, name in enumerate(tried)], F.lit("utf-8"))
    return files.select("path", chosen.alias("encoding"), "header")


def layouts(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str] = USUAL) -> list[Layout]:
    """The files under `path` by encoding and header line; one row for each pair comes to the driver, with its paths."""
    groups = probe(spark, path, encodings).groupBy("encoding", "header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    found = [Layout(r.encoding, bytes(r.header), tuple(map(unquote, r.paths))) for r in groups.collect()]
    return sorted(found, key=lambda layout: layout.paths)


def decoded(df: DataFrame, layout: Layout) -> DataFrame:
    """Text columns and names of files read as `layout.read_as`, in the layout's own encoding."""
    if is_utf_8(layout.encoding):
        return df.toDF(*[c.removeprefix(BYTE_ORDER_MARK) for c in df.columns])
    table = single_byte(layout.encoding)
    texts = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    return df.select(*[(table.decoded(F.col(f"`{c}`")) if c in texts else F.col(f"`{c}`")).alias(table.decode(c)) for c in df.columns])
