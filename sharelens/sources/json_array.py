"""Records of JSON arrays in any layout, split over tasks.

A file is cut at every ``}``, whether it ends a record or not, so tasks read byte ranges
side by side.  What a cut means depends on the text before it: whether it lies in a
string, and how many braces are open.  The effect of a byte range on both is worked out
for either start (in a string or not) and the effects are composed file by file, one row
a range; then every range is read again with its true start.  Records that reach over
the end of a range are put together from their pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RECORD_BYTES = 256 << 20
NO_FLOOR = -(1 << 40)
BYTE_ORDER_MARK = 3

_ESCAPE = re.compile(rb"\\[^\n]")
_BETWEEN = re.compile(rb"[\s,\[\]]+")

EFFECT_SCHEMA = (
    "file string, block long, size long, bytes long, cuts long, "
    "in_0 boolean, sum_0 long, floor_0 long, in_1 boolean, sum_1 long, floor_1 long"
)
START_SCHEMA = "file string, block long, inside boolean, depth long, last boolean, closed boolean"
PIECE_SCHEMA = "file string, block long, nth long, kind string, text string"


def walk(chunk: bytes, inside: bool) -> tuple[bool, int, int]:
    """In a string at the end?  Braces opened; where the first of them is, or -1.

    ``chunk`` holds no closing brace.  A raw line end can't be in a string, so a quote
    that is missing spoils its own line only.
    """
    plain = _ESCAPE.sub(b"__", chunk) if b"\\" in chunk else chunk
    opened, first, at = 0, -1, 0
    for number, line in enumerate(plain.split(b"\n")):
        quoted = inside and number == 0
        for part in line.split(b'"'):
            n = 0 if quoted else part.count(b"{")
            if n and first < 0:
                first = at + part.index(b"{")
            opened += n
            at += len(part) + 1
            quoted = not quoted
    return not quoted, opened, first


class Effect:
    """What chunks do to (in a string, open braces) from one start: depth d becomes max(d + sum, floor)."""

    def __init__(self, inside: bool):
        self.inside, self.sum, self.floor = inside, 0, NO_FLOOR

    def add(self, chunk: bytes) -> None:
        self.inside, opened, _ = walk(chunk, self.inside)
        self.sum += opened
        self.floor += opened
        if not self.inside:  # the cut is a closing brace; one too many closes nothing
            self.sum -= 1
            self.floor = max(self.floor - 1, 0)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("value"),
    )


def _effects(chunks: DataFrame) -> DataFrame:
    """One row per byte range."""

    def run(batches):
        ranges: dict = {}
        for batch in batches:
            for file, block, size, value in zip(*(batch.column(i).to_pylist() for i in range(4))):
                key = (file, block)
                if key not in ranges:
                    ranges[key] = [size, 0, 0, Effect(False), Effect(True)]
                row = ranges[key]
                row[1] += len(value)
                row[2] += 1
                row[3].add(value)
                row[4].add(value)
        rows = [
            (*key, size, n, cuts, a.inside, a.sum, a.floor, b.inside, b.sum, b.floor)
            for key, (size, n, cuts, a, b) in ranges.items()
        ]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=_names(EFFECT_SCHEMA)), schema=_arrow(EFFECT_SCHEMA))

    return chunks.mapInArrow(run, EFFECT_SCHEMA)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def _starts(effects: DataFrame) -> DataFrame:
    """The true start of every byte range; a file has few ranges, whatever its size."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        # All bytes read and one a cut: the file ends with a closing brace.  A byte order
        # mark is not read.
        excess = int(rows["bytes"].sum() + rows["cuts"].sum() - rows["size"].iloc[0])
        closed = excess in (0, -BYTE_ORDER_MARK)
        inside, depth, found = False, 0, []
        for row in rows.itertuples():
            found.append((row.file, row.block, inside, depth, False, closed))
            start = int(inside)
            total, floor = getattr(row, f"sum_{start}"), getattr(row, f"floor_{start}")
            inside, depth = getattr(row, f"in_{start}"), max(depth + total, floor)
        found[-1] = (*found[-1][:4], True, closed)
        return pd.DataFrame(found, columns=_names(START_SCHEMA))

    return effects.groupBy("file").applyInPandas(run, START_SCHEMA)


class _Range:
    """Reads one byte range from its true start and gives its pieces."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth = inside, depth
        self.begun = depth > 0 or inside  # the record at the start began in an earlier range
        self.parts: list[bytes] = []
        self.held = 0

    def add(self, chunk: bytes, cut: bool) -> Iterator[tuple[str, bytes]]:
        """Pieces that end with ``chunk``; ``cut`` tells whether a closing brace follows it."""
        if self.depth == 0 and not self.begun:
            self.inside, opened, first = walk(chunk, False)
            between = chunk if first < 0 else chunk[:first]
            if _BETWEEN.sub(b"", between).removeprefix(b"\xef\xbb\xbf"):
                yield "bad", between.strip(b" \t\r\n,[]")
            if first < 0:
                if cut and not self.inside:
                    yield "bad", b"}"
                # A text outside of any record can't go on after a cut.
                self.inside = False
                return
            chunk = chunk[first:]
        else:
            self.inside, opened, _ = walk(chunk, self.inside)
        self.depth += opened
        self.parts.append(chunk)
        if cut:
            self.parts.append(b"}")
        self.held += len(chunk) + 1
        if self.held > MAX_RECORD_BYTES:
            raise ValueError(f"a record is over {MAX_RECORD_BYTES} bytes: {b''.join(self.parts)[:100]!r}")
        if cut and not self.inside:
            self.depth -= 1
            if self.depth <= 0:
                yield from self.end("tail" if self.begun else "record")
                self.begun, self.depth = False, 0

    def end(self, kind: str) -> Iterator[tuple[str, bytes]]:
        text, self.parts, self.held = b"".join(self.parts), [], 0
        yield kind, text

    def stop(self, last: bool) -> Iterator[tuple[str, bytes]]:
        """What is left at the end of the range; at the end of the file it is cut off."""
        if self.parts or self.begun:
            if self.begun:
                yield from self.end("cut tail" if last else "middle")
            else:
                yield from self.end("bad" if last else "head")


def _pieces(chunks: DataFrame, starts: DataFrame) -> DataFrame:
    """Records and parts of records, range by range, in file order."""
    # One slim row a byte range: a million for 100 TB in ranges of the usual size.
    known = F.broadcast(starts.withColumnRenamed("file", "_f").withColumnRenamed("block", "_b"))
    rows = chunks.join(known, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")), "left")
    moved = F.raise_error(F.lit("the files or their split changed while they were read"))
    rows = rows.select(
        "file", "block", "value", F.coalesce("inside", moved.cast("boolean")).alias("inside"), "depth", "last", "closed"
    )

    def run(batches):
        key, reader, ends, before, nth = None, None, None, None, 0

        def finish():
            last, closed = ends
            if before is not None:
                yield from reader.add(before, cut=not last or closed)
            yield from reader.stop(last)

        for batch in batches:
            out = []

            def put(pieces):
                nonlocal nth
                for kind, text in pieces:
                    out.append((*key, nth, kind, text.decode("utf-8", "replace")))
                    nth += 1

            for file, block, value, inside, depth, last, closed in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (file, block) != key:
                    if key:
                        put(finish())
                    key, reader, ends, before, nth = (file, block), _Range(inside, depth), (last, closed), None, 0
                if before is not None:
                    put(reader.add(before, cut=True))
                before = value
            yield _batch(out)
        if key:
            yield _batch([(*key, nth + i, kind, text.decode("utf-8", "replace")) for i, (kind, text) in enumerate(finish())])

    return rows.mapInArrow(run, PIECE_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = _arrow(PIECE_SCHEMA)
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that reach over ranges, from their pieces: at most two a range."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found, parts, place = [], [], None
        for row in rows.sort_values(["block", "nth"]).itertuples():
            if place is None:
                place = (row.block, row.nth)
            parts.append(row.text)
            if row.kind in ("tail", "cut tail"):
                found.append((row.file, *place, "record" if row.kind == "tail" else "bad", "".join(parts)))
                parts, place = [], None
        if parts:
            found.append((rows["file"].iloc[0], *place, "bad", "".join(parts)))
        return pd.DataFrame(found, columns=_names(PIECE_SCHEMA))

    return pieces.groupBy("file").applyInPandas(run, PIECE_SCHEMA)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, nth, kind, text``: every object that is not inside another one.

    ``kind`` is ``record``, or ``bad`` for what stands between records and is no object, and
    for an object that the file's end cuts off.  ``block`` and ``nth`` give the order in the
    file.  One line, a line a record, pretty printing, several arrays, or no array at all:
    the layout makes no difference.  A record must fit a task; one of over
    ``MAX_RECORD_BYTES`` is an error, as an object that is never closed would be.
    """
    chunks = _chunks(spark, path)
    pieces = _pieces(chunks, _starts(_effects(chunks)))
    whole = pieces.where(F.col("kind").isin("record", "bad"))
    return whole.unionByName(_joined(pieces.where(~F.col("kind").isin("record", "bad"))))
