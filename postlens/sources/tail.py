"""A stream of the lines of files that go on growing, such as a live feed's log.

Spark's file source reads a file once, when it appears; what is appended later is lost. Here the position of a stream is
a byte offset for each file, and a line is read once it has ended.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
#: Bytes that a task reads, but for the end of its last line.
CHUNK = 32 << 20
#: Bytes that are read at a time.
BLOCK = 1 << 20


def ended(path: str, upto: int, start: int = 0) -> int:
    """Offset behind the last line break before ``upto``, or ``start`` where there is none behind it."""
    with open(path, "rb") as file:
        while upto > start:
            at = max(start, upto - BLOCK)
            file.seek(at)
            found = file.read(upto - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            upto = at
    return start


@dataclass
class Piece(InputPartition):
    path: str
    start: int
    end: int
    first: int  # where the batch starts in this file, which is the start of a line


class GrowingLinesReader(DataSourceStreamReader):
    """Files are listed and measured on the driver; the position has an entry for each file of the folder."""

    def __init__(self, options):
        self.folder, self.pattern = options["path"], options.get("pattern", "*")
        self.chunk = int(options.get("chunk", CHUNK))
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = {}
        for entry in os.scandir(self.folder):
            if entry.is_file() and fnmatch.fnmatch(entry.name, self.pattern):
                found[entry.name] = ended(entry.path, entry.stat().st_size, self.known.get(entry.name, 0))
        self.known = {**self.known, **found}  # a file that is gone keeps its place
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for name, upto in sorted(end.items()):
            first = start.get(name, 0)
            for at in range(first, upto, self.chunk):
                pieces.append(Piece(os.path.join(self.folder, name), at, min(at + self.chunk, upto), first))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        """A line belongs to the piece in which it starts."""
        with open(partition.path, "rb") as file:
            place = partition.start
            if place > partition.first:
                file.seek(place - 1)
                place += len(file.readline()) - 1  # the rest of a line that starts before
            file.seek(place)
            name = os.path.basename(partition.path)
            lines, offsets, size = [], [], 0

            def batch():
                return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([name] * len(lines)), pa.array(offsets, pa.int64())], names=["value", "file", "offset"])

            while place < partition.end:
                line = file.readline()
                if not line:
                    raise OSError(f"{partition.path} is shorter than it was")
                lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                offsets.append(place)
                place += len(line)
                size += len(line)
                if size >= BLOCK:
                    yield batch()
                    lines, offsets, size = [], [], 0
            if lines:
                yield batch()


class GrowingLines(DataSource):
    """``spark.readStream.format(FORMAT).option("pattern", "*.json").load(folder)`` after ``register_tail(spark)``: the
    columns value (the line without its end), file and offset. The folder must be mounted on the driver and on all
    executors. Files may grow and appear, and must not be shortened or rewritten."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file string, offset long"

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(self.options)


def register_tail(spark) -> None:
    spark.dataSource.register(GrowingLines)
