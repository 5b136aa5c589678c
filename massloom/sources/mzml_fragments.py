"""The spectra of mzML files as texts, found by their tags: a data source whose partitions are stretches of a file.

A run of any size is read by many tasks: each takes the spectra that start in
its stretch. One that is broken costs itself and no other, and what is missing
is said: rows with a ``fault`` hold what was found instead.
"""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from massloom.sources.files import list_files, open_file

NAME = "mzml_fragments"
SCHEMA = "path string, start long, fault string, fragment string"
#: Bytes of a file that are read in one go, and that a task takes at most where they come in shorter stretches.
STRETCH = 64 << 20
BLOCK = 1 << 20

OPENS = re.compile(rb"<spectrum(?=[\s>])")
CLOSES = b"</spectrum>"
#: Bytes that the start of a tag may lack at the end of a block.
TAG = len(b"<spectrum ")
#: Bytes at the end of a file that hold its last tag.
TAIL = 1024
NO_END, CUT = "spectrum without end", "file without end"


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    stop: int
    last: bool


@dataclass
class Task(InputPartition):
    """Stretches, one after the other, that one task reads."""

    parts: list[Stretch]


def stretch_fragments(part: Stretch) -> Iterator[tuple[str, int, str | None, str]]:
    """The spectra that start in a stretch; they may end behind it."""
    packed = part.path.endswith(".gz")
    with open_file(part.path, seekable=not packed) as raw:
        stream = gzip.GzipFile(fileobj=raw) if packed else raw
        if part.start:
            stream.seek(part.start)
        # Of a packed file that is cut off, all up to the cut is read.
        read = stream.read1 if packed else stream.read
        data, base, ended = b"", part.start, False

        def more() -> bool:
            nonlocal data, ended
            try:
                block = read(BLOCK)
            except (EOFError, OSError, zlib.error):
                block = b""
            data += block
            ended = not block
            return not ended

        tail = b""
        while True:
            found = OPENS.search(data)
            if not found:
                # Nothing starts here but, at most, at the very end.
                keep = min(len(data), TAG)
                tail = (tail + data)[-TAIL:]
                data, base = data[len(data) - keep :], base + len(data) - keep
                if base >= part.stop and not packed or not more():
                    break
                continue
            at = base + found.start()
            if at >= part.stop and not packed:
                break
            data, base = data[found.start() :], at
            scanned = 1
            while True:
                end, following = data.find(CLOSES, scanned), OPENS.search(data, scanned)
                if end >= 0 and (not following or end < following.start()):
                    size, fault = end + len(CLOSES), None
                    break
                if following:
                    size, fault = following.start(), NO_END
                    break
                scanned = max(1, len(data) - 2 * TAG)
                if not more():
                    size, fault = len(data), NO_END
                    break
            yield part.path, at, fault, data[:size].decode("utf-8", "replace")
            tail = data[max(0, size - TAIL) : size]
            data, base = data[size:], base + size
        if part.last:
            if packed:
                while not ended and more():
                    tail, data = (tail + data)[-TAIL:], b""
                tail += data
            else:
                raw.seek(max(0, raw.size() - TAIL))
                tail = raw.read(TAIL)
            if b"</mzML>" not in tail and b"</indexedmzML>" not in tail:
                yield part.path, -1, CUT, ""


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], stretch: int, tasks: int) -> None:
        self.files, self.stretch, self.tasks = files, stretch, tasks

    def partitions(self) -> list[Task]:
        # Starting a task costs more than a short stretch; there are to be enough of them for all cores.
        share = min(STRETCH, sum(length for _, length in self.files) // self.tasks)
        out, held = [], share
        for path, length in self.files:
            size = max(length, 1) if path.endswith(".gz") else self.stretch
            starts = range(0, max(length, 1), size)
            for start in starts:
                part, own = Stretch(path, start, start + size, start == starts[-1]), min(size, max(length, 1) - start)
                if held + own > share:
                    out.append(Task([]))
                    held = 0
                out[-1].parts.append(part)
                held += own
        return out

    def read(self, partition: Task | None) -> Iterator[tuple]:
        for part in partition.parts if partition is not None else ():
            yield from stretch_fragments(part)


class MzmlFragments(DataSource):
    """Option ``files``: JSON list of (path, length); ``stretch``: bytes read in one go; ``tasks``: no fewer, if there are so many stretches."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader([tuple(f) for f in json.loads(self.options["files"])], int(self.options.get("stretch", STRETCH)), int(self.options.get("tasks", 1 << 30)))


def read_fragments(spark: SparkSession, path: str | list[str], stretch: int = STRETCH) -> DataFrame:
    """(path, start, fault, fragment): every spectrum of the files, and what is wrong with the files' text."""
    spark.dataSource.register(MzmlFragments)
    files = [(f["path"], f["length"]) for f in list_files(spark, path).select("path", "length").collect()]
    if not files:
        return spark.createDataFrame([], SCHEMA)
    tasks = 8 * spark.sparkContext.defaultParallelism
    return spark.read.format(NAME).options(files=json.dumps(files), stretch=str(stretch), tasks=str(tasks)).load()
