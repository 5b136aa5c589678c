"""Opening files inside tasks, for what Spark's own sources cannot say about them."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def open_file(path: str, seekable: bool = False) -> BinaryIO:
    """A file as Spark names it (``file:``, ``hdfs:``, ``s3:`` or a plain path), for reading bytes."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        store, name = fs.LocalFileSystem(), path
    elif scheme == "file":
        store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return store.open_input_file(name) if seekable else store.open_input_stream(name, compression=None)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length) of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "modificationTime", "length")


def _first_line(path: str) -> str | None:
    """The first line with anything in it; reads no further."""
    with open_file(path) as raw:
        stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
        head = b""
        while block := stream.read(1 << 14):
            head += block
            *lines, rest = head.replace(b"\r\n", b"\n").replace(b"\r", b"\n").removeprefix(b"\xef\xbb\xbf").split(b"\n")
            for line in lines:
                if line:
                    return line.decode()
            head = rest
    text = head.removeprefix(b"\xef\xbb\xbf").strip(b"\r\n").decode()
    return text or None


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line) of every file: a task opens its files and stops behind their first lines; null where there is none."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "line": [_first_line(p) for p in batch["path"]]})

    return list_files(spark, path).select("path").mapInPandas(heads, "path string, line string")
