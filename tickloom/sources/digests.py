"""Digests of whole files, read in pieces.

``binaryFile`` holds a file in one value, and fails above 2 GB; here a task reads its files
one after the other in pieces of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame

#: Bytes that a task holds at most.
PIECE = 8 << 20


def _open(path: str):
    """A file for reading, in a folder that executors see or on any file system pyarrow knows."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return open(unquote(url.path), "rb")  # noqa: SIM115
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner)


def digest_of(path: str, algorithm: str = "md5", piece: int = PIECE) -> tuple[int, str]:
    """Length and hex digest of a file, in pieces."""
    made, length = hashlib.new(algorithm), 0
    with _open(path) as f:
        while part := f.read(piece):
            made.update(part)
            length += len(part)
    return length, made.hexdigest()


def file_digests(files: DataFrame, algorithm: str = "md5", piece: int = PIECE, parts: int | None = None) -> DataFrame:
    """(path, length, digest) of the files in the column ``path``, which may be any number (see ``lake.file_list``).

    Paths are dealt by hash over ``parts`` tasks, by default the session's shuffle partitions.
    A null path gives no row, a path listed twice one row; a file that is gone is an error.
    """
    hashlib.new(algorithm)  # an unknown one fails before any task

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                length, digest = digest_of(path, algorithm, piece)
                yield pd.DataFrame({"path": [path], "length": [length], "digest": [digest]})

    paths = files.where("path is not null").select("path").distinct()
    return (paths.repartition(parts, "path") if parts else paths).mapInPandas(run, "path string, length bigint, digest string")


def changed(files: DataFrame, known: DataFrame, algorithm: str = "md5") -> DataFrame:
    """Files to send again: those whose path and digest are not among the (path, digest) of ``known``."""
    return file_digests(files, algorithm).join(known.select("path", "digest"), ["path", "digest"], "left_anti")
