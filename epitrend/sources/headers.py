"""The header line of every file without reading the data.

A listing of the files (paths only) is dealt to the tasks; each opens its files
through Arrow's file systems, reads block by block and stops after the first
non-blank line. The bytes read so grow with the number of files, not with their
sizes. Stores that Arrow cannot open, and files in codecs it does not know or
whose header is not UTF-8, are left to a pass over the text (``csv_reports``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 10
# File suffixes of the codecs that Hadoop and Arrow share, and of
# those that only Hadoop reads.
_CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
_UNKNOWN = (".deflate", ".lz4", ".snappy", ".lzo", ".xz")
_BOM = "﻿"


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """``file, length, modified`` of all files below ``paths``; no content is
    read. ``file`` is the URI that ``_metadata.file_path`` gives in any scan."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load([paths] if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"))


def is_blank(line: str) -> bool:
    """True for lines that the CSV scan skips: nothing but blanks and a BOM."""
    return not line.replace(_BOM, "").strip(" ")


def first_line(read: Callable[[int], bytes]) -> tuple[str | None, int, bool]:
    """``(line, bytes read, readable)`` of a stream: its first non-blank line
    (None without one), ended by LF, CRLF, CR or the end of the stream.
    ``readable`` is False if that line is not UTF-8."""
    rest, total = b"", 0
    while True:
        block = read(max(BLOCK_BYTES, len(rest)))  # a long line is read in doubling steps
        total += len(block)
        rest += block
        # The last piece goes on in the next block.
        *whole, rest = rest.replace(b"\r", b"\n").split(b"\n")
        for raw in whole if block else [*whole, rest]:
            try:
                line = raw.decode()
            except UnicodeDecodeError:
                return None, total, False
            if not is_blank(line):
                return line, total, True
        if not block:
            return None, total, True


def _open(uri: str):
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    codec = next((c for end, c in _CODECS.items() if uri.lower().endswith(end)), None)
    return store.open_input_stream(path, compression=codec)


def openable(uri: str) -> bool:
    """Whether Arrow opens this file from here."""
    try:
        with _open(uri):
            return True
    except Exception:  # noqa: BLE001 - whatever it is, the text pass takes over
        return False


def opened_headers(files: DataFrame) -> DataFrame:
    """``file, header, bytes, readable`` for ``files (file, ...)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for uri in b["file"]:
                if uri.lower().endswith(_UNKNOWN):
                    out.append((uri, None, 0, False))
                    continue
                with _open(uri) as stream:
                    out.append((uri, *first_line(stream.read)))
            yield pd.DataFrame(out, columns=["file", "header", "bytes", "readable"])

    return files.select("file").mapInPandas(run, "file string, header string, bytes long, readable boolean")
