"""Zip archive entries as a table.

Archives can be tens of GB, far past a 2 GB ``binaryFile`` cell, so nothing
reads an archive whole: a task lists one archive's central directory, the entry
list is spread over tasks, and each task opens the archive and streams only its
own entries. Archives are written entry by entry, many of bounded size per task. A corrupt archive fails as a whole (one error row); a bad entry is
reported on its own row and does not stop the rest.
"""

from __future__ import annotations

import hashlib
import os
import posixpath
import zipfile

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRY_SCHEMA = "archive string, idx long, entry string, is_dir boolean, size long, error string"
READ_SCHEMA = "archive string, entry string, base_name string, n_bytes long, content_md5 string, error string"
ENTRY_BLOCK = 256  # entries per read task group within one archive
ARCHIVE_BYTES = 256 << 20  # content after which a writer starts its next archive
READ_BYTES = 1 << 20  # read at a time from an entry


def _resolve(uri: str):
    """(filesystem, path) for a local path or any URI pyarrow knows (file, hdfs, s3,
    gs), so tasks read and write the same shared folder Spark uses."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


class _Reader:
    """A pyarrow file whose bad seeks raise OSError, as zipfile expects (it probes before the start of short archives)."""

    def __init__(self, file):
        self._file = file

    def __getattr__(self, name):
        return getattr(self._file, name)

    def seek(self, offset, whence=0):
        try:
            return self._file.seek(offset, whence)
        except ValueError as e:
            raise OSError(str(e)) from e


def _open_zip(uri: str) -> zipfile.ZipFile:
    fs, path = _resolve(uri)
    return zipfile.ZipFile(_Reader(fs.open_input_file(path)))  # seekable random-access reader


def write_archives(
    df: DataFrame, root: str, entry_col: str = "entry", content_col: str = "content", max_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write each partition of (entry, content) rows as zips under ``root`` (a fresh shared folder), the next one
    started when the content so far reaches ``max_bytes``; entries go to the shared file as they come. Entries
    ending in '/' become directory entries. Returns the archive paths."""

    def write(batches):
        fs, base = _resolve(root)
        fs.create_dir(base, recursive=True)
        part, count = TaskContext.get().partitionId(), 0
        rows = ((e, c) for pdf in batches for e, c in zip(pdf[entry_col], pdf[content_col]))
        row = next(rows, None)
        while row:
            # named by partition and number, so a retried task attempt overwrites its own archives
            name = f"archive-{part:05d}-{count:05d}.zip"
            n = size = 0
            with fs.open_output_stream(posixpath.join(base, name)) as out, zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED) as z:
                while row and (not n or size < max_bytes):
                    e, data = row[0], b"" if row[0].endswith("/") else (row[1] or "").encode("utf-8")
                    z.writestr(zipfile.ZipInfo(e) if e.endswith("/") else e, data)
                    n, size = n + 1, size + len(data)
                    row = next(rows, None)
            count += 1
            yield pd.DataFrame({"archive": [root.rstrip("/") + "/" + name], "n_entries": [n]})

    return df.select(entry_col, content_col).mapInPandas(write, "archive string, n_entries long")


def list_entries(archives: DataFrame, path_col: str = "archive", strict: bool = False) -> DataFrame:
    """One row per central-directory entry; a corrupt archive yields a single
    error row (the archive fails as a whole), or ends the query if ``strict``."""

    def listing(batches):
        for pdf in batches:
            rows = []
            for a in pdf[path_col]:
                try:
                    with _open_zip(a) as z:
                        for i, info in enumerate(z.infolist()):
                            rows.append((a, i, info.filename, info.is_dir(), info.file_size, None))
                except (zipfile.BadZipFile, OSError, ValueError) as e:  # pyarrow raises ValueError on bad seeks
                    if strict:
                        raise ValueError(f"Corrupt zip file: {a}: {e}") from e
                    rows.append((a, -1, None, None, None, f"Corrupt zip file: {e}"))
            yield pd.DataFrame(rows, columns=["archive", "idx", "entry", "is_dir", "size", "error"])

    return archives.select(path_col).mapInPandas(listing, ENTRY_SCHEMA)


def read_entries(entries: DataFrame, strict: bool = False) -> DataFrame:
    """Read file entries (directories skipped), spread over tasks by
    (archive, block of entries); per-entry failures become error rows, or end
    the query if ``strict``."""
    files = entries.where(F.col("error").isNull() & ~F.col("is_dir"))
    spread = files.repartition("archive", (F.col("idx") / ENTRY_BLOCK).cast("long")).sortWithinPartitions("archive", "idx")

    def read(batches):
        for pdf in batches:
            out = []
            for a, g in pdf.groupby("archive", sort=False):
                try:
                    z = _open_zip(a)
                except (zipfile.BadZipFile, OSError, ValueError) as e:  # pyarrow raises ValueError on bad seeks
                    if strict:
                        raise ValueError(f"Corrupt zip file: {a}: {e}") from e
                    out += [(a, n, os.path.basename(n), None, None, f"Corrupt zip file: {e}") for n in g["entry"]]
                    continue
                with z:
                    infos = z.infolist()
                    for i, n in zip(g["idx"], g["entry"]):
                        try:
                            size, digest = 0, hashlib.md5()
                            with z.open(infos[int(i)]) as f:
                                while data := f.read(READ_BYTES):
                                    size += len(data)
                                    digest.update(data)
                            out.append((a, n, os.path.basename(n), size, digest.hexdigest(), None))
                        except Exception as e:  # noqa: BLE001 - a bad entry is logged, not fatal
                            if strict:
                                raise ValueError(f"Failed to extract {n}: {a}: {e}") from e
                            out.append((a, n, os.path.basename(n), None, None, f"Failed to extract {n}: {e}"))
            yield pd.DataFrame(out, columns=["archive", "entry", "base_name", "n_bytes", "content_md5", "error"])

    return spread.select("archive", "idx", "entry").mapInPandas(read, READ_SCHEMA)
