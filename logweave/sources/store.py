"""Objects of any name, listed and read by tasks.

Spark's scans leave out names that begin with ``_`` or ``.`` and hand over a container
only as a whole. What needs more goes through here: a task opens the store itself and
lists folders, or reads byte ranges.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemes that differ from the library's name for the same store.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
_stores: dict[str, fs.FileSystem] = {}

OBJECTS = "path string, length bigint, modificationTime timestamp"
_FOUND = OBJECTS + ", folder boolean"
_ROWS = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", tz="UTC")), ("folder", pa.bool_())])
_BATCH = 10_000

# Names that belong to writers of tables, not to evidence.
OWN_NAMES = ("_SUCCESS", "_READY", "_temporary", "_spark_metadata")


def _parts(uri: str) -> tuple[str, str]:
    """What names the store, and the path in it."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*|\Z)", uri)
    if not found:
        return "file:///", uri
    scheme, host, path = found[1].lower(), found[2] or "", found[3] or "/"
    if scheme == "file":
        return "file:///", path
    scheme = _SCHEMES.get(scheme, scheme)
    if scheme in ("hdfs", "viewfs"):
        return f"{scheme}://{host}/", path
    # Object stores: the container's name is the first part of the path.
    return f"{scheme}://{host}/", f"{host.split('@')[0]}{path}".rstrip("/")


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of an object, and the object's path in it."""
    store, path = _parts(uri)
    if store not in _stores:
        _stores[store] = fs.LocalFileSystem() if store == "file:///" else fs.FileSystem.from_uri(store)[0]
    return _stores[store], path


class _Raw(io.RawIOBase):
    """A file of a store with the errors that Python's readers expect."""

    def __init__(self, file: pa.NativeFile) -> None:
        self._file, self._size = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        body = self._file.read(len(into))
        into[: len(body)] = body
        return len(body)

    def seek(self, offset: int, whence: int = 0) -> int:
        to = offset + (0, self._file.tell(), self._size)[whence]
        if to < 0:
            raise OSError("before the beginning of the file")
        self._file.seek(to)
        return to

    def close(self) -> None:
        self._file.close()
        super().close()


def open_file(uri: str, buffer: int = 1 << 16) -> BinaryIO:
    """An object to be read at any place; only what is read is fetched."""
    store, path = open_store(uri)
    return io.BufferedReader(_Raw(store.open_input_file(path)), buffer)


def reachable(uri: str) -> bool:
    """Whether this process can open the store of an object; executors are set up as the driver is."""
    try:
        open_store(uri)
    except (OSError, pa.ArrowException):
        return False
    return True


def _outside(uri: str, path: str) -> str:
    """The URI of a path in the store of ``uri``, written as Spark writes it."""
    store, _ = _parts(uri)
    if store == "file:///":
        return f"file:{path}"
    if store.startswith(("hdfs", "viewfs")):
        return store.rstrip("/") + path
    return f"{uri.split(':', 1)[0]}://{urlsplit(uri).netloc}/{path.split('/', 1)[-1]}"


def entries(uri: str, deep: bool) -> Iterator[tuple]:
    """(path, length, time, is a folder) of what is in a folder, or of the object itself."""
    store, path = open_store(uri)
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        return
    below = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=deep))
    for x in below:
        if x.is_file or not deep:
            yield _outside(uri, x.path), x.size or 0, x.mtime, not x.is_file


def _listed(deep: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                rows.extend(entries(row["path"], deep) if row["folder"] else [tuple(row.values())])
                while len(rows) >= _BATCH:
                    yield _batch(rows[:_BATCH])
                    del rows[:_BATCH]
        if rows:
            yield _batch(rows)

    return work


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def list_objects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, length, modificationTime`` of all objects below ``paths``, whatever their names.

    One level is listed by one task for each of the paths, the folders in it by many.
    """
    roots = [(p.rstrip("/") or "/", 0, None, True) for p in ([paths] if isinstance(paths, str) else paths)]
    start = spark.createDataFrame(roots, _FOUND)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if len(roots) > 1:
        start = start.repartition(min(n, len(roots)), "path")
    top = start.coalesce(1) if len(roots) == 1 else start
    found = top.mapInArrow(_listed(False), _FOUND).repartition(n, "path").mapInArrow(_listed(True), _FOUND)
    return found.select("path", "length", "modificationTime")


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, r"\A[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


def is_own(path: Column) -> Column:
    """Whether an object, or a folder above it, is named as writers of tables name what they need for themselves.

    That includes ``.<name>.crc``, the checksums that Spark's writers leave in local folders.
    """
    inside = F.concat(F.lit("/"), path, F.lit("/"))
    found = F.lit(False)
    for name in OWN_NAMES:
        found = found | F.contains(inside, F.lit(f"/{name}/"))
    return found | path.rlike(r"(?:\A|/)\.[^/]*\.crc\z")


def is_hidden(path: Column, roots: str | Sequence[str]) -> Column:
    """Whether Spark's scans of ``roots`` leave an object out for a name below them; see ``is_own`` for those that count as no evidence."""
    below = path
    for root in [roots] if isinstance(roots, str) else roots:
        base = re.sub(r"\A[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root.rstrip("/"))
        plain = _plain(path)
        # An object named as a root of its own is looked at by its own name.
        cut = F.when(plain == base, F.substr(plain, F.lit(len(base.rsplit("/", 1)[0]) + 1))).when(
            plain.startswith(base + "/"), F.substr(plain, F.lit(len(base) + 1)))
        below = F.coalesce(cut, below)
    # A name with "=" is a partition's folder, which scans do read.
    return below.rlike(r"/(?:\.|_[^/=]*(?:/|\z))") & ~is_own(below)
