"""Archive scan: zip, tar, tar.gz/tgz and gz containers, nested up to a depth.

No archive is ever held as a whole. The directory at the end of a zip says where its
entries lie; they are dealt to tasks, each of which reads their bytes alone. The other
containers can only be read from front to back and are streamed, one by a task.
"""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import os
import struct
import tarfile
import tempfile
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import is_archive
from .ranges import FRAME, line_batches
from .store import list_objects, open_file, open_store, reachable

# Fixed value: containers may be nested this deep unless a caller says otherwise.
MAX_DEPTH = 5

# Lines of one entry are numbered in blocks of this many, the counterpart of a
# file split.
BLOCK_LINES = 100_000


class ArchiveError(ValueError):
    pass


def walk(
    name: str, stream: BinaryIO, depth: int = 0, max_depth: int = MAX_DEPTH, way: tuple[str, ...] = ()
) -> Iterator[tuple[tuple[str, ...], BinaryIO]]:
    """``(way, stream)`` of every regular file, containers unpacked.

    The way names the nested containers around the file, outermost first, and the
    file itself.
    """
    if depth > max_depth:
        raise ArchiveError(f"archive nesting deeper than {max_depth} levels at {name!r}")
    lower = name.lower()
    if lower.endswith((".tar.gz", ".tgz", ".tar")):
        mode = "r|" if lower.endswith(".tar") else "r|gz"
        with tarfile.open(fileobj=stream, mode=mode) as tar:
            for member in tar:
                if member.isreg():
                    yield from walk(member.name, tar.extractfile(member), depth + 1, max_depth, (*way, member.name))
    elif lower.endswith(".gz"):
        with gzip.GzipFile(fileobj=stream) as plain:
            yield from walk(name[:-3], plain, depth + 1, max_depth, way and (*way[:-1], name[:-3]))
    elif lower.endswith(".zip"):
        if not isinstance(stream, io.BytesIO):
            # A nested zip needs random access, which its container's stream does
            # not give: spool it to the task's own space, gone once it is closed.
            spool = tempfile.TemporaryFile()
            while chunk := stream.read(1 << 20):
                spool.write(chunk)
            spool.seek(0)
            stream = spool
        with zipfile.ZipFile(stream) as archive:
            for info in archive.infolist():
                if not info.is_dir():
                    with archive.open(info) as entry:
                        yield from walk(info.filename, entry, depth + 1, max_depth, (*way, info.filename))
    else:
        yield way or (name,), stream


#: What a damaged container can raise.
_DAMAGE = (ArchiveError, OSError, EOFError, tarfile.TarError, zipfile.BadZipFile,
           RuntimeError, NotImplementedError, ValueError, zlib.error, lzma.LZMAError)


def _named(way: tuple[str, ...], used: set[str]) -> str:
    """An entry goes by its own name; one whose name is taken by its whole way, and if
    that is taken too with a number, so that no two are mixed up."""
    entry, number = way[-1], 1
    while entry in used:
        entry = "!".join(way) + (f"#{number}" if number > 1 else "")
        number += 1
    used.add(entry)
    return entry


def _numbered(where: str, stream: Iterable[bytes]) -> Iterator[tuple]:
    for number, line in enumerate(stream):
        yield where, number // BLOCK_LINES, number, line.removesuffix(b"\n"), None


def _lines(path: str, stream: BinaryIO, max_depth: int) -> Iterator[tuple]:
    """Lines of a container that is read from front to back (a zip: in memory)."""
    where, used = path, set()
    try:
        for way, inner in walk(os.path.basename(path), stream, max_depth=max_depth):
            where = f"{path}!{_named(way, used)}"
            yield from _numbered(where, inner)
    except _DAMAGE as problem:
        yield where, 0, 0, None, f"archive: {problem}"


def _unpack(max_depth: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = ((path.as_py(), content.as_py()) for batch in batches for path, content in zip(batch.column("path"), batch.column("content")))
        yield from line_batches(row for path, content in files for row in _lines(path, io.BytesIO(content), max_depth))

    return work


# --- entries of a zip in several tasks ---

#: Packed bytes of entries that one task reads in a row.
CHUNK_BYTES = 64 << 20
_ENTRY = "path string, chunk bigint, name string, at bigint, packed bigint, size bigint, crc bigint, method int, locked boolean, used array<string>"
_ENTRY_ROWS = pa.schema([
    ("path", pa.string()), ("chunk", pa.int64()), ("name", pa.string()), ("at", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()),
    ("crc", pa.int64()), ("method", pa.int32()), ("locked", pa.bool_()), ("used", pa.list_(pa.string()))])


def _holds_others(name: str) -> bool:
    return name.lower().endswith((".zip", ".tar", ".gz", ".tgz"))


def _entries(path: str) -> Iterator[tuple]:
    """A row for each entry of a zip, from its directory alone; for another container one row without a name."""
    if not path.lower().endswith(".zip"):
        yield path, 0, None, 0, 0, 0, 0, 0, False, None
        return
    try:
        with open_file(path) as raw, zipfile.ZipFile(raw) as archive:
            infos = [x for x in archive.infolist() if not x.is_dir()]
    except (*_DAMAGE, pa.ArrowException) as problem:
        yield path, 0, f"archive: {problem}", -1, 0, 0, 0, 0, False, None
        return
    used: set[str] = set()
    plain = [(x, _named((x.filename,), used)) for x in infos if not _holds_others(x.filename)]
    # Names inside nested containers give way to those of entries, so these are read by one task.
    # The list of names travels with the first of them.
    nested = [x for x in infos if _holds_others(x.filename)]
    rows = [(x, name, None) for x, name in plain] + [(x, x.filename, [] if i else sorted(used)) for i, x in enumerate(nested)]
    chunk = size = 0
    for x, name, known in rows:
        if known is not None:
            own = -1
        else:
            own = chunk
            size += x.compress_size
            if size >= CHUNK_BYTES:
                chunk, size = chunk + 1, 0
        yield path, own, name, x.header_offset, x.compress_size, x.file_size, x.CRC, x.compress_type, bool(x.flag_bits & 1), known


class _Entry(io.RawIOBase):
    """One entry of a zip as a stream, read from its byte range and checked at its end."""

    def __init__(self, raw: BinaryIO, row: dict) -> None:
        self._raw, self._left, self._crc, self._want, self._size = raw, row["packed"], 0, row["crc"], row["size"]
        raw.seek(row["at"])
        head = raw.read(30)
        if row["locked"]:
            raise ArchiveError("the entry is encrypted")
        if len(head) < 30 or head[:4] != b"PK\x03\x04":
            raise ArchiveError("no entry where the directory says")
        name, extra = struct.unpack("<HH", head[26:30])
        raw.seek(row["at"] + 30 + name + extra)
        unpackers = {zipfile.ZIP_STORED: lambda: None, zipfile.ZIP_DEFLATED: lambda: zlib.decompressobj(-15), zipfile.ZIP_BZIP2: bz2.BZ2Decompressor, zipfile.ZIP_LZMA: lambda: _lzma(self)}
        if row["method"] not in unpackers:
            raise ArchiveError(f"packed by an unknown method ({row['method']})")
        self._unpacker = unpackers[row["method"]]()
        self._held, self._done = b"", 0

    def readable(self) -> bool:
        return True

    def packed(self, most: int) -> bytes:
        body = self._raw.read(min(most, self._left))
        self._left -= len(body)
        return body

    def readinto(self, into) -> int:
        while not self._held:
            body = self.packed(1 << 16)   # may unpack to a thousand times as much
            if not body:
                if self._unpacker is not None and hasattr(self._unpacker, "flush"):
                    self._held = self._unpacker.flush()
                    self._unpacker = None
                if not self._held:
                    if self._crc != self._want or self._done != self._size:
                        raise ArchiveError("the entry is damaged")
                    return 0
            elif self._unpacker is None:
                self._held = body
            else:
                self._held = self._unpacker.decompress(body)
        n = min(len(into), len(self._held))
        into[:n] = self._held[:n]
        self._crc = zlib.crc32(self._held[:n], self._crc)
        self._held, self._done = self._held[n:], self._done + n
        return n


def _lzma(entry: _Entry) -> lzma.LZMADecompressor:
    """A zip's own head comes before the packed bytes: version, length of the filter's properties, these."""
    size = struct.unpack("<HH", entry.packed(4))[1]
    props = entry.packed(size)
    return lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[lzma._decode_filter_properties(lzma.FILTER_LZMA1, props)])


def _entry_lines(rows: Iterable[dict], max_depth: int) -> Iterator[tuple]:
    """Lines of the entries; the store is opened once for all entries of an archive that follow each other."""
    opened: tuple[str, BinaryIO] | None = None
    used: set[str] = set()
    for row in rows:
        path, name = row["path"], row["name"]
        where = path
        if row["at"] < 0:   # the directory itself is damaged
            yield path, 0, 0, None, name
            continue
        try:
            if name is None:
                store, at = open_store(path)
                # Compression is undone by the walk, never by the store for the sake of a name.
                with store.open_input_stream(at, compression=None) as stream:
                    yield from _lines(path, stream, max_depth)
                continue
            if opened is None or opened[0] != path:
                if opened is not None:
                    opened[1].close()
                opened, used = (path, open_file(path)), set()
            where = f"{path}!{name}"
            used.update(row["used"] or ())
            entry = io.BufferedReader(_Entry(opened[1], row), 1 << 20)
            if row["used"] is None:
                yield from _numbered(where, entry)
                continue
            for way, inner in walk(name, entry, 1, max_depth, (name,)):
                where = f"{path}!{_named(way, used)}"
                yield from _numbered(where, inner)
        except (*_DAMAGE, pa.ArrowException) as problem:
            yield where, 0, 0, None, f"archive: {problem}"
    if opened is not None:
        opened[1].close()


def _find_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            entries = _entries(path)
            while rows := list(islice(entries, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ENTRY_ROWS, strict=True)], schema=_ENTRY_ROWS)


def _read_entries(max_depth: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        yield from line_batches(_entry_lines(rows, max_depth))

    return work


def archive_entries(objects: DataFrame) -> DataFrame:
    """Where the entries of the archives (``path``) lie; of what can only be streamed one row each."""
    n = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return objects.select("path").repartition(n, "path").mapInArrow(_find_entries, _ENTRY)


def archive_lines(spark: SparkSession, paths: str | Sequence[str], max_depth: int = MAX_DEPTH, objects: DataFrame | None = None) -> DataFrame:
    """Line frame (plus ``error``) of all archives at ``paths``, or of the given ``objects``.

    A broken or too deeply nested archive or entry gives one row with an error; lines
    read before it, and the other entries of a zip, are kept.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    if not all(reachable(p) for p in roots):
        # A store that only Spark opens: whole archives, by its own scan.
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
        return archive_lines_of(files.where(is_archive(F.col("_metadata.file_path"))).select("path", "content"), max_depth)
    if objects is None:
        objects = list_objects(spark, roots).where(is_archive(F.col("path")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = archive_entries(objects).repartition(n, "path", "chunk").sortWithinPartitions("path", "chunk", F.size("used").desc(), "at")
    return dealt.mapInArrow(_read_entries(max_depth), FRAME).withColumn("value", F.col("value").cast("string"))


def archive_lines_of(files: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The same for a DataFrame with ``path STRING, content BINARY``."""
    return files.select("path", "content").mapInArrow(_unpack(max_depth), FRAME).withColumn(
        "value", F.col("value").cast("string")
    )
