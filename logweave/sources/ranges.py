"""Lines of objects that Spark's text scan leaves out, read by tasks in byte ranges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import open_store

#: Bytes that one task reads of one object, the counterpart of a file split.
SPLIT_BYTES = 128 << 20
_BUFFER = 1 << 20
#: Lines held as single objects: at 8 MB a worker that is used again grows from batch to batch, as freed lines leave gaps.
_BATCH_BYTES = 1 << 20

#: Objects whose lines are found only after the whole of them is unpacked in a way that is not built here.
UNREAD = r"(?i)\.(?:bz2|zst|lz4|snappy|deflate)$"
FRAME = "source_file string, block bigint, seq bigint, value binary, error string"
_ROWS = pa.schema([("source_file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("value", pa.binary()), ("error", pa.string())])


def line_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of a line frame in batches of bounded bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[3] or b"") + 64
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), _ROWS, strict=True)], schema=_ROWS)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), _ROWS, strict=True)], schema=_ROWS)


def range_lines(path: str, start: int, end: int) -> Iterator[tuple]:
    """Lines that begin in the bytes [start, end): a line belongs to the range of its first byte."""
    try:
        store, at = open_store(path)
        with store.open_input_file(at) as raw:
            first = max(0, start - 1)
            raw.seek(first)
            # `held` are the pieces of the line that begins at `place`.
            place, held, skip, n = first, [], start > 0, 0
            while place < end or held:
                chunk = raw.read(_BUFFER)
                *whole, last = chunk.split(b"\n")
                if not chunk:   # the object ends without a line break
                    whole, last = [b""] if held else [], b""
                for piece in whole:
                    if held:
                        piece, held = b"".join([*held, piece]), []
                    if skip:   # what began before this range
                        skip = False
                    elif place < end:
                        yield path, start, n, piece, None
                        n += 1
                    place += len(piece) + 1
                if not chunk or place >= end:
                    break
                if last:
                    held.append(last)
    except (OSError, pa.ArrowException) as problem:
        yield path, start, 0, None, f"not read: {problem}"


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for x in batch.to_pylist():
                yield from range_lines(x["path"], x["start"], x["end"])

    yield from line_batches(rows())


def object_lines(objects: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """Line frame (plus ``error``) of plain objects (``path, length``), large ones in several tasks."""
    n = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split).cast("bigint")))
    readable = ~F.col("path").rlike(UNREAD)
    ranges = objects.where(readable & (F.col("length") > 0)).select("path", starts.alias("start")).withColumn("end", F.col("start") + split)
    lines = ranges.repartition(n, "path", "start").mapInArrow(_work, FRAME).withColumn("value", F.col("value").cast("string"))
    unread = objects.where(~readable).select(
        F.col("path").alias("source_file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("seq"),
        F.lit(None).cast("string").alias("value"), F.lit("not read: packed in a way that is known only for visible names").alias("error"))
    return lines.unionByName(unread)
