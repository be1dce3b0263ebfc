"""Which hashes occur at least twice in a corpus, without a row per hash.

Documents are dealt into batches. A batch sends its hashes, packed, to buckets by their
top bits; each bucket finds what is repeated and answers each batch with those of its
own hashes that are. A batch sends a hash at most twice, so hot keys are pre-aggregated
where they are made and no key gathers in a task.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm import tables
from logweave.llm.words import member, reps

#: Hashes that one bucket holds, about.
BUCKET_HASHES = 2 << 20
SENT = "batch int, bucket int, hashes binary, anchors binary"
FOUND = "batch int, found binary"


def bucket_bits(hashes: int) -> int:
    return max(6, ceil(log2(max(hashes, 1) / BUCKET_HASHES)))


def batch_of(size: int) -> Column:
    """The batch of a uid in a corpus of so many bytes."""
    return F.pmod("uid", F.lit(max(1, ceil(size / tables.BATCH_BYTES)))).cast("int")


def batched(docs: DataFrame, size: int, *keep: str) -> DataFrame:
    """Columns `keep`, uid, body (UTF-8 bytes of text) and batch; partitioned by batch."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        docs.select(*keep, text.cast("binary").alias("body"), F.xxhash64("doc_id", text).alias("uid"))
        .withColumn("batch", batch_of(size))
        .repartition(tables.partitions(spark, size), "batch")
    )


def _pack(values: np.ndarray) -> bytes:
    """Ordered values as differences with like bytes together, which compress."""
    wide = values.dtype.itemsize
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, wide).T.tobytes()


def _unpack(body: bytes, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(wide, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


def send(batch: int, hashes: np.ndarray, bits: int, wide: bool, anchors: np.ndarray | None = None) -> pa.Table:
    """Rows for the buckets. Narrow: only the 32 bits after the bucket's travel; see `key`."""
    kind = np.uint64 if wide else np.uint32
    shift = np.uint64(0 if wide else 32 - bits)

    def cut(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        values = reps(values, most)
        if not wide:
            values = reps(values >> shift, most)
        bounds = np.searchsorted(values, _edges(bits, 64 - bits if wide else 32))
        return values, np.append(bounds, len(values))

    values, bounds = cut(hashes, 2)
    marks, ends = cut(anchors, 1) if anchors is not None else (values[:0], np.zeros_like(bounds))
    full = np.flatnonzero(np.diff(bounds))
    return pa.table({
        "batch": pa.array(np.full(len(full), batch, np.int32)),
        "bucket": pa.array(full.astype(np.int32)),
        "hashes": pa.array([_pack(values[bounds[b] : bounds[b + 1]].astype(kind)) for b in full], pa.binary()),
        "anchors": pa.array([_pack(marks[ends[b] : ends[b + 1]].astype(kind)) for b in full], pa.binary()),
    })


def _edges(bits: int, top: int) -> np.ndarray:
    """Lowest key of each bucket."""
    return np.arange(1 << bits, dtype=np.uint64) << np.uint64(top)


def key(hashes: np.ndarray, bits: int, wide: bool) -> np.ndarray:
    """What `repeated` answers with for a hash: itself, or its top 32 + bits bits."""
    return hashes if wide else hashes >> np.uint64(32 - bits)


def repeated(sent: DataFrame, bits: int, wide: bool, anchored: bool = False) -> DataFrame:
    """For each batch, those of its keys that occur at least twice (anchored: and are an anchor somewhere)."""
    kind = np.uint64 if wide else np.uint32

    def find(table: pa.Table) -> pa.Table:
        rows = [_unpack(x.as_py(), kind) for x in table["hashes"]]
        every = np.sort(np.concatenate(rows))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        if anchored:
            marks = np.unique(np.concatenate([_unpack(x.as_py(), kind) for x in table["anchors"]]))
            twice = twice[member(twice, marks)]
        top = np.uint64(table["bucket"][0].as_py()) << np.uint64(32)
        batches, found = [], []
        for batch, own in zip(table["batch"].to_pylist(), rows, strict=True):
            own = np.unique(own)
            own = own[member(own, twice)].astype(np.uint64)
            if len(own):
                batches.append(batch)
                found.append((own if wide else own | top).tobytes())
        return pa.table({"batch": pa.array(batches, pa.int32()), "found": pa.array(found, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(find, FOUND)


def found_keys(side: pa.Table) -> np.ndarray:
    """All keys a batch was answered with, in order."""
    parts = [np.frombuffer(x.as_py(), np.uint64) for x in side["found"]]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def per_batch(batches: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return batches.groupBy("batch").applyInArrow(work, schema)


def with_answer(batches: DataFrame, side: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """`work` on each batch and the rows of `side` for it."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left, right)

    return batches.groupBy("batch").cogroup(side.groupBy("batch")).applyInArrow(both, schema)
