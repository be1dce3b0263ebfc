"""Exact copies of texts, kept in an index of cuckoo filters that takes and gives back documents.

A text counts as its UTF-8 bytes with A-Z lowered; its digest is the SHA-256 of these. Digests
are dealt to shards by their first bits. A shard is one cuckoo filter over its live digests
beside the content of them: text, largest document id and number of documents. A document that
comes in asks the filter. A miss is a new text and is inserted. A hit is verified against the
content of the shard, byte by byte; if the text is there, the document joins its group and, with a
larger id, takes the place of the one that stayed; if not, the hit was false and the text is new.
A document that goes leaves its group; with the last one, digest and content go. A filter that
overflows is built anew, twice as large, from the digests that the shard stores.

Copies are put together where they are read, so a text comes to its shard once from each
task (and once more for every `HELD_BYTES` of other texts in it), however many copies it has. A
shard is streamed by one task; nothing is collected for a group. `members` are joined to the groups
of several documents alone, with Spark's splitting of skewed keys.

Defined cases: NULL and empty texts are equal; a NULL id is smaller than any other; rows that agree
in id and text count one by one and share their fate; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import tables
from logweave.llm.cuckoo import CuckooFilter

#: Bytes of distinct texts that a task holds to put copies together before it sends them on.
HELD_BYTES = 32 << 20
#: Bytes of text in a shard, about.
SHARD_BYTES = 16 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# Rows of a shard in the order in which they are streamed: its filter, its content, documents that come, documents that go.
_FILTER, _CONTENT, _COME, _GO = 0, 1, 2, 3
_ROWS = "shard int, kind int, digest binary, top {id}, n bigint, body binary"


class Index(NamedTuple):
    """Shards (rows of filters and content) and members (doc_id, digest)."""

    shards: DataFrame
    members: DataFrame
    bits: int


def _normalised(column: pa.Array) -> Iterator[bytes]:
    for x in column:
        yield (x.as_py() or b"").translate(_LOWER)


def _later(a, b):
    """The larger id; None is smaller than any."""
    return b if a is None or (b is not None and b > a) else a


def _shard(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:4], "big") >> (32 - bits)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], schema)


def _sent(docs: DataFrame, bits: int, kind: int) -> DataFrame:
    """One row for each text and task: how many of its documents have it, and their largest id."""
    frame = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("body"))
    name = frame.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [(_shard(d, bits), kind, d, top, n, body) for d, (top, n, body) in held.items()]
            held.clear()
            return _table(rows, schema)

        for batch in batches:
            schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("digest", pa.binary()), ("top", batch.schema.field("doc_id").type), ("n", pa.int64()), ("body", pa.binary())])
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), _normalised(batch.column("body")), strict=True):
                digest = hashlib.sha256(body).digest()
                group = held.get(digest)
                if group is None:
                    held[digest] = [doc_id, 1, body]
                    size += len(body)
                    if size > HELD_BYTES:
                        size = 0
                        yield flush()
                elif group[2] != body:
                    raise ValueError(f"two texts share the digest {digest.hex()}")
                else:
                    group[0], group[1] = _later(group[0], doc_id), group[1] + 1
        if held:
            yield flush()

    return frame.mapInArrow(work, _ROWS.format(id=name))


class _Shard:
    """The filter of a shard and its content, by digest: [largest id, documents, text]."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.filter = CuckooFilter()
        self.content: dict[bytes, list] = {}

    def come(self, digest: bytes, top, n: int, body: bytes) -> None:
        if digest in self.filter and (group := self.content.get(digest)) is not None:
            if group[2] != body:
                raise ValueError(f"two texts share the digest {digest.hex()}")
            group[0], group[1] = _later(group[0], top), group[1] + n
            return
        self.content[digest] = [top, n, body]
        if not self.filter.insert(digest):
            self.filter = CuckooFilter.resized(self.filter.bits + 1, self.content)

    def go(self, digest: bytes, top, n: int) -> None:
        """`top` is what the group's largest id is afterwards."""
        if digest in self.filter and (group := self.content.get(digest)) is not None:
            group[0], group[1] = top, group[1] - n
            if group[1] <= 0:
                del self.content[digest]
                self.filter.delete(digest)

    def rows(self) -> list[tuple]:
        if not self.content:
            return []
        return [(self.number, _FILTER, None, None, len(self.content), self.filter.to_bytes())] + [
            (self.number, _CONTENT, d, top, n, body) for d, (top, n, body) in self.content.items()]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shards, each shard's together and in order of kind, to the rows of the shards afterwards."""
    shard = schema = None
    for batch in batches:
        schema = batch.schema
        for number, kind, digest, top, n, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if shard is None or shard.number != number:
                if shard is not None and shard.content:
                    yield _table(shard.rows(), schema)
                shard = _Shard(number)
            if kind == _FILTER:
                shard.filter = CuckooFilter.from_bytes(body)
            elif kind == _CONTENT:
                shard.content[digest] = [top, n, body]
            elif kind == _COME:
                shard.come(digest, top, n, body)
            else:
                shard.go(digest, top, n)
    if shard is not None and shard.content:
        yield _table(shard.rows(), schema)


def _settled(rows: DataFrame, bits: int) -> DataFrame:
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(1 << bits, 200_000))
    dealt = rows.repartition(n, "shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(_streamed, rows.schema)


def _members(docs: DataFrame) -> DataFrame:
    """doc_id and digest of every document."""
    frame = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("body"))
    name = frame.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array([hashlib.sha256(x).digest() for x in _normalised(batch.column("body"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), digests], ["doc_id", "digest"])

    return frame.mapInArrow(work, f"doc_id {name}, digest binary")


def index(docs: DataFrame) -> Index:
    """An index of all the documents (doc_id, text)."""
    bits = max(6, ceil(log2(max(1, tables.text_bytes(docs)) / SHARD_BYTES)))
    return Index(_settled(_sent(docs, bits, _COME), bits), _members(docs), bits)


def stored(held: Index) -> Index:
    """The index, written to the shared folder and read again."""
    return Index(tables.stored(held.shards), tables.stored(held.members), held.bits)


def insert(held: Index, docs: DataFrame) -> Index:
    """The index with these documents too. Store an index before it grows often."""
    return Index(_settled(held.shards.unionAll(_sent(docs, held.bits, _COME)), held.bits), held.members.unionAll(_members(docs)), held.bits)


def delete(held: Index, docs: DataFrame) -> Index:
    """The index without these documents; those that it does not hold by id and text change nothing.

    Of rows that agree in id and text all go.
    """
    leave = _members(docs).distinct().withColumnsRenamed({"doc_id": "own", "digest": "key"})
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("key"))
    rest = held.members.join(leave, same, "left_anti")
    gone = held.members.join(leave, same, "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    left = rest.join(gone.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.max("doc_id").alias("top"))
    bits = held.bits
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    rows = gone.join(left, "digest", "left").select(
        F.shiftright(first, 32 - bits).cast("int").alias("shard"), F.lit(_GO).alias("kind"), "digest", "top", "n", F.lit(None).cast("binary").alias("body"))
    return Index(_settled(held.shards.unionAll(rows), bits), rest, bits)


def groups(held: Index) -> DataFrame:
    """digest, keep_id and group_size of every text that some document has."""
    return held.shards.where(F.col("kind") == _CONTENT).select("digest", F.col("top").alias("keep_id"), F.col("n").alias("group_size"))


def copies(held: Index) -> DataFrame:
    """doc_id, digest, keep_id, group_size and kept of every document in the index."""
    several = groups(held).where("group_size > 1").withColumnRenamed("digest", "key")
    rows = held.members.join(several, F.col("digest") == F.col("key"), "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id", "digest", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copies(index(tables.read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


COPIES_SQL = """
WITH own AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM own WINDOW w AS (PARTITION BY text_sha256)
"""

QUERIES = {"op13_exact_dedup": op13_exact_dedup}
ORACLES = {"op13_exact_dedup": COPIES_SQL}
