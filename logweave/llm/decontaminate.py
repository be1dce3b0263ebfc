"""Benchmark decontamination as a prefix-filtered set join with exact containment.

Each benchmark item is cut into windows of ten words (a shorter item is one window). A
window is contained in a document only if all of its four-word shingles are, so of each
window's shingles, ordered by how rare they are in the corpus, the rarest alone is the
necessary prefix token. Documents are joined on those tokens; the token's place in the window
fixes where the window would begin (positional bound) and end (length bound) in the text,
and what remains is verified word by word over the item-sized window.

Two passes over the documents, no shuffle: one counts the benchmark's shingles in the whole
corpus, one joins and verifies. The benchmark side goes to the tasks in blocks of at most
`block_windows` windows (about 130 bytes each), so what is broadcast is bounded; a larger
benchmark means more blocks, each against all documents.

Defined cases: NULL or wordless text and items have no words and no windows; items of equal
item_id are one item, a NULL item_id is the id ''; rows that agree in id and text stay
separate rows; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import tables
from logweave.llm.words import ALNUM, LOWER, Words, member, texts, tokenise, windows

WINDOW = 10
SHINGLE = 4
BLOCK_WINDOWS = 200_000


class Index(NamedTuple):
    """Distinct windows of a block: word hashes (zero padded), lengths, and the items of each."""

    words: np.ndarray
    lengths: np.ndarray
    item_bounds: np.ndarray
    items: list[str]

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows whose shingles have n words: shingle hash, window, place in it."""
        own = np.flatnonzero(np.minimum(self.lengths, SHINGLE) == n)
        out = [(windows(self.words[w, : self.lengths[w]], n), w) for w in own]
        if not out:
            none = np.empty(0, np.int64)
            return np.empty(0, np.uint64), none, none
        sizes = [len(h) for h, _ in out]
        return np.concatenate([h for h, _ in out]), np.repeat(own, sizes), np.concatenate([np.arange(n) for n in sizes])


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, bodies, lengths = [], [], []
        for lo, _, data, offsets in texts(batch["body"]):
            words = tokenise(data, offsets, ALNUM, LOWER)
            for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                size = min(window, b - a)
                for at in range(a, b - size + 1) if size else ():
                    ids.append(batch["item_id"][lo + i].as_py())
                    bodies.append(words.hashes[at : at + size].tobytes())
                    lengths.append(size)
        yield pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.string()), "words": pa.array(bodies, pa.binary()), "size": pa.array(lengths, pa.int32())})


def _blocks(benchmark: DataFrame, window: int, block_windows: int) -> Iterator[Index]:
    """The benchmark's windows, one bounded block after the other."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    made = (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), body.alias("body"))
        .mapInArrow(lambda it: _item_windows(it, window), "item_id string, words binary, size int")
        .groupBy("words", "size").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    made = tables.checkpointed(made)
    blocks = max(1, -(-made.count() // block_windows))
    for n in range(blocks):
        rows = made.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == n).collect()
        grid = np.zeros((len(rows), window), np.uint64)
        for i, row in enumerate(rows):
            grid[i, : row["size"]] = np.frombuffer(row["words"], np.uint64)
        yield Index(grid, np.array([r["size"] for r in rows], np.int64), np.cumsum([0] + [len(r["items"]) for r in rows]), [x for r in rows for x in r["items"]])


def _count(tokens: dict[int, np.ndarray]):
    """Per task: how often each benchmark shingle occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {n: np.zeros(len(t), np.int64) for n, t in tokens.items()}
        for batch in batches:
            for _, _, data, offsets in texts(batch["body"]):
                words = tokenise(data, offsets, ALNUM, LOWER)
                for n, own in tokens.items():
                    hashes = windows(words.hashes, n)
                    at = np.searchsorted(own, hashes[member(hashes, own)])
                    seen[n] += np.bincount(at, minlength=len(own))
        for n, counts in seen.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"n": pa.array(np.full(len(some), n, np.int32)), "token": pa.array(some, pa.int64()), "seen": pa.array(counts[some], pa.int64())})

    return work


def _prefixes(docs: DataFrame, index: Index) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By shingle length: tokens in order, the bounds of their entries, and entries (window, place).

    One token for each window: its rarest shingle in the corpus, ties by hash.
    """
    parts = {n: index.shingles(n) for n in range(1, SHINGLE + 1)}
    tokens = {n: np.unique(hashes) for n, (hashes, _, _) in parts.items() if len(hashes)}
    counts = {n: np.zeros(len(t), np.int64) for n, t in tokens.items()}
    if tokens:
        sums = docs.mapInArrow(_count(tokens), "n int, token bigint, seen bigint").groupBy("n", "token").agg(F.sum("seen").alias("seen"))
        for row in sums.collect():
            counts[row["n"]][row["token"]] = row["seen"]
    out = {}
    for n, own in tokens.items():
        hashes, window, place = parts[n]
        order = np.lexsort((place, hashes, counts[n][np.searchsorted(own, hashes)], window))
        pick = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
        pick = pick[np.argsort(hashes[pick], kind="stable")]
        keys, first = np.unique(hashes[pick], return_index=True)
        out[n] = keys, np.append(first, len(pick)), window[pick], place[pick]
    return out


def _verified(words: Words, prefixes: dict, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Where windows occur, and which."""
    starts, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    room = words.room()
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for n, (keys, bounds, window, place) in prefixes.items():
        hashes = windows(words.hashes, n)
        at = np.flatnonzero(member(hashes, keys))
        token = np.searchsorted(keys, hashes[at])
        many = bounds[token + 1] - bounds[token]
        entry = np.repeat(bounds[token] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(at) else np.empty(0, np.int64)
        start, window_of = np.repeat(at, many) - place[entry], window[entry]
        ok = start >= 0
        start, window_of, at = start[ok], window_of[ok], np.repeat(at, many)[ok]
        ok = (room[start] >= index.lengths[window_of]) & (doc[start] == doc[at])
        start, window_of = start[ok], window_of[ok]
        lengths, same = index.lengths[window_of], np.ones(len(start), bool)
        for i in range(index.words.shape[1]):
            live = np.flatnonzero(same & (lengths > i))
            same[live] = words.hashes[start[live] + i] == index.words[window_of[live], i]
        starts.append(start[same])
        found.append(window_of[same])
    return np.concatenate(starts), np.concatenate(found)


def _join(prefixes: dict, index: Index):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits, items = [], [], []
            for _, _, data, offsets in texts(batch["body"]):
                words = tokenise(data, offsets, ALNUM, LOWER)
                n = len(offsets) - 1
                n_words.append(np.diff(words.first))
                own_hits, own_items = [[] for _ in range(n)], [[] for _ in range(n)]
                start, window = _verified(words, prefixes, index)
                doc = np.searchsorted(words.first, start, "right") - 1
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, start + index.lengths[window], -1)
                hit = np.cumsum(change[:-1]) > 0
                for d in np.unique(doc).tolist():
                    a, b = words.first[d], words.first[d + 1]
                    edges = np.flatnonzero(np.diff(hit[a:b], prepend=False, append=False)).tolist()
                    own_hits[d] = [{"first": x, "last": y - 1} for x, y in zip(edges[::2], edges[1::2], strict=True)]
                    mine = np.unique(window[doc == d])
                    own_items[d] = sorted({index.items[k] for w in mine for k in range(index.item_bounds[w], index.item_bounds[w + 1])})
                hits += own_hits
                items += own_items
            spans = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            keep = {name: batch[name] for name in batch.schema.names if name != "body"}
            yield pa.RecordBatch.from_pydict(keep | {
                "n_words": pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                "hits": pa.array(hits, spans), "items": pa.array(items, pa.list_(pa.string())),
            })

    return work


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _uid() -> Column:
    return F.xxhash64("doc_id", _text())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, hits (maximal word ranges inside occurrences, 0-based, ends included), items (ids as strings, in order)."""
    return _contamination(docs, benchmark, window, block_windows).drop("uid")


def _contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]
    bodies = docs.select("doc_id", _uid().alias("uid"), _text().cast("binary").alias("body"))
    schema = f"doc_id {kind}, uid bigint, n_words bigint, hits array<struct<first: int, last: int>>, items array<string>"
    parts = [bodies.mapInArrow(_join(_prefixes(bodies.select("body"), index), index), schema) for index in _blocks(benchmark, window, block_windows)]
    out = parts[0]
    for more in parts[1:]:
        # The same rows against a further block of windows: both sides have the same uids.
        more = more.where(F.size("items") > 0).dropDuplicates(["uid"]).select("uid", F.col("hits").alias("more_hits"), F.col("items").alias("more_items"))
        out = out.join(more, "uid", "left").select(
            "doc_id", "uid", "n_words", _merged(F.concat("hits", F.coalesce("more_hits", F.array().cast("array<struct<first: int, last: int>>")))).alias("hits"),
            F.sort_array(F.array_union("items", F.coalesce("more_items", F.array().cast("array<string>")))).alias("items"),
        )
    return out


def _merged(ranges: Column) -> Column:
    """Ranges in order, with those that overlap or touch made one."""
    empty = F.array().cast("array<struct<first: int, last: int>>")

    def step(done, x):
        end = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(end["first"].alias("first"), F.greatest(end["last"], x["last"]).alias("last"))))
        return F.when((F.size(done) > 0) & (x["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(ranges), empty, step)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents without any hit, all columns kept; rows of equal id and text share their fate."""
    name = tables.free(docs.columns, "uid")
    hit = _contamination(docs, benchmark).where(F.size("hits") > 0).select(F.col("uid").alias(name)).distinct()
    return docs.join(hit, _uid() == F.col(name), "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"] + 1)
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(10, len(w)) AS size, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS body
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
doc_window AS (
  SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS body
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM item_window) AS sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, i, d.size, item_id FROM doc_window AS d JOIN item_window AS b ON d.body = b.body AND d.size = b.size),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit ON hit.doc_id = doc.doc_id LEFT JOIN items ON items.doc_id = doc.doc_id
"""

QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLES = {"op6_decontaminate": CONTAMINATION_SQL}
