"""Removal of long word sequences that occur more than once, through fixed-block anchors.

The corpus is indexed by non-overlapping blocks of half a window: every window of W words
holds a whole block of B = (W + 1) // 2 words of its own text. All rolling B-word windows
probe that index; a block that also occurs at another position is an anchor. Each hit is
extended both ways: of the W-word windows around an anchor those that occur again are kept,
and windows that touch or overlap merge to the maximal repeat.

Blocks, probes and windows go by hash to the buckets of `packed`; no pair of occurrences is
ever formed, so the work is linear however often a passage is repeated. Probes carry 38 bits
or more (a chance hit only costs one further look), windows all 64.

Defined cases: NULL or wordless text has no words and loses none; a text shorter than the
window loses nothing; rows that agree in id and text are separate texts (both lose their
words); other columns of the input are neither read nor touched; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import packed, tables
from logweave.llm.words import AS_IS, NOT_SPACE, Words, covered, member, texts, tokenise, windows

WINDOW = 35
REPEATS = "array<struct<first: int, last: int>>"


def _windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of `width` words begin, and their hashes."""
    at = np.flatnonzero(words.room() >= width)
    return at, windows(words.hashes, width)[at]


def _probes(block: int, bits: int):
    def work(table: pa.Table) -> pa.Table:
        rolling, blocks = [], []
        for _, _, data, offsets in texts(table["body"]):
            words = tokenise(data, offsets, NOT_SPACE, AS_IS)
            at, hashes = _windows(words, block)
            begin = np.repeat(words.first[:-1], np.diff(words.first))
            rolling.append(hashes)
            blocks.append(hashes[(at - begin[at]) % block == 0])
        return packed.send(table["batch"][0].as_py(), np.concatenate(rolling or [np.empty(0, np.uint64)]), bits, False,
                           np.concatenate(blocks or [np.empty(0, np.uint64)]))

    return work


def _around(block: int, window: int, probe_bits: int, bits: int):
    """Windows that hold an anchor: what an anchor can be extended to."""

    def work(table: pa.Table, side: pa.Table) -> pa.Table:
        anchors = packed.found_keys(side)
        out = [np.empty(0, np.uint64)]
        for _, _, data, offsets in texts(table["body"]) if len(anchors) else ():
            words = tokenise(data, offsets, NOT_SPACE, AS_IS)
            at, hashes = _windows(words, block)
            hit = np.zeros(len(words.starts) + window, np.int32)
            hit[at[member(packed.key(hashes, probe_bits, False), anchors)]] = 1
            sums = np.concatenate([[0], np.cumsum(hit)])
            at, hashes = _windows(words, window)
            out.append(hashes[sums[at + window - block + 1] > sums[at]])
        return packed.send(table["batch"][0].as_py() if table.num_rows else 0, np.concatenate(out), bits, True)

    return work


def _remove(window: int):
    def work(table: pa.Table, side: pa.Table) -> pa.Table:
        again = packed.found_keys(side)
        n_words, kept, spans = [], [], []
        for _, _, data, offsets in texts(table["body"]):
            words = tokenise(data, offsets, NOT_SPACE, AS_IS)
            gone = np.zeros(len(words.starts), bool)
            if len(again):
                at, hashes = _windows(words, window)
                gone = covered(at[member(hashes, again)], len(gone), window)
            body = data.tobytes()
            for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                n_words.append(hi - lo)
                own = gone[lo:hi]
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
                spans.append([{"first": a, "last": b - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                rest = np.flatnonzero(~own) + lo
                kept.append(b" ".join([body[s:e] for s, e in zip(words.starts[rest].tolist(), words.ends[rest].tolist(), strict=True)]))
        out = {name: table[name] for name in table.column_names if name not in ("body", "uid", "batch")}
        return pa.table(out | {
            "n_words": pa.array(n_words, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            "repeats": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        })

    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, kept_text (words outside repeats, one space between) and repeats.

    `repeats` lists the maximal word ranges (0-based, both ends included) that are covered
    by windows occurring at another position of the corpus too.
    """
    block = (window + 1) // 2
    size = tables.text_bytes(docs)
    bits = packed.bucket_bits(size // 5)
    batches = packed.batched(docs, size, "doc_id")
    anchors = packed.repeated(packed.per_batch(batches, _probes(block, bits), packed.SENT), bits, False, anchored=True)
    around = packed.with_answer(batches, anchors, _around(block, window, bits, bits), packed.SENT)
    again = packed.repeated(around, bits, True)
    kind = dict(docs.dtypes)["doc_id"]
    return packed.with_answer(batches, again, _remove(window), f"doc_id {kind}, n_words bigint, kept_text string, repeats {REPEATS}")


def removed_words() -> Column:
    return F.aggregate("repeats", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"] + 1)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(tables.read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", removed_words().alias("n_removed"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op8_substring_dedup": op8_substring_dedup}
#: DuckDB takes too long over all 35-word windows; tests compare with brute force instead.
ORACLES: dict[str, str] = {}
