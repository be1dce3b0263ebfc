"""Encrypted chunks: 12-byte nonce, ciphertext, 16-byte tag (AES-256-GCM)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the chunk format.
NONCE_BYTES = 12
MAX_CHUNK_BYTES = 64 * 1024 * 1024 + 64


def decrypt_chunks(chunks: DataFrame, key: Column) -> DataFrame:
    """Add ``plain`` (BINARY) and ``error`` to a frame with a ``payload`` column.

    ``key`` is a column, so that it can come from a joined key table instead of
    standing in the plan as a literal.
    """
    size = F.octet_length("payload")
    sized = chunks.withColumn("plain", F.when(
        size.between(NONCE_BYTES, MAX_CHUNK_BYTES), F.try_aes_decrypt(F.col("payload"), key, F.lit("GCM"))
    ))
    return sized.withColumn("error", (
        F.when(size > MAX_CHUNK_BYTES, F.lit("chunk exceeds the size limit"))
        .when(size < NONCE_BYTES, F.lit("chunk too short for its nonce"))
        .when(F.col("plain").isNull(), F.lit("chunk does not decrypt: wrong key or damaged"))
    ))


#: Chunk numbers of one path that are looked at together.
SPAN = 4096
_RANGES = "array<struct<first: bigint, last: bigint>>"


def _ranges(numbers: Column) -> Column:
    """Ordered numbers as ranges without gaps."""
    def step(done: Column, n: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["first"].alias("first"), n.alias("last"))))
        return F.when(last["last"] == n - 1, longer).otherwise(F.concat(done, F.array(F.struct(n.alias("first"), n.alias("last")))))

    return F.aggregate(numbers, F.array().cast(_RANGES), step)


def completeness(chunks: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """What is wrong with the chunks (``path, chunk_no``, from 0) of each artifact.

    ``n_chunks`` different ones are there; ``missing`` and ``repeated`` are ranges of numbers,
    ``missing`` up to the last chunk that is there; ``cut`` is the number of the first chunk of
    a tail that should be there, where ``expected`` (``path, n_expected``) says how many there
    are. A path of which nothing is there is all tail.

    Numbers are looked at in spans of ``SPAN``; only one row for each span comes together for a
    path, so a path may have any number of chunks. Ranges that touch at the edge of a span are
    given as two; chunks without a number or path are left out.
    """
    counted = chunks.where("path IS NOT NULL AND chunk_no >= 0").groupBy("path", F.col("chunk_no").cast("bigint").alias("chunk_no")).count()
    spans = counted.groupBy("path", F.floor(F.col("chunk_no") / SPAN).alias("span")).agg(
        F.sort_array(F.collect_list("chunk_no")).alias("own"),
        F.sort_array(F.collect_list(F.when(F.col("count") > 1, F.col("chunk_no")))).alias("twice"))
    begin, order = F.col("span") * SPAN, Window.partitionBy("path").orderBy("span")
    after = F.lead("span").over(order)
    # Up to the end of its span if others follow, else to its own last chunk; spans before it that are not there go with it.
    end = F.when(after.isNotNull(), begin + SPAN - 1).otherwise(F.array_max("own"))
    before = (F.coalesce(F.lag("span").over(order), F.lit(-1)) + 1) * SPAN
    empty = F.when(before < begin, F.array(F.struct(before.alias("first"), (begin - 1).alias("last")))).otherwise(F.array().cast(_RANGES))
    inside = _ranges(F.array_except(F.sequence(begin, end), F.col("own")))
    looked = spans.select("path", "span", F.size("own").alias("n"), F.concat(empty, inside).alias("missing"), _ranges(F.col("twice")).alias("repeated"), F.array_max("own").alias("last"))
    found = looked.groupBy("path").agg(
        F.sum("n").alias("n_chunks"), F.max("last").alias("last"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("span", "missing"))), lambda x: x["missing"])).alias("missing"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("span", "repeated"))), lambda x: x["repeated"])).alias("repeated"))
    if expected is None:
        return found.select("path", "n_chunks", "missing", "repeated", F.lit(None).cast("bigint").alias("cut"))
    told = found.join(expected.select("path", "n_expected"), "path", "full")
    none = F.array().cast(_RANGES)
    follows = F.coalesce(F.col("last") + 1, F.lit(0))
    return told.select(
        "path", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), F.coalesce("missing", none).alias("missing"), F.coalesce("repeated", none).alias("repeated"),
        F.when(follows < F.col("n_expected"), follows).alias("cut"))
