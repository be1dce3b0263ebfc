"""Text-line scans.

Every scan gives one *line frame*:

    source_file STRING   file (or ``archive!entry``) the line came from
    block       BIGINT   byte offset of the file split (entry part) it starts in
    seq         BIGINT   increases with the line's place inside its block
    value       STRING   the line without its ``\\n``

(source_file, block, seq) is a total order over the lines of a file although
files are split and read in parallel, and a block is never larger than one
split, so per-block work is bounded however large a file is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .listing import hidden_objects

HIDDEN = "not read: its name begins with _ or ."

LINE_FRAME = "source_file string, block bigint, seq bigint, value string"

# Names the archive walker unpacks. A plain .gz of one text file is left to
# Spark's own codec.
_WALKED = r"(?i)\.(?:(?:zip|tar|tgz)(?:\.gz)*|gz\.gz)$"
_ODD_GZ = r"\.(?:[Gg]Z|G[Zz])$"


def is_archive(path: Column) -> Column:
    # Scans ask this for every line; the last letter answers it for most names.
    return F.right(path, F.lit(1)).isin(*"pPrRzZ") & (path.rlike(_WALKED) | path.rlike(_ODD_GZ))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Line frame of all plain (or .gz) files at ``paths``, sub-folders included.

    Archives are left out; the filter on the file name keeps them out of the
    scan's file list.
    """
    scan = spark.read.option("recursiveFileLookup", True).text(
        [paths] if isinstance(paths, str) else list(paths), lineSep="\n"
    )
    return scan.where(~is_archive(F.col("_metadata.file_path"))).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def with_unread(lines: DataFrame, spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The frame with an error row for each object that Spark's scans leave out by its name."""
    hidden = hidden_objects(spark, paths)
    if not hidden:
        return lines
    rows = spark.createDataFrame([(path,) for path in hidden], "source_file string").select(
        "source_file", F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("seq"),
        F.lit(None).cast("string").alias("value"), F.lit(HIDDEN).alias("error"),
    )
    return lines.withColumn("error", F.lit(None).cast("string")).unionByName(rows)


def as_line_frame(df: DataFrame, value: Column | str, source: Column | str | None = None) -> DataFrame:
    """Line frame over any DataFrame with one text per row."""
    text = F.col(value) if isinstance(value, str) else value
    source = F.lit("") if source is None else F.col(source) if isinstance(source, str) else source
    return df.select(
        source.alias("source_file"),
        # The upper bits of the id are the partition's number.
        F.shiftright(F.monotonically_increasing_id(), 33).alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        text.alias("value"),
    )


def number_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Add ``line_number`` (from 1, per file) to ``rows`` of the frame ``lines``.

    Only one row per block is aggregated and prefix-summed, so no file has to
    pass through one task; ``rows`` should be the few that need a number.
    """
    blocks = lines.groupBy("source_file", "block").agg(
        F.count("*").alias("n"), F.min("seq").alias("first_seq")
    )
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = blocks.select(
        "source_file", "block", "first_seq",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before"),
    )
    return rows.join(starts, ["source_file", "block"], "left").withColumn(
        "line_number", F.col("lines_before") + F.col("seq") - F.col("first_seq") + 1
    ).drop("first_seq", "lines_before")
