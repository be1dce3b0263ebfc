"""Raw timeline JSON lines -> timeline events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timeline import MAX_LINE_BYTES, PLACE, normalise
from ..schemas import TIMELINE_COLUMNS
from ..session import configure
from ..sources.scan import scan_lines
from ..sources.listing import list_files, require_files
from .network import Parsed


def parse_timeline(
    lines: DataFrame, root: str, default_device: str = "unknown",
    max_line_bytes: int = MAX_LINE_BYTES,
) -> Parsed:
    """Normalise a line frame; ``root`` is the folder the devices' folders are in."""
    rows = normalise(lines, root, default_device, max_line_bytes)
    if "error" in lines.columns:
        rows = rows.unionByName(
            lines.where(F.col("error").isNotNull()).select(*PLACE, F.lit("").alias("raw_line"), "error"),
            allowMissingColumns=True,
        )
    return Parsed(rows, TIMELINE_COLUMNS, lines)


def ingest_timeline(
    spark: SparkSession, paths: str | Sequence[str], root: str, default_device: str = "unknown",
    max_line_bytes: int = MAX_LINE_BYTES,
) -> Parsed:
    """Read all files below ``paths`` as timeline JSON lines; longer lines than given are rejected."""
    configure(spark)
    require_files(list_files(spark, paths))
    lines = scan_lines(spark, paths, archives=False)
    return parse_timeline(lines, root, default_device, max_line_bytes)
