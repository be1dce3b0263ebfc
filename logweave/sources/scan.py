"""All lines below some paths: plain files, objects of hidden names, archives."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archives import MAX_DEPTH, archive_lines
from .lines import LINE_FRAME, is_archive, read_lines, with_unread
from .listing import list_files, literal_path
from .ranges import object_lines
from .store import is_hidden, list_objects, reachable


def _resolved(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The paths, patterns replaced by what they stand for."""
    out = []
    for path in [paths] if isinstance(paths, str) else paths:
        if not re.search(r"[\\\[{*?]", path):
            out.append(path)
            continue
        pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
        out += [status.getPath().toString() for status in found or ()]
    return out


def _with_error(lines: DataFrame) -> DataFrame:
    return lines if "error" in lines.columns else lines.withColumn("error", F.lit(None).cast("string"))


def scan_lines(
    spark: SparkSession, paths: str | Sequence[str], *, archives: bool = True, max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """Line frame of all objects below ``paths``, with ``error`` where some may not be readable.

    Visible plain files are scanned by Spark. What its scans leave out by name, and the
    entries of archives, are read by tasks of their own. In a store that only Spark can
    open, hidden objects become error rows and archives are read whole.
    """
    roots = _resolved(spark, paths)
    lines = read_lines(spark, paths)
    if not roots:
        return lines
    if not all(reachable(p) for p in roots):
        lines = with_unread(lines, spark, paths)
        if archives and not list_files(spark, paths).where(is_archive(F.col("path"))).isEmpty():
            lines = _with_error(lines).unionByName(archive_lines(spark, roots, max_depth))
        return lines
    return _added(spark, lines, list_objects(spark, roots), roots, archives, max_depth)


def scan_objects(spark: SparkSession, objects: Sequence[tuple[str, int]], *, archives: bool = True, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The same of objects named one by one, (path, length) each; nothing is listed again."""
    found = spark.createDataFrame(list(objects), "path string, length bigint")
    roots = sorted({p.rsplit("/", 1)[0] for p, _ in objects})
    # A scan looks at the name of what it is given, not at the folders above.
    visible = [literal_path(p) for p, n in objects if n and not p.rsplit("/", 1)[1].startswith(("_", "."))]
    lines = read_lines(spark, visible) if visible else spark.createDataFrame([], LINE_FRAME)
    return _added(spark, lines, found, roots, archives, max_depth)


def _added(
    spark: SparkSession, lines: DataFrame, objects: DataFrame, roots: list[str], archives: bool, max_depth: int
) -> DataFrame:
    hidden = is_hidden(F.col("path"), roots)
    # Spark's own codec reads a plain .gz, but not one that it does not see.
    packed = is_archive(F.col("path")) | (hidden & F.lower("path").endswith(".gz"))
    kinds = objects.agg(F.max(packed), F.max(hidden & ~packed)).first()
    if kinds[1]:
        lines = _with_error(lines).unionByName(object_lines(objects.where(hidden & ~packed)))
    if archives and kinds[0]:
        lines = _with_error(lines).unionByName(archive_lines(spark, roots, max_depth, objects.where(packed)))
    return lines
