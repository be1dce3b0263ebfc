"""File listings: path, size and time of every object below a prefix."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from .store import OWN_NAMES


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, modificationTime, length`` of all files, sub-folders included.

    The content column is pruned, so no file is opened. Spark's scans leave out
    empty files; they hold no line.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        [paths] if isinstance(paths, str) else list(paths)
    )
    return listing.select("path", "modificationTime", "length")




def _at_each_level(spark: SparkSession, paths: str | Sequence[str], name: str) -> Iterator[JavaObject]:
    """File status of all objects below ``paths`` whose own name fits a pattern.

    The file system lists one level of folders after the other and gives back what
    fits, so only that comes to the driver. Folders that Spark's scans leave out are
    not entered.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in [paths] if isinstance(paths, str) else paths:
        level = path.rstrip("/")
        system = jvm.org.apache.hadoop.fs.Path(level).getFileSystem(conf)
        while system.globStatus(jvm.org.apache.hadoop.fs.Path(level + "/*")):
            yield from system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/{name}")) or ()
            level += "/[!_.]*"


def hidden_objects(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Objects below ``paths`` whose names begin with ``_`` or ``.``: Spark's scans leave them out.

    A folder of such a name is given as a whole, an empty object not at all.
    """
    found = set()
    for status in _at_each_level(spark, paths, "[_.]*"):
        name = status.getPath().getName()
        read = name.startswith("_") and "=" in name   # a partition's folder
        if not read and name not in OWN_NAMES and (status.isDirectory() or status.getLen()):
            found.add(status.getPath().toString())
    return sorted(found)


def list_with_markers(spark: SparkSession, paths: str | Sequence[str], marker: str) -> DataFrame:
    """``path`` of all files and of all markers: the names of markers are such that scans leave them out."""
    found = [(status.getPath().toString(),) for status in _at_each_level(spark, paths, marker)]
    return list_files(spark, paths).select("path").unionByName(spark.createDataFrame(found, "path string"))


def require_files(listing: DataFrame) -> DataFrame:
    """The listing itself; an empty one is an error."""
    if listing.isEmpty():
        raise FileNotFoundError("no files below the given prefix")
    return listing


def literal_path(path: str) -> str:
    """A listed path as reader input: readers take ``[``, ``*`` and the like as patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def put_object(spark: SparkSession, path: str, body: bytes) -> None:
    """Write one small object; it appears whole, in place of one of the same name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(to.getParent(), f".{uuid.uuid4().hex}")
    stream = to.getFileSystem(conf).create(draft, True)
    try:
        stream.write(bytearray(body))
    finally:
        stream.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), conf).rename(draft, to, how)
