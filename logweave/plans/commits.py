"""Commit points of a table: rows are seen once the run that wrote them has committed.

A run writes each part of its rows under its own value of the partition column ``run``.
It commits by one small file in ``_commits``, renamed into place, that names its parts
with their days. A repeated run replaces the file of its earlier attempt, so whatever
that had written, in one part or in many, goes out of sight in the same step. Scans join
the parts that some file names; what an attempt left behind is never read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from urllib.parse import quote, unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.listing import put_object

FOLDER = "_commits"
NO_DAY = "none"
_SCHEMA = (
    "run string, at bigint, replaces boolean, parts array<struct<part: string, days: array<string>>>,"
    " applied array<struct<part: string, days: array<string>>>, since string"
)


def _folder(spark: SparkSession, table: str) -> tuple[JavaObject, JavaObject]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{FOLDER}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def new_part(spark: SparkSession, table: str, run: str) -> str:
    """A value of the partition column that no other attempt uses; from now on the table has commit points."""
    system, folder = _folder(spark, table)
    system.mkdirs(folder)
    return f"{run}~{uuid.uuid4().hex[:12]}"


def days_of(spark: SparkSession, table: str, part: str, status: str | None = "accepted") -> list[str]:
    """The days of which a part has rows, from the names of its folders; ``NO_DAY`` for rows without a time."""
    system, folder = _folder(spark, table)
    above = f"status={status}/" if status else ""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder.getParent(), f"{above}run={part}")
    if not system.exists(path):
        return []
    names = [x.getPath().getName() for x in system.listStatus(path)]
    days = [unquote(n.split("=", 1)[1]) for n in names if n.startswith("event_date=")]
    return sorted(NO_DAY if d.startswith("__HIVE") else d for d in days)


def commit(
    spark: SparkSession, table: str, run: str, parts: Iterable[dict], *,
    replaces: bool = False, applied: list[dict] | None = None, since: str | None = None,
) -> None:
    """Make the parts visible, and those of earlier commits of the run (``replaces``: of all runs) invisible."""
    # Later commits have later times even if the clock does not move.
    at = max(time.time_ns() // 1000, _latest(spark, table) + 1)
    body = {"run": run, "at": at, "replaces": replaces, "parts": list(parts), "applied": applied, "since": since}
    put_object(spark, f"{table.rstrip('/')}/{FOLDER}/{quote(run, safe='')}.json", json.dumps(body).encode())


def has_commits(spark: SparkSession, table: str) -> bool:
    system, folder = _folder(spark, table)
    return system.exists(folder)


def commits(spark: SparkSession, table: str) -> DataFrame:
    """The commits that hold: the last of each run, from the last one that replaces all others on."""
    system, folder = _folder(spark, table)
    if not system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "*.json")):
        return spark.createDataFrame([], _SCHEMA)
    found = spark.read.schema(_SCHEMA).json(f"{folder.toString()}/*.json")
    first = found.where("replaces").agg(F.coalesce(F.max("at"), F.lit(0)).alias("first"))
    return found.join(F.broadcast(first), F.col("at") >= F.col("first")).drop("first")


def _latest(spark: SparkSession, table: str) -> int:
    return commits(spark, table).agg(F.coalesce(F.max("at"), F.lit(0))).first()[0]


def parts(spark: SparkSession, table: str) -> DataFrame:
    """``part, days, at`` of all visible parts."""
    return commits(spark, table).select("at", F.explode("parts").alias("x")).select("x.part", "x.days", "at")


def visible(rows: DataFrame, table: str) -> DataFrame:
    """Rows of the table (with ``run``) that some commit makes visible."""
    names = parts(rows.sparkSession, table).select(F.col("part").alias("run")).distinct()
    return rows.join(names, "run", "left_semi")


def vacuum(spark: SparkSession, table: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete the files of parts that no commit names and that are older than any run takes; returns them."""
    system, folder = _folder(spark, table)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    known = {r.part for r in parts(spark, table).select("part").toLocalIterator()}
    limit = (time.time() - 3600 * older_than_hours) * 1000
    gone = []
    for pattern in ("status=*/run=*", "run=*"):
        for x in system.globStatus(path(folder.getParent(), pattern)) or ():
            part = unquote(x.getPath().getName().split("=", 1)[1])
            if part not in known and x.getModificationTime() < limit:
                system.delete(x.getPath(), True)
                gone.append(part)
    return sorted(set(gone))
