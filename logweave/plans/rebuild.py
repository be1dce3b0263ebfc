"""The logon table kept up to date by days.

Every commit of the network and the timeline table names the days of which it has rows. A
rebuild compares the commits it sees with those that the last rebuild had seen and computes
the days of the difference alone. What it writes is one part; from its commit on that part
stands for all of these days, also for those of which nothing is left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits
from .correlate import logon_nexus
from .sinks import scan_network, scan_timeline

_RUN = "logons"


def _last(spark: SparkSession, table: str) -> tuple[dict[str, list[str]], str | None]:
    """What the last rebuild had seen: parts with their days, and its bound."""
    row = commits.commits(spark, table).orderBy(F.desc("at")).select("applied", "since").first()
    return ({x["part"]: x["days"] for x in row["applied"]}, row["since"]) if row else ({}, None)


def _seen(spark: SparkSession, network: str, timeline: str) -> dict[str, list[str]]:
    """All visible parts of both tables; a row for each run, as their commits are."""
    return {
        f"{kind}/{row.part}": row.days
        for kind, table in (("network", network), ("timeline", timeline)) if commits.has_commits(spark, table)
        for row in commits.parts(spark, table).toLocalIterator()
    }


def rebuild_logons(
    spark: SparkSession, network: str, timeline: str, table: str, since: datetime | str | None = None, whole: bool = False,
) -> list[str]:
    """Bring ``table`` up to date with both tables; returns the days that were computed anew.

    ``since`` bounds the logons as in ``correlate.logon_nexus``; where it has moved, the days
    between are computed too. ``whole`` computes all days.
    """
    bound = since.isoformat(sep=" ") if isinstance(since, datetime) else since
    now = _seen(spark, network, timeline)
    before, old_bound = ({}, None) if whole else _last(spark, table)
    differ = [(now.get(p) or before.get(p)) for p in now.keys() ^ before.keys()]
    days = {d for some in differ for d in some}
    if before and bound != old_bound:
        low, high = sorted(((old_bound or "")[:10], (bound or "")[:10]))
        days |= {d for some in now.values() for d in some if d == commits.NO_DAY or low <= d <= (high or "9999")}
    if whole and commits.has_commits(spark, table):
        days |= {d for row in commits.parts(spark, table).toLocalIterator() for d in row.days}
    if not days:
        return []
    rows = logon_nexus(
        scan_network(spark, network, days=sorted(days)), scan_timeline(spark, timeline, days=sorted(days)), since=bound)
    part = commits.new_part(spark, table, _RUN)
    laid = rows.withColumn("event_date", F.to_date("event_timestamp")).withColumn("run", F.lit(part)).hint("rebalance", F.col("event_date"))
    laid.write.mode("append").partitionBy("run", "event_date").parquet(table)
    # Each rebuild is a commit of its own: earlier ones still stand for the other days.
    commits.commit(spark, table, part, [{"part": part, "days": sorted(days)}],
                   applied=[{"part": p, "days": d} for p, d in sorted(now.items())], since=bound)
    return sorted(days)


def scan_logons(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the logon table: of each day those of the last rebuild that computed it."""
    owner = commits.parts(spark, table).select("part", "at", F.explode("days").alias("day")).groupBy("day").agg(F.max_by("part", "at").alias("part"))
    rows = spark.read.parquet(table)
    day = F.to_date(F.nullif("day", F.lit(commits.NO_DAY)))
    held = rows.join(owner, (F.col("run") == F.col("part")) & F.col("event_date").eqNullSafe(day), "left_semi")
    return held.drop("run", "event_date")
