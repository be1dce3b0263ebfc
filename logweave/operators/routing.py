"""Which objects of a listing are ingested, and as what.

All take a listing with a ``key`` column, the object's path below its bucket.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_PREFIX = "log/"
TIMELINE_MARK = "-timeline-"
MARKER = "_READY"


def with_key(listing: DataFrame, root: str) -> DataFrame:
    """Add ``key``: the path below ``root``; objects elsewhere are dropped."""
    scheme = r"\A[A-Za-z][A-Za-z0-9+.-]*:/*"
    base = F.regexp_replace(F.lit(root.rstrip("/") + "/"), scheme, "/")
    path = F.regexp_replace("path", scheme, "/")
    return listing.where(path.startswith(base)).withColumn("key", F.substr(path, F.length(base) + 1))


def accept_events(notices: DataFrame, event_type: str, bucket: str = "") -> DataFrame:
    """Notifications of one kind, and of one bucket if one is named."""
    kept = notices.where(F.col("event_type") == event_type)
    return kept.where(F.col("bucket") == bucket) if bucket else kept


def route_logs(listing: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Add ``log_type`` and ``reject`` (NULL if the object is to be ingested)."""
    key = F.col("key")
    rest = F.when(key.startswith(LOG_PREFIX), F.substr(key, F.lit(len(LOG_PREFIX) + 1)))
    log_type = F.when(F.contains(rest, F.lit("/")), F.substring_index(rest, "/", 1))
    reject = (
        F.when(rest.isNull(), F.lit("outside the log/ prefix"))
        .when(F.coalesce(log_type, F.lit("")) == "", F.lit("no log type in the path"))
        .when(~log_type.isin(*allowed), F.lit("log type not allowed"))
    )
    return listing.withColumn("log_type", F.nullif(log_type, F.lit(""))).withColumn("reject", reject)


def route_timelines(listing: DataFrame) -> DataFrame:
    """Add ``case_id`` and ``reject`` for ``<case>-timeline-<stamp>.jsonl``."""
    key = F.col("key")
    case = F.when(F.contains(key, F.lit(TIMELINE_MARK)), F.substring_index(key, TIMELINE_MARK, 1))
    reject = (
        F.when(~F.lower(key).endswith(".jsonl"), F.lit("not a timeline file"))
        .when(F.coalesce(case, F.lit("")) == "", F.lit("no case id in the name"))
    )
    return listing.withColumn("case_id", F.nullif(case, F.lit(""))).withColumn("reject", reject)


def _basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def _folder(key: Column) -> Column:
    base = _basename(key)
    return F.substr(key, F.lit(1), F.length(key) - F.length(base))


def markers(listing: DataFrame) -> DataFrame:
    """Completion markers, at any depth."""
    return listing.where(_basename(F.col("key")) == MARKER)


def ready_only(listing: DataFrame) -> DataFrame:
    """Objects whose folder holds a completion marker (the markers left out)."""
    folders = markers(listing).select(_folder(F.col("key")).alias("folder")).distinct()
    others = listing.where(_basename(F.col("key")) != MARKER)
    return others.withColumn("folder", _folder(F.col("key"))).join(
        folders, "folder", "left_semi"
    ).drop("folder")


def route_artifacts(listing: DataFrame, case_id: str) -> DataFrame:
    """Encrypted artifacts ``<device>.<case_id>`` with their ``device_name``."""
    base = _basename(F.col("key"))
    device = F.regexp_replace(base, r"\.[^.]*\z", "")
    return listing.where(F.lower("key").endswith("." + case_id.lower())).withColumn(
        "device_name", F.when(device == "", F.lit("unknown")).otherwise(device)
    )
