"""Correlation queries over the network and the timeline table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ZONE = "Asia/Tokyo"

# Positions in the string list of a Windows logon event, from 0.
LOGON_SUCCESS, LOGON_FAILURE = 4624, 4625
_USER = 5
_WORKSTATION = {LOGON_SUCCESS: 11, LOGON_FAILURE: 13}
_ADDRESS = {LOGON_SUCCESS: 18, LOGON_FAILURE: 19}
_EVENT_LOG = "windows:evtx:record"
# The list ends at the first "]", whatever it belongs to.
_STRINGS = r"(?d)Strings:[\t\n\f\r ]*\[(.*?)\]"
_ITEM = "'([^']*)'"


def _local(zone: str) -> Column:
    return F.from_utc_timestamp("event_timestamp", zone).cast("timestamp_ntz")


def _no_text() -> Column:
    return F.lit(None).cast("string")


def nexus_events(network: DataFrame, timeline: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """One time line over both tables, with UTC and local time."""
    net = network.where(F.col("event_timestamp").isNotNull()).select(
        F.col("event_timestamp").alias("utc_timestamp"),
        _local(zone).alias("local_datetime"),
        F.lit("network").alias("log_source"),
        "device_name",
        F.col("user_name").alias("username"),
        "src_ip", "dst_ip", "dst_port", "action",
        F.concat(
            F.coalesce("log_type", F.lit("")), F.lit(": "),
            F.coalesce("threat_name", "action", F.lit("")),
        ).alias("summary_detail"),
        "event_uuid",
    )
    endpoint = timeline.where(F.col("event_timestamp").isNotNull()).select(
        F.col("event_timestamp").alias("utc_timestamp"),
        _local(zone).alias("local_datetime"),
        F.lit("endpoint").alias("log_source"),
        "device_name", "username",
        _no_text().alias("src_ip"), _no_text().alias("dst_ip"),
        F.lit(None).cast("bigint").alias("dst_port"), _no_text().alias("action"),
        F.concat(
            F.lit("["), F.coalesce("parser", F.lit("unknown")), F.lit("] "),
            F.coalesce("message", F.lit("")),
        ).alias("summary_detail"),
        "event_uuid",
    )
    return net.unionByName(endpoint)


def logon_nexus(
    network: DataFrame, timeline: DataFrame, since: datetime | str | Column | None = None
) -> DataFrame:
    """Windows logons, successful and failed, beside all network rows.

    ``since`` bounds the logons (not the network rows) from below: a time, or a
    column such as ``F.current_timestamp() - F.expr("INTERVAL 90 DAYS")``. Both
    kinds of logon come from one scan; only their list positions differ.
    """
    kind = F.col("event_identifier")
    wanted = (
        (F.col("data_type") == _EVENT_LOG)
        & kind.isin(LOGON_SUCCESS, LOGON_FAILURE)
        & F.col("message").isNotNull()
    )
    if since is not None:
        bound = since if isinstance(since, Column) else F.lit(since).cast("timestamp")
        wanted = wanted & (F.col("event_timestamp") >= bound)

    def position(of: dict[int, int]) -> Column:
        return F.when(kind == LOGON_SUCCESS, F.lit(of[LOGON_SUCCESS])).otherwise(F.lit(of[LOGON_FAILURE]))

    strings = F.regexp_extract_all(
        F.regexp_extract("message", _STRINGS, 1), F.lit(_ITEM), F.lit(1)
    )
    logons = (
        timeline.where(wanted)
        .select("event_timestamp", "event_uuid", "device_name", "event_identifier", strings.alias("strings"))
        .select(
            "event_timestamp", "event_uuid",
            F.get("strings", position(_ADDRESS)).alias("src_ip"),
            F.get("strings", position(_WORKSTATION)).alias("src_name"),
            _no_text().alias("dst_ip"),
            F.col("device_name").alias("dst_name"),
            F.get("strings", F.lit(_USER)).alias("user_name"),
        )
    )
    flows = network.select(
        "event_timestamp", "event_uuid", "src_ip", _no_text().alias("src_name"),
        "dst_ip", _no_text().alias("dst_name"), "user_name",
    )
    return logons.union(flows)
