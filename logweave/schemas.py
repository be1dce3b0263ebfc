"""Fixed table schemas. Names, order and types are the tables' contract."""

from __future__ import annotations

from pyspark.sql import types as T

# The network table's columns in table order.
NETWORK_COLUMNS = (
    "event_timestamp", "device_name", "log_type", "action", "rule_id", "rule_name",
    "direction", "src_ip", "src_port", "dst_ip", "dst_port", "protocol", "ing_if",
    "egr_if", "vpn_remote_ip", "nat_src_ip", "nat_src_port", "nat_dst_ip",
    "nat_dst_port", "user_name", "app_name", "sent_bytes", "rcvd_bytes", "duration",
    "threat_name", "event_uuid",
)
NETWORK_INTEGERS = frozenset({
    "src_port", "dst_port", "nat_src_port", "nat_dst_port",
    "sent_bytes", "rcvd_bytes", "duration",
})
# event_uuid is computed, everything else may be a mapping target.
NETWORK_TARGETS = frozenset(NETWORK_COLUMNS) - {"event_uuid"}

# The timeline table's columns in table order.
TIMELINE_COLUMNS = (
    "event_timestamp", "timestamp_desc", "device_name", "parser", "display_name",
    "message", "data_type", "event_identifier", "username", "tag", "event_uuid",
)


def _network_type(name: str) -> T.DataType:
    if name == "event_timestamp":
        return T.TimestampType()
    return T.LongType() if name in NETWORK_INTEGERS else T.StringType()


def _timeline_type(name: str) -> T.DataType:
    special = {
        "event_timestamp": T.TimestampType(),
        "event_identifier": T.LongType(),
        "tag": T.ArrayType(T.StringType()),
    }
    return special.get(name, T.StringType())


NETWORK_EVENTS = T.StructType([
    T.StructField(c, _network_type(c), nullable=c != "event_timestamp") for c in NETWORK_COLUMNS
])
TIMELINE_EVENTS = T.StructType([
    T.StructField(c, _timeline_type(c), nullable=c != "device_name") for c in TIMELINE_COLUMNS
])
QUARANTINE = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("line_number", T.LongType()),
    T.StructField("raw_line", T.StringType()),
    T.StructField("error", T.StringType()),
])
