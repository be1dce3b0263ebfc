"""The fixed set of value transforms a mapping may name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# IANA protocol numbers that get a name.
PROTOCOLS = {"1": "ICMP", "6": "TCP", "17": "UDP"}

_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"


def lookup(c: Column, table: dict[str, str]) -> Column:
    """``table[c]``, or ``c`` itself where the table has no entry."""
    pairs = [F.lit(text) for entry in table.items() for text in entry]
    return F.coalesce(F.create_map(*pairs)[c], c)


def url_decode(c: Column) -> Column:
    """Percent-decoding with ``+`` as a blank; NULL on a malformed escape."""
    return F.when(~c.rlike(_BAD_ESCAPE), F.try_url_decode(c))


def proto_num(c: Column) -> Column:
    return lookup(c, PROTOCOLS)


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def _log_name(c: Column) -> tuple[Column, Column]:
    """``projects/<project>/logs/<id>`` cut at the first ``/logs/``."""
    at = F.instr(c, "/logs/")
    return F.substr(c, F.lit(1), at - 1), F.substr(c, at + 6)


def gcp_log_name_project(c: Column) -> Column:
    head, _ = _log_name(c)
    project = F.regexp_replace(head, r"\Aprojects/", "")
    return F.when(F.contains(c, F.lit("/logs/")), project).otherwise("")


def gcp_log_name_id(c: Column) -> Column:
    _, tail = _log_name(c)
    log_id = F.coalesce(url_decode(tail), tail)
    return F.when(F.contains(c, F.lit("/logs/")), log_id).otherwise("")


# The names a mapping may use.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "": lambda c: c,
    "upper": F.upper,
    "lower": F.lower,
    "url_decode": url_decode,
    "proto_num": proto_num,
    "basename": basename,
    "gcp_log_name_project": gcp_log_name_project,
    "gcp_log_name_id": gcp_log_name_id,
}

# Transforms that can refuse a value; NULL from one of them is a row error.
FALLIBLE = frozenset({"url_decode"})
