"""Text -> TIMESTAMP (UTC). Every function gives NULL where the text does not fit."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import INTEGER, once

# The transform names a mapping may use for event_timestamp.
NAMED = ("", "rfc3339", "rfc3339nano", "unix", "unix_ms", "aws_suricata", "auto")
LAYOUT_PREFIX = "layout:"

# Seconds of 0001-01-01 and 9999-12-31T23:59:59, the range of the TIMESTAMP
# columns. Conversions of larger numbers would throw and fail the job.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799

_CLOCK = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{1,2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?"
_RFC3339 = rf"\A{_CLOCK}(?:Z|[+-][0-9]{{2}}:[0-9]{{2}})\z"
_SURICATA = rf"\A{_CLOCK}[+-][0-9]{{4}}\z"


def _cast(iso: Column) -> Column:
    ts = F.replace(iso, F.lit(","), F.lit(".")).try_cast("timestamp")
    first = F.lit("0001-01-01T00:00:00Z").cast("timestamp")
    last = F.lit("9999-12-31T23:59:59.999999Z").cast("timestamp")
    return once(ts, lambda t: F.when(t.between(first, last), t))


def rfc3339(c: Column) -> Column:
    """``2026-09-16T11:59:59.5+09:00``; the guard keeps looser forms out of the cast."""
    return F.when(c.rlike(_RFC3339), _cast(c))


def unix_seconds(c: Column) -> Column:
    n = c.try_cast("bigint")
    return F.when(
        c.rlike(INTEGER), F.when(n.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(n))
    )


def unix_millis(c: Column) -> Column:
    n = c.try_cast("bigint")
    fits = n.between(_FIRST_SECOND * 1000, _LAST_SECOND * 1000 + 999)
    return F.when(c.rlike(INTEGER), F.when(fits, F.timestamp_millis(n)))


def micros(n: Column) -> Column:
    """Epoch microseconds (BIGINT)."""
    return F.when(
        n.between(_FIRST_SECOND * 10**6, _LAST_SECOND * 10**6 + 999999), F.timestamp_micros(n)
    )


def suricata(c: Column) -> Column:
    """RFC 3339 with an offset without colon, ``+0000``."""
    head = F.substr(c, F.lit(1), F.length(c) - 2)
    return F.when(c.rlike(_SURICATA), _cast(F.concat(head, F.lit(":"), F.right(c, F.lit(2)))))


def auto(c: Column) -> Column:
    """Epoch seconds, then RFC 3339, then two plain date-time layouts."""
    return F.coalesce(
        unix_seconds(c),
        rfc3339(c),
        from_layout(c, "2006-01-02 15:04:05"),
        from_layout(c, "2006/01/02 15:04:05"),
    )


# --- reference-time layouts --------------------------------------------------

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_LONG_MONTHS = ("January|February|March|April|May|June|July|August|September|October"
                "|November|December")
_SHORT_MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
_LONG_DAYS = "Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
_SHORT_DAYS = "Mon|Tue|Wed|Thu|Fri|Sat|Sun"

# Layout element -> (what it sets, pattern of its text).
# The reference time is Mon Jan 2 15:04:05 MST 2006.
_ELEMENTS = {
    "January": ("month_name", f"(?i:{_LONG_MONTHS})"),
    "Jan": ("month_name", f"(?i:{_SHORT_MONTHS})"),
    "Monday": ("", f"(?i:{_LONG_DAYS})"),
    "Mon": ("", f"(?i:{_SHORT_DAYS})"),
    "MST": ("", "[A-Z]{3,5}"),
    "2006": ("year", "[0-9]{4}"),
    "Z07:00": ("offset", "Z|[+-][0-9]{2}:[0-9]{2}"),
    "Z0700": ("offset", "Z|[+-][0-9]{4}"),
    "Z07": ("offset", "Z|[+-][0-9]{2}"),
    "-07:00": ("offset", "[+-][0-9]{2}:[0-9]{2}"),
    "-0700": ("offset", "[+-][0-9]{4}"),
    "-07": ("offset", "[+-][0-9]{2}"),
    "002": ("year_day", "[0-9]{3}"),
    "01": ("month", "[0-9]{2}"),
    "02": ("day", "[0-9]{2}"),
    "03": ("hour", "[0-9]{2}"),
    "04": ("minute", "[0-9]{2}"),
    "05": ("second", "[0-9]{2}"),
    "06": ("short_year", "[0-9]{2}"),
    "15": ("hour", "[0-9]{1,2}"),
    "PM": ("half", "AM|PM"),
    "pm": ("half", "am|pm"),
    "_2": ("day", " ?[0-9]{1,2}"),
    "1": ("month", "[0-9]{1,2}"),
    "2": ("day", "[0-9]{1,2}"),
    "3": ("hour", "[0-9]{1,2}"),
    "4": ("minute", "[0-9]{1,2}"),
    "5": ("second", "[0-9]{1,2}"),
}
_SECONDS = ("05", "5")
_FRACTION = re.compile(r"[.,](0+|9+)(?![0-9])")
_TOKEN = re.compile("|".join(
    re.escape(e) for e in sorted(_ELEMENTS, key=len, reverse=True)
) + "| +")


@dataclass(frozen=True)
class Layout:
    pattern: str          # whole-text Java regex with one group per part
    parts: tuple[str, ...]  # what each group sets


def compile_layout(layout: str) -> Layout:
    """Translate a reference-time layout to a regex and its parts.

    A run of blanks in the layout stands for one or more blanks, and a fraction
    is accepted after the seconds even where the layout has none.
    """
    out, parts, twelve = [], [], False
    pos = 0
    while pos < len(layout):
        fraction = _FRACTION.match(layout, pos)
        token = _TOKEN.match(layout, pos)
        if fraction:
            digits = fraction.group(1)
            exact = rf"[.,][0-9]{{{len(digits)}}}"
            out.append(f"({exact})" if digits[0] == "0" else "([.,][0-9]+)?")
            parts.append("fraction")
            pos = fraction.end()
        elif token and token.group().startswith(" "):
            out.append(r"(?: +|\z)")
            pos = token.end()
        elif token:
            what, pattern = _ELEMENTS[token.group()]
            twelve = twelve or token.group() in ("3", "03")
            out.append(f"({pattern})" if what else f"(?:{pattern})")
            if what:
                parts.append(what)
            pos = token.end()
            if token.group() in _SECONDS and not _FRACTION.match(layout, pos):
                out.append("([.,][0-9]+)?")
                parts.append("fraction")
        else:
            out.append(re.escape(layout[pos]))
            pos += 1
    if twelve:
        parts = ["hour12" if p == "hour" else p for p in parts]
    return Layout(r"\A" + "".join(out) + r"\z", tuple(parts))


_SEPARATOR = "\x01"


def from_layout(c: Column, layout: str) -> Column:
    """Parse by a reference-time layout; no offset in the layout means UTC.

    One match rewrites the text to its parts, joined by a separator.
    """
    spec = compile_layout(layout)
    groups = "".join(f"{_SEPARATOR}${n}" for n in range(1, len(spec.parts) + 1))
    rewritten = F.regexp_replace(c, spec.pattern, groups or _SEPARATOR)
    fits = ~F.contains(c, F.lit(_SEPARATOR))
    return F.when(fits, once(
        F.split(rewritten, _SEPARATOR, -1),
        lambda parts: F.when(F.get(parts, F.lit(0)) == "", _assemble(parts, spec.parts)),
    ))


def _assemble(texts: Column, names: tuple[str, ...]) -> Column:
    """Timestamp from the parts of one match; ``texts`` starts with an empty one."""

    def part(name: str, absent: str) -> Column:
        if name not in names:
            return F.lit(absent)
        # The last element that sets a part wins.
        at = len(names) - names[::-1].index(name)
        return F.trim(F.get(texts, F.lit(at)))

    year = part("year", "0000")
    if "year" not in names and "short_year" in names:
        short = part("short_year", "").try_cast("int")
        year = F.when(short >= 69, short + 1900).otherwise(short + 2000).cast("string")
    month = part("month", "1")
    if "month" not in names and "month_name" in names:
        name = F.lower(F.substr(part("month_name", ""), F.lit(1), F.lit(3)))
        month = F.floor((F.instr(F.lit(_MONTHS), name) + 2) / 3).cast("string")
    hour = part("hour", "0")
    if "hour12" in names:
        hour = F.when(part("hour12", "").try_cast("int") <= 12, part("hour12", ""))
    if "half" in names:
        half, h = F.upper(part("half", "")), hour.try_cast("int")
        hour = (
            F.when((half == "PM") & (h < 12), h + 12).when((half == "AM") & (h == 12), F.lit(0)).otherwise(h)
        ).cast("string")
    offset = part("offset", "Z")
    if "offset" in names:
        offset = F.regexp_replace(offset, r"\A([+-][0-9]{2}):?([0-9]{2})?\z", "$1:$2")
        offset = F.when(offset.endswith(":"), F.concat(offset, F.lit("00"))).otherwise(offset)
    by_year_day = "year_day" in names
    iso = F.concat(
        year, F.lit("-"), F.lit("1") if by_year_day else month, F.lit("-"),
        F.lit("1") if by_year_day else part("day", "1"), F.lit("T"),
        hour, F.lit(":"), part("minute", "0"), F.lit(":"), part("second", "0"), part("fraction", ""), offset,
    )
    if not by_year_day:
        return _cast(iso)
    day = part("year_day", "").try_cast("int")

    def moved(ts: Column) -> Column:
        later = ts + F.make_dt_interval(days=day - 1)
        return F.when((day >= 1) & (F.year(later) == F.year(ts)), later)

    return once(_cast(iso), moved)


def is_timestamp_transform(name: str) -> bool:
    return name in NAMED or name.startswith(LAYOUT_PREFIX)


def parse(c: Column, transform: str) -> Column:
    """Apply the named event_timestamp transform."""
    if transform.startswith(LAYOUT_PREFIX):
        return from_layout(c, transform[len(LAYOUT_PREFIX):])
    named = {
        "": rfc3339, "rfc3339": rfc3339, "rfc3339nano": rfc3339,
        "unix": unix_seconds, "unix_ms": unix_millis,
        "aws_suricata": suricata, "auto": auto,
    }
    return named[transform](c)
