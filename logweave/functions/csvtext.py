"""Delimited text: one record -> array<string>, with strict quoting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiter names of a CSV mapping.
DELIMITERS = {"": ",", "comma": ",", "space": " ", "tab": "\t", "pipe": "|"}

_QUOTED = r'"(?:[^"]++|"")*+"'


def _field(d: str) -> str:
    return rf'(?:{_QUOTED}|[^"{re.escape(d)}]*+)'


def is_valid(record: Column, d: str) -> Column:
    """No quote inside an unquoted field, nothing between a closing quote and
    the next delimiter, every quote closed."""
    f, sep = _field(d), re.escape(d)
    return ~F.contains(record, F.lit('"')) | record.rlike(rf"\A{f}(?:{sep}{f})*+\z")


def open_end(d: str) -> str:
    """Pattern, but for its end, of a line that starts outside quotes and ends inside a quoted field."""
    f, sep = _field(d), re.escape(d)
    return rf'\A(?:{f}{sep})*+"(?:[^"]++|"")*+'


def fields(record: Column, d: str) -> Column:
    """The fields of a valid record, unquoted."""
    sep = re.escape(d)
    quoted = F.transform(
        F.regexp_extract_all(
            F.concat(F.lit(d), record), F.lit(rf'{sep}({_QUOTED}|[^"{sep}]*+)'), F.lit(1)
        ),
        lambda t: F.when(
            t.startswith('"'),
            F.replace(F.substr(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(t),
    )
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, sep, -1))
