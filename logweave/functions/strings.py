"""Small string helpers shared by the parsers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0        "
    "        　"
)

INTEGER = r"\A[+-]?[0-9]+\z"


def _is_printable(char: Column) -> Column:
    return F.ascii(char).between(ord("!"), ord("~"))


def trim_space(c: Column) -> Column:
    """Strip Unicode white space from both ends (``F.trim`` strips U+0020 only).

    Most texts start and end with a printable ASCII character; looking at those
    two first is far cheaper than a search in the trim set.
    """
    clean = _is_printable(c) & _is_printable(F.substring(c, -1, 1))
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def strip_quotes(c: Column) -> Column:
    return F.btrim(c, F.lit('"'))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def event_uuid(raw: Column) -> Column:
    """Lower-case hex SHA-256 of a record's text."""
    return F.sha2(raw, 256)


def to_int64(c: Column) -> Column:
    """Base-10 signed 64-bit integer, NULL for anything else.

    The pattern is needed because a cast would also accept blanks around it.
    """
    return F.when(c.rlike(INTEGER), c.try_cast("bigint"))


def int_or_zero(c: Column) -> Column:
    return F.coalesce(to_int64(c), F.lit(0).cast("bigint"))


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)``, with ``c`` worked out once however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def pinned(c: Column) -> Column:
    """``c`` itself, marked so that the optimizer leaves filters on it in place.

    A filter such as ``error IS NULL`` would otherwise be pushed below every
    projection of the parser, which repeats all of the parsing inside the
    filter, several times over. A filter on lines would go even further, below the
    shuffle that deals them out, and have the few tasks that read do the work. Spark
    does not move filters past a projection with a non-deterministic column; the
    partition id is one that costs nothing.
    """
    return F.when(F.spark_partition_id() >= 0, c)
