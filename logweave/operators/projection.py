"""A mapping's field list compiled to one projection over a record frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timestamps
from ..functions.strings import blank_to_null, event_uuid, int_or_zero, pinned
from ..functions.transforms import FALLIBLE, TRANSFORMS, lookup
from ..mapping import Field, Mapping
from ..schemas import NETWORK_COLUMNS, NETWORK_INTEGERS

# Source path -> value column; NULL (or '') where the record has no value.
Lookup = Callable[[str], Column]


def resolve(field: Field, find: Lookup) -> Column:
    """The first non-empty source, or the non-empty join parts put together."""
    if field.join:
        return blank_to_null(F.concat_ws(field.separator, *[find(p) for p in field.join if p]))
    found = [find(p) for p in field.source if p]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def substitute(field: Field, raw: Column) -> Column:
    """Value map on a resolved value; else the default, which skips the map."""
    value = lookup(raw, field.value_map) if field.value_map else raw
    if field.default:
        value = F.coalesce(value, F.lit(field.default))
    return blank_to_null(value) if "" in field.value_map.values() else value


def _first(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.coalesce(*columns)


def project(frame: DataFrame, mapping: Mapping, find: Lookup, keep: list[str]) -> DataFrame:
    """Columns of the network table, the ``keep`` columns and ``error``.

    ``frame`` has ``raw`` (the record's own text) and ``error`` (set if the
    record could not be read). Each step is its own projection: a value used
    several times by the next step is then computed once.
    """
    carried = [*keep, "raw", "error"]
    slots = [f"_f{i}" for i in range(len(mapping.fields))]
    stamps = [f"{s}_at" for s in slots]

    looked_up = {p: f"_p{i}" for i, p in enumerate(mapping.paths)}
    found = frame.select(*carried, *[find(p).alias(c) for p, c in looked_up.items()])
    resolved = found.select(*carried, *[
        resolve(f, lambda p: blank_to_null(F.col(looked_up[p]))).alias(s)
        for f, s in zip(mapping.fields, slots)
    ])
    settled = resolved.select(
        *carried, *[substitute(f, F.col(s)).alias(s) for f, s in zip(mapping.fields, slots)]
    )
    converted, problems = [], []
    for f, s, at in zip(mapping.fields, slots, stamps):
        if f.target == "event_timestamp":
            converted.append(timestamps.parse(F.col(s), f.transform).alias(at))
            problems.append(
                F.when(F.col(s).isNull(), F.lit("event_timestamp: no value"))
                .when(F.col(at).isNull(), F.concat(
                    F.lit(f"event_timestamp: not a {f.transform or 'rfc3339'} time: "), F.col(s)))
            )
        elif f.transform in FALLIBLE:
            converted.append(TRANSFORMS[f.transform](F.col(s)).alias(at))
            problems.append(F.when(F.col(s).isNotNull() & F.col(at).isNull(), F.concat(
                F.lit(f"{f.target}: {f.transform} refused: "), F.col(s))))
        elif f.transform:
            converted.append(TRANSFORMS[f.transform](F.col(s)).alias(at))
        else:
            converted.append(F.col(s).alias(at))
    # Only event_timestamp and fallible fields still need their input text.
    inputs = [
        s for f, s in zip(mapping.fields, slots)
        if f.target == "event_timestamp" or f.transform in FALLIBLE
    ]
    done = settled.select(*carried, *inputs, *converted)

    def column(name: str) -> Column:
        # The last field of a target that has a value wins.
        values = [F.col(at) for f, at in zip(mapping.fields, stamps) if f.target == name][::-1]
        if name == "event_uuid":
            return event_uuid(F.col("raw"))
        if name == "event_timestamp":
            return values[0]
        if name in NETWORK_INTEGERS:
            return int_or_zero(_first(values)) if values else F.lit(0).cast("bigint")
        return F.coalesce(*values, F.lit(""))

    return done.select(
        *[column(name).alias(name) for name in NETWORK_COLUMNS],
        *keep,
        F.col("raw").alias("raw_line"),
        pinned(F.coalesce("error", *problems)).alias("error"),
    )
