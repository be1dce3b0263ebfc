"""JSON leaves as text, read from a VARIANT column."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .strings import once

# Numbers the plain cast may have got wrong: fractions and exponents (to be
# written the short way), and integers that may not fit a double exactly. Those
# below 9 * 10^15 all fit, as 2^53 is more; epoch microseconds are among them.
_DOUBTFUL = r"\A-?(?:[0-9]+\.[0-9]+(?:E-?[0-9]+)?|9[0-9]{15}|[0-9]{17,})\z"
_EXPONENT = r"\A(-?)([0-9])\.([0-9]+)E(-?[0-9]+)\z"


# Marks the end of a text that was parsed; new in each process, so that no log
# line can hold it.
_END = uuid.uuid4().hex

# Where ``parse_one`` puts the value.
ROOT = "$[0]"


def parse_one(text: Column) -> Column:
    """VARIANT with the text's only JSON value at ``ROOT``; NULL if the text is
    anything else than exactly one value.

    Spark's parser stops after the first value and accepts whatever follows.
    Hence the value is parsed as the first of two elements of a list, which
    holds only if the value ends where the text does.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    return once(pair, lambda v: F.when(F.try_variant_get(v, "$[1]", "string") == _END, v))


def path_of(dotted: str) -> str:
    """``a.b`` -> ``$[0]['a']['b']``: object keys only, never array positions."""
    steps = []
    for key in dotted.split("."):
        quote = "'" if "'" not in key else '"'
        if quote in key:
            raise ValueError(f"JSON key cannot hold both kinds of quotes: {key!r}")
        steps.append(f"[{quote}{key}{quote}]")
    return ROOT + "".join(steps)


def double_text(d: Column) -> Column:
    """A double in plain decimals: ``6.0`` -> ``6``, ``1.0E-7`` -> ``0.0000001``."""
    text = d.cast("string")
    sign = F.regexp_extract(text, _EXPONENT, 1)
    digits = F.concat(
        F.regexp_extract(text, _EXPONENT, 2),
        F.rtrim(F.regexp_extract(text, _EXPONENT, 3), F.lit("0")),
    )
    exponent = F.regexp_extract(text, _EXPONENT, 4).try_cast("int")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    whole = F.concat(sign, F.rpad(digits, exponent + 1, "0"))
    tail = F.substr(digits, exponent + 2)
    large = F.when(tail == "", whole).otherwise(F.concat(whole, F.lit("."), tail))
    return (
        F.when(d == d.try_cast("bigint").cast("double"), d.try_cast("bigint").cast("string"))
        .when(exponent.isNull(), text)
        .when(exponent < 0, small)
        .otherwise(large)
    )


def _exact_text(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return (
        F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("string"))
        .when(
            kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
            double_text(v.try_cast("double")),
        )
        .otherwise(v.try_cast("string"))
    )


def _doubtful(plain: Column) -> Column:
    first = F.ascii(plain)
    nested = first.isin(ord("["), ord("{"))
    return nested | (first.between(ord("-"), ord("9")) & plain.rlike(_DOUBTFUL))


def with_leaves(frame: DataFrame, doc: str, leaves: dict[str, str]) -> DataFrame:
    """Add leaves of ``doc``, a ``parse_one`` column: column name -> dotted path.

    A leaf is NULL if missing, null, an object or an array; numbers go through a
    double, as the table contract has it. The cast is right for nearly all
    leaves. The doubtful ones are read again by the exact rule, in a lambda, which
    keeps that rule's code out of each field, but is slow: not for the other leaves.
    """
    variants = [F.when(F.col(f"{c}_doubt"), F.try_variant_get(doc, path_of(p), "variant")) for c, p in leaves.items()]
    plain = frame.select(
        "*", *[F.try_variant_get(doc, path_of(p), "string").alias(f"{c}_cast") for c, p in leaves.items()]
    )
    doubts = [_doubtful(F.col(f"{c}_cast")).alias(f"{c}_doubt") for c in leaves]
    marked = plain.select("*", *doubts)
    any_doubt = reduce(lambda a, b: a | b, [F.coalesce(f"{c}_doubt", F.lit(False)) for c in leaves])
    exact = marked.withColumn(
        "exact", F.when(any_doubt, F.transform(F.array(*variants), _exact_text))
    )
    return exact.select(*frame.columns, *[
        F.when(F.col(f"{c}_doubt"), F.get("exact", F.lit(i))).otherwise(F.col(f"{c}_cast")).alias(c)
        for i, c in enumerate(leaves)
    ], *[F.col(f"{c}_doubt") for c in leaves])
