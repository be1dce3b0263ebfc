"""key=value tokenisers: one log line -> map<string,string>.

Quantifiers are possessive on purpose: Java's backtracking groups recurse per
repetition and overflow the stack on long values.

Both need ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (see ``session.configure``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import strip_quotes, trim_space

# A comma-separated field. One that starts with a quote runs to a quote that is
# followed by a comma or the line end; "" inside is one quote, and any other
# quote is an ordinary character. The line gets a comma in front, so that an
# empty first field is a field too.
_COMMA_FIELD = r',("[^"]*+(?:(?:""|"(?!,|\z))[^"]*+)*+"?|[^,]*+)'

_UNPRINTABLE = "[^ -~]"
_NO_EQUALS = r",[^=,]*+(?:,|\z)"

# A field up to its "=", in a line in which no field starts with a quote: the key
# without the blanks around it. A field without "=" is taken whole, and has no key.
_KEY = (
    r",(?:[^=,]*+(?=,|\z)|\p{IsWhite_Space}*+"
    r"((?:[^=,\p{IsWhite_Space}]++|\p{IsWhite_Space}++(?!=))*+)\p{IsWhite_Space}*+=)"
)

_SPACE_TOKEN = r'((?:[^ "]++|"[^"]*+(?:"|\z))++)'
# The key ends at the first "=" outside quotes.
_QUOTED_KEY = r'\A((?:[^"=]++|"[^"]*+(?:"|\z))*+)'


def _after(text: Column, prefix: Column) -> Column:
    """What follows ``prefix`` and the one character after it."""
    return F.substr(text, F.length(prefix) + 2)


def _unquote(field: Column) -> Column:
    bare = F.replace(F.regexp_replace(field, r'\A"|"\z', ""), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), bare).otherwise(field)


def _cut_comma_field(field: Column) -> Column:
    key = F.substring_index(field, "=", 1)
    # A field without "=" gets the key "", which no mapping can ask for.
    return F.struct(
        F.when(F.contains(field, F.lit("=")), key).otherwise("").alias("key"),
        _after(field, key).alias("value"),
    )


def _trim_key(pair: Column) -> Column:
    return F.struct(trim_space(pair["key"]).alias("key"), pair["value"].alias("value"))


def bare(value: Column) -> Column:
    """A value of ``comma_kv`` without the blanks, and then the quotes, around it."""
    return strip_quotes(trim_space(value))


def _is_uneven(led: Column) -> Column:
    """Lines to put in order first: a field without "=", blanks around a separator,
    anything but printable ASCII. Plain searches, and patterns of one simple class,
    keep the test itself cheap."""
    apart = [" ,", ", ", " =", "= "]
    found = [F.contains(led, F.lit(a)) for a in apart]
    return reduce(lambda a, b: a | b, found) | led.rlike(_UNPRINTABLE) | led.rlike(_NO_EQUALS)


def comma_kv(line: Column) -> Column:
    """``key=value,key2="value2"``. Fields without ``=`` are dropped.

    Values keep the blanks and quotes around them; ``bare`` takes them off the few
    that are looked up.

    Commas are protected only in a field that *starts* with a quote, so
    ``name="a,b"`` ends at the comma.
    """
    led = F.concat(F.lit(","), line)
    fields = F.regexp_extract_all(led, F.lit(_COMMA_FIELD), F.lit(1))
    pairs = F.transform(F.transform(fields, _unquote), _cut_comma_field)
    careful = F.map_from_entries(F.transform(pairs, _trim_key))
    # Work by the field, in lambdas, is dear: all but lines with a field that starts
    # with a quote are put in order by one search, and cut then.
    even = F.when(_is_uneven(led), F.regexp_replace(led, _KEY, ",$1=")).otherwise(line)
    return F.when(F.contains(led, F.lit(',"')), careful).otherwise(
        F.str_to_map(even, F.lit(","), F.lit("=")))


def _cut_space_token(token: Column) -> Column:
    simple = F.substring_index(token, "=", 1)
    key = F.when(
        F.contains(simple, F.lit('"')), F.regexp_extract(token, _QUOTED_KEY, 1)
    ).otherwise(simple)
    return F.struct(
        F.replace(key, F.lit('"'), F.lit("")).alias("key"),
        strip_quotes(_after(token, key)).alias("value"),
    )


def space_kv(line: Column) -> Column:
    """``key="a value" key2=value2``. Only U+0020 outside quotes separates."""
    tokens = F.regexp_extract_all(line, F.lit(_SPACE_TOKEN), F.lit(1))
    return F.map_from_entries(F.transform(tokens, _cut_space_token))
