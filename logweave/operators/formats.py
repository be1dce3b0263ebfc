"""Record formats: line frame -> record frame plus a way to look values up.

A record frame has ``source_file, block, seq, raw, error`` and whatever columns
the format's lookup reads. ``raw`` is the text the event id is the hash of.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import csvtext, kv, regexes
from ..functions.jsontext import resumed, split_records
from ..functions.strings import pinned, strip_quotes, trim_space
from ..functions.variants import parse_one, with_leaves
from ..mapping import Mapping
from ..session import counted
from ..sources import multiline
from .projection import Lookup

PLACE = ["source_file", "block", "seq"]

# Fixed value: the strict form takes only key=value and free-text lines shorter than this.
MAX_LINE_BYTES = 1 << 20


@dataclass(frozen=True)
class Options:
    """How to read; the mapping says what.

    multiline  "auto" looks for files with records that span lines, at the cost
               of one more pass over the input; True and False skip that look.
    header     names of the header row all CSV files share; a file whose first
               record is that row loses it.
    one_per_line  every JSON line is one record (and nothing is an array or an
               envelope): the whole job then stays in the JVM.
    max_line_bytes  key=value and free-text lines this long or longer are row
               errors; None, the default, takes lines of any length.
    """

    multiline: bool | str = "auto"
    header: tuple[str, ...] | None = None
    one_per_line: bool = False
    max_line_bytes: int | None = None


Reader = Callable[[DataFrame, Mapping, Options], tuple[DataFrame, Lookup]]


def _trimmed_lines(lines: DataFrame, limit: int | None) -> DataFrame:
    """Non-blank lines, trimmed; those beyond a limit get an error and no text to parse."""
    too_long = F.lit(False) if limit is None else F.octet_length("value") >= limit
    return (
        lines.select(
            *PLACE, pinned(trim_space(F.col("value"))).alias("raw"),
            F.when(too_long, F.lit(f"line exceeds {limit} byte limit")).alias("error"),
        )
        .where(F.col("raw") != "")
        .withColumn("text", F.when(F.col("error").isNull(), F.col("raw")))
    )


def read_kv(lines: DataFrame, mapping: Mapping, options: Options) -> tuple[DataFrame, Lookup]:
    tokenise, bare = (kv.space_kv, strip_quotes) if mapping.delimiter == "space" else (kv.comma_kv, kv.bare)
    frame = _trimmed_lines(lines, options.max_line_bytes).withColumn("pairs", tokenise(F.col("text"))).drop("text")
    return frame, lambda key: bare(F.col("pairs")[key])


def read_regex(lines: DataFrame, mapping: Mapping, options: Options) -> tuple[DataFrame, Lookup]:
    """Patterns in order, the first that matches wins; none is a row error."""
    frame = _trimmed_lines(lines, options.max_line_bytes)
    matched = []
    for number, pattern in enumerate(mapping.patterns):
        line = F.col("text")
        if matched:   # tried only on lines no earlier pattern took
            line = F.when(F.coalesce(*[F.col(m) for m in matched]).isNull(), line)
        matched.append(f"match{number}")
        frame = frame.withColumn("joined", regexes.joined_captures(line, pattern.java)).withColumn(
            matched[-1], regexes.captures(line, F.col("joined"), pattern.java)
        )
    none = F.coalesce(*[F.col(m) for m in matched]).isNull()
    frame = frame.withColumn("error", F.coalesce(
        "error", F.when(none, F.lit(f"line matches none of {len(matched)} patterns"))
    )).drop("text", "joined")

    def find(name: str) -> Column:
        values = [F.lit(None).cast("string")]
        for column, pattern in zip(matched, mapping.patterns):
            if name in pattern.java.names:   # a capture wins over a constant
                values.append(F.get(F.col(column), F.lit(pattern.java.names[name] - 1)))
            elif pattern.consts.get(name):
                values.append(F.when(F.col(column).isNotNull(), F.lit(pattern.consts[name])))
        return F.coalesce(*values)

    return frame, find


# --- JSON --------------------------------------------------------------------

_JSON_SPACE = " \t\r\n"
_RECORDS = "array<struct<raw:binary,error:string>>"


def _cut(body: bytes, record_path: str) -> list[tuple[bytes, str | None]]:
    """Records of a text with their own bytes, those that are no UTF-8 included."""
    text = body.decode("utf-8", "surrogateescape")
    rows = list(split_records(text, record_path))
    if "\n" in text and rows and rows[-1][1] and rows[-1][1].startswith("invalid JSON"):
        # Lines brought together that make no JSON were no unit: a line was cut off.
        rows = [r for unit in resumed(text) for r in split_records(unit, record_path)]
    return [(record.strip().encode("utf-8", "surrogateescape"), error) for record, error in rows]


def _cutter(record_path: str):
    @F.pandas_udf(_RECORDS)
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [
            {"raw": raw, "error": error} for raw, error in _cut(t, record_path)
        ])

    def records(text: Column) -> Column:
        return F.transform(cut(text.cast("binary")), lambda r: F.struct(
            r["raw"].cast("string").alias("raw"), r["error"].alias("error")
        ))

    return records


def json_records(values: DataFrame, record_path: str, one_per_row: bool = False) -> DataFrame:
    """Rows of ``PLACE, raw`` with complete top-level values -> a row per record.

    Rows that are one record already, by far the most in practice, stay in the
    JVM; only the text of the others is sent to Python, as only a scanner can cut
    an element out of an envelope byte for byte. ``one_per_row`` promises that
    there are no others.
    """
    records = values.withColumn("doc", parse_one(F.col("raw")))
    if one_per_row:
        records = records.withColumn("error", F.lit(None).cast("string"))
    else:
        starts = F.lit("[{" if record_path else "[")
        records = records.withColumn(
            "one", F.col("doc").isNotNull() & ~F.contains(starts, F.left("raw", F.lit(1)))
        )
        text = F.when(~F.col("one"), F.col("raw"))
        records = records.withColumn("pieces", _cutter(record_path)(text))
        itself = F.array(F.struct("raw", F.lit(None).cast("string").alias("error")))
        records = records.select(
            *PLACE, "doc", "one", F.explode(F.when(F.col("one"), itself).otherwise(F.col("pieces"))).alias("r")
        ).select(*PLACE, "r.raw", "r.error", F.when(F.col("one"), F.col("doc")).when(
            F.col("r.error").isNull(), parse_one(F.col("r.raw"))).alias("doc"))
    return records.withColumn(
        "error", F.coalesce("error", F.when(F.col("doc").isNull(), F.lit("invalid JSON")))
    )


def read_json(lines: DataFrame, mapping: Mapping, options: Options) -> tuple[DataFrame, Lookup]:
    one_per_row = options.one_per_line
    text = F.col("value")
    if options.multiline is not False and not one_per_row:
        flagged = multiline.with_json_flags(lines.select(*PLACE, "value"))
        surveyed = multiline.survey(flagged, quoted=False)
        # A line of complete values closes every bracket it opens.
        if options.multiline is True or not surveyed.where("broken").isEmpty():
            lines, text = multiline.records(flagged, surveyed, quoted=False), F.col("raw")
    values = lines.select(*PLACE, pinned(F.btrim(text, F.lit(_JSON_SPACE))).alias("raw")).where(F.col("raw") != "")
    frame = json_records(values, mapping.record_path, one_per_row)
    leaves = {f"leaf{i}": p for i, p in enumerate(mapping.paths)}
    columns = {p: c for c, p in leaves.items()}
    frame = with_leaves(frame, "doc", leaves) if leaves else frame
    return frame, lambda path: F.col(columns[path])


# --- CSV ---------------------------------------------------------------------


def _header_name(name: str) -> str:
    return name.strip().lower()


def _position(path: str) -> int | None:
    """1-based position of a ``col:N`` path; 0 if N is no position; None if a name."""
    if not path.startswith("col:"):
        return None
    digits = path[len("col:"):]
    return max(int(digits), 0) if re.fullmatch(r"[+-]?[0-9]+", digits) else 0


def _headers(firsts: DataFrame, delimiter: str, names: list[str]) -> DataFrame:
    """Each file's own header: where it is and ``at``, the 0-based position of
    every wanted name in it (NULL if absent; the last of equal names counts)."""
    cells = F.transform(
        csvtext.fields(F.col("first.raw"), delimiter), lambda c: F.lower(trim_space(c))
    )
    last_of = [
        F.array_max(F.filter(
            F.transform(F.col("cells"), lambda c, i: F.when(c == name, i)), lambda i: i.isNotNull()
        ))
        for name in names
    ]
    return firsts.select(
        "source_file",
        F.col("first.block").alias("header_block"), F.col("first.seq").alias("header_seq"),
        cells.alias("cells"), csvtext.is_valid(F.col("first.raw"), delimiter).alias("header_ok"),
    ).select(
        "source_file", "header_block", "header_seq", "header_ok",
        (F.array(*last_of) if names else F.array().cast("array<int>")).alias("at"),
    )


def _csv_records(
    lines: DataFrame, delimiter: str, options: Options, names: list[str] | None
) -> DataFrame:
    """Line frame -> rows of ``PLACE, raw`` with one record's text each.

    With ``names``, the names to look for in each file's header, also ``at`` and
    ``header_ok``, and without the header rows. All that must be known about a
    file beforehand (does a record span lines, what is its first record) comes
    from one look at the input, a row for each block.
    """
    plain = lines.select(*PLACE, F.when(
        F.endswith("value", F.lit("\r")), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value")).alias("value"))
    flagged = multiline.with_csv_flags(plain, delimiter, spanning=options.multiline is not False)
    surveyed = None
    if options.multiline is not False or names is not None:
        surveyed = multiline.survey(flagged, quoted=True, first=names is not None)
    if options.multiline is True or (options.multiline == "auto" and not surveyed.where("broken").isEmpty()):
        records = multiline.records(flagged, surveyed, quoted=True)
    else:
        records = plain.select(*PLACE, pinned(F.col("value")).alias("raw")).where(F.col("raw") != "")
    if names is None:
        return records
    first = F.struct("block", F.col("record_seq").alias("seq"), F.col("record").cast("string").alias("raw"))
    firsts = surveyed.where("record_seq IS NOT NULL").groupBy("source_file").agg(F.min(first).alias("first"))
    bound = records.join(counted(_headers(firsts, delimiter, names)), "source_file")
    is_header = (F.col("block") == F.col("header_block")) & (F.col("seq") == F.col("header_seq"))
    return bound.where(~is_header | ~F.col("header_ok")).drop("header_block", "header_seq")


def read_csv(lines: DataFrame, mapping: Mapping, options: Options) -> tuple[DataFrame, Lookup]:
    d = csvtext.DELIMITERS[mapping.delimiter]
    names = list(dict.fromkeys(_header_name(p) for p in mapping.paths if _position(p) is None))
    own_header = mapping.has_header and options.header is None
    records = _csv_records(lines, d, options, names if own_header else None)
    ok = csvtext.is_valid(F.col("raw"), d)
    problem = F.when(~ok, F.lit("csv: stray or unclosed quote"))
    index: dict[str, Column] = {}
    if mapping.has_header and options.header is not None:
        shared = {_header_name(n): i for i, n in enumerate(options.header)}
        index = {n: F.lit(shared[n]) for n in names if n in shared}
        heading = F.transform(
            csvtext.fields(F.col("raw"), d), lambda c: F.lower(trim_space(c))
        ) == F.array(*[F.lit(_header_name(n)) for n in options.header])
        # Only the first record of a file is a header; an equal row further on is data.
        firsts = lines.where(~F.col("value").isin("", "\r")).groupBy("source_file").agg(F.min(F.struct("block", "seq")).alias("first"))
        is_first = F.struct("block", "seq") == F.col("first")
        records = records.join(counted(firsts), "source_file").where(~(is_first & F.coalesce(heading, F.lit(False)))).drop("first")
    elif mapping.has_header:
        problem = F.when(~F.col("header_ok"), F.lit("csv: unreadable header row")).otherwise(problem)
        index = {n: F.get(F.col("at"), F.lit(i)) for i, n in enumerate(names)}
    frame = records.select(
        *PLACE, "raw", problem.alias("error"), *(["at"] if "at" in records.columns else [])
    ).withColumn("fields", F.when(F.col("error").isNull(), csvtext.fields(F.col("raw"), d)))
    # The id is the hash of the unquoted fields joined by commas.
    frame = frame.withColumn("raw", F.coalesce(
        F.when(F.col("fields").isNotNull(), F.concat_ws(",", "fields")), F.col("raw")
    ))

    def find(path: str) -> Column:
        position = _position(path)
        if position is None:
            at = index.get(_header_name(path))
            return F.lit(None).cast("string") if at is None else F.get("fields", at)
        if position == 0:
            return F.lit(None).cast("string")
        return F.get("fields", F.lit(position - 1))

    return frame, find


FORMATS: dict[str, Reader] = {
    "kv": read_kv, "regex": read_regex, "json": read_json, "csv": read_csv,
}

# Readers for whole log types, for a format no mapping can describe.
CUSTOM: dict[str, Reader] = {}


def register_format(log_type: str, reader: Reader) -> None:
    """Read ``log_type`` with ``reader`` instead of its mapping's format."""
    CUSTOM[log_type] = reader


def reader_for(mapping: Mapping) -> Reader:
    return CUSTOM.get(mapping.log_type) or FORMATS[mapping.format]
