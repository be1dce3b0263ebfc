"""Raw vendor logs -> network events, quarantined rows beside them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import pinned
from ..mapping import Mapping, check_patterns, warn_if_template
from ..operators.formats import MAX_LINE_BYTES, PLACE, Options, reader_for
from ..operators.projection import project
from ..schemas import NETWORK_COLUMNS
from ..session import configure
from ..sources.archives import MAX_DEPTH
from ..sources.lines import number_lines
from ..sources.scan import scan_lines

_FATAL = r"\A(?:invalid JSON|not a JSON object|archive:|csv: unreadable header|not read:)"


@dataclass(frozen=True)
class Parsed:
    """One pass over the input: every row either an event or an error.

    ``rows`` has the table's columns, ``raw_line``, ``error`` and the place of
    the record. Write it once with ``sinks.write_parsed``; ``events`` and
    ``quarantine`` are views for queries.
    """

    rows: DataFrame
    columns: tuple[str, ...]
    lines: DataFrame | None = None
    line_format: bool = False

    def failfast(self) -> Parsed:
        """The strict form: input that makes a whole file unreadable ends the job.

        That is broken JSON, an over-long log line, a container that cannot be
        opened and an unreadable header row. Errors of single rows stay rows.
        """
        error = F.col("error")
        fatal = error.rlike(_FATAL)
        if self.columns == NETWORK_COLUMNS:
            fatal = fatal | error.startswith("line exceeds")
            if self.line_format:
                too_long = F.octet_length("raw_line") >= MAX_LINE_BYTES
                error = F.when(too_long, F.lit(f"line exceeds {MAX_LINE_BYTES} byte limit")).otherwise(error)
                fatal = fatal | too_long
        ended = F.when(fatal, F.raise_error(error).cast("string")).otherwise(error)
        return replace(self, rows=self.rows.withColumn("error", pinned(ended)))

    @property
    def events(self) -> DataFrame:
        return self.rows.where(F.col("error").isNull()).select(*self.columns)

    def quarantine(self, line_numbers: bool = False) -> DataFrame:
        """``source_file, line_number, raw_line, error`` of the rows not accepted.

        Numbers cost one more pass over the files, to count their lines.
        """
        bad = self.rows.where(F.col("error").isNotNull())
        if line_numbers and self.lines is not None:
            bad = number_lines(bad, self.lines)
        else:
            bad = bad.withColumn("line_number", F.lit(None).cast("bigint"))
        return bad.select("source_file", "line_number", "raw_line", "error")


def parse_network(lines: DataFrame, mapping: Mapping, options: Options = Options()) -> Parsed:
    """Parse a line frame (see ``sources.lines``) by ``mapping``."""
    warn_if_template(mapping)
    readable = lines.where(F.col("error").isNull()) if "error" in lines.columns else lines
    frame, find = reader_for(mapping)(readable.select(*PLACE, "value"), mapping, options)
    rows = project(frame, mapping, find, PLACE)
    if "error" in lines.columns:   # containers that could not be opened
        broken = lines.where(F.col("error").isNotNull())
        rows = rows.unionByName(
            broken.select(*PLACE, F.lit("").alias("raw_line"), "error"), allowMissingColumns=True
        )
    return Parsed(rows, NETWORK_COLUMNS, lines, mapping.format in ("kv", "regex"))


def ingest_network(
    spark: SparkSession,
    paths: str | Sequence[str],
    mapping: Mapping,
    *,
    archives: bool = True,
    max_depth: int = MAX_DEPTH,
    options: Options = Options(),
) -> Parsed:
    """Read all objects below ``paths``, archives included, as logs of one type.

    Containers may be nested ``max_depth`` deep.
    """
    configure(spark)
    check_patterns(spark, mapping)
    return parse_network(scan_lines(spark, paths, archives=archives, max_depth=max_depth), mapping, options)
