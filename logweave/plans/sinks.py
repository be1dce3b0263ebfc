"""Writes: tables, quarantine, JSON lines, manifests, views."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import MARKER
from ..operators.timeline import to_json_line
from ..schemas import NETWORK_COLUMNS, TIMELINE_COLUMNS
from ..session import scratch_dir
from . import commits
from .correlate import DEFAULT_ZONE, nexus_events
from .network import Parsed

ACCEPTED, REJECTED = "accepted", "rejected"


def _cell(column: str) -> Column:
    """16 bits of an address, IPv4 or IPv6: ten of its network, all groups but the last, and six of itself.

    The bits are hashed, so that they are used evenly whatever addresses a site has; a network stays together.
    """
    address = F.coalesce(F.col(column), F.lit(""))
    network = F.regexp_replace(address, r"[.:][^.:]*\z", "")
    return F.pmod(F.xxhash64(network), F.lit(1024)) * 64 + F.pmod(F.xxhash64(address), F.lit(64))


def _spread(bits: Column) -> Column:
    """16 bits with a free bit before each of them."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return bits


def _address_curve() -> tuple[Column, ...]:
    """Z-order over the cells of source and destination.

    A sort by one of them first would spread every value of the other over all row groups; along
    the curve a row group holds some of the sources and some of the destinations.
    """
    z = _spread(_cell("src_ip")).bitwiseOR(F.shiftleft(_spread(_cell("dst_ip")), 1))
    return (z, F.col("src_ip"), F.col("dst_ip"))


#: Row groups small enough that a look-up by an address skips most of them, and what it skips them by:
#: least and greatest values say little about addresses as text, Bloom filters do.
_LOOKUPS = {"parquet.block.size": str(16 << 20)} | {
    f"parquet.bloom.filter.{key}#{column}": value
    for column in ("src_ip", "dst_ip") for key, value in (("enabled", "true"), ("expected.ndv", "100000"))}


def _laid_out(rows: DataFrame, cluster: tuple[Column, ...]) -> DataFrame:
    """Day partitions, clustered inside.

    REBALANCE lets Spark cut a day that holds much of the data into several
    tasks and files, and merge small days, by the sizes it measured.
    """
    rows = rows.withColumn("event_date", F.to_date("event_timestamp"))
    return rows.hint("rebalance", F.col("event_date")).sortWithinPartitions("event_date", *cluster)


def write_network(events: DataFrame, path: str, mode: str = "append") -> None:
    """Append accepted network rows, partitioned by day, clustered by address pair."""
    laid = _laid_out(events.select(*NETWORK_COLUMNS), _address_curve())
    laid.write.mode(mode).options(**_LOOKUPS).partitionBy("event_date").parquet(path)


def write_timeline(events: DataFrame, path: str, mode: str = "append") -> None:
    """Append accepted timeline rows; keys the table does not know are gone by now."""
    events.select(*TIMELINE_COLUMNS).write.mode(mode).parquet(path)


def write_quarantine(rows: DataFrame, path: str, mode: str = "append") -> None:
    rows.write.mode(mode).parquet(path)


class Run:
    """What one run adds to a table: parts of rows that become visible together, by ``commit``.

    Committing a run of the same name again replaces all that it had added before.
    """

    def __init__(self, spark: SparkSession, table: str, name: str | None = None) -> None:
        self.spark, self.table, self.name = spark, table, name or uuid.uuid4().hex
        self.parts: list[dict] = []
        self.counters = {"events_loaded": 0, "rows_skipped": 0}

    def add(self, parsed: Parsed) -> dict[str, int]:
        """Write accepted and rejected rows in one pass; nothing of it is seen if this fails."""
        observed = Observation()
        counted = parsed.rows.observe(
            observed,
            F.count(F.when(F.col("error").isNull(), 1)).alias("events_loaded"),
            F.count("error").alias("rows_skipped"),
        )
        bad = F.col("error").isNotNull()
        part = commits.new_part(self.spark, self.table, self.name)
        rows = counted.select(
            *[F.when(~bad, F.col(c)).alias(c) for c in parsed.columns],
            F.when(bad, F.col("source_file")).alias("source_file"),
            F.when(bad, F.col("raw_line")).alias("raw_line"),
            "error",
            F.when(bad, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)).alias("status"),
            F.lit(part).alias("run"),
        )
        is_network = parsed.columns == NETWORK_COLUMNS
        cluster = _address_curve() if is_network else (F.col("device_name"),)
        writer = _laid_out(rows, cluster).write.mode("append").partitionBy("status", "run", "event_date")
        writer.options(**(_LOOKUPS if is_network else {})).parquet(self.table)
        counters = dict(observed.get)
        self.parts.append({"part": part, "days": commits.days_of(self.spark, self.table, part)})
        for key, n in counters.items():
            self.counters[key] += n
        return counters

    def commit(self, replaces: bool = False) -> dict[str, int]:
        commits.commit(self.spark, self.table, self.name, self.parts, replaces=replaces)
        return self.counters


def write_parsed(
    parsed: Parsed, path: str, mode: str = "append", run: str | None = None
) -> dict[str, int]:
    """Write accepted and rejected rows in one pass and one commit.

    The rows are parsed once: both kinds go to ``path``, told apart by the
    partition column ``status``. Read them back with ``scan_network``,
    ``scan_timeline`` and ``scan_quarantine``. With ``run`` the rows of that run
    replace what an earlier attempt of it has written; ``mode="overwrite"``
    replaces all runs. Returns the run's counters.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode is append or overwrite, not {mode!r}")
    own = Run(parsed.rows.sparkSession, path, run)
    own.add(parsed)
    return own.commit(replaces=mode == "overwrite")


def _between(since: datetime | str | None, until: datetime | str | None) -> Column:
    """Time bounds, with the day bounds that let Spark skip whole partitions."""
    keep = F.lit(True)
    if since is not None:
        at = F.lit(since).cast("timestamp")
        keep = keep & (F.col("event_date") >= F.to_date(at)) & (F.col("event_timestamp") >= at)
    if until is not None:
        at = F.lit(until).cast("timestamp")
        keep = keep & (F.col("event_date") <= F.to_date(at)) & (F.col("event_timestamp") < at)
    return keep


def _of_status(spark: SparkSession, path: str, status: str) -> DataFrame:
    """Rows of committed runs; of a table without commit points, as single writes make it, all rows."""
    table = spark.read.parquet(path)
    if "status" in table.columns:
        table = table.where(F.col("status") == status)
    return commits.visible(table, path) if "run" in table.columns and commits.has_commits(spark, path) else table


def _accepted(spark: SparkSession, path: str) -> DataFrame:
    return _of_status(spark, path, ACCEPTED)


def _on(days: Iterable[str] | None) -> Column:
    if days is None:
        return F.lit(True)
    days = set(days)
    dated = F.col("event_date").isin(*[date.fromisoformat(d) for d in sorted(days - {commits.NO_DAY})])
    return dated | F.col("event_date").isNull() if commits.NO_DAY in days else dated


def scan_network(
    spark: SparkSession, path: str,
    since: datetime | str | None = None, until: datetime | str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Network events in ``[since, until)``, and of the given days, reading only the days in question."""
    return _accepted(spark, path).where(_between(since, until) & _on(days)).select(*NETWORK_COLUMNS)


def scan_timeline(
    spark: SparkSession, path: str,
    since: datetime | str | None = None, until: datetime | str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Timeline events; a table without day partitions is filtered by time alone."""
    table = _accepted(spark, path)
    if "event_date" not in table.columns:
        table = table.withColumn("event_date", F.to_date("event_timestamp"))
    return table.where(_between(since, until) & _on(days)).select(*TIMELINE_COLUMNS)


def scan_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return _of_status(spark, path, REJECTED).select("source_file", "raw_line", "error")


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def write_timeline_jsonl(
    parsed: Parsed, root: str, case_id: str, stamp: str | None = None
) -> tuple[str, str | None]:
    """Normalised JSON lines as ``<case>-timeline-<stamp>.jsonl``, a folder of part files.

    Skipped lines go to ``<case>-timeline-errorlines-<stamp>.json``, written only
    if there are any.
    """
    stamp = stamp or run_stamp()
    out = f"{root.rstrip('/')}/{case_id}-timeline-{stamp}.jsonl"
    good = F.col("error").isNull()
    # The input is parsed once; what comes of it is stored, and read for either output.
    parsed.rows.select(
        "source_file", "block", "seq", "error", F.when(~good, F.col("raw_line")).alias("raw_line"),
        F.when(good, to_json_line(F.col("raw"))).alias("value"),
    ).write.parquet(scratch := scratch_dir(parsed.rows.sparkSession, "jsonl"))
    stored = parsed.rows.sparkSession.read.parquet(scratch)
    stored.where(good).select("value").write.text(out)
    skipped = replace(parsed, rows=stored)
    if stored.where(~good).isEmpty():
        return out, None
    skipped = skipped.quarantine(line_numbers=True)
    errors = f"{root.rstrip('/')}/{case_id}-timeline-errorlines-{stamp}.json"
    skipped.select("line_number", F.col("error").alias("reason")).write.json(errors)
    return out, errors


def write_manifest(
    spark: SparkSession, folder: str, case_id: str, source: str, entries: int, size: int
) -> None:
    """The ``_READY`` marker: one JSON object, written after everything else."""
    text = json.dumps({
        "case_id": case_id, "src_object": source, "entries_written": entries, "bytes_decrypted": size,
        "completed_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
    })
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{MARKER}")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_nexus_view(
    network: DataFrame, timeline: DataFrame, name: str = "nexus_events", zone: str = DEFAULT_ZONE
) -> DataFrame:
    view = nexus_events(network, timeline, zone)
    view.createOrReplaceTempView(name)
    return view


def rebuild_table(rows: DataFrame, name: str) -> None:
    """Full rebuild of a derived table, as the scheduled logon query does."""
    rows.write.mode("overwrite").saveAsTable(name)
