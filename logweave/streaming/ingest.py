"""New objects -> tables, each object once.

A stream of objects (see ``objects``) finds what is new; each micro-batch runs the batch
plan over it, so every format, archives included, is read by the same code. What a batch
adds becomes visible by one commit, which a repeated batch replaces: appends are
exactly-once. An object that cannot be read is tried again, later and later, and given up
after a number of attempts; the others of its batch are loaded without it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..mapping import Mapping, check_patterns, load_mapping
from ..operators.formats import Options
from ..operators.routing import MARKER, route_logs, route_timelines, with_key
from ..operators.timeline import MAX_LINE_BYTES
from ..plans.network import Parsed, parse_network
from ..plans.sinks import Run
from ..plans.timeline import parse_timeline
from ..session import configure, released
from ..sources.scan import scan_objects
from ..sources.store import is_own, reachable
from .gate import hold_until_ready
from .objects import BACKOFF, MAX_ATTEMPTS, failures, note_failure, object_stream

# The names of the objects of a turn pass through the driver, so their number
# is bounded here.
MAX_FILES_PER_BATCH = 10_000

_Found = tuple   # path, length, time, attempt


def new_objects(spark: SparkSession, root: str, checkpoint: str, max_files: int = MAX_FILES_PER_BATCH, gate: bool = False) -> DataFrame:
    """Stream of the objects arriving below ``root``, with ``key``; with ``gate`` once their folder has its marker."""
    if gate and not (reachable(root) and reachable(checkpoint)):
        raise ValueError("markers are seen only in stores that tasks can open")
    found = with_key(object_stream(spark, root, checkpoint, max_files), root)
    is_marker = F.substring_index("key", "/", -1) == MARKER
    found = found.where(~is_own(F.col("key")) | (is_marker & F.lit(gate)))
    return hold_until_ready(found) if gate else found


def _each_batch(
    objects: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    return objects.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)


def _run_name(batch: DataFrame, number: int, part: str = "") -> str:
    """Names a batch across restarts: the query's id lives in its checkpoint."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
    return f"{query}-{number}{part}"


def _reason(problem: Exception) -> str:
    return str(problem).strip()[:500]


def _unreadable(found: list[_Found], scan: Callable[[list[_Found]], DataFrame]) -> list[tuple[_Found, str]]:
    """Objects that cannot be read to their ends, with the reason: found by halving, and nothing is parsed for it."""
    if not found:
        return []
    try:
        scan(found).write.format("noop").mode("overwrite").save()
        return []
    except Exception as problem:   # whatever ends the job of one object must not end the stream
        if len(found) == 1:
            return [(found[0], _reason(problem))]
    middle = len(found) // 2
    return _unreadable(found[:middle], scan) + _unreadable(found[middle:], scan)


def _load(
    run: Run, found: list[_Found], scan: Callable[[list[_Found]], DataFrame], parse: Callable[[DataFrame], Parsed], checked: bool = False,
) -> list[tuple[_Found, str]]:
    """Add the objects to the run; those that fail are left out and returned with the reason.

    Most failures are those of reading, which costs a small part of parsing and writing. Objects that
    failed before, and packed ones, which are long in one task, are read through first; all are, once
    they fail together. What can be read and fails all the same is found by halving.
    """
    suspects = [] if checked else [x for x in found if x[3] > 1 or x[0].lower().endswith(".gz")]
    failed = _unreadable(suspects, scan)
    found = _without(found, failed)
    if not found:
        return failed
    try:
        with released():
            run.add(parse(scan(found)))
        return failed
    except Exception as problem:   # as above
        if len(found) == 1:
            return [*failed, (found[0], _reason(problem))]
    unreadable = [] if checked else _unreadable(found, scan)
    if unreadable:
        failed, found = failed + unreadable, _without(found, unreadable)
        return failed + (_load(run, found, scan, parse, checked=True) if found else [])
    middle = len(found) // 2
    return failed + _load(run, found[:middle], scan, parse, checked=True) + _load(run, found[middle:], scan, parse, checked=True)


def _without(found: list[_Found], failed: list[tuple[_Found, str]]) -> list[_Found]:
    gone = {x for x, _ in failed}
    return [x for x in found if x not in gone]


def _handler(
    spark: SparkSession, table: str, checkpoint: str, route: Callable[[DataFrame], DataFrame], kind: str | None,
    scan: Callable[[list[_Found]], DataFrame], parser: Callable[[str | None], Callable[[DataFrame], Parsed]], max_attempts: int, backoff: tuple[float, float],
) -> Callable[[DataFrame, int], None]:
    """What becomes of a micro-batch of routed objects; ``kind`` is a column that tells runs apart."""

    def handle(batch: DataFrame, number: int) -> None:
        routed = route(batch.persist())
        try:
            routed.where(F.col("reject").isNotNull()).select("path", "reject").write.mode(
                "overwrite"
            ).parquet(f"{table}_rejected/run={_run_name(batch, number)}")
            taken = routed.where(F.col("reject").isNull()).withColumn("kind", F.col(kind) if kind else F.lit(None).cast("string"))
            # An attempt that is noted as failed, by this batch before a restart, stays failed: its retry is on the way.
            noted = failures(spark, checkpoint).select("path", "length", F.col("time").alias("at"), "attempt")
            taken = taken.withColumn("at", F.unix_micros("modificationTime")).join(noted, ["path", "length", "at", "attempt"], "left_anti")
            groups = [tuple(r) for r in taken.select("turn", "kind").distinct().orderBy("turn", "kind").collect()]
            for turn, name in groups:
                own = taken.where((F.col("turn") == turn) & F.col("kind").eqNullSafe(F.lit(name)))
                found = [tuple(r) for r in own.select("path", "length", "modificationTime", "attempt").orderBy("path").toLocalIterator()]
                run = Run(spark, table, _run_name(batch, number, f"-{turn}" + (f"-{name}" if name else "")))
                # A mapping that is wrong is no fault of an object: it ends the stream here.
                failed = _load(run, found, scan, parser(name))
                run.commit()
                # Only now: a batch that ends before its commit has failed nothing.
                for one, reason in failed:
                    note_failure(spark, checkpoint, one, reason, max_attempts, backoff)
        finally:
            batch.unpersist()

    return handle


def stream_network(
    spark: SparkSession, root: str, table: str, checkpoint: str, allowed: Iterable[str], *,
    mapping_for: Callable[[str], Mapping] | None = None,
    options: Options = Options(),
    max_files: int = MAX_FILES_PER_BATCH,
    gate: bool = False, max_attempts: int = MAX_ATTEMPTS, backoff: tuple[float, float] = BACKOFF,
) -> DataStreamWriter:
    """Ingest ``<root>/log/<log_type>/<file>`` as it arrives.

    Mappings come from ``<root>/config/<log_type>.json`` unless ``mapping_for``
    gives them. Objects that are not taken are written beside the table, under
    ``<table>_rejected``, with the reason; those that cannot be read are tried
    ``max_attempts`` times (see ``objects.failures`` and ``objects.dead_letters``).
    With ``gate`` the objects of a folder wait for its completion marker. Start
    the returned writer with the trigger of your choice, e.g.
    ``.trigger(availableNow=True).start()``.
    """
    configure(spark)
    allowed = tuple(allowed)
    mapping_for = mapping_for or (lambda log_type: load_mapping(spark, root, log_type))

    def scan(found: list[_Found]) -> DataFrame:
        return scan_objects(spark, [x[:2] for x in found])

    def parser(log_type: str) -> Callable[[DataFrame], Parsed]:
        mapping = mapping_for(log_type)
        check_patterns(spark, mapping)
        return lambda lines: parse_network(lines, mapping, options)

    handle = _handler(spark, table, checkpoint, lambda batch: route_logs(batch, allowed), "log_type", scan, parser, max_attempts, backoff)
    return _each_batch(new_objects(spark, root, checkpoint, max_files, gate), checkpoint, handle)


def stream_timeline(
    spark: SparkSession, folder: str, table: str, checkpoint: str, root: str, *,
    default_device: str = "unknown", max_files: int = MAX_FILES_PER_BATCH,
    max_line_bytes: int = MAX_LINE_BYTES,
    gate: bool = False, max_attempts: int = MAX_ATTEMPTS, backoff: tuple[float, float] = BACKOFF,
) -> DataStreamWriter:
    """Ingest ``<case>-timeline-<stamp>.jsonl`` objects as they arrive in ``folder``.

    Rejects, attempts and ``gate`` are those of ``stream_network``.
    """
    configure(spark)

    def scan(found: list[_Found]) -> DataFrame:
        return scan_objects(spark, [x[:2] for x in found], archives=False)

    def parser(_: None) -> Callable[[DataFrame], Parsed]:
        return lambda lines: parse_timeline(lines, root, default_device, max_line_bytes)

    handle = _handler(spark, table, checkpoint, route_timelines, None, scan, parser, max_attempts, backoff)
    return _each_batch(new_objects(spark, folder, checkpoint, max_files, gate), checkpoint, handle)
