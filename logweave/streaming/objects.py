"""The objects below a folder as a stream, each taken once, whatever its name.

A streaming source of its own: each turn lists the folder and writes what is new to a
ledger beside the checkpoint, before anything is made of it. An offset is the number of
a turn, and its rows are those of the turn's file, so a repeated batch is the same batch.
What a run could not read is noted in a second folder and comes again, when it is due, as
the next attempt.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.listing import put_object
from ..sources.store import entries, open_store, reachable

OBJECT = "path string, length bigint, modificationTime timestamp, attempt int, turn bigint"
LEDGER, FAILURES = "objects", "failures"
#: Attempts before an object is given up, and the seconds between them: they double, from the first to the last.
MAX_ATTEMPTS, BACKOFF = 5, (10, 300)
_FAILURE = "path string, length bigint, time bigint, attempt int, reason string, due double, dead boolean"


def _micros(at: datetime | None) -> int:
    return 0 if at is None else round(at.replace(tzinfo=at.tzinfo or timezone.utc).timestamp() * 1_000_000)


def _read(store: fs.FileSystem, path: str) -> list[dict]:
    with store.open_input_stream(path, compression=None) as file:
        return [json.loads(x) for x in file.read().splitlines()]


def _names(store: fs.FileSystem, folder: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))
    return sorted(x.base_name for x in found if x.is_file and not x.base_name.startswith("."))


class _Turn(InputPartition):
    def __init__(self, number: int, file: str) -> None:
        self.number, self.file = number, file


class _Reader(DataSourceStreamReader):
    def __init__(self, root: str, state: str, most: int) -> None:
        self._root, self._state, self._most = root, state.rstrip("/"), most
        self._turn = 0
        self._taken: set[tuple] = set()   # (path, length, time, attempt)
        self._failed: dict[str, dict] = {}

    def initialOffset(self) -> dict:
        return {"turn": 0}

    def _known(self) -> None:
        """What turns before this process have taken; one whose batch was never planned counts too."""
        store, folder = open_store(f"{self._state}/{LEDGER}")
        for name in _names(store, folder):
            turn = int(name.split(".")[0])
            if turn > self._turn:
                self._taken.update((x["path"], x["length"], x["time"], x["attempt"]) for x in _read(store, f"{folder}/{name}"))
        self._turn = max([self._turn, *(int(n.split(".")[0]) for n in _names(store, folder))])

    def _again(self) -> Iterator[dict]:
        """Objects whose next attempt is due."""
        store, folder = open_store(f"{self._state}/{FAILURES}")
        for name in _names(store, folder):
            if name not in self._failed:
                self._failed[name] = _read(store, f"{folder}/{name}")[0]
        for x in self._failed.values():
            key = (x["path"], x["length"], x["time"], x["attempt"] + 1)
            if not x["dead"] and x["due"] <= time.time() and key not in self._taken:
                yield dict(zip(("path", "length", "time", "attempt"), key, strict=True))

    def latestOffset(self, *_) -> dict:
        if not self._turn:
            self._known()
        new = list(self._again())
        for path, length, at, _folder in entries(self._root, True):
            key = (path, length, _micros(at), 1)
            if key not in self._taken:
                new.append(dict(zip(("path", "length", "time", "attempt"), key, strict=True)))
        store, folder = open_store(f"{self._state}/{LEDGER}")
        if new:
            store.create_dir(folder, recursive=True)
        for lo in range(0, len(new), self._most):
            some = new[lo : lo + self._most]
            draft = f"{folder}/.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as file:
                file.write("\n".join(json.dumps(x) for x in some).encode())
            store.move(draft, f"{folder}/{self._turn + 1:012d}.jsonl")
            self._turn += 1
            self._taken.update((x["path"], x["length"], x["time"], x["attempt"]) for x in some)
        return {"turn": self._turn}

    def partitions(self, start: dict, end: dict) -> list[_Turn]:
        return [_Turn(n, f"{self._state}/{LEDGER}/{n:012d}.jsonl") for n in range(start["turn"] + 1, end["turn"] + 1)]

    def read(self, partition: _Turn) -> Iterator[tuple]:
        for x in _read(*open_store(partition.file)):
            yield x["path"], x["length"], datetime.fromtimestamp(x["time"] / 1_000_000, timezone.utc), x["attempt"], partition.number

    def commit(self, end: dict) -> None:
        """The ledger stays: it is what was taken."""


class ObjectStream(DataSource):
    """``spark.readStream.format("logweave_objects")`` with ``path``, ``state`` (a folder) and ``maxFilesPerTurn``."""

    @classmethod
    def name(cls) -> str:
        return "logweave_objects"

    def schema(self) -> str:
        return OBJECT

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options["state"], int(self.options["maxFilesPerTurn"]))


def object_stream(spark: SparkSession, root: str, checkpoint: str, max_files: int) -> DataFrame:
    """Stream of ``path, length, modificationTime, attempt, turn`` of the objects arriving below ``root``.

    A turn is at most ``max_files`` objects. In a store that only Spark opens, objects come from
    its own file stream: those of hidden names are not seen there, and none comes again.
    """
    if reachable(root) and reachable(checkpoint):
        spark.dataSource.register(ObjectStream)
        return spark.readStream.format(ObjectStream.name()).option("path", root.rstrip("/")).option(
            "state", checkpoint).option("maxFilesPerTurn", max_files).load()
    stream = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        # Evidence is old: an object counts as new whatever its age is.
        .option("maxFileAge", "36500d")
        .load(root)
    )
    return stream.select("path", "length", "modificationTime", F.lit(1).alias("attempt"), F.lit(0).cast("bigint").alias("turn"))


def _failure_name(path: str, length: int, at: int, attempt: int) -> str:
    return f"{hashlib.sha256(f'{path}|{length}|{at}'.encode()).hexdigest()[:40]}-{attempt}.json"


def note_failure(
    spark: SparkSession, checkpoint: str, found: tuple[str, int, datetime, int], reason: str,
    max_attempts: int = MAX_ATTEMPTS, backoff: tuple[float, float] = BACKOFF,
) -> None:
    """Note that an attempt (path, length, time, attempt) failed: it is due again later, or given up."""
    path, length, at, attempt = found
    # A store that the source cannot open gives nothing back.
    dead = attempt >= max_attempts or not reachable(checkpoint)
    due = time.time() + min(backoff[0] * 2 ** (attempt - 1), backoff[1])
    body = {"path": path, "length": length, "time": _micros(at), "attempt": attempt, "reason": reason, "due": due, "dead": dead}
    put_object(spark, f"{checkpoint.rstrip('/')}/{FAILURES}/{_failure_name(path, length, _micros(at), attempt)}", json.dumps(body).encode())


def failures(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Every attempt that failed: ``path, length, time, attempt, reason, due, dead``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/{FAILURES}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _FAILURE)
    return spark.read.schema(_FAILURE).json(folder.toString())


def dead_letters(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Objects that were given up, with the reason of their last attempt."""
    return failures(spark, checkpoint).where("dead").select("path", "length", "attempt", "reason")
