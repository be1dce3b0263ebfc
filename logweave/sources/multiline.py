"""Records that span lines, put together where they lie.

Whether a line starts a record depends on everything before it in its file. One look at
the input gives each block's effect on that state (a sum of brackets, or where either
state of the quotes leads), a scan over the few block rows of a file gives the state at
each block's begin, and a second look puts the records together as the lines stream by.
Only a record that crosses the edge of a block is shuffled, in as many pieces as blocks.
No group of lines is collected, so a file that is one block, as every ``.gz`` is, takes no
more memory than its longest record.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import csvtext
from ..functions.strings import WHITE_SPACE
from ..session import kept

# A record that grows past this is not put together any further: its lines go on one by
# one. Only an unclosed quote or bracket makes records of this size.
MAX_RECORD_BYTES = 256 * 1024 * 1024

# Up to this many blocks (of a file split each, so of some 100 TB) have their states sent
# to all tasks, as some 100 MB; beyond, lines and states are brought together by block.
MAX_BROADCAST_BLOCKS = 1_000_000

_BATCH_BYTES = 8 << 20
_BLOCK = ["source_file", "block"]
_LINE = ["source_file", "block", "seq"]
_SURVEY = ("source_file string, block bigint, first_seq bigint, broken boolean, total bigint, if_out boolean, if_in boolean,"
           " record_seq bigint, record binary")
_SURVEY_ROWS = pa.schema([
    ("source_file", pa.string()), ("block", pa.int64()), ("first_seq", pa.int64()), ("broken", pa.bool_()), ("total", pa.int64()),
    ("if_out", pa.bool_()), ("if_in", pa.bool_()), ("record_seq", pa.int64()), ("record", pa.binary())])
_PIECE = "source_file string, block bigint, seq bigint, kind int, value binary"
_PIECE_ROWS = pa.schema([("source_file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()), ("value", pa.binary())])
_WHOLE, _TAIL, _HEAD = 0, 1, 2


@dataclass(frozen=True)
class Flagged:
    """Lines, and what tells of each (given the bytes of a batch of them) ``a`` and ``b``, its effect on the state, and ``full``."""

    lines: DataFrame
    flags: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]

    def collect(self) -> list[Row]:
        """The few lines of a trial, with their flags."""
        flags = self.flags

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b, full = flags(batch.column("value"))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(full)], [*_LINE, "a", "b", "full"])

        lines = self.lines.select(*_LINE, F.col("value").cast("binary").alias("value"))
        return lines.mapInArrow(work, "source_file string, block bigint, seq bigint, a bigint, b bigint, full boolean").collect()


def _buffer(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, one after the other, and where each begins (and the last ends)."""
    values = values.cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    _, places, body = values.buffers()
    at = np.frombuffer(places, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(b"" if body is None else body, np.uint8)[at[0] : at[-1]], at - at[0]


def _held(found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places in the bytes: how many each value has, and how many all before it have."""
    cuts = np.searchsorted(found, at)
    return np.diff(cuts), cuts[:-1]


# JSON strings hold no raw line ends, so a line never starts inside one.
_STRING = re.compile('"(?:[^"\\\\]++|\\\\[^\n\r\x85\u2028\u2029])*+"')
_CLOSER = str.maketrans({"[": "{", "]": "}"})


def _depth_change(value: bytes) -> int:
    bare = _STRING.sub("", value.decode("utf-8", "replace")).translate(_CLOSER)
    return bare.count("{") - bare.count("}")


def _json_flags(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body, at = _buffer(values)
    n = len(values)
    quotes, folded = np.flatnonzero(body == 0x22), body | 0x20
    held, before = _held(quotes, at)
    brackets = np.flatnonzero((folded == 0x7B) | (folded == 0x7D))
    line = np.searchsorted(at, brackets, "right") - 1
    outside = (np.searchsorted(quotes, brackets) - before[line]) % 2 == 0
    a = np.bincount(line[outside], np.where(folded[brackets[outside]] == 0x7B, 1, -1), n).astype(np.int64)
    # Only where strings hold escapes or are left open do quotes not tell what lies in strings.
    escaped = _held(np.flatnonzero(body == 0x5C), at)[0] > 0
    for i in np.flatnonzero((held > 0) & (escaped | (held % 2 == 1))).tolist():
        a[i] = _depth_change(values[i].as_py())
    full = np.zeros(n, bool)
    some = np.flatnonzero(np.diff(at))
    for edge in (at[some], at[some + 1] - 1):
        full[some] |= (body[edge] > 0x20) & (body[edge] < 0x7F)
    for i in some[~full[some]].tolist():
        full[i] = values[i].as_py().decode("utf-8", "replace").strip(WHITE_SPACE) != ""
    return a, np.zeros(n, np.int64), full


def with_json_flags(lines: DataFrame) -> Flagged:
    """``a`` are the brackets a line leaves open, ``full`` is whether it can start a value."""
    return Flagged(lines, _json_flags)


def with_csv_flags(lines: DataFrame, delimiter: str, spanning: bool = True) -> Flagged:
    """``a`` and ``b`` are whether a line ends in a quoted field if it starts outside of or in one.

    Without ``spanning`` no line is taken to do so.
    """
    ends_open = re.compile(csvtext.open_end(delimiter).encode() + rb"\Z").match

    def flags(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        body, at = _buffer(values)
        a, b = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
        if spanning:
            # What is left open has an odd number of quotes, the one it began with included: most lines need no closer look.
            held, _ = _held(np.flatnonzero(body == 0x22), at)
            b[held == 0] = 1
            for i in np.flatnonzero(held).tolist():
                value = values[i].as_py()
                if held[i] % 2:
                    a[i] = ends_open(value) is not None
                else:
                    b[i] = ends_open(b'"' + value) is not None
        return a, b, np.diff(at) > 0

    return Flagged(lines, flags)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, begin, end) of neighbouring rows of one block."""
    if not batch.num_rows:
        return
    block = batch.column("block").to_numpy(zero_copy_only=False)
    file = batch.column("source_file").dictionary_encode()
    code = file.indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (code[1:] != code[:-1])) + 1
    names = file.dictionary.to_pylist()
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield names[code[lo]], int(block[lo]), lo, hi


def _quote_states(a: np.ndarray, b: np.ndarray, before: bool) -> tuple[np.ndarray, bool]:
    """Whether each line starts in a quoted field, and whether the last one ends in one."""
    fixes, flips = a == b, (a == 1) & (b == 0)
    at = np.maximum.accumulate(np.where(fixes, np.arange(len(a)), -1))
    last = np.concatenate([[-1], at])   # the last line before each that fixes the state
    turns = np.concatenate([[0], np.cumsum(flips)])
    known = last >= 0
    base = np.where(known, a[np.maximum(last, 0)] == 1, before)
    state = base ^ ((turns - np.where(known, turns[np.maximum(last, 0) + 1], 0)) % 2 == 1)
    return state[:-1], bool(state[-1])


class _Summary:
    """A block's effect on the state, and its first record as if it began outside of all."""

    def __init__(self, file: str, block: int, seq: int) -> None:
        self.place = (file, block, seq)
        self.broken, self.total, self.ends = False, 0, [False, True]
        self.record_seq: int | None = None
        self.record: list[bytes] = []
        self.done = False

    def add(self, seq: np.ndarray, a: np.ndarray, b: np.ndarray, full: np.ndarray, quoted: bool, values: pa.Array | None) -> None:
        self.broken |= bool(a.any())
        if values is not None and not self.done:
            self._first(seq, a, b, full, values)
        if quoted:
            self.ends = [_quote_states(a, b, s)[1] for s in self.ends]
        else:
            self.total += int(a.sum())

    def _first(self, seq: np.ndarray, a: np.ndarray, b: np.ndarray, full: np.ndarray, values: pa.Array) -> None:
        begin = 0
        if self.record_seq is None:
            found = np.flatnonzero(full)
            if not len(found):
                return
            begin = int(found[0])
            self.record_seq, self._open = int(seq[begin]), False
        for i in range(begin, len(a)):
            self.record.append(values[i].as_py() or b"")
            self._open = bool(b[i] if self._open else a[i])
            if not self._open or len(self.record) > 10_000:
                self.done = True
                return

    def row(self) -> tuple:
        record = None if self.record_seq is None else b"\n".join(self.record if self.done else self.record[:1])
        return (*self.place, self.broken, self.total, *self.ends, self.record_seq, record)


def _summarise(flags: Callable, quoted: bool, first: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Summary | None = None
        rows: list[tuple] = []
        for batch in batches:
            a, b, full = flags(batch.column("value"))
            seq = batch.column("seq").to_numpy(zero_copy_only=False)
            values = batch.column("value") if first else None
            for file, block, lo, hi in _runs(batch):
                if own is None or own.place[:2] != (file, block):
                    if own is not None:
                        rows.append(own.row())
                    own = _Summary(file, block, int(seq[lo]))
                own.add(seq[lo:hi], a[lo:hi], b[lo:hi], full[lo:hi], quoted, None if values is None else values.slice(lo, hi - lo))
            if len(rows) > 1000:
                yield _batch(rows, _SURVEY_ROWS)
                rows = []
        if own is not None:
            rows.append(own.row())
        if rows:
            yield _batch(rows, _SURVEY_ROWS)

    return work


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def survey(flagged: Flagged, quoted: bool, first: bool = False) -> DataFrame:
    """A row for each block: ``broken`` if a record in it may span lines, what it does to the state, and with
    ``first`` its first record (``record``, from ``record_seq`` on). Kept until ``released``."""
    lines = flagged.lines.select(*_LINE, F.col("value").cast("binary").alias("value"))
    return kept(lines.mapInArrow(_summarise(flagged.flags, quoted, first), _SURVEY))


def _states(blocks: DataFrame, quoted: bool) -> DataFrame:
    """``source_file, block, base, open_end``: the state at each block's begin, and whether it ends inside a record."""
    order = Window.partitionBy("source_file").orderBy("block", "first_seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    if quoted:
        # A block fixes the state, or swaps the two, or leaves it.
        fixed = F.when(F.col("if_out") == F.col("if_in"), F.col("if_out"))
        turns = F.sum((F.col("if_out") & ~F.col("if_in")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        rows = blocks.withColumn("fixed", fixed).withColumn("turns", turns)
        at = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turns")), ignorenulls=True).over(before)
        turned = F.coalesce(F.lag("turns").over(order), F.lit(0)) - F.coalesce(at["turns"], F.lit(0))
        rows = rows.withColumn("base", (F.coalesce(at["fixed"], F.lit(False)) != (turned % 2 == 1)).cast("bigint"))
        end = F.when(F.col("base") == 1, F.col("if_in")).otherwise(F.col("if_out"))
    else:
        rows = blocks.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
        end = F.col("base") + F.col("total") > 0
    return rows.select(*_BLOCK, "first_seq", "base", end.alias("open_end")).groupBy(*_BLOCK).agg(
        F.min_by("base", "first_seq").alias("base"), F.max_by("open_end", "first_seq").alias("open_end"))


class _Assembler:
    """Pieces of one block after the other."""

    def __init__(self, quoted: bool, most: int, edges: bool) -> None:
        self._quoted, self._most, self._edges = quoted, most, edges
        self._block: tuple | None = None
        self.out: list[tuple] = []
        self.bytes = 0

    def _emit(self, seq: int, kind: int, value: bytes) -> None:
        if (kind != _WHOLE) == self._edges:
            self.out.append((*self._block, seq, kind, value))
            self.bytes += len(value) + 64

    def _flush(self, is_open: bool) -> None:
        if self._lines:
            here = self._started
            kind = (_TAIL if here else _HEAD) if is_open else (_WHOLE if here else _HEAD)
            self._emit(self._lines[0][0], kind, b"\n".join([x for _, x in self._lines]))
        self._lines, self._size, self._loose = [], 0, False

    def begin(self, file: str, block: int, base: int) -> None:
        self.end()
        self._block, self._state = (file, block), (base == 1 if self._quoted else base)
        self._started, self._lines, self._size, self._loose = False, [], 0, False

    def end(self) -> None:
        if self._block is not None:
            self._flush(self._state if self._quoted else self._state > 0)

    def _go_on(self, seq: int, value: bytes) -> None:
        if self._loose:
            self._emit(seq, _WHOLE, value)
            return
        self._lines.append((seq, value))
        self._size += len(value) + 1
        if self._size > self._most:
            for own in self._lines:
                self._emit(own[0], _WHOLE, own[1])
            self._lines, self._size, self._loose = [], 0, True

    def add(self, seq: list[int], a: np.ndarray, b: np.ndarray, full: np.ndarray, values: list[bytes]) -> None:
        if self._quoted:
            inside, self._state = _quote_states(a, b, self._state)
        else:
            depth = self._state + np.concatenate([[0], np.cumsum(a)])
            inside, self._state = depth[:-1] > 0, int(depth[-1])
        starts = np.flatnonzero(~inside & full).tolist()
        # Blank lines outside of records belong to none.
        keep = (inside | full).tolist()
        ends = [*starts[1:], len(values)] if starts else []
        for i in range(starts[0] if starts else len(values)):
            if keep[i]:
                self._go_on(seq[i], values[i] or b"")
        for begin, end in zip(starts, ends, strict=True):
            self._flush(False)
            self._started = True
            own = [(seq[i], values[i] or b"") for i in range(begin, end) if keep[i]]
            if end < len(values) and sum(len(x) + 1 for _, x in own) <= self._most:
                self._emit(seq[begin], _WHOLE, b"\n".join([x for _, x in own]))   # it ends here
                continue
            for line in own:
                self._go_on(*line)


def _assemble(flags: Callable, quoted: bool, most: int, edges: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Assembler(quoted, most, edges)
        for batch in batches:
            a, b, full = flags(batch.column("value"))
            base = batch.column("base").to_numpy(zero_copy_only=False)
            seq, values = batch.column("seq").to_pylist(), batch.column("value").to_pylist()
            for file, block, lo, hi in _runs(batch):
                if own._block != (file, block):
                    own.begin(file, block, int(base[lo]))
                own.add(seq[lo:hi], a[lo:hi], b[lo:hi], full[lo:hi], values[lo:hi])
                if own.bytes > _BATCH_BYTES:
                    yield _batch(own.out, _PIECE_ROWS)
                    own.out, own.bytes = [], 0
        own.end()
        if own.out:
            yield _batch(own.out, _PIECE_ROWS)

    return work


def records(flagged: Flagged, surveyed: DataFrame, quoted: bool) -> DataFrame:
    """``source_file, block, seq, raw``: records with the place of their first line, lines joined by line ends."""
    states = kept(_states(surveyed, quoted))
    few = states.count() <= MAX_BROADCAST_BLOCKS
    placed = flagged.lines.join(F.broadcast(states) if few else states, _BLOCK)
    if not few:
        placed = placed.sortWithinPartitions(*_BLOCK, "seq")
    columns = [*_LINE, "base", F.col("value").cast("binary").alias("value")]
    put = lambda rows, edges: rows.select(*columns).mapInArrow(_assemble(flagged.flags, quoted, MAX_RECORD_BYTES, edges), _PIECE)
    done = put(placed, False).select(*_BLOCK, "seq", F.col("value").cast("string").alias("raw"))
    if states.where("open_end OR base > 0").isEmpty():
        return done
    # Records over the edges of blocks: a tail, blocks without a start, and the head of the block that ends it.
    edges = put(placed.where("open_end OR base > 0"), True)
    before = Window.partitionBy("source_file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.last(F.when(F.col("kind") == _TAIL, F.struct("block", "seq")), ignorenulls=True).over(before)
    edges = edges.withColumn("start", F.coalesce(start, F.struct("block", "seq")))
    total = F.sum(F.octet_length("value") + 1).over(Window.partitionBy("source_file", "start"))
    edges = edges.withColumn("loose", total > MAX_RECORD_BYTES)
    whole = edges.where("NOT loose").groupBy("source_file", "start").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", F.col("value").cast("string").alias("value")))).alias("pieces")
    ).select("source_file", "start.block", "start.seq", F.array_join("pieces.value", "\n").alias("raw"))
    lines = edges.where("loose").select(*_BLOCK, "seq", F.posexplode(F.split(F.col("value").cast("string"), "\n")).alias("at", "raw")).select(
        *_BLOCK, (F.col("seq") + F.col("at")).alias("seq"), "raw")
    return done.unionByName(whole).unionByName(lines)
