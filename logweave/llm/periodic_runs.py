"""Runs of repeated word sequences inside one text, found by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart are the same)
of at least max(6, 4 q) words that no neighbouring word extends. Every word of such a run
occurs at least four times in it. So a word that occurs less often than that in the segment
at hand is in none: the segment is split there, and its pieces, in which other words are now
rare, are looked at again until no piece changes.

What survives is scanned by lag. A run with a period from Q to below 2 Q holds two equal
sequences of 2 Q words, q apart, of which the first begins at a multiple of Q; so for
Q = 1, 2, 4 ... the sequences at multiples of Q are compared with those that begin Q to
2 Q - 1 words later, n comparisons for each Q. What agrees is extended word by word. Places
inside a run of a smaller period are passed over: any longer period there is a multiple of it.
A text of n words thus takes in the order of n log n steps, whatever its length.

Words are compared by 64-bit hashes first; every run found is compared again by its words.

Defined cases: NULL or wordless text has no words and no runs; runs may overlap; rows that
agree in id and text each get their row; columns of the input other than those kept are
neither read nor touched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweave.llm import tables
from logweave.llm.words import AS_IS, NOT_SPACE, texts, tokenise, windows

#: A run has this many words at least, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_CELLS = 1 << 22  # comparisons made at once
_TEXT = "text as bytes"


def split_by_frequency(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Segments (begin, end) of the texts words[first[i]:first[i + 1]] in which every word is frequent."""
    _, names = np.unique(words, return_inverse=True)
    width = np.int64(len(words) + 1)
    lows, highs = first[:-1].astype(np.int64), first[1:].astype(np.int64)
    stable: list[tuple[int, int]] = []
    while True:
        long = highs - lows >= LEAST_WORDS
        lows, highs = lows[long], highs[long]
        if not len(lows):
            return sorted(stable)
        sizes = highs - lows
        segment = np.repeat(np.arange(len(lows)), sizes)
        base = np.cumsum(sizes) - sizes
        at = np.arange(len(segment)) - base[segment] + lows[segment]
        _, same, counts = np.unique(segment * width + names[at], return_inverse=True, return_counts=True)
        rare = counts[same] < LEAST_PERIODS
        cut = np.zeros(len(lows), bool)
        cut[segment[rare]] = True
        stable.extend(zip(lows[~cut].tolist(), highs[~cut].tolist(), strict=True))
        # Pieces between rare words: begin behind one or at a segment's begin, end before one or at its end.
        stay = ~rare & cut[segment]
        opens, closes = stay.copy(), stay.copy()
        opens[1:] &= ~stay[:-1] | (segment[1:] != segment[:-1])
        closes[:-1] &= ~stay[1:] | (segment[1:] != segment[:-1])
        lows, highs = at[opens], at[closes] + 1


def _stretch(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest range around `at` in which words `lag` apart agree."""
    low, step = at, 64
    while low:
        to = max(0, low - step)
        off = np.flatnonzero(words[to:low] != words[to + lag : low + lag])
        if len(off):
            low = to + int(off[-1]) + 1
            break
        low, step = to, 2 * step
    high, step, last = at, 64, len(words) - lag
    while high < last:
        to = min(last, high + step)
        off = np.flatnonzero(words[high:to] != words[high + lag : to + lag])
        if len(off):
            high += int(off[0])
            break
        high, step = to, 2 * step
    return low, high + lag


def _hits(sequences: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(start, lag) with lags from `size` to below twice that whose sequences agree."""
    lags = np.arange(size, 2 * size)
    rows = max(1, _CELLS // size)
    for lo in range(0, len(starts), rows):
        own = starts[lo : lo + rows]
        to = own[:, None] + lags
        inside = to < len(sequences)
        same = inside & (sequences[np.where(inside, to, 0)] == sequences[own][:, None])
        row, lag = np.nonzero(same)
        yield from zip(own[row].tolist(), lags[lag].tolist(), strict=True)


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment, by start and period."""
    found: dict[tuple[int, int], int] = {}  # period of (start, end)
    size = 1
    while LEAST_PERIODS * size <= len(words):
        sequences = windows(words, 2 * size)
        starts = np.arange(0, len(sequences), size)
        # The furthest end of any run that begins at a word or before it.
        ordered = sorted(found)
        begins = np.array([s for s, _ in ordered], np.int64)
        ends = np.concatenate([[0], np.maximum.accumulate(np.array([e for _, e in ordered], np.int64))])
        reach = ends[np.searchsorted(begins, starts, "right")]
        todo = starts + LEAST_PERIODS * size > reach
        reach = dict(zip(starts[todo].tolist(), reach[todo].tolist(), strict=True))
        known: dict[int, int] = {}  # end of the last stretch of a lag
        for at, lag in _hits(sequences, starts[todo], size):
            if at + lag < known.get(lag, 0) or at + lag + 2 * size <= reach[at]:
                continue
            low, high = _stretch(words, at, lag)
            known[lag] = high
            if high - low >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                found.setdefault((low, high), lag)
        size *= 2
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda x: (x[0], x[2]))


def runs_of_texts(words: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each text that has any; starts count from the text's first word."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    for low, high in split_by_frequency(words, first):
        runs = lag_scan(words[low:high])
        if runs:
            text = int(np.searchsorted(first, low, "right")) - 1
            shift = low - int(first[text])
            out.setdefault(text, []).extend((s + shift, n, q) for s, n, q in runs)
    return {text: sorted(runs, key=lambda x: (x[0], x[2])) for text, runs in out.items()}


def _repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> bool:
    return all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in runs)


def _by_name(words: list[bytes]) -> list[tuple[int, int, int]]:
    """Runs with words numbered one by one, for texts in which two words share a hash."""
    names: dict[bytes, int] = {}
    numbers = np.array([names.setdefault(w, len(names) + 1) for w in words], np.uint64)
    return runs_of_texts(numbers, np.array([0, len(words)])).get(0, [])


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, found, rest = [], [], []
        for _, _, data, offsets in texts(batch.columns[-1]):
            words = tokenise(data, offsets, NOT_SPACE, AS_IS)
            runs = runs_of_texts(words.hashes, words.first)
            body = data.tobytes()
            for i, (lo, hi) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                own = [body[s:e] for s, e in zip(words.starts[lo:hi].tolist(), words.ends[lo:hi].tolist(), strict=True)]
                mine = runs.get(i, [])
                if not _repeats(own, mine):
                    mine = _by_name(own)
                drop = np.zeros(hi - lo, bool)
                for s, n, q in mine:
                    drop[s + q : s + n] = True
                n_words.append(hi - lo)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
                rest.append(b" ".join([own[j] for j in np.flatnonzero(~drop).tolist()] if mine else own))
        yield pa.RecordBatch.from_arrays(
            batch.columns[:-1] + [pa.array(n_words, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(rest, pa.binary()).cast(pa.string())],
            batch.schema.names[:-1] + ["n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, *keep: str, text: Column | None = None) -> DataFrame:
    """Columns `keep`, n_words, runs (by start, then period) and collapsed.

    `collapsed` is the text without what runs repeat: of each run its first period stays; words
    are joined by one space.
    """
    body = F.coalesce(F.col("text") if text is None else text, F.lit("")).cast("binary")
    frame = docs.select(*keep, body.alias(_TEXT))
    made = StructType.fromDDL(f"n_words bigint, runs {RUNS}, collapsed string")
    return frame.mapInArrow(_work, StructType([*frame.schema.fields[:-1], *made.fields]))


def _planted() -> Column:
    """The text, in which every tenth document by the hash of its id repeats words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    parts = F.transform(F.array(F.struct(words.alias("w"), F.size(words).cast("bigint").alias("n"))), lambda x: F.struct(x["w"].alias("w"), x["n"].alias("n"), (g % F.greatest(x["n"], F.lit(1).cast("bigint"))).alias("a")))
    looped = F.transform(parts, lambda x: F.when(x["n"] > 0, F.array_join(F.concat(
        F.slice(x["w"], F.lit(1), x["a"].cast("int")),
        F.transform(F.sequence(F.lit(0).cast("bigint"), x["n"] - x["a"] - 1),
                    lambda i: F.get(x["w"], (x["a"] + i % (1 + F.floor((x["n"] - x["a"]) / (3 + g % 8)))).cast("int")))), " ")))
    return F.when(h % 10 == 0, F.get(looped, F.lit(0))).otherwise(F.col("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    rows = find_runs(docs, "doc_id", text=_planted())
    # Longest first, then by start and period.
    best = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string"))), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
#: SQL would compare every word with every later one of its text; tests compare with brute force instead.
ORACLES: dict[str, str] = {}
