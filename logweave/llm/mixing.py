"""Mixing sources by temperature: weights from token shares, realised as budgeted permutations of blocks.

A source with share p of all tokens gets the weight p**a / Z. The exponent a is found by
bisection (in sections, one aggregation over the sources a step, so that the driver holds a
few numbers however many sources there are): the largest a whose weights reach the target
entropy, raised where needed until no source is repeated more than the limit; a = 1, the
natural shares, is the end of the range.

Each source is cut by hash into BLOCKS blocks. Its budget, weight times the tokens of the whole
mix, is filled with passes over its blocks, each pass in an order of its own; the last pass
stops at the block with which it comes nearest to the budget, so a source misses its budget by
half a block at most. `at`, between 0 and 1, is where a row stands in the mix; sorting by it
interleaves all sources in the proportions of their weights. A hot source is so many blocks
like any other: per-source sums and orders see blocks, never rows.

Defined cases: NULL text has no tokens; a NULL source is a source of its own; sources without
tokens, and an empty table, give no rows; rows that agree in id and text share a block and are
drawn together; equal hashes order by block number; columns of any other name pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from logweave.llm import tables

#: Target entropy, as a share of that of equal weights.
ENTROPY = 0.95
#: Most passes over a source.
REPEATS = 4.0
BLOCKS = 1024
SEED = 20240229
_SECTIONS, _ROUNDS = 32, 5


def n_tokens() -> Column:
    return F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _source() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))


def _uid() -> Column:
    return F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")))


def sizes(docs: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(key, block, tokens): at most `blocks` rows for each source."""
    rows = docs.select(_source().alias("key"), F.pmod(_uid(), F.lit(blocks)).alias("block"), n_tokens().alias("n"))
    return tables.checkpointed(rows.groupBy("key", "block").agg(F.sum("n").alias("tokens")))


def _section(holds: Callable[[list[float]], list[bool]]) -> float:
    """The largest exponent in [0, 1] for which a condition holds that fails beyond some point."""
    lo, hi = 0.0, 1.0
    if holds([1.0])[0]:
        return 1.0
    for _ in range(_ROUNDS):
        points = [lo + (hi - lo) * i / _SECTIONS for i in range(1, _SECTIONS)]
        good = sum(holds(points))
        lo, hi = ([lo] + points)[good], (points + [hi])[good]
    return lo


def exponent(totals: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget_ratio: float = 1.0) -> float:
    """totals: key, tokens. The exponent whose weights meet the entropy, within the limit of repetition."""
    rows = totals.where("tokens > 0")
    whole = rows.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"), F.min("tokens").alias("least")).first()
    if not whole["n"]:
        return 1.0
    share = F.col("tokens") / F.lit(float(whole["tokens"]))
    target, least = entropy * log(whole["n"]), whole["least"] / whole["tokens"]

    def sums(points: list[float]) -> list[tuple[float, float]]:
        parts = [F.sum(F.pow(share, F.lit(a))) for a in points] + [F.sum(F.pow(share, F.lit(a)) * F.log(share)) for a in points]
        out = list(rows.agg(*[x.alias(f"x{i}") for i, x in enumerate(parts)]).first())
        return list(zip(out[: len(points)], out[len(points) :], strict=True))

    def entropic(points: list[float]) -> list[bool]:
        return [log(z) - a * y / z >= target - 1e-12 for a, (z, y) in zip(points, sums(points), strict=True)]

    def repeated(points: list[float]) -> list[bool]:
        return [budget_ratio * least ** (a - 1) / z > repeats for a, (z, _) in zip(points, sums(points), strict=True)]

    wide = _section(entropic)
    # Passes over the smallest source fall as the exponent grows.
    return wide if not repeated([wide])[0] else min(1.0, _section(repeated) + 1.0 / _SECTIONS**_ROUNDS)


def plan(own: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, seed: int = SEED) -> DataFrame:
    """(key, block, epoch, start, width, weight): which blocks are drawn in which pass, and the part of [0, 1) that is theirs."""
    totals = own.groupBy("key").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    mass = float(budget or whole)
    a = exponent(totals, entropy, repeats, mass / max(whole, 1))
    raw = F.pow(F.col("tokens") / F.lit(float(max(whole, 1))), F.lit(a))
    z = totals.agg(F.sum(raw)).first()[0] or 1.0
    given = totals.select("key", F.col("tokens").alias("total"), (raw / F.lit(z)).alias("weight")).withColumn("budget", F.col("weight") * F.lit(mass))
    drawn = own.join(given, "key").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("budget") / F.col("total")))))
    turn = Window.partitionBy("key", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "key", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("before", F.coalesce(F.sum("tokens").over(turn), F.lit(0)) + F.col("epoch") * F.col("total"))
    placed = placed.where(F.col("before") + F.col("tokens") / 2 <= F.col("budget"))
    return placed.select("key", "block", "epoch", (F.col("before") / F.col("budget")).alias("start"), (F.col("tokens") / F.col("budget")).alias("width"), "weight")


def mix(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """A row for each time a document is drawn: its columns, n_tokens, epoch (pass over its source), block, weight and at."""
    drawn = plan(sizes(docs, blocks), entropy, repeats, budget, seed)
    # The draw and what is computed of a row travel as one column each.
    one, row = tables.free(docs.columns, "draw"), tables.free(docs.columns, "row")
    drawn = drawn.select(F.struct("*").alias(one))
    own = docs.withColumn(row, F.struct(_source().alias("key"), _uid().alias("uid"), n_tokens().alias("n"), F.pmod(_uid(), F.lit(blocks)).alias("block")))
    x, y = (lambda name: F.col(f"{one}.{name}")), (lambda name: F.col(f"{row}.{name}"))
    within = F.pmod(F.xxhash64(y("uid"), F.lit(seed), x("epoch")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    extra = {"n_tokens": y("n"), "epoch": x("epoch"), "block": y("block"), "weight": x("weight"), "at": F.least(x("start") + x("width") * within, F.lit(1.0))}
    kept = [F.col(f"`{c}`") for c in tables.others(docs.columns, extra)]
    return own.join(drawn, (x("key") == y("key")) & (x("block") == y("block"))).select(*kept, *[v.alias(k) for k, v in extra.items()])


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(tables.read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "source", "n_tokens", "epoch", "block", F.round("weight", 9).alias("weight"), F.round("at", 9).alias("at"))


QUERIES = {"op7_source_mix": op7_source_mix}
#: Bisection over aggregates is not one SQL statement; tests compare with a plain version.
ORACLES: dict[str, str] = {}
