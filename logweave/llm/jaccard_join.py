"""Near copies: documents whose five-word shingle sets have a Jaccard similarity of 0.8 or more.

Two sets that similar share a token among the first n - ceil(0.8 n) + 1 of each under any
global order of tokens. Several orders are used. All begin with the tokens that only one set
of the corpus has, found exactly by their hashes (see `packed`): these can be in no
intersection, so a set that fills its prefix with them is similar to none and is done with.
What the others still have in their prefixes comes rarest first, by a sketch of how often
tokens occur in the sets that are left (2**18 counters, so what is broadcast is 256 KB at any
size), ties broken by another hash in each order. Tokens that two sets share in the prefix of
the first order make candidates if lengths and parity sketches allow it; candidates must also
share prefix tokens under the second and the third order, as many as their lengths ask for;
only pairs in the intersection are verified, on all tokens that the sets share with any other.

Equal sets are one class from the start, so copies are never paired. Candidates of a token
are not all paired at once either: some members, the pivots, are compared with all others
and what links becomes one component; pairs inside a component need no further look. This is
repeated as long as it halves what is left, unless that is few pairs for each set; then all
pairs between different components are looked at, in the join itself by their sketches, so no
link between components is lost and no partner is capped.

Defined cases: NULL or wordless text has an empty set and is linked with nothing; a text of
fewer than five words is one shingle; the length of a text changes nothing else; a NULL doc_id
takes part, but is no smallest id unless all are NULL; ties of ids are rows that agree in id and
text, one document twice; columns of any other name are not read (`one_of_each` carries them);
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import packed, tables
from logweave.llm.components import components
from logweave.llm.words import LOWER, NOT_SPACE, Words, member, mix, texts, tokenise, windows

SHINGLE = 5
#: Similarity as a fraction of integers, so that the comparison is exact.
PERCENT = 80
SKETCH = 1 << 18
_SLOT = 4096
#: Seeds that break ties in the orders: the first makes candidates, all others filter them.
ORDERS = (0x1F83D9AB, 0x5BE0CD19, 0x3C6EF372)
PIVOTS = 2
#: What is left is paired at once when that makes at most so many pairs for each set of the corpus.
REST = 1


def shingles(words: Words, i: int) -> np.ndarray:
    """The set of text i, in order of hash."""
    own = words.hashes[words.first[i] : words.first[i + 1]]
    return np.unique(windows(own, min(SHINGLE, len(own)))) if len(own) else own


def _sets(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for lo, _, data, offsets in texts(table["body"]):
        words = tokenise(data, offsets, NOT_SPACE, LOWER)
        for i in range(len(offsets) - 1):
            yield lo + i, shingles(words, i)


def _name(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and name of each document's set."""
    for batch in batches:
        n, names = [], []
        for _, tokens in _sets(batch):
            n.append(len(tokens))
            names.append(_name(tokens) if len(tokens) else None)
        yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "uid": batch["uid"], "n": pa.array(n, pa.int64()), "class": pa.array(names, pa.binary())})


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At the end of the task, its part of the sketch."""
    sketch = np.zeros(SKETCH, np.uint32)
    for batch in batches:
        for body in batch["shared"]:
            tokens = np.frombuffer(body.as_py(), np.uint64)
            sketch += np.bincount((tokens & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
    used = [at for at in range(0, SKETCH, _SLOT) if sketch[at : at + _SLOT].any()]
    yield pa.RecordBatch.from_pydict({
        "slot": pa.array([at // _SLOT for at in used], pa.int32()), "counts": pa.array([sketch[at : at + _SLOT].tobytes() for at in used], pa.binary())})


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(_SLOT, np.uint64)
    for x in table["counts"]:
        total += np.frombuffer(x.as_py(), np.uint32)
    return pa.table({"slot": table["slot"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _levels(left: DataFrame) -> np.ndarray:
    """Of each counter of the sketch, the binary order of magnitude."""
    levels = np.zeros(SKETCH, np.uint8)
    sums = left.select("shared").mapInArrow(_sketch, "slot int, counts binary").groupBy("slot").applyInArrow(_add, "slot int, counts binary")
    for row in sums.collect():
        counts = np.frombuffer(row["counts"], np.uint64)
        levels[row["slot"] * _SLOT : (row["slot"] + 1) * _SLOT] = np.log2(np.maximum(counts, 1)).astype(np.uint8)
    return levels


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def prefix(tokens: np.ndarray, levels: np.ndarray, seed: int, size: int) -> np.ndarray:
    """The first tokens under one of the orders, of those that other sets have too."""
    rank = mix(tokens ^ np.uint64(seed)) >> np.uint64(8)
    rank |= levels[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    return tokens[np.argpartition(rank, size - 1)[:size]] if size < len(tokens) else tokens


def _top(tokens: np.ndarray, size: int) -> bytes:
    """The top bytes of each token, in order."""
    return np.sort(tokens).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _from_top(body: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(body) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(body, np.uint8).reshape(-1, size)
    return out.view(">u8").ravel().astype(np.uint64)


#: Bytes of a token that travel to filter candidates. Chance agreement only adds candidates.
_FILTER = 2
#: Longs of a set's parity sketch.
_LONGS = 24


def parity(tokens: np.ndarray) -> np.ndarray:
    """For each bit of the sketch, whether the set has an odd number of tokens that fall on it.

    Two sketches differ in no more bits than their sets differ in tokens.
    """
    place = (mix(tokens ^ np.uint64(ORDERS[0])) >> np.uint64(40)).astype(np.int64) % (64 * _LONGS)
    odd = (np.bincount(place, minlength=64 * _LONGS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _heads(table: pa.Table, side: pa.Table) -> pa.Table:
    """Of the batch's rows those that stand for their class, each once."""
    left = set(side["uid"].to_pylist())
    out = []
    for i, uid in enumerate(table["uid"].to_pylist()):
        if uid in left:
            left.remove(uid)
            out.append(i)
    return table.take(pa.array(out, pa.int64()))


def _send(bits: int):
    def work(table: pa.Table, side: pa.Table) -> pa.Table:
        own = [tokens for _, tokens in _sets(_heads(table, side))]
        return packed.send(table["batch"][0].as_py() if table.num_rows else 0, np.concatenate([np.empty(0, np.uint64), *own]), bits, False)

    return work


LEFT = "node bigint, n bigint, alone bigint, shared binary"


def _left(bits: int):
    """Sets that may be similar to another: n tokens, of which `alone` are in no other set, and the rest of them."""

    def work(table: pa.Table, side: pa.Table) -> pa.Table:
        shared = packed.found_keys(side.filter(pa.compute.is_valid(side["found"])))
        own = _heads(table, side)
        pick, n, alone, rest = [], [], [], []
        for i, tokens in _sets(own) if len(shared) else ():
            both = tokens[member(packed.key(tokens, bits, False), shared)]
            if len(tokens) - len(both) < prefix_size(len(tokens)):
                pick.append(i)
                n.append(len(tokens))
                alone.append(len(tokens) - len(both))
                rest.append(both.tobytes())
        return pa.table({
            "node": own["uid"].take(pa.array(pick, pa.int64())), "n": pa.array(n, pa.int64()), "alone": pa.array(alone, pa.int64()), "shared": pa.array(rest, pa.binary())})

    return work


NODES = "node bigint, n bigint, alone bigint, tokens array<bigint>, filters array<binary>, sketch array<bigint>"


def _outline(levels: np.ndarray):
    """The prefixes of each set under all orders, without the tokens that are in no other set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, filters, sketch = [], [], []
            for n, alone, body in zip(*(batch[c].to_pylist() for c in ("n", "alone", "shared")), strict=True):
                tokens = np.frombuffer(body, np.uint64)
                heads = [prefix(tokens, levels, seed, prefix_size(n) - alone) for seed in ORDERS]
                first.append(heads[0].view(np.int64))
                filters.append([_top(x, _FILTER) for x in heads[1:]])
                sketch.append(parity(tokens))
            yield pa.RecordBatch.from_pydict({
                "node": batch["node"], "n": batch["n"], "alone": batch["alone"], "tokens": pa.array(first, pa.list_(pa.int64())),
                "filters": pa.array(filters, pa.list_(pa.binary())), "sketch": pa.array(sketch, pa.list_(pa.int64()))})

    return work


def _common(a: np.ndarray, b: np.ndarray) -> int:
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    return int(member(short, long).sum())


def least_common(n: int, m: int) -> int:
    """How many tokens prefixes must have in common under any order if the sets are similar enough.

    What two sets share lies in both prefixes or in the rest of the one whose prefix ends earlier.
    """
    need = -(-PERCENT * (n + m) // (100 + PERCENT))
    return max(1, need - max(n - prefix_size(n), m - prefix_size(m)))


def _filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n, m, x, y in zip(*(batch[c].to_pylist() for c in ("n", "m", "x", "y")), strict=True):
            least = least_common(n, m)
            keep.append(all(_common(_from_top(p, _FILTER), _from_top(q, _FILTER)) >= least for p, q in zip(x, y, strict=True)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = _common(x, y)
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n, m, x, y in zip(*(batch[c].to_pylist() for c in ("n", "m", "x", "y")), strict=True):
            both = _common(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
            keep.append(100 * both >= PERCENT * (n + m - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _thinned(nodes: DataFrame) -> DataFrame:
    """(token, node, n, alone, sketch, weight): of tokens that exactly the same nodes have, one, with their number.

    A passage that documents share gives as many such tokens as it has words; one of
    them makes the same candidates.
    """
    rows = nodes.select("node", F.explode("tokens").alias("token"))
    same = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"x{i}") for i, seed in enumerate(ORDERS)]
    lists = rows.groupBy("token").agg(F.count("*").alias("size"), *same).where("size > 1")
    chosen = lists.groupBy("size", "x0", "x1", "x2").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    thin = rows.join(chosen.select("token", "weight"), "token")
    return thin.join(nodes.select("node", "n", "alone", "sketch"), "node").select("token", "node", "n", "alone", "sketch", "weight")


def _pairs(left: DataFrame, right: DataFrame, more: str = "true") -> DataFrame:
    """Of each token, pairs of unlike components that fit in length and by their sketches: a, b, n, m and the token's weight."""
    fits = f"component <> other_component AND 100 * n >= {PERCENT} * other_n AND 100 * other_n >= {PERCENT} * n AND {more}"
    apart = " + ".join(f"bit_count(sketch[{i}] ^ other_sketch[{i}])" for i in range(_LONGS))
    # Sketches are of shared tokens; those that a set has alone are known to differ.
    fits += f" AND {apart} <= n - alone + other_n - other_alone - 2 * (({PERCENT} * (n + other_n) + {99 + PERCENT}) div {100 + PERCENT})"
    first = F.col("node") < F.col("other")
    return left.join(right, "token").where(fits).select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"),
        F.when(first, F.col("n")).otherwise(F.col("other_n")).alias("n"), F.when(first, F.col("other_n")).otherwise(F.col("n")).alias("m"), "weight")


def _as_other(rows: DataFrame) -> DataFrame:
    return rows.select("token", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("alone").alias("other_alone"), F.col("sketch").alias("other_sketch"), F.col("component").alias("other_component"))


def _with_pivots(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of each token's pivots, the nodes that come first in orders of this turn, with all others."""
    places = [F.xxhash64("node", F.lit(1000 * turn + k)) for k in range(PIVOTS)]
    groups = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), *[F.min(x).alias(f"h{k}") for k, x in enumerate(places)]).where("low <> high")
    chosen = reduce(or_, [x == F.col(f"h{k}") for k, x in enumerate(places)])
    pivots = rows.join(groups, "token").where(chosen)
    return _pairs(rows, _as_other(pivots)).select("a", "b", "n", "m").distinct()


def _all_pairs(rows: DataFrame) -> DataFrame:
    """All pairs across components whose prefixes of the first order have enough in common."""
    groups = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    own = rows.join(groups, "token", "left_semi")
    counts = _pairs(own, _as_other(own), "node < other").groupBy("a", "b", "n", "m").agg(F.sum("weight").alias("common"))

    def rest(n: str) -> str:
        return f"(({PERCENT} * {n} + 99) div 100 - 1)"

    return counts.where(f"common >= ({PERCENT} * (n + m) + {99 + PERCENT}) div {100 + PERCENT} - greatest({rest('n')}, {rest('m')})").select("a", "b", "n", "m")


def _verified(near: DataFrame, left: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough, by all tokens of either that are not in it alone."""
    x = left.select(F.col("node").alias("a"), "n", F.col("shared").alias("x"))
    y = left.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("shared").alias("y"))
    return near.select("a", "b").join(x, "a").join(y, "b").mapInArrow(_verify, "a bigint, b bigint")


def _linked(nodes: DataFrame, left: DataFrame, heads: int) -> DataFrame:
    """(node, component) of the nodes that have links; heads: how many sets the corpus has."""
    outlines = nodes.select("node", "filters")
    postings = tables.checkpointed(_thinned(nodes))
    labels = tested = before = None
    turn, rest = 0, False
    while not rest:
        rows = postings.withColumn("component", F.col("node"))
        if labels is not None:
            rows = postings.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        inside = rows.groupBy("token", "component").agg(F.count("*").alias("size"))
        across = inside.groupBy("token").agg((F.sum("size") * F.sum("size") - F.sum(F.col("size") * F.col("size"))).alias("across"))
        total = across.agg(F.sum("across")).first()[0]
        if not total:
            break
        # Pivots are worth a turn as long as they unite much of what is there.
        rest = before is not None and (total <= 2 * REST * heads or 2 * total > before)
        before = total
        pairs = _all_pairs(rows) if rest else _with_pivots(rows, turn)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = tables.checkpointed(pairs)
        now = pairs.select("a", "b")
        tested = now if tested is None else tested.unionAll(now)
        near = (
            pairs.join(outlines.select(F.col("node").alias("a"), F.col("filters").alias("x")), "a")
            .join(outlines.select(F.col("node").alias("b"), F.col("filters").alias("y")), "b")
            .select("a", "b", "n", "m", "x", "y").mapInArrow(_filter, "a bigint, b bigint")
        )
        near = tables.checkpointed(near)
        links = tables.checkpointed(_verified(near, left))
        edges = links if labels is None else links.unionAll(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        if not links.isEmpty():
            labels = components(edges)
        tables.release(nodes)
        turn += 1
    return labels if labels is not None else nodes.select("node", F.col("node").alias("component")).limit(0)


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, uid, n_shingles, component_id and component for each row; uid names its id and text."""
    size = tables.text_bytes(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kind = dict(docs.dtypes)["doc_id"]
    bodies = docs.select("doc_id", F.xxhash64("doc_id", text).alias("uid"), text.cast("binary").alias("body"))
    rows = tables.checkpointed(bodies.mapInArrow(_sign, f"doc_id {kind}, uid bigint, n bigint, class binary"))
    heads = tables.checkpointed(rows.where("class IS NOT NULL").groupBy("class").agg(F.min("uid").alias("uid"), F.min("doc_id").alias("head")))

    # Tokens are as many as words, of six bytes or so.
    bits = packed.bucket_bits(size // 6)
    batches = packed.batched(docs, size)
    side = heads.select(packed.batch_of(size).alias("batch"), "uid")
    shared = packed.repeated(packed.with_answer(batches, side, _send(bits), packed.SENT), bits, False)
    answer = side.withColumn("found", F.lit(None).cast("binary")).unionByName(shared, allowMissingColumns=True)
    left = tables.checkpointed(packed.with_answer(batches, answer, _left(bits), LEFT))
    tables.release(left)
    nodes = tables.checkpointed(left.mapInArrow(_outline(_levels(left)), NODES))

    labels = _linked(nodes, left, heads.count())
    named = heads.join(labels.withColumnRenamed("node", "uid"), "uid", "left").select("class", "head", F.coalesce("component", "uid").alias("component"))
    least = named.groupBy("component").agg(F.min("head").alias("component_id"))
    named = named.join(least, "component").select("class", "component", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id", "uid", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "component")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with one document of each component; those with an empty set all stay."""
    marked = tables.checkpointed(classes(docs).select("doc_id", "uid", "component"))
    first = marked.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "uid")).alias("keep"))
    own, uid = tables.free(docs.columns, "own uid"), tables.free(docs.columns, "uid")
    kept = first.select(F.col("keep.uid").alias(uid)).unionAll(marked.where("component IS NULL").select(F.col("uid").alias(uid)).distinct())
    out = docs.withColumn(own, F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit(""))))
    again = F.col(own) == F.col(uid)
    out = out.join(kept, again, "left_semi")
    twice = marked.where("component IS NOT NULL").groupBy("uid").count().where("count > 1").select(F.col("uid").alias(uid))
    if not twice.isEmpty():
        out = out.join(twice, again, "left_anti").unionByName(out.join(twice, again, "left_semi").dropDuplicates([own]))
    return out.drop(own)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(tables.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op4_ngram_jaccard": op4_ngram_jaccard}
#: Components are no SQL of acceptable cost over all pairs; tests compare with brute force.
ORACLES: dict[str, str] = {}
