"""A Merkle manifest of a table, and a recursive query that climbs it from every leaf.

Each row is a leaf: the SHA-256 of its columns. The leaves of a group, in order, make a tree in
which eight consecutive nodes have one parent, the hash of theirs; the roots of the groups' trees,
in the order of the groups, are the leaves of one more tree. Levels are built bottom up and stored,
a row for each inner node: its id, its parent's id, its place among the parent's children, its hash
and the hashes of its children.

The check climbs: a recursive query starts from the runs of eight leaves, finds the node above by
its id, appends the siblings' hashes to the proof and folds them with what was shown for each
leaf, until a node has no parent. Leaves of a run have all siblings in common from the run upwards,
so they travel in one row, each with its own fold.

Places are numbered by range partitions and their counts, not by one window over a group. As all
leaves meet at the root, nodes above the third level are stored once for each block of 512 leaves
below them (their ids name the block): no row of the join is looked for by more than 64 runs, and
the copies are a sixtieth of the leaves for each level.

Defined cases: NULL in any column is hashed as `-`; groups are ordered NULL first, then by bytes;
a NULL id is smaller than any other; leaves of equal id are ordered by their hash, and rows equal
in all hashed columns have equal leaves in neighbouring places; a group of one row has its leaf for
a root, and a table of one group that group's root; an empty table has no rows. Columns that
are not hashed are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm import tables

#: Levels whose nodes are stored once; a block is the leaves below a node of the last of them.
OWN_LEVELS = 3
_MOST_LEVELS = 21  # 8 ** 21 is the largest power of eight in 64 bits
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


class Manifest(NamedTuple):
    """`runs`: leaves, eight to a row, with the id of the node to climb to. `nodes`: all inner nodes above them."""

    runs: DataFrame
    nodes: DataFrame


def _hash(body: Column) -> Column:
    return F.unhex(F.sha2(body.cast("binary"), 256))


def _text(hashes: Column) -> Column:
    return F.lower(F.hex(hashes))


def leaf(*columns: Column) -> Column:
    """Hash of the columns: of each its bytes' number, a colon and its value; `-` for NULL."""
    texts = [c.cast("string") for c in columns]
    return _hash(F.concat(*[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]))


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return sum(((n > 8**level).cast("int") for level in range(_MOST_LEVELS)), F.lit(0))


def _numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """Rows, stored in order of tree and `order`, with `at`; and for each part of a tree: tree, part, shift, n.

    The place of a row in its tree is at + shift, for the part at >> 33; n is the size of the tree.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = tables.stored(rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id()))
    counts = laid.groupBy("tree", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("own"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("own").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return laid, counts.select("tree", "part", (before - F.col("begin")).alias("shift"), F.sum("own").over(whole).alias("n"))


def _up(rows: DataFrame) -> DataFrame:
    """Nodes (tree, n, pos, hash, hashes) above nodes (tree, n, pos, hash) of one level."""
    children = F.array_sort(F.collect_list(F.struct("pos", "hash")))
    text = F.array_join(F.transform(children, lambda x: _text(x["hash"])), "")
    above = rows.groupBy("tree", "n", F.shiftright("pos", 3).alias("pos")).agg(text.alias("text"))
    return above.select("tree", "n", "pos", _hash(F.col("text")).alias("hash"), F.unhex("text").alias("hashes"))


def _climbed(rows: DataFrame, height: int) -> list[DataFrame]:
    """Levels 1 to `height` above the rows, each of the trees that reach so far, each stored."""
    out = []
    for level in range(height):
        rows = tables.stored(_up(rows.where(F.col("n") > 8**level)))
        out.append(rows)
    return out


def _id(tree: Column, step: Column, spot: Column) -> Column:
    return F.struct(tree.cast("bigint").alias("tree"), step.cast("int").alias("step"), spot.cast("bigint").alias("spot"))


def _nodes(rows: DataFrame, step: Column, top: Column, place: Column, spots: Column) -> DataFrame:
    """Node rows for each spot: rows (tree, n, hash, hashes) at `step` of a way that ends at step `top`."""
    spread = rows.select("tree", "n", "hash", "hashes", step.alias("step"), top.alias("top"), place.cast("int").alias("place"), F.explode(spots).alias("spot"))
    above = F.when(F.col("step") < OWN_LEVELS, F.shiftright("spot", 3)).otherwise(F.col("spot"))
    return spread.select(
        _id(F.col("tree"), F.col("step"), F.col("spot")).alias("node"),
        F.when(F.col("step") < F.col("top"), _id(F.col("tree"), F.col("step") + 1, above)).alias("parent"),
        "place", "hash", "hashes", (F.col("step") == _height(F.col("n"))).alias("subroot"))


def _blocks(n: Column) -> Column:
    """Number of the last block of a tree of n leaves."""
    return F.shiftright(n - 1, 3 * OWN_LEVELS)


def build(docs: DataFrame, doc_id: str, group: str, made: Column, shown: Column | None = None) -> Manifest:
    """The manifest of rows with leaves `made`; `shown` are the leaves that are to be checked against it."""
    # '-' sorts before '=': NULL comes first, then the groups by their bytes.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    first = tables.stored(docs.select(
        tree.alias("tree"), F.col(doc_id).alias("id"), made.alias("leaf"), (made if shown is None else shown).alias("shown"), F.monotonically_increasing_id().alias("row")))
    laid, parts = _numbered(first, "id", "leaf", "row")
    parts = tables.stored(parts)
    # Trees are the leaves of the tree at the top, and get their numbers like leaves.
    named, whole = _numbered(parts.groupBy("tree").agg(F.max("n").alias("n")).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "n"), "name")
    trees = named.withColumnRenamed("n", "leaves").withColumn("part", F.shiftright("at", 33)).join(whole, ["tree", "part"]).select(
        F.col("name").alias("tree"), (F.col("at") + F.col("shift")).alias("number"))
    parts = tables.stored(parts.join(trees, "tree"))
    most, n_trees = parts.agg(F.max("n"), F.countDistinct("number")).first()
    heights = [next(h for h in range(_MOST_LEVELS) if 8**h >= (n or 1)) for n in (most, n_trees)]

    leaves = laid.withColumn("part", F.shiftright("at", 33)).join(parts, ["tree", "part"]).select(
        F.col("number").alias("tree"), "n", (F.col("at") + F.col("shift")).alias("pos"), "id", "leaf", "shown")
    runs = tables.stored(leaves.groupBy("tree", "n", F.shiftright("pos", 3).alias("pos")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "leaf", "shown"))).alias("own")))
    hashes = F.transform("own", lambda x: _text(x["leaf"]))
    lone = F.col("n") == 1
    level = runs.select("tree", "n", "pos", F.when(lone, F.get("own", F.lit(0))["leaf"]).otherwise(_hash(F.array_join(hashes, ""))).alias("hash"))
    levels = [level, *_climbed_from(level, heights[0])]

    roots = levels[0].where(F.col("n") <= 8)
    for k, rows in enumerate(levels[1:], 2):
        roots = roots.unionAll(rows.where((F.col("n") > 8 ** (k - 1)) & (F.col("n") <= 8**k)).select("tree", "n", "pos", "hash"))
    roots = tables.stored(roots)
    top = _climbed(roots.select(F.lit(-1).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"), F.col("tree").alias("pos"), "hash"), heights[1])

    end = _height(F.col("n")) + heights[1]
    place = lambda step: F.when(step < _height(F.col("n")), F.col("pos").bitwiseAND(7)).otherwise(F.col("tree").bitwiseAND(7))
    frames = []
    for k, rows in enumerate(levels[1:], 2):
        own = F.col("pos")
        if k <= OWN_LEVELS:
            spots = F.array(own)
        else:
            wide = 3 * (k - OWN_LEVELS)
            spots = F.sequence(F.shiftleft(own, wide), F.least(F.shiftleft(own + 1, wide) - 1, _blocks(F.col("n"))))
        frames.append(_nodes(rows, F.lit(k), end, place(F.lit(k)), spots))
    for k, rows in enumerate(top, 1):
        below = F.sequence(F.shiftleft("pos", 3 * k), F.least(F.shiftleft(F.col("pos") + 1, 3 * k) - 1, F.lit(n_trees - 1).cast("bigint")))
        spread = rows.select(F.explode(below).alias("tree"), F.col("pos").bitwiseAND(7).alias("above"), "hash", "hashes").join(roots.select("tree", "n"), "tree")
        frames.append(_nodes(spread, _height(F.col("n")) + k, end, F.col("above"), F.sequence(F.lit(0).cast("bigint"), _blocks(F.col("n")))))

    step = F.when(lone, F.lit(0)).otherwise(F.lit(1))
    climbers = runs.join(level.select("tree", "pos", "hash"), ["tree", "pos"]).select(
        F.when(step < end, _id(F.col("tree"), step + 1, F.shiftright("pos", 3))).alias("node"),
        place(step).cast("int").alias("place"),
        F.transform("own", lambda x: F.struct(x["id"].alias("id"), x["leaf"].alias("leaf"), _folded_in_run(x).alias("fold"))).alias("members"),
        F.when(F.col("n") <= 8, F.col("hash")).alias("subroot"), F.col("hash").alias("root"))
    nodes = frames[0] if frames else _nodes(levels[0].withColumn("hashes", F.col("hash")).limit(0), F.lit(1), end, F.lit(0), F.array(F.lit(0).cast("bigint")))
    for more in frames[1:]:
        nodes = nodes.unionAll(more)
    return Manifest(tables.stored(climbers), tables.stored(nodes))


def _climbed_from(level: DataFrame, height: int) -> Iterator[DataFrame]:
    """Levels 2 to `height` above level 1."""
    rows = level
    for k in range(1, height):
        rows = tables.stored(_up(rows.where(F.col("n") > 8**k)))
        yield rows


def _folded_in_run(member: Column) -> Column:
    """The hash of the run with what was shown for one member in the place of its leaf."""
    own = F.col("own")
    body = F.array_join(F.transform(own, lambda x: _text(F.when(x["pos"] == member["pos"], x["shown"]).otherwise(x["leaf"]))), "")
    return F.when(F.col("n") == 1, member["shown"]).otherwise(_hash(body))


@contextmanager
def _all_rows(spark: SparkSession) -> Iterator[None]:
    """Lifts Spark's limit of a million rows for a recursive query while one runs."""
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(_ROW_LIMIT, before)


_CLIMB = """
WITH RECURSIVE climb (node, place, members, proof, subroot, root) AS (
  SELECT node, place, members, unhex(''), subroot, root FROM {runs}
  UNION ALL
  SELECT n.parent, n.place,
    transform(c.members, m -> named_struct('id', m.id, 'leaf', m.leaf, 'fold',
      unhex(sha2(lower(hex(concat(substring(n.hashes, 1, 32 * c.place), m.fold, substring(n.hashes, 32 * c.place + 33)))), 256)))),
    concat(c.proof, substring(n.hashes, 1, 32 * c.place), substring(n.hashes, 32 * c.place + 33)),
    coalesce(c.subroot, CASE WHEN n.subroot THEN n.hash END), n.hash
  FROM climb c JOIN {nodes} n ON c.node = n.node
)
SELECT members, proof, subroot, root FROM climb WHERE node IS NULL
"""


def climb(manifest: Manifest) -> DataFrame:
    """id, leaf, subroot, root, siblings (hashes on the way up, left to right) and fold of every leaf."""
    spark = manifest.runs.sparkSession
    with _all_rows(spark):
        ends = tables.stored(spark.sql(_CLIMB, runs=manifest.runs, nodes=manifest.nodes))
    one = ends.select("members", "proof", "subroot", "root", F.posexplode("members").alias("at", "member"))
    others = F.array_join(F.transform(F.filter("members", lambda x, i: i != F.col("at")), lambda x: _text(x["leaf"])), "")
    return one.select("member.id", "member.leaf", "subroot", "root", F.unhex(F.concat(others, _text(F.col("proof")))).alias("siblings"), "member.fold")


def verify(docs: DataFrame, doc_id: str, group: str, columns: Sequence[Column], shown: Sequence[Column] | None = None) -> DataFrame:
    """What `climb` gives, all hashes as hexadecimal text, proof_sha256 for the siblings, and verified."""
    rows = climb(build(docs, doc_id, group, leaf(*columns), None if shown is None else leaf(*shown)))
    return rows.select(
        F.col("id").alias(doc_id), _text(F.col("leaf")).alias("leaf"), _text(F.col("subroot")).alias("subroot"), _text(F.col("root")).alias("root"),
        F.sha2(_text(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"), _text(F.col("fold")).alias("folded_root"), (F.col("fold") == F.col("root")).alias("verified"))


_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    columns = [F.col(c) for c in _COLUMNS]
    return verify(docs, "doc_id", "lang", columns, [*columns[:-1], F.when(tampered, lowered).otherwise(F.col("text"))])


_H = """sha256(concat({}))""".format(", ".join(f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')" for c in _COLUMNS[:-1]) + ", {text}")
_TEXT = "coalesce(octet_length(encode({0}))::varchar || ':' || {0}, '-')"
CLIMB_SQL = f"""
WITH RECURSIVE
own AS (SELECT *, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(doc_id::varchar) + 1),
    lambda i: list_concat([ascii((doc_id::varchar)[i])::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc FROM documents),
doc AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
    {_H.format(text=_TEXT.format("text"))} AS leaf,
    CASE WHEN (4294967295 - crc) % 3 = 0 THEN {_H.format(text=_TEXT.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))} ELSE {_H.format(text=_TEXT.format("text"))} END AS shown
  FROM own),
low (lang, level, pos, hash, n) AS (
  SELECT lang, 0, idx, leaf, n FROM doc
  UNION ALL
  SELECT lang, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM low WHERE n > 1 GROUP BY lang, level, pos // 8),
tree AS (SELECT lang, level AS height, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, count(*) OVER () AS n FROM low WHERE n = 1),
high (level, pos, hash, n) AS (
  SELECT 0, t, subroot, n FROM tree
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM high WHERE n > 1 GROUP BY level, pos // 8),
sib AS (
  SELECT d.doc_id, l.level AS step, string_agg(l.hash, '' ORDER BY l.pos) FILTER (WHERE l.pos < (d.idx >> (3 * l.level))) AS lefts,
    string_agg(l.hash, '' ORDER BY l.pos) FILTER (WHERE l.pos > (d.idx >> (3 * l.level))) AS rights
  FROM doc d JOIN low l ON l.lang IS NOT DISTINCT FROM d.lang AND l.n > 1 AND l.pos // 8 = (d.idx >> (3 * l.level)) // 8 GROUP BY ALL
  UNION ALL
  SELECT d.doc_id, t.height + h.level, string_agg(h.hash, '' ORDER BY h.pos) FILTER (WHERE h.pos < (t.t >> (3 * h.level))),
    string_agg(h.hash, '' ORDER BY h.pos) FILTER (WHERE h.pos > (t.t >> (3 * h.level)))
  FROM doc d JOIN tree t ON t.lang IS NOT DISTINCT FROM d.lang JOIN high h ON h.n > 1 AND h.pos // 8 = (t.t >> (3 * h.level)) // 8 GROUP BY ALL),
fold (doc_id, step, hash) AS (
  SELECT doc_id, 0, shown FROM doc
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(concat(lefts, f.hash, rights)) FROM fold f JOIN sib s ON s.doc_id = f.doc_id AND s.step = f.step),
proof AS (SELECT doc_id, sha256(string_agg(concat(lefts, rights), '' ORDER BY step)) AS proof_sha256 FROM sib GROUP BY doc_id),
root AS (SELECT hash AS root FROM high WHERE n = 1),
last AS (SELECT doc_id, arg_max(hash, step) AS folded_root FROM fold GROUP BY doc_id)
SELECT doc.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM doc JOIN tree ON tree.lang IS NOT DISTINCT FROM doc.lang CROSS JOIN root LEFT JOIN proof ON proof.doc_id = doc.doc_id JOIN last ON last.doc_id = doc.doc_id
"""

QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLES = {"op11_merkle_manifest": CLIMB_SQL}
