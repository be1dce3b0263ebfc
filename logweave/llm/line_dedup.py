"""Removal of repeated runs of lines, found by winnowing over line hashes; Spark columns only.

The lines of a text that are not blank are hashed, K neighbouring line hashes make a gram, and
of every window of W neighbouring grams the least (of equals the last) is a fingerprint. Two
places with the same K + W - 1 lines have a fingerprint in common, whatever stands around
them. Positions of fingerprints that occur more than once are joined; each such match is
extended both ways to the runs of K + W - 1 lines that hold it. A single line of LEAST_WORDS
words or more is a fingerprint and a run by itself, so a passage goes on however few lines it
stands. A run that occurred earlier, by document id and line, is deleted line by line;
overlapping runs thus go whole, however long. The first occurrence stays. What is repeated on
fewer lines than K + W - 1, each of fewer words, stays.

No pairs are formed: a run is compared with its first occurrence alone, and hot fingerprints
and runs are counted before they are shuffled and joined with Spark's splitting of skewed keys.

Defined cases: NULL text stays NULL and has no lines; lines of spaces alone are blank, stay
where they are and belong to no run; spaces at the ends of a line do not count; documents
of NULL id come last; rows that agree in id and text are one document given twice (neither is
later than the other); an empty table gives an empty result; columns of any other name pass
through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import tables

GRAM = 2
WINDOW = 2
#: A line of so many words is a run however few lines repeat with it.
LEAST_WORDS = 20
_WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of the value, which is computed once however often `then` uses it."""
    return F.transform(F.array(value), then)[0]


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)


def _uid() -> Column:
    return F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")))


def _fingerprints(grams: Column, window: int) -> Column:
    """Places of the least gram in each window, of equals the last."""

    def least(i: Column) -> Column:
        return _let(F.slice(grams, i + 1, F.lit(window)), lambda own: (i + window - F.array_position(F.reverse(own), F.array_min(own))).cast("int"))

    return F.array_distinct(F.transform(_upto(F.size(grams) - window + 1), least))


def _hashed(keys: Column, n: int) -> Column:
    """Hash of each n neighbouring keys."""
    return F.transform(_upto(F.size(keys) - n + 1), lambda i: F.xxhash64(*[F.get(keys, i + j) for j in range(n)]))


def repeated_lines(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, least_words: int = LEAST_WORDS) -> DataFrame:
    """uid (of id and text) and gone: the lines to delete, by their place in the text (0-based), in order."""
    run = gram + window - 1
    lines = docs.select("doc_id", _uid().alias("uid"), _lines().alias("lines")).select(
        "doc_id", "uid", _let(F.col("lines"), lambda own: F.filter(F.transform(own, lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("body"))), lambda x: x["body"] != "")).alias("own"))
    # A line has fewer words than characters.
    is_long = lambda x: (F.length(x["body"]) >= 2 * least_words - 1) & (F.regexp_count(x["body"], F.lit(_WORD)) >= least_words)
    wide = lines.select("doc_id", "uid", F.posexplode("own").alias("start", "x")).where(is_long(F.col("x"))).select(
        # Not the hash of any run of several lines.
        "doc_id", "uid", F.xxhash64(F.lit("line"), "x.body").alias("run"), "start", F.array("x.at").alias("lines"))
    keyed = lines.where(F.size("own") >= run).select(
        "doc_id", "uid", F.transform("own", lambda x: x["at"]).alias("at"), F.transform("own", lambda x: F.xxhash64(x["body"])).alias("keys"))
    grams = keyed.select("doc_id", "uid", "at", _hashed(F.col("keys"), gram).alias("grams"), _hashed(F.col("keys"), run).alias("runs"))
    prints = grams.select(
        "doc_id", "uid", "at", "runs", "grams", F.explode(_fingerprints(F.col("grams"), window)).alias("place"))
    # Runs that hold the gram at `place`, with the lines of each.
    starts = F.filter(F.sequence(F.col("place") - window + 1, F.col("place")), lambda s: (s >= 0) & (s < F.size("runs")))
    prints = prints.select(
        "doc_id", "uid", F.get("grams", F.col("place")).alias("print"),
        F.transform(starts, lambda s: F.struct(F.get("runs", s).alias("run"), s.alias("start"), F.slice("at", s + 1, run).alias("lines"))).alias("around"))
    often = prints.groupBy("print").count().where("count > 1").select("print")
    matched = prints.join(often, "print")
    several = matched.select("doc_id", "uid", F.explode("around").alias("x")).select("doc_id", "uid", "x.run", "x.start", "x.lines")
    again = wide.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("run")
    runs = several.unionByName(wide.join(again, "run", "left_semi")).select(
        "run", F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("uid").alias("uid"), F.col("start").alias("start")).alias("place"), "lines")
    first = runs.groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("end")).where(~F.col("first").eqNullSafe(F.col("end"))).select("run", "first")
    later = runs.join(first, "run").where(~F.col("place").eqNullSafe(F.col("first")))
    gone = later.select(F.col("place.uid").alias("uid"), F.explode("lines").alias("line"))
    return gone.groupBy("uid").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, gone: str = "gone", least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows and columns, text without repeated runs, and under the name `gone` the lines deleted (NULL if none)."""
    uid, key, lines = (tables.free(docs.columns, x) for x in ("own uid", "uid", "lines"))
    marked = repeated_lines(docs, gram, window, least_words).select(F.col("uid").alias(key), F.col("gone").alias(lines))
    joined = docs.withColumn(uid, _uid()).join(marked, F.col(uid) == F.col(key), "left")
    rest = _let(_lines(), lambda own: F.array_join(F.transform(F.array_except(_upto(F.size(own)), F.col(lines)), lambda i: F.get(own, i)), "\n"))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(rest)
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in tables.others(docs.columns, [gone])], F.col(lines).alias(gone))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = drop_repeated_lines(docs.withColumn("n_lines", F.size(_lines()).cast("bigint")))
    return rows.select(
        "doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


LINES_SQL = rf"""
WITH line AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS body, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
own AS (SELECT doc_id, pos, trim(body, ' ') AS body, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM line WHERE trim(body, ' ') <> ''),
run AS (
  SELECT doc_id, place, [body, lead(body) OVER w, lead(body, 2) OVER w] AS bodies, [pos, lead(pos) OVER w, lead(pos, 2) OVER w] AS ats
  FROM own WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
whole AS (SELECT *, row_number() OVER (PARTITION BY bodies ORDER BY doc_id, place) AS turn FROM run WHERE bodies[3] IS NOT NULL),
wide AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id, place) AS turn FROM own WHERE len(regexp_extract_all(body, '{_WORD}')) >= {LEAST_WORDS}),
gone AS (SELECT doc_id, unnest(ats) AS pos FROM whole WHERE turn > 1 UNION SELECT doc_id, pos FROM wide WHERE turn > 1)
SELECT line.doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY line.pos) FILTER (WHERE gone.pos IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.pos = gone.pos GROUP BY line.doc_id
"""

QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES = {"op3_line_dedup": LINES_SQL}
