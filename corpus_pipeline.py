"""From raw documents to a training mix: language, lines, near copies, benchmark passages, weights.

Every stage takes and returns whole tables; all but the last return the columns of their input.
NULL or empty texts go in the first stage, as their language is unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import decontaminate, jaccard_join, language, line_dedup, mixing, tables


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from their own labels."""
    names = tuple(tables.free(docs.columns, x) for x in ("language", "certainty", "spans"))
    rows = language.identify(docs, language.train(docs), *docs.columns, names=names)
    return rows.where(F.col(names[0]) != language.UNKNOWN).select(*_columns(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that occurred before; a document that loses all its lines goes."""
    gone = tables.free(docs.columns, "lines gone")
    rows = line_dedup.drop_repeated_lines(docs, gone=gone).where(F.col(gone).isNull() | F.col("text").rlike(r"[^\x20\n]"))
    return rows.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*_columns(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs).select(*_columns(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean_documents(docs, tables.read(spark, sf_dir, "benchmark")).select(*_columns(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for, with their place in the mix."""
    return mixing.mix(docs)


STAGES = [
    ("language", known_language),
    ("lines", without_repeated_lines),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("mix", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language and mix are trained and searched for, which SQL cannot express.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
