"""Input columns that are called like any helper column change nothing and come back unchanged."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import decontaminate, html_extract, jaccard_join, language, licenses, line_dedup, mixing, quality_rules, secrets, tables

ROOT = __file__.rsplit("/tests/", 1)[0]
#: Every name in quotes that any module of the package gives to a column, and the longer ones that `free` would try next.
FOUND = sorted({
    name for module in ("decontaminate", "html_extract", "jaccard_join", "language", "licenses", "line_dedup", "mixing", "quality_rules", "secrets", "exact_dedup", "merkle", "periodic_runs")
    for name in re.findall(r'(?:alias|withColumn|withColumnRenamed|free)\((?:[^()"]*, )?"([A-Za-z_ ]+)"', open(f"{ROOT}/logweave/llm/{module}.py").read())})
MADE = {"spans", "text", "n_chars", "url", "path", "doc_id", "source", "lang", "gone", "license", "own_license", "own_score", "folder_of_license", "n_tokens", "epoch", "block", "weight", "at", "lang_pred", "score", "n_words"}
NAMES = sorted({x.lower() for x in FOUND + [f"{x}_" for x in FOUND] + [
    "__body", "__uid", "__row_uid", "__gone", "__hit", "__own", "__key", "__block", "__n", "__dir", "__up", "__lang", "__lines", "text as bytes", "language", "certainty", "own uid", "lines gone"]} - MADE)

TEXTS = ["the cat sat on the mat. it was a warm day for all of us.", "first line\nsecond line\nthird line\nown", "first line\nsecond line\nthird line\nother", None, "",
         "password = abcdefgh12345678", "le chat est sur le tapis. il fait chaud pour nous tous.", "the cat sat on the mat. it was a warm day for all of us."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(i, t, "src", "en" if i < 6 else "fr", len(t or ""), f"/a/{i}/LICENSE", f"<p>{t}</p>") for i, t in enumerate(TEXTS)],
                                 "doc_id bigint, text string, source string, lang string, n_chars bigint, path string, html string")
    return rows.select("*", *[F.concat(F.lit(f"{n}="), F.col("doc_id").cast("string")).alias(n) for n in NAMES]).repartition(2).persist()


def unchanged(rows, columns=NAMES):
    assert set(columns) <= set(rows.columns)
    for row in rows.select("doc_id", *[F.col(f"`{c}`") for c in columns]).collect():
        assert list(row)[1:] == [f"{c}={row.doc_id}" for c in columns]


def test_names_that_are_tried():
    assert len(NAMES) > 60 and {"uid", "body", "row", "draw", "best"} <= set(NAMES)


OPERATORS = {
    "secrets": lambda docs: secrets.find_secrets(docs, *docs.columns),
    "quality": lambda docs: quality_rules.judge(docs, *docs.columns),
    "lines": line_dedup.drop_repeated_lines,
    "near copies": jaccard_join.one_of_each,
    "html": lambda docs: html_extract.extract(docs, *docs.columns),
    "benchmark": lambda docs: decontaminate.clean_documents(docs, docs.select("text", F.col("doc_id").alias("item_id")).where("doc_id = 99")),
    "mix": mixing.mix,
    "language": lambda docs: language.identify(docs, language.train(docs), *docs.columns),
    "licenses": licenses.scan,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_leave_other_columns_as_they_are(docs, name):
    run = OPERATORS[name]
    made = run(docs)
    unchanged(made, [c for c in NAMES if c in {x.lower() for x in made.columns}])
    plain = docs.drop(*[f"{c}" for c in NAMES])
    want = run(plain)
    own = [c for c in want.columns if c not in ("cost",)]
    assert {c.lower() for c in docs.columns} <= {c.lower() for c in made.columns}
    key = lambda rows: sorted(map(repr, rows.select(*[F.col(f"`{c}`") for c in own]).collect()))
    assert key(made) == key(want)


def test_stages_of_the_corpus_run_leave_other_columns_as_they_are(spark, docs, tmp_path):
    docs.select(F.col("doc_id").alias("item_id"), F.lit("nothing that any text holds at all in ten words or more").alias("text")).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = tables.stored(stage(spark, rows, str(tmp_path)))
        assert rows.columns == docs.columns, name
        unchanged(rows)
    assert rows.count() == 5
    unchanged(corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)))
