"""The pipeline's stages against plain Python, and the SQL of the queries."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from twinfold.llm.decontam import decontaminate  # noqa: E402
from twinfold.llm.queries import QUERIES  # noqa: E402
from twinfold.llm.simhash import simhash_components  # noqa: E402
from twinfold.llm.sql import SQL  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    extra = [
        (900001, None, None, None, None, "k"),
        (900002, "12 34 ...", "en", "src1", 9, "k"),
        (None, "A document that has no id of its own", "en", "src1", 9, "k"),
        (900003, "twice the same row is one document", "en", "src1", 9, "k"),
        (900003, "twice the same row is one document", "en", "src1", 9, "k"),
    ]
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit("k"))
    return table.unionByName(spark.createDataFrame(extra, table.schema)).repartition(3)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)


def test_language_stage_keeps_all_with_words(spark, docs):
    out = STAGE["language_id"](spark, docs, SF)
    assert out.columns == docs.columns
    assert set(ids(docs)) - set(ids(out)) == {900001, 900002}
    assert out.where("doc_id = 900003").count() == 2


def test_exact_stage(spark, docs):
    out = STAGE["exact_dedup"](spark, docs, SF)
    assert out.columns == docs.columns
    groups = defaultdict(set)
    for r in docs.collect():
        groups[re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")].add(r["doc_id"])
    want = {max(g - {None}, default=None) for g in groups.values()}
    assert set(ids(out)) == want


def test_near_copy_stage(spark, docs):
    out = STAGE["simhash"](spark, docs, SF)
    found = simhash_components(docs).collect()
    assert out.columns == docs.columns
    assert set(ids(out)) == {r["doc_id"] for r in found if r["doc_id"] == r["component_id"]}
    assert {r["component_id"] for r in found} <= set(ids(out))


def test_decontamination_stage(spark, docs):
    out = STAGE["decontamination"](spark, docs, SF)
    judged = decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    gone = {r["doc_id"] for r in judged if r["contaminated"]}
    assert gone and out.columns == docs.columns and set(ids(docs)) - set(ids(out)) == gone


def test_run_is_the_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(ids(docs))


def test_stages_of_an_empty_table(spark, docs):
    none = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, none, SF).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    found = sorted(str(tuple(r[c] for c in names)) for r in df.collect())
    assert found == sorted(str(tuple(r)) for r in cursor.fetchall())
