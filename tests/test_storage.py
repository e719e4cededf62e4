"""Tables that jobs stage, and outputs that are replaced."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tables import S1, S2, S3, entities, golden_pairs, pairs

from twinfold.operators.outputs import id_lists
from twinfold.plans import jobs
from twinfold.session import owned_tables, shared_folder, stage, together
from twinfold.sources.sinks import write_parquet, write_record, write_report, write_tsv


def staged(spark):
    folder = Path(shared_folder(spark)) / spark.sparkContext.applicationId
    return {p.name for p in folder.glob("staged-*")}


@pytest.fixture
def sources(spark, tmp_path):
    for name, rows in (("s1", S1), ("s2", S2), ("s3", S3)):
        entities(spark, rows).write.parquet(f"{tmp_path}/{name}.parquet")
    return jobs.Sources(*(f"{tmp_path}/{n}.parquet" for n in ("s1", "s2", "s3")))


def test_owned_tables_are_removed(spark):
    before = staged(spark)
    with owned_tables(spark):
        rows = together(lambda: stage(spark.range(5)).count(), lambda: stage(spark.range(7)).count())
        assert len(staged(spark) - before) == 2 and rows == [5, 7]
        with pytest.raises(ZeroDivisionError), owned_tables(spark):
            stage(spark.range(3))
            1 / 0
        assert len(staged(spark) - before) == 2
    assert staged(spark) == before
    stage(spark.range(1))
    assert len(staged(spark) - before) == 1


def test_jobs_leave_no_staged_table(spark, sources, tmp_path):
    before = staged(spark)
    known = f"{tmp_path}/pairs"
    capped = jobs.block_capped_job(spark, sources, known).collect()
    tokens = jobs.block_tokens_job(spark, sources, f"{tmp_path}/tokens", known=known).count()
    grams = jobs.block_ngrams_job(spark, sources, known, f"{tmp_path}/grams").count()
    pairs(spark, golden_pairs()).write.mode("overwrite").parquet(known)
    features = f"{tmp_path}/features"
    assert jobs.pair_features_job(spark, sources, known, features).count() == 14
    assert jobs.fuzzy_features_job(spark, features, f"{tmp_path}/fuzzy").count() == 14
    assert capped and tokens and grams
    assert staged(spark) == before


def broken(spark):
    return spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))


@pytest.mark.parametrize("write", [write_parquet, write_tsv, write_report, write_record])
def test_a_failed_write_leaves_the_old_output(spark, tmp_path, write):
    path = f"{tmp_path}/out"
    assert write(spark.range(6), path) == 6
    old = sorted(p.name for p in Path(path).iterdir())
    with pytest.raises(Exception, match="broken"):
        write(broken(spark), path)
    assert sorted(p.name for p in Path(path).iterdir()) == old
    assert write(spark.range(9), path) == 9
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_table_can_replace_itself(spark, tmp_path):
    path = f"{tmp_path}/out"
    write_parquet(spark.range(4), path)
    assert write_parquet(spark.read.parquet(path).where("id > 0"), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_rows_are_counted_by_the_write_itself(spark, tmp_path):
    """One pass over the rows gives the table and its size."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 1000, 1, 3).mapInArrow(count, "id long")
    assert write_parquet(rows, f"{tmp_path}/out") == 1000 and passed.value == 1000
    assert write_tsv(spark.range(0), f"{tmp_path}/none", "id") == 0


def test_a_list_that_is_too_long_names_its_entity(spark):
    s1 = entities(spark, [("one", "a", "b"), ("two", "a", "b")])
    wanted = pairs(spark, [("one", "x"), ("two", "x"), ("two", "yy"), ("two", "yy")])
    found = {r[0]: r[1] for r in id_lists(s1, wanted, "ids", most=4).collect()}
    assert found == {"one": "x", "two": "x,yy"}
    with pytest.raises(Exception, match="ids of entity two takes more than 3 bytes"):
        id_lists(s1, wanted, "ids", most=3).collect()
