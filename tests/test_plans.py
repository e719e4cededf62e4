"""Plans: what is read, what is shuffled, and joins that must not appear."""

import re

import pytest
from pyspark.sql import functions as F
from tables import S1, S2, S3, entities, golden_pairs, pairs, truth

from twinfold.operators import exact, ngrams, outputs, tokens
from twinfold.operators.features import RAW_TEXT, pair_features
from twinfold.operators.similarity import fuzzy_features, text_scores
from twinfold.operators.truth import evaluate_blocking, missed_details
from twinfold.session import stage


@pytest.fixture(scope="module")
def stored(spark):
    """Tables on disk, and no broadcast that is only due to their size."""
    s1, c = stage(entities(spark, S1)), stage(entities(spark, S2 + S3))
    known, wanted = stage(truth(spark)), stage(pairs(spark, golden_pairs()))
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield s1, c, known, wanted
    for name in names:
        spark.conf.unset(name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", part)) for part in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", text))


def test_no_join_without_keys(stored):
    s1, c, known, wanted = stored
    frames = [
        exact.exact_block(s1, c),
        exact.capped_block(s1, c),
        tokens.token_block(s1, c, "clean_name"),
        ngrams.ngram_block(s1, c),
        pair_features(wanted, s1, c),
        evaluate_blocking(wanted, known, s1, c, c),
        missed_details(wanted, known, s1, c),
        *outputs.build_outputs(s1, wanted, wanted.selectExpr("*", "0 as prediction")),
    ]
    for df in frames:
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_columns_are_pruned(stored):
    s1, c, _, wanted = stored
    for columns in read_columns(plan(exact.exact_rows(s1, c, "clean_name"))):
        assert columns == {"entity_id", "clean_name", "clean_country"}
    lengths = pair_features(wanted, s1, c).select("name_length_diff", "name_exact")
    text = plan(lengths)
    assert all("clean_address" not in columns for columns in read_columns(text))
    exchanged = re.findall(r"Exchange hashpartitioning.*\n.*Project \[(.*?)\]\n", text)
    assert exchanged and not any("AS name1#" in line for line in exchanged)


def test_shuffle_counts(stored):
    s1, c, _, wanted = stored
    assert shuffles(plan(exact.exact_rows(s1, c, "clean_name"))) == 2
    assert shuffles(plan(pair_features(wanted, s1, c))) == 4
    # token: both sides of the vocabulary join, both sides of the pair join, the pairs
    assert shuffles(plan(tokens.token_block(s1, c, "clean_name"))) == 5
    # two vocabulary joins, the ranking, the pair join (one side is in place), the scores
    frequency, hot = ngrams.gram_statistics(s1, c)
    scores = ngrams.gram_pair_scores(s1, c, statistics=(frequency, hot))
    assert shuffles(plan(ngrams.best_candidates(scores))) == 7


def test_similarity_crosses_to_python_once(stored):
    s1, c, _, wanted = stored
    key = F.col("name1").cast("binary").alias("text_key")
    texts = pair_features(wanted, s1, c).select(key, F.col("name1").alias("a"), F.col("name2").alias("b"))
    text = plan(text_scores(texts))
    assert text.count("MapInArrow") == 1 and "EvalPython" not in text
    whole = plan(fuzzy_features(pair_features(wanted, s1, c)))
    assert "MapInArrow" not in whole and "EvalPython" not in whole  # scores come from a written table
    assert not set(RAW_TEXT) & set(fuzzy_features(pair_features(wanted, s1, c)).columns)


def test_filters_reach_the_scan(stored):
    s1, c, _, _ = stored
    text = plan(exact.exact_rows(s1, c, "clean_address"))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", text)
    assert pushed and all("IsNotNull(clean_address)" in p for p in pushed)
