import pytest
from tables import S1, S2, S3, TRUTH, as_set, entities, golden_pairs, pairs, truth

from twinfold.operators import matcher, outputs
from twinfold.plans import jobs
from twinfold.sources.entities import (
    PAIR,
    candidates_of,
    read_entities,
    read_id_lists,
    require_columns,
)
from twinfold.sources.sinks import write_parquet, write_positive_pairs, write_tsv

SMALL_TREES = matcher.TreeSettings(rounds=3, depth=2, min_rows_per_leaf=1, row_share=1.0)


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    """The three tables (one of them as text), pairs and truth on disk."""
    root = str(tmp_path_factory.mktemp("case"))
    write_parquet(entities(spark, S1), f"{root}/s1.parquet")
    write_parquet(entities(spark, S2), f"{root}/s2.parquet", codec=None)
    write_tsv(entities(spark, S3), f"{root}/s3.tsv", sort_by="entity_id")
    write_parquet(pairs(spark, golden_pairs()), f"{root}/pairs.parquet")
    write_parquet(truth(spark), f"{root}/truth.parquet")
    return root, jobs.Sources(f"{root}/s1.parquet", f"{root}/s2.parquet", f"{root}/s3.tsv")


def test_readers(spark, case, tmp_path):
    root, sources = case
    _, s2, s3, both = sources.read(spark)
    assert both.count() == 11 and s3.schema == s2.schema
    assert {r.entity_id for r in s3.collect()} == {r[0] for r in S3}
    with pytest.raises(ValueError, match="clean_name"):
        require_columns(s2.drop("clean_name"), ["entity_id", "clean_name"])
    bad = tmp_path / "bad.tsv"
    bad.write_text("entity_id\tclean_name\tclean_address\tclean_country\n1\ta\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_entities(spark, str(bad)).collect()
    assert candidates_of(s2, s3.withColumn("more", s3.entity_id)).columns == s2.columns


def test_blocking_jobs(spark, case):
    root, sources = case
    base = as_set(jobs.block_exact_job(spark, sources, f"{root}/exact"))
    assert len(base) == 4
    names = jobs.block_tokens_job(spark, sources, f"{root}/names", ("clean_name",), f"{root}/exact", max_freq=1)
    both = jobs.block_tokens_job(spark, sources, f"{root}/both", max_freq=1)
    assert len(as_set(names)) == 6 and len(as_set(both)) == 7
    grams = as_set(jobs.block_ngrams_job(spark, sources, f"{root}/both", f"{root}/grams"))
    assert grams >= as_set(both) and ("s1_001", "s3_001") in grams
    coverage = jobs.block_capped_job(spark, sources, f"{root}/capped").first()
    assert tuple(coverage) == (4, 4)
    quality = jobs.evaluate_blocking_job(spark, sources, f"{root}/exact", f"{root}/truth.parquet")
    assert quality.first().recall == 0.5
    missed = jobs.missed_pairs_job(
        spark, sources, f"{root}/exact", f"{root}/truth.parquet", f"{root}/missed", sample=3
    )
    assert missed.count() == 3


def test_matching_from_features_to_checked_outputs(spark, case):
    root, sources = case
    features = jobs.pair_features_job(spark, sources, f"{root}/pairs.parquet", f"{root}/features")
    assert features.count() == 14
    fuzzy = jobs.fuzzy_features_job(spark, f"{root}/features", f"{root}/fuzzy")
    assert len(fuzzy.columns) == 23
    fitted = jobs.train_job(
        spark, f"{root}/fuzzy", f"{root}/truth.parquet", f"{root}/model",
        validation_share=0.4, settings=SMALL_TREES,
    )
    assert len(fitted.features) == 21 and 0 <= fitted.threshold <= 1
    loaded = jobs.load_matcher(spark, f"{root}/model")
    assert (loaded.features, loaded.threshold) == (fitted.features, fitted.threshold)
    kept = spark.read.json(f"{root}/model/validation_metrics.json").first()
    assert kept.validation_rows == kept.validation_positives + kept.validation_negatives
    assert kept.best_iteration >= 1 and 0 <= kept.roc_auc <= 1
    assert spark.read.csv(f"{root}/model/threshold_search.csv", header=True).count() == 199
    assert spark.read.csv(f"{root}/model/feature_importance.csv", header=True).count() == 21

    scored = jobs.score_job(
        spark, f"{root}/fuzzy", f"{root}/model", f"{root}/scored", f"{root}/positives.tsv"
    )
    rows = scored.collect()
    assert len(rows) == 14 and scored.columns == [*PAIR, "match_probability", "prediction"]
    assert all(0 <= r.match_probability <= 1 for r in rows)
    assert all(r.prediction == int(r.match_probability >= fitted.threshold) for r in rows)
    said = spark.read.csv(f"{root}/positives.tsv", sep="\t", header=True)
    assert as_set(said) == {(r[0], r[1]) for r in rows if r.prediction}
    first = jobs.score_job(spark, f"{root}/fuzzy", f"{root}/model", f"{root}/few", limit=5)
    assert as_set(first) == set(sorted(golden_pairs())[:5])

    jobs.outputs_job(spark, sources.s1, f"{root}/pairs.parquet", f"{root}/scored", f"{root}/out", True)
    checks = jobs.validate_job(spark, sources, f"{root}/out")
    assert [r.violations for r in checks.collect()] == [0] * 6
    lists = read_id_lists(spark, f"{root}/out/candidate_pairs.tsv", "candidate_entity_ids")
    found = {r[0]: r[1] for r in lists.collect()}
    assert found["s1_001"] == "s2_001,s2_007,s3_001" and len(found) == 6


def test_training_needs_both_classes(spark):
    features = pairs(spark, golden_pairs()).selectExpr("*", "1.0 as x")
    with pytest.raises(ValueError, match="true pair"):
        matcher.training_sample(features, truth(spark, [("no", "one")]))
    only = features.where("candidate_entity_id = 's2_001'")
    with pytest.raises(ValueError, match="negative"):
        matcher.training_sample(only, truth(spark))
    sample = matcher.training_sample(features, truth(spark), max_negatives=4, negative_ratio=5)
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {1: 8, 0: 4}
    with pytest.raises(ValueError, match="no feature"):
        matcher.model_features(sample.drop("x"))


def test_training_without_held_out_positives(spark):
    rows = [("a", f"c{i}", float(i), int(i > 3)) for i in range(8)]
    sample = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, x double, label int")
    fitted = matcher.fit_matcher(sample, 0.0, SMALL_TREES)
    assert fitted.metrics.first().f0_5 == 1.0
    assert fitted.importance.first().feature == "x"


def test_clean_features(spark):
    df = spark.createDataFrame(
        [(None, True), (float("nan"), False), (float("inf"), True), (float("-inf"), None), (2.5, True)],
        "x double, flag boolean",
    )
    rows = matcher.clean_features(df, ["x", "flag"]).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (2.5, 1.0)]


def test_outputs_reject_matches_outside_candidates(spark):
    s1 = entities(spark, S1 + S1[:1])
    wanted = pairs(spark, golden_pairs() + golden_pairs()[:2] + [(None, "x"), ("s1_001", None)])
    stray = pairs(spark, [("s1_001", "s2_008")]).selectExpr("*", "1 as prediction")
    with pytest.raises(ValueError, match="1 predicted"):
        outputs.build_outputs(s1, wanted, stray)
    nothing = stray.selectExpr(*PAIR, "0 as prediction")
    matches, candidates = outputs.build_outputs(s1, wanted, nothing)
    assert {r[1] for r in matches.collect()} == {""} and matches.count() == 6
    assert {r[0]: r[1] for r in candidates.collect()}["s1_006"] == "s2_006,s3_003"


@pytest.mark.parametrize(
    "fault,check",
    [
        ([("s1_001", "s2_001"), ("s1_002", "s2_005")], "matches_outside_candidates"),
        ([("s1_001", "s9_001")], "unknown_matched_ids"),
        ([("s1_001", "s2_001"), ("s1_001", "s2_001")], "matches_duplicate_entities"),
    ],
)
def test_every_planted_fault_is_reported(spark, fault, check):
    s1, s2, s3 = (entities(spark, t) for t in (S1, S2, S3))
    _, lists = outputs.build_outputs(s1, pairs(spark, golden_pairs()), pairs(spark, []).selectExpr("*", "0 as prediction"))
    wrong = spark.createDataFrame(fault, "source1_entity_id string, matched_entity_ids string")
    checks = outputs.validate_outputs(wrong, lists, s1, s2, s3)
    found = {r.check_name: r.violations for r in checks.collect()}
    assert found[check] >= 1 and found["candidates_row_difference"] == 0
    with pytest.raises(ValueError, match=check):
        outputs.assert_valid(checks)


def test_empty_positive_list_has_its_header(spark, tmp_path):
    none = pairs(spark, golden_pairs()).selectExpr("*", "0 as prediction")
    write_positive_pairs(none, str(tmp_path / "none.tsv"))
    assert spark.read.schema(none.drop("prediction").schema).csv(str(tmp_path / "none.tsv"), sep="\t", header=True).count() == 0


def test_profile_jobs(spark, case):
    _, sources = case
    found = jobs.profile_job(spark, sources.s2)
    assert found["summary_clean_name"].first().unique_values == 8
    assert found["duplicates"].first().duplicate_rows == 0 and found["first_rows"].count() == 5
    assert all(df.count() > 0 for df in found.values())
    report = jobs.token_analysis_job(spark, sources)
    assert report["buckets_clean_name"].count() == 10
    assert report["top_by_country"].count() == 15
    assert len(TRUTH) == 6
