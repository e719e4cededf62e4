"""How many rounds the match model keeps."""

import random

from pyspark.ml.feature import VectorAssembler

from twinfold.operators import matcher
from twinfold.operators.sampling import grouped_split
from twinfold.session import stage


def test_best_round():
    assert matcher.best_round([5, 4, 4.5, 4.5, 3, 9, 9, 9], 3) == (5, True)
    assert matcher.best_round([5, 4, 4.5, 4.5, 3, 9, 9, 9], 2) == (2, True)
    assert matcher.best_round([5, 4, 3], 2) == (3, False)
    assert matcher.TreeSettings().rounds == 1000 and matcher.TreeSettings().patience == 75


def test_small_gains_do_not_end_the_training(spark, monkeypatch):
    monkeypatch.setattr(matcher, "FIRST_ROUNDS", 5)
    draw = random.Random(1)
    rows = []
    for i in range(400):
        x = draw.random()
        rows.append((f"a{i}", f"b{i}", x, int(x + draw.gauss(0, 0.2) > 0.5)))
    ddl = "source1_entity_id string, candidate_entity_id string, x double, label int"
    sample = stage(spark.createDataFrame(rows, ddl))
    # Steps so small that no round gains a ten-thousandth of the loss, but each gains.
    settings = matcher.TreeSettings(rounds=12, patience=4, step=1e-5, depth=2, min_rows_per_leaf=5)
    train, valid = grouped_split(sample, 0.2, "source1_entity_id", settings.seed)
    vectors = VectorAssembler(inputCols=["x"], outputCol="feature_vector").transform
    straight = settings.classifier(settings.rounds).fit(vectors(stage(train)))
    losses = straight.evaluateEachIteration(vectors(stage(valid)))
    best, _ = matcher.best_round(losses, settings.patience)
    fitted = matcher.fit_matcher(sample, settings=settings)
    assert fitted.metrics.first()["best_iteration"] == best > 1


def labelled(spark, held_out_positives=True):
    draw = random.Random(2)
    rows = []
    for i in range(300):
        x = draw.random()
        rows.append((f"a{i}", f"b{i}", x, draw.random(), int(x + draw.gauss(0, 0.2) > 0.5)))
    ddl = "source1_entity_id string, candidate_entity_id string, x double, y double, label int"
    df = spark.createDataFrame(rows, ddl)
    if not held_out_positives:
        _, valid = grouped_split(df, 0.2, "source1_entity_id", 42)
        away = valid.where("label = 1").select("source1_entity_id")
        df = df.join(away, "source1_entity_id", "left_anti")
    return stage(df)


def test_first_trees_are_those_of_a_shorter_fit(spark, tmp_path):
    settings = matcher.TreeSettings(depth=3, min_rows_per_leaf=5)
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="feature_vector").transform
    rows = vectors(labelled(spark))
    long, short = (settings.classifier(n).fit(rows) for n in (9, 4))
    cut = matcher.first_trees(long, 4)
    assert cut.getNumTrees == 4 and cut.numFeatures == 2 and cut.numClasses == 2
    assert cut.toDebugString.split("\n", 1)[1] == short.toDebugString.split("\n", 1)[1]
    assert cut.featureImportances == short.featureImportances
    cut.write().overwrite().save(str(tmp_path / "cut"))
    again = type(cut).load(str(tmp_path / "cut"))
    found = [
        [r.probability for r in m.transform(rows).orderBy("source1_entity_id").collect()]
        for m in (cut, short, again)
    ]
    assert found[0] == found[1] == found[2]


def test_patience_without_held_out_positives(spark, monkeypatch):
    monkeypatch.setattr(matcher, "FIRST_ROUNDS", 6)
    seen = []
    fit = matcher.TreeSettings.classifier
    monkeypatch.setattr(
        matcher.TreeSettings, "classifier", lambda self, n: seen.append(n) or fit(self, n)
    )
    monkeypatch.setattr(matcher, "best_round", lambda losses, patience: (3, True))
    fitted = matcher.fit_matcher(
        labelled(spark, held_out_positives=False),
        settings=matcher.TreeSettings(rounds=50, patience=2, depth=2, min_rows_per_leaf=5),
    )
    assert seen == [6] and fitted.metrics.first()["best_iteration"] == 3


def test_rounds_are_not_fitted_again_far_past_the_best(spark, monkeypatch):
    """A loss that has passed its least value is looked at again where patience ends."""
    monkeypatch.setattr(matcher, "FIRST_ROUNDS", 6)
    seen = []
    fit = matcher.TreeSettings.classifier
    monkeypatch.setattr(
        matcher.TreeSettings, "classifier", lambda self, n: seen.append(n) or fit(self, n)
    )
    monkeypatch.setattr(
        matcher, "best_round", lambda losses, patience: (4, len(losses) >= 4 + patience)
    )
    settings = matcher.TreeSettings(rounds=50, patience=4, depth=2, min_rows_per_leaf=5)
    fitted = matcher.fit_matcher(labelled(spark), settings=settings)
    assert seen == [6, 8] and fitted.metrics.first()["best_iteration"] == 4


def fits(losses, patience, first, most):
    """Rounds of the fits until training stops, and the best round."""
    done, rounds, step = [], first, first
    while True:
        done.append(rounds)
        best, stopped = matcher.best_round(losses[:rounds], patience)
        if stopped or rounds == most:
            return done, best
        rounds, step = matcher.rounds_of_next_fit(best, patience, rounds, step)
        rounds = min(rounds, most)


def test_fits_end_at_the_round_of_one_long_fit():
    v = lambda least, n=1000: [abs(i + 1 - least) for i in range(n)]
    assert fits(v(119), 75, 150, 1000) == ([150, 194], 119)
    assert fits(v(148), 75, 150, 1000) == ([150, 450], 148)
    assert fits(v(380), 75, 150, 1000) == ([150, 450, 455], 380)
    assert fits(v(1000), 75, 150, 1000) == ([150, 450, 1000], 1000)
    assert fits(v(2), 75, 5, 1000) == ([5, 77], 2)
    draw = random.Random(3)
    for _ in range(200):
        least, patience = draw.randint(1, 300), draw.randint(1, 40)
        noisy = [x + draw.uniform(0, 30) for x in v(least, 300)]
        done, best = fits(noisy, patience, 2 * patience, 300)
        assert best == matcher.best_round(noisy, patience)[0] and done == sorted(set(done))


def test_one_fit_is_enough_up_to_twice_the_patience():
    """Best rounds of 76 and 119 were seen over documents of 0.1 GB."""
    losses = [abs(i + 1 - 150) for i in range(1000)]
    assert fits(losses, 75, matcher.FIRST_ROUNDS, 1000) == ([225], 150)


def test_trees_do_not_depend_on_the_order_of_rows(spark):
    settings = matcher.TreeSettings(depth=3, min_rows_per_leaf=5)
    assembler = VectorAssembler(inputCols=["x", "y"], outputCol="feature_vector")
    rows = labelled(spark)
    matcher.shared_folder(spark)
    found = [
        settings.classifier(4).fit(matcher.rows_to_fit(stage(df), assembler)).toDebugString.split("\n", 1)[1]
        for df in (rows.coalesce(1).orderBy("x"), rows.repartition(5, "y"))
    ]
    assert found[0] == found[1]
    assert "CheckpointRDD" in matcher.rows_to_fit(rows, assembler)._jdf.rdd().toDebugString()
