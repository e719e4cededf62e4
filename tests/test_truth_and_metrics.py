import random

import pytest
from tables import S1, S2, S3, TRUTH, as_set, entities, golden_pairs, pairs, truth

from twinfold.operators import metrics
from twinfold.operators.exact import exact_block
from twinfold.operators.truth import (
    evaluate_blocking,
    explode_id_list,
    missed_details,
    missed_pairs,
)

ODD = [("a", "x,,y"), ("b", " x , y "), ("c", ""), ("d", None), ("e", "z,z")]


def test_three_readings_of_a_list(spark):
    lists = truth(spark, ODD)
    raw = explode_id_list(lists, trim=False, drop_blank=False, distinct=False)
    assert sorted(r[1] for r in raw.where("source1_entity_id in ('a','b')").collect()) == [
        "", " x ", " y ", "x", "y",
    ]
    assert as_set(explode_id_list(lists)) == {
        ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("e", "z"),
    }
    with pytest.raises(ValueError, match="matched_entity_ids"):
        explode_id_list(lists.drop("matched_entity_ids"))


def test_blocking_quality_golden(spark):
    s1, s2, s3 = (entities(spark, t) for t in (S1, S2, S3))
    found = exact_block(s1, s2.unionByName(s3))
    r = evaluate_blocking(found, truth(spark), s1, s2, s3).first()
    assert (r.true_pairs, r.captured_pairs, r.missed_pairs) == (8, 4, 4)
    assert (r.candidate_pairs, r.all_pairs, r.recall) == (4, 66, 0.5)
    assert r.reduction == pytest.approx(0.93939394)
    empty = evaluate_blocking(found.limit(0), truth(spark, [("a", None)]), s1, s2, s3).first()
    assert (empty.true_pairs, empty.recall, empty.reduction) == (0, 0.0, 1.0)
    odd = evaluate_blocking(pairs(spark, [("a", "y"), ("e", "z")]), truth(spark, ODD), s1, s2, s3)
    assert (odd.first().true_pairs, odd.first().captured_pairs) == (7, 3)


def test_missed_pairs(spark):
    s1, c = entities(spark, S1), entities(spark, S2 + S3)
    found = exact_block(s1, c)
    missed = as_set(missed_pairs(found, truth(spark)))
    assert missed == {("s1_001", "s2_001"), ("s1_001", "s3_001"), ("s1_002", "s3_002"), ("s1_003", "s2_003")}
    details = missed_details(found, truth(spark), s1, c)
    assert {r.s1_clean_name for r in details.collect()} == {S1[i][1] for i in (0, 1, 2)}
    assert details.count() == 4
    one, two = (missed_details(found, truth(spark), s1, c, sample=2) for _ in range(2))
    assert as_set(one) == as_set(two) and as_set(one) < missed
    assert missed_details(found, truth(spark), s1, c, sample=0).count() == 0


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, match_probability double")


GOLDEN = [(1, 0.9), (1, 0.8), (0, 0.702), (1, 0.6), (0, 0.2), (0, 0.1)]


def test_metric_goldens(spark):
    df = scored(spark, GOLDEN)
    best = metrics.best_threshold(metrics.threshold_sweep(df)).first()
    assert best.threshold == 0.705 and best.precision == 1.0
    assert best.recall == pytest.approx(2 / 3) and best.f0_5 == pytest.approx(0.909091, abs=1e-6)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(8 / 9)
    assert metrics.average_precision(df).first()[0] == pytest.approx(11 / 12)


def sweep_by_hand(rows):
    positives = sum(label for label, _ in rows)
    out = []
    for i in range(199):
        t = (10 + 5 * i) / 1000.0
        tp = sum(1 for label, p in rows if p >= t and label)
        fp = sum(1 for label, p in rows if p >= t and not label)
        precision = tp / (tp + fp) if tp + fp else 0.0
        recall = tp / positives if positives else 0.0
        bottom = 0.25 * precision + recall
        out.append((t, tp, fp, 1.25 * precision * recall / bottom if bottom else 0.0))
    return out


def auc_by_hand(rows):
    pos, neg = [p for x, p in rows if x], [p for x, p in rows if not x]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def ap_by_hand(rows):
    positives, total, last = sum(x for x, _ in rows), 0.0, 0
    for score in sorted({p for _, p in rows}, reverse=True):
        tp = sum(x for x, p in rows if p >= score)
        total += (tp - last) / positives * tp / sum(1 for _, p in rows if p >= score)
        last = tp
    return total


def test_metrics_against_definition(spark):
    rng = random.Random(5)
    grid = [(10 + 5 * i) / 1000.0 for i in range(199)]
    rows = [(int(rng.random() < 0.3), rng.choice([rng.random(), rng.choice(grid), 0.0, 1.0])) for _ in range(800)]
    df = scored(spark, rows)
    found = metrics.threshold_sweep(df).orderBy("threshold").collect()
    expected = sweep_by_hand(rows)
    assert [(r.threshold, r.true_positives, r.false_positives) for r in found] == [e[:3] for e in expected]
    assert [r.f0_5 for r in found] == pytest.approx([e[3] for e in expected])
    ranked = metrics.ranked_scores(df, "label", "match_probability", rows_per_task=70)
    assert metrics._roc(ranked).first()[0] == pytest.approx(auc_by_hand(rows))
    assert metrics._average_precision(ranked).first()[0] == pytest.approx(ap_by_hand(rows))
    both = metrics.ranking_quality(df).first()
    assert both.roc_auc == pytest.approx(auc_by_hand(rows))
    assert both.average_precision == pytest.approx(ap_by_hand(rows))


@pytest.mark.parametrize("rows_per_task", [1, 40])
def test_running_sums_by_ranges_of_ranges(spark, monkeypatch, rows_per_task):
    """However many scores there are, a task gets few of them, and few sums of ranges."""
    rng = random.Random(6)
    df = scored(spark, [(int(rng.random() < 0.4), rng.random()) for _ in range(2000 if rows_per_task > 1 else 25)])
    levels = []
    above = metrics._above
    monkeypatch.setattr(metrics, "_above", lambda sums, n: levels.append(sums.count()) or above(sums, n))
    staged = []
    stage = metrics.stage
    monkeypatch.setattr(metrics, "stage", lambda x: staged.append(stage(x)) or staged[-1])
    ranked = metrics.ranked_scores(df, "label", "match_probability", rows_per_task)
    placed = next(x for x in staged if {"range", "score"} <= {*x.columns})
    most = placed.groupBy("range").count().agg({"count": "max"}).first()[0]
    assert most <= 4 * rows_per_task and len(levels) > 1 and levels[-1] <= max(2, rows_per_task)
    monkeypatch.undo()
    columns = ["score", "pos", "neg", "tp", "fp", "positives", "negatives"]
    whole = metrics.ranked_scores(df, "label", "match_probability")
    assert sorted(map(tuple, ranked.select(*columns).collect())) == sorted(map(tuple, whole.select(*columns).collect()))


def test_metrics_of_one_class(spark):
    only = scored(spark, [(0, 0.3), (0, 0.3), (0, 0.9)])
    assert metrics.roc_auc(only).first()[0] is None
    assert metrics.average_precision(only).first()[0] == 0.0
    assert metrics.best_threshold(metrics.threshold_sweep(only)).first().threshold == 0.01


def test_confusion(spark):
    df = scored(spark, GOLDEN).selectExpr("label", "int(match_probability >= 0.65) as prediction")
    r = metrics.confusion(df).first()
    assert tuple(r)[:4] == (2, 1, 1, 2)
    nothing = metrics.confusion(df.withColumn("prediction", df.label * 0)).first()
    assert (nothing.precision, nothing.recall, nothing.f0_5) == (0.0, 0.0, 0.0)


def test_golden_truth_counts(spark):
    assert explode_id_list(truth(spark, TRUTH)).count() == 8 and len(golden_pairs()) == 14
