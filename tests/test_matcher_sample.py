"""The training sample of the matcher queries."""

from pathlib import Path

import pytest

from twinfold.operators import exact, matcher
from twinfold.plans import queries
from twinfold.plans.cards import Cards, line_cards
from twinfold.session import stage
from twinfold.sources.entities import PAIR

SF_DIR = "/root/testdata/sf0.001"
LIMITS = {"max_negatives": 40, "negative_ratio": 2}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")


@pytest.fixture
def compared(monkeypatch):
    """How many pairs each call of ``fuzzy_features`` gets."""
    seen, fuzzy = [], queries.fuzzy_features

    def counted(pairs):
        seen.append(pairs.count())
        return fuzzy(pairs)

    monkeypatch.setattr(queries, "fuzzy_features", counted)
    return seen


def sample_of_all(c):
    return matcher.training_sample(queries._fuzzy_features(c), stage(queries._truth(c)), **LIMITS)


def test_only_sampled_pairs_are_compared(spark, compared):
    c = Cards(spark, SF_DIR, line_cards)
    few = queries._training_features(c, **LIMITS)
    assert compared == [few.count()] and few.count() < exact.capped_block(c.s1, c.candidates).count()
    whole = sample_of_all(c).select(*few.columns)
    assert matcher.model_features(few) == matcher.model_features(sample_of_all(c))
    assert few.exceptAll(whole).isEmpty() and whole.exceptAll(few).isEmpty()


def test_repeated_ids_repeat_their_rows(spark):
    c = Cards(spark, SF_DIR, line_cards)
    twice = lambda df: stage(df.unionByName(df.where("entity_id like '%7-0'")))
    c.s1, c.candidates = twice(c.s1), twice(c.candidates)
    c.derived = lambda name, build: stage(build())
    few, whole = queries._training_features(c, **LIMITS), sample_of_all(c)
    assert few.count() == whole.count() and few.select(*PAIR).distinct().count() < few.count()
    # Of rows that share their ids any may be in the sample.
    assert few.select(*PAIR, "label").exceptAll(whole.select(*PAIR, "label")).isEmpty()


def test_metrics_and_importance_need_no_other_pairs(spark, compared, monkeypatch):
    settings = matcher.TreeSettings
    monkeypatch.setattr(queries.matcher, "TreeSettings", lambda **_: settings(rounds=2, depth=2, min_rows_per_leaf=1))
    monkeypatch.setattr(queries, "_matchers", {})
    asked = []
    sampled = queries._training_features
    monkeypatch.setattr(queries, "_training_features", lambda c: asked.append(1) or sampled(c, **LIMITS))
    assert queries.REGISTRY["matcher_metrics"](spark, SF_DIR).count() == 1
    assert queries.REGISTRY["matcher_importance"](spark, SF_DIR).count() == 21
    assert asked == [1] and len(compared) == 1
