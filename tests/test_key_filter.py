"""The filter may let common keys through, but never stops a rare one."""

import pytest
from pyspark.sql import functions as F
from tables import as_set, entities, messy

from twinfold.operators import key_filter, ngrams, postings, tokens
from twinfold.session import stage

COMMON, RARE = 3000, 40_000


@pytest.fixture(scope="module")
def counted(spark):
    """Keys with frequencies of 11 to 3010, and of 1 to 10; one key is NULL."""
    keys = spark.range(COMMON + RARE).select(
        F.when(F.col("id") != COMMON, F.concat(F.lit("k"), "id")).alias("k"),
        F.when(F.col("id") < COMMON, 11 + F.col("id")).otherwise(1 + F.col("id") % 10).alias("frequency"),
    )
    return stage(keys)


@pytest.fixture(autouse=True)
def always(monkeypatch):
    """Filters also for few keys."""
    monkeypatch.setattr(key_filter, "LEAST_RARE", 0)


def passed(made, counted):
    kept = made.apply(counted)
    rare = kept.where("frequency <= 10").count()
    return rare, kept.where("frequency > 10")


def test_rare_keys_pass_and_common_ones_do_not(counted):
    made = key_filter.key_filter(counted, ["k"], 10, listed=100)
    rare, common = passed(made, counted)
    assert rare == RARE
    assert common.count() < COMMON / 50
    # The second map holds only the rare keys that look common in the first.
    assert made.common.words == 1024 and made.let_through.words <= 1024
    assert made.common.table.select(F.size("bits")).first()[0] == made.common.words


def test_full_maps_lose_no_rare_key(counted, monkeypatch):
    monkeypatch.setattr(key_filter, "MAP_WORDS", (4, 16))  # 1024 bits at most
    made = key_filter.key_filter(counted, ["k"], 10, listed=100)
    rare, _ = passed(made, counted)
    assert rare == RARE


def test_the_heaviest_keys_are_held_first(counted, monkeypatch):
    monkeypatch.setattr(key_filter, "MAP_WORDS", (512, 512))  # room for 2048 keys of 3000
    made = key_filter.key_filter(counted, ["k"], 10, listed=100)
    rare, common = passed(made, counted)
    assert rare == RARE
    assert common.where("frequency < 2048").count() >= 0.3 * 2037  # a map of heavier keys
    assert common.where("frequency >= 2048").count() < 963  # some pass, most do not


def test_a_list_is_enough_for_few_common_keys(counted):
    assert key_filter.key_filter(counted, ["k"], 10, listed=COMMON) is None
    assert key_filter.key_filter(counted.limit(0), ["k"], 10, listed=0) is None


def test_few_rare_keys_need_no_filter(counted, monkeypatch):
    monkeypatch.setattr(key_filter, "LEAST_RARE", RARE + 1)
    assert key_filter.key_filter(counted, ["k"], 10, listed=100) is None


def test_only_common_keys(counted):
    """No rare key at all: the second map is empty."""
    common = counted.where("frequency > 10")
    made = key_filter.key_filter(common, ["k"], 10, listed=0)
    assert made.apply(common).count() == 0


def test_blocks_are_the_same_with_maps_of_any_size(spark, monkeypatch):
    s1, c = entities(spark, messy("a", 3)), entities(spark, messy("c", 2))
    plain = as_set(tokens.token_block(s1, c, "clean_name", 3)), as_set(ngrams.ngram_block(s1, c, max_freq=6))
    monkeypatch.setattr(postings, "MAX_COMMON", 0)
    for sizes in ((1, 1), (64, 64)):  # full, and nearly empty
        monkeypatch.setattr(key_filter, "MAP_WORDS", sizes)
        assert as_set(tokens.token_block(s1, c, "clean_name", 3)) == plain[0]
        assert as_set(ngrams.ngram_block(s1, c, max_freq=6)) == plain[1]


def test_rows_of_common_keys_leave_before_the_shuffle(spark, counted, monkeypatch):
    """Beyond the exact list, too."""
    monkeypatch.setattr(postings, "MAX_COMMON", 10)
    maps = postings.common_filter(counted, ["k"], 10)
    kept = postings.drop_common(counted, counted, ["k"], 10, maps)
    without = postings.drop_common(counted, counted, ["k"], 10)
    assert without.where("frequency > 10").count() == COMMON - 10
    assert kept.where("frequency > 10").count() < COMMON / 50
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(k" not in plan and "BroadcastHashJoin" in plan
