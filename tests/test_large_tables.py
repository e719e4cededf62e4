"""What must not grow with the input: tables in the driver, rows in a task, pairs in a shuffle."""

import pytest
from tables import as_set, entities, messy

from twinfold.operators import exact, ngrams, postings, tokens
from twinfold.operators.features import pair_records


@pytest.fixture(scope="module")
def rough(spark):
    return entities(spark, messy("a")), entities(spark, messy("c", 2))


@pytest.fixture
def broadcasting(spark):
    """Every table that Spark takes for small is broadcast, as staged tables are whose files are small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "1g")
    yield
    spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_of_ids_are_not_broadcast(rough, broadcasting):
    plan = plan_of(ngrams.ngram_block(*rough, min_freq=1))
    # Candidates numbered, lists met, both ids of a pair translated back.
    assert plan.count("SortMergeJoin") >= 4
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "entity_id" in line]


def test_many_rare_keys_are_not_broadcast(spark, broadcasting, monkeypatch):
    counted = spark.createDataFrame([(str(i), i) for i in range(9)], "token string, frequency long")
    rows = spark.createDataFrame([("a", "3"), ("b", "8")], "entity_id string, token string")
    found = {}
    for least in (100, 3):
        monkeypatch.setattr(postings, "LEAST_RARE", least)
        found[least] = rows.join(postings.rare_keys(counted, 5), "token")
        assert [r["entity_id"] for r in found[least].collect()] == ["a"]
    assert "BroadcastHashJoin" in plan_of(found[100])
    assert "SortMergeJoin" in plan_of(found[3])


def test_lists_are_opened_in_tasks_by_their_ids(rough, monkeypatch):
    before = as_set(ngrams.gram_pair_scores(*rough, min_freq=1))
    monkeypatch.setattr(ngrams, "TASK_IDS", 20 * 500)  # an entity each
    many = ngrams.gram_pair_scores(*rough, min_freq=1)
    assert many.rdd.getNumPartitions() > 8  # the session shuffles into 4
    assert as_set(many) == before


def shuffled(df):
    """What is shuffled by the ids of pairs."""
    return [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning(source1_entity_id" in line]


def unique_rows(prefix, times):
    rows = messy(prefix, times)
    return rows[:-3]


@pytest.fixture(scope="module")
def keys(spark):
    rows = unique_rows("a", 2), unique_rows("c", 3)
    return *rows, entities(spark, rows[0]), entities(spark, rows[1])


def test_exact_pairs_are_made_once_and_not_shuffled(keys):
    _, _, s1, c = keys
    block = exact.exact_block(s1, c)
    assert not shuffled(block)
    rows = [tuple(r) for r in block.collect()]
    expected = as_set(exact.exact_rows(s1, c, "clean_name")) | as_set(exact.exact_rows(s1, c, "clean_address"))
    assert len(rows) == len(set(rows)) and set(rows) == expected


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("columns", [["clean_name"], ["clean_name", "clean_address"]])
def test_combined_blocks_hold_each_pair_once(spark, keys, rough, columns, repeated):
    """Ids that come twice with different texts included."""
    s1, c = rough if repeated else keys[2:]
    more = ngrams.ngram_block(s1, c, min_freq=1)
    parts = [exact.exact_rows(s1, c, t) for t in exact.TEXTS] + [tokens.token_rows(s1, c, t, 4) for t in columns]
    expected = set().union(*(as_set(part.distinct()) for part in parts))
    rows = [tuple(r) for r in tokens.combined_block(s1, c, columns, 4).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected
    rows = [tuple(r) for r in tokens.combined_block(s1, c, columns, 4, more=lambda: more).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected | as_set(more)


def test_pairs_carry_short_digests(keys):
    _, _, s1, c = keys
    row = pair_records(exact.exact_block(s1, c), s1, c).first()
    assert {len(row[f"{field}{side}_digest"]) for field in ("name", "address") for side in (1, 2)} == {16}
