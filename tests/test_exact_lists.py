"""Exact pairs made from lists of ids, and those among other pairs."""

import random

import pytest
from pyspark.sql import functions as F
from tables import as_set, entities, messy

from twinfold.operators import exact, skew


def keyed_rows(spark, prefix, sizes):
    rows = [(f"{prefix}{k}-{i}", k) for k, n in sizes.items() for i in range(n)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, f"{prefix} string, k string")


@pytest.mark.parametrize("cell_rows", [3, 4096])
def test_lists_give_the_pairs_of_the_join(spark, cell_rows):
    left = keyed_rows(spark, "l", {"big": 40, "one": 1, "left": 3})
    right = keyed_rows(spark, "r", {"big": 70, "one": 1, "right": 2})
    hot = skew.hot_keys_of_both(left, right, ["k"], cell_rows)
    assert (hot is None) == (cell_rows == 4096)
    lists = skew.spread_lists(left, right, ["k"], hot, "l", "r", F.col("r"))
    rows = [(r["l"], r["r"]) for r in lists.select("l", F.explode("ids").alias("r")).collect()]
    expected = {(r["l"], r["r"]) for r in left.join(right, "k").collect()}
    assert len(rows) == len(set(rows)) and set(rows) == expected
    per_left = lists.where("k = 'big'").groupBy("l").count().agg(F.max("count")).first()[0]
    cells = -(-70 // cell_rows)
    assert per_left <= skew.LISTS * cells


def test_a_long_side_alone_makes_a_key_hot(spark, monkeypatch):
    left, right = keyed_rows(spark, "l", {"long": 9, "short": 2}), keyed_rows(spark, "r", {"long": 1, "short": 2})
    assert skew.hot_keys_of_both(left, right, ["k"], 4) is None
    monkeypatch.setattr(skew, "SIDE_ROWS", 8)
    cells = skew.hot_keys_of_both(left, right, ["k"], 4).cells.collect()
    assert [(r.left_cells, r.right_cells) for r in cells] == [(3, 1)]


def test_pairs_of_a_large_group_take_little_room(spark, tmp_path):
    def size(pairs, name):
        pairs.coalesce(1).write.parquet(str(tmp_path / name))
        return sum(p.stat().st_size for p in (tmp_path / name).glob("*.parquet"))

    row = lambda i, p: (f"{p}-{i * 7919 % 100003}-{i % 13}", "same name", None, "x")
    s1, c = entities(spark, [row(i, "S1") for i in range(901)]), entities(spark, [row(i, "S2") for i in range(1803)])
    keyed = exact.keyed(c, "clean_name").withColumnRenamed("entity_id", "candidate_entity_id")
    joined = exact.keyed(s1, "clean_name").join(keyed.hint("merge"), exact.KEY)
    before = size(joined.select(F.col("entity_id").alias("source1_entity_id"), "candidate_entity_id"), "joined")
    pairs = exact.exact_rows(s1, c, "clean_name")
    assert pairs.count() == 901 * 1803
    assert 2 * size(pairs, "lists") < before


def test_exact_pairs_among_others(spark):
    """Ids that come twice with different texts included."""
    s1, c = entities(spark, messy("a")), entities(spark, messy("c", 2))
    every = s1.selectExpr("entity_id as source1_entity_id").crossJoin(c.selectExpr("entity_id as candidate_entity_id"))
    whole = as_set(exact.exact_block(s1, c))
    assert whole and as_set(exact.exact_block(s1, c, among=every)) == whole
    some = every.where("crc32(cast(concat(source1_entity_id, candidate_entity_id) as binary)) % 3 = 0")
    rows = [tuple(r) for r in exact.exact_block(s1, c, among=some).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == whole & as_set(some.distinct())
