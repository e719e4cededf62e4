"""Blocking on equal names or equal addresses within a country."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import filled, short_key, text_digest
from twinfold.operators.pairs import stack_pairs, union_pairs
from twinfold.operators.postings import common_filter, drop_common, meet, rare_postings
from twinfold.operators.skew import hot_keys, hot_keys_of_both, spread_lists
from twinfold.session import by_merge, stage, together
from twinfold.sources.entities import PAIR

KEY = ["country_key", "text_key"]
TEXTS = ["clean_name", "clean_address"]

# A cell of a hot key pairs at most this many records of either side.
CELL_ROWS = 4096


def digests(columns: Sequence[str]) -> list[Column]:
    """A record's digests of ``columns``, as ``<column>_digest``."""
    return [text_digest(c).alias(f"{c}_digest") for c in columns]


def keyed(entities: DataFrame, column: str, also: Sequence[str] = ()) -> DataFrame:
    """``entity_id`` with bounded-size country and text keys; blanks and NULLs out.  With the
    digests of the columns ``also``."""
    rows = entities.where(F.col("clean_country").isNotNull() & filled(column)).select(
        "entity_id",
        short_key("clean_country").alias(KEY[0]),
        short_key(column).alias(KEY[1]),
        *digests(also),
    )
    # Said outright, so that every use of a key count has the same plan and is shared.
    return rows.where(F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull())


def agree(unless: Sequence[str], other: Column) -> Column:
    """Whether a record has the text of any column of ``unless`` in common with another, whose
    digests are fields of ``other``."""
    same = [F.col(f"{c}_digest") == other[f"{c}_digest"] for c in unless]
    return reduce(or_, [F.coalesce(s, F.lit(False)) for s in same], F.lit(False))


def exact_rows(
    s1: DataFrame, candidates: DataFrame, column: str, unless: Sequence[str] = ()
) -> DataFrame:
    """Pairs with equal text and country.  Both sides of a hot key are split.

    Pairs that agree on a column of ``unless`` are left out where they are made.
    """
    left = keyed(s1, column, unless)
    right = keyed(candidates, column, unless).withColumnRenamed("entity_id", PAIR[1])
    hot = hot_keys_of_both(left, right, KEY, CELL_ROWS)
    own = [f"{c}_digest" for c in unless]
    item = F.struct(PAIR[1], *own) if unless else F.col(PAIR[1])
    lists = spread_lists(left, right, KEY, hot, "entity_id", PAIR[1], item)
    pairs = lists.select(F.col("entity_id").alias(PAIR[0]), *own, F.explode("ids").alias("other"))
    if not unless:
        return pairs.withColumnRenamed("other", PAIR[1])
    other = F.col("other")
    return pairs.where(~agree(unless, other)).select(PAIR[0], other[PAIR[1]].alias(PAIR[1]))


def has_repeated_ids(*tables: DataFrame) -> bool:
    """Whether a table holds two records of one id."""
    counts = [t.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1") for t in tables]
    return not reduce(DataFrame.unionByName, counts).isEmpty()


def exact_rows_once(s1: DataFrame, candidates: DataFrame) -> list[DataFrame]:
    """The pairs that agree on name, and those that only agree on address.

    No pair is in both, and none comes twice unless an id does, so that the pairs of
    an equal key, however many, need not be shuffled.
    """
    return together(
        lambda: exact_rows(s1, candidates, "clean_name"),
        lambda: exact_rows(s1, candidates, "clean_address", unless=["clean_name"]),
    )


def without_exact(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """Distinct ``pairs`` of one country that agree neither on name nor on address; ids are keys."""
    one = s1.select(F.col("entity_id").alias(PAIR[0]), *digests(TEXTS))
    two = candidates.select(
        F.col("entity_id").alias(PAIR[1]), F.struct(*digests(TEXTS)).alias("other")
    )
    found = pairs.select(*PAIR).join(one, PAIR[0]).join(two, PAIR[1])
    return found.where(~agree(TEXTS, F.col("other"))).select(*PAIR)


def capped_rows(s1: DataFrame, candidates: DataFrame, column: str, cap: int) -> DataFrame:
    """The same for keys carried by at most ``cap`` candidate records."""
    index = keyed(candidates, column)

    def vocabulary() -> tuple:
        counted = stage(index.groupBy(*KEY).agg(F.count(F.lit(1)).alias("frequency")))
        return counted, common_filter(counted, KEY, cap)

    (frequency, maps), hot = together(vocabulary, lambda: hot_keys(keyed(s1, column), KEY))
    left = drop_common(keyed(s1, column), frequency, KEY, cap, maps)
    postings = rare_postings(index, frequency, KEY, KEY, cap, maps=maps)
    return meet(left, postings, KEY, hot)


def exact_pair_total(s1: DataFrame, candidates: DataFrame, column: str) -> DataFrame:
    """How many pairs ``exact_rows`` gives, without forming them: one row ``pairs``."""
    left, right = keyed(s1, column), keyed(candidates, column)
    sides = (
        left.select(*KEY, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(*KEY, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy(*KEY)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    both = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    total = F.sum(both.cast("decimal(38,0)")).cast("decimal(38,0)")
    return sides.agg(F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias("pairs"))


def exact_among(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """Those of ``pairs`` that ``exact_block`` gives, found by digests; ids may come twice."""
    facts = [short_key("clean_country").alias(KEY[0]), *digests(TEXTS)]
    one = s1.select(F.col("entity_id").alias(PAIR[0]), *facts)
    two = candidates.select(F.col("entity_id").alias(PAIR[1]), F.struct(*facts).alias("other"))
    found = pairs.select(*PAIR).join(by_merge(one), PAIR[0]).join(by_merge(two), PAIR[1])
    other = F.col("other")
    same = (F.col(KEY[0]) == other[KEY[0]]) & agree(TEXTS, other)
    return found.where(same).select(*PAIR).distinct()


def exact_block(
    s1: DataFrame, candidates: DataFrame, among: DataFrame | None = None
) -> DataFrame:
    """Distinct pairs that agree on name or on address; only those of the pairs ``among``, if given.

    All of them grow with the square of a group of copies, those among others do not.
    """
    if among is not None:
        return exact_among(among, s1, candidates)
    if not has_repeated_ids(s1, candidates):
        return stack_pairs(*exact_rows_once(s1, candidates))
    return union_pairs(
        *together(
            lambda: exact_rows(s1, candidates, "clean_name"),
            lambda: exact_rows(s1, candidates, "clean_address"),
        )
    )


def capped_block(
    s1: DataFrame, candidates: DataFrame, name_cap: int = 200, address_cap: int = 100
) -> DataFrame:
    """``exact_block`` without the keys that more than the cap of candidates share."""
    return union_pairs(
        *together(
            lambda: capped_rows(s1, candidates, "clean_name", name_cap),
            lambda: capped_rows(s1, candidates, "clean_address", address_cap),
        )
    )
