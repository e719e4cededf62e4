"""Posting lists of rare keys, the core of all frequency-capped blocking.

A key (a token, a character gram, a whole name) is rare when at most ``cap``
candidate records carry it.  Frequencies are counted first, with partial sums
before the shuffle; only rare keys are then gathered, so a list never exceeds
``cap`` ids.  Rows of common keys are dropped before anything is shuffled by
key: those of the ``MAX_COMMON`` commonest by an exact list, so that what remains
per key is below ``1/MAX_COMMON`` of all rows, and nearly all others by two bit maps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.operators.key_filter import LEAST_RARE, KeyFilter, key_filter
from twinfold.operators.skew import Hot, spread_join
from twinfold.session import by_merge

MAX_COMMON = 2000


def common_keys(frequency: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """The heaviest keys above ``cap``, at most ``MAX_COMMON`` of them."""
    return (
        frequency.where(F.col("frequency") > cap)
        .orderBy(F.desc("frequency"), *keys)
        .limit(MAX_COMMON)
        .select(*keys)
    )


def common_filter(frequency: DataFrame, keys: list[str], cap: int) -> KeyFilter | None:
    """Bit maps for the common keys, if there are more than the list can name."""
    return key_filter(frequency, keys, cap, MAX_COMMON)


def drop_common(
    index: DataFrame, frequency: DataFrame, keys: list[str], cap: int, maps: KeyFilter | None = None
) -> DataFrame:
    kept = maps.apply(index) if maps else index
    return kept.join(F.broadcast(common_keys(frequency, keys, cap)), keys, "left_anti")


def rare_keys(frequency: DataFrame, cap: int, floor: int = 1) -> DataFrame:
    """Keys with floor <= frequency <= cap, only broadcast if they are few."""
    rare = frequency.where(F.col("frequency").between(floor, cap))
    many = rare.limit(LEAST_RARE).count() == LEAST_RARE
    return by_merge(rare) if many else rare


def rare_postings(
    index: DataFrame,
    frequency: DataFrame,
    frequency_keys: list[str],
    join_keys: list[str],
    cap: int,
    floor: int = 1,
    maps: KeyFilter | None = None,
) -> DataFrame:
    """``join_keys, frequency, ids`` for each key with floor <= frequency <= cap."""
    return (
        drop_common(index, frequency, frequency_keys, cap, maps)
        .join(rare_keys(frequency, cap, floor), frequency_keys)
        .groupBy(*join_keys)
        .agg(F.first("frequency").alias("frequency"), F.collect_set("entity_id").alias("ids"))
    )


def meet(
    left: DataFrame, postings: DataFrame, keys: list[str], hot: Hot | None
) -> DataFrame:
    """Pairs (with repeats) of left records and the ids listed under their keys."""
    return spread_join(left, postings, keys, hot, left_id="entity_id").select(
        F.col("entity_id").alias("source1_entity_id"),
        F.explode("ids").alias("candidate_entity_id"),
    )
