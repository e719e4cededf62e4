"""Set operations on candidate pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.sources.entities import PAIR


def stack_pairs(*blocks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [b.select(*PAIR) for b in blocks])


def union_pairs(*blocks: DataFrame) -> DataFrame:
    """Distinct pairs of all blocks; one shuffle however many blocks there are."""
    return stack_pairs(*blocks).distinct()


def new_pairs(found: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct pairs of ``found`` that ``known`` lacks."""
    return found.select(*PAIR).subtract(known.select(*PAIR))


def block_coverage(pairs: DataFrame) -> DataFrame:
    """Pairs, and reference entities with at least one candidate, as one row.

    Counted from per-entity partial counts rather than by shuffling each pair
    for a distinct count.
    """
    per_entity = pairs.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n"))
    return per_entity.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidate_pairs"),
        F.count(F.lit(1)).alias("covered_entities"),
    )
