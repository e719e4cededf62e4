"""One-row-per-entity result tables and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.operators.counts import count_repeated, count_rows, one_row
from twinfold.operators.truth import explode_id_list
from twinfold.sources.entities import PAIR, as_text

CHECKS = [
    "matches_row_difference",
    "candidates_row_difference",
    "matches_duplicate_entities",
    "candidates_duplicate_entities",
    "matches_outside_candidates",
    "unknown_matched_ids",
]


def _pairs(df: DataFrame) -> DataFrame:
    return as_text(df, PAIR).dropna(subset=PAIR).distinct()


def positive_pairs(predictions: DataFrame) -> DataFrame:
    return _pairs(predictions.where(F.col("prediction") == 1))


def outside_candidates(positives: DataFrame, pairs: DataFrame) -> DataFrame:
    return positives.join(_pairs(pairs), PAIR, "left_anti")


LIST_BYTES = 1 << 30  # of one list; a field of a row can hold twice as much


def id_lists(s1: DataFrame, pairs: DataFrame, name: str, most: int = LIST_BYTES) -> DataFrame:
    """Each entity of ``s1`` once, with its ids sorted and joined by commas, ``''``
    if it has none.  Ids are gathered per map task before the shuffle; the list
    itself is one field of one row, as the format demands.  A list of more than ``most``
    bytes is an error that names the entity."""
    entities = s1.select(F.col("entity_id").cast("string").alias(PAIR[0])).distinct()
    lists = pairs.groupBy(PAIR[0]).agg(
        F.array_join(F.sort_array(F.collect_set(PAIR[1])), ",").alias(name)
    )
    too_long = F.concat(
        F.lit(f"{name} of entity "), PAIR[0], F.lit(f" takes more than {most} bytes")
    )
    lists = lists.withColumn(
        name, F.when(F.octet_length(name) > most, F.raise_error(too_long)).otherwise(F.col(name))
    )
    return entities.join(lists, PAIR[0], "left").fillna("", [name])


def build_outputs(
    s1: DataFrame, pairs: DataFrame, predictions: DataFrame, check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Match lists and candidate lists; a match outside the candidates is an error."""
    candidates, positives = _pairs(pairs), positive_pairs(predictions)
    if check:
        stray = outside_candidates(positives, candidates).count()
        if stray:
            raise ValueError(f"{stray} predicted matches are not among the candidates")
    return (
        id_lists(s1, positives, "matched_entity_ids"),
        id_lists(s1, candidates, "candidate_entity_ids"),
    )


def validate_outputs(
    matches: DataFrame, candidates: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame
) -> DataFrame:
    """Violations per check: ``check_name, violations``; all zero when valid."""
    predicted = explode_id_list(matches, distinct=False)
    allowed = explode_id_list(candidates, "candidate_entity_ids")
    known = s2.select("entity_id").unionByName(s3.select("entity_id"))
    known = known.select(F.col("entity_id").cast("string").alias(PAIR[1])).distinct()
    unknown = predicted.select(PAIR[1]).distinct().join(known, PAIR[1], "left_anti")
    counts = one_row(
        entities=count_rows(s1.select("entity_id").distinct()),
        match_rows=count_rows(matches),
        candidate_rows=count_rows(candidates),
        repeated_matches=count_repeated(matches, PAIR[0]),
        repeated_candidates=count_repeated(candidates, PAIR[0]),
        outside=count_rows(predicted.join(allowed, PAIR, "left_anti")),
        unknown=count_rows(unknown),
    )
    violations = [
        F.abs(F.col("match_rows") - F.col("entities")),
        F.abs(F.col("candidate_rows") - F.col("entities")),
        F.col("repeated_matches"),
        F.col("repeated_candidates"),
        F.col("outside"),
        F.col("unknown"),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), value.alias("violations"))
            for name, value in zip(CHECKS, violations)
        ]
    )
    return counts.select(F.inline(rows))


def assert_valid(checks: DataFrame) -> None:
    failed = [r for r in checks.collect() if r["violations"]]  # one row per check
    if failed:
        raise ValueError(
            "invalid output: " + ", ".join(f"{r['check_name']}={r['violations']}" for r in failed)
        )
