"""Known matches: reading them, and judging a set of candidate pairs by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import filled, text_or_empty
from twinfold.operators.counts import count_rows, one_row
from twinfold.operators.sampling import keyed_sample
from twinfold.sources.entities import CLEAN, PAIR, RAW, require_columns

TRUTH = ["source1_entity_id", "matched_entity_ids"]


def explode_id_list(
    df: DataFrame,
    column: str = "matched_entity_ids",
    trim: bool = True,
    drop_blank: bool = True,
    distinct: bool = True,
) -> DataFrame:
    """One pair per id of a comma-separated list."""
    require_columns(df, ["source1_entity_id", column], "id lists")
    piece = F.explode(F.split(text_or_empty(column), ","))
    pairs = df.select(
        F.col("source1_entity_id").cast("string").alias(PAIR[0]), piece.alias(PAIR[1])
    )
    if trim:
        pairs = pairs.withColumn(PAIR[1], F.trim(PAIR[1]))
    if drop_blank:
        pairs = pairs.where(F.trim(PAIR[1]) != "")
    return pairs.distinct() if distinct else pairs


def _listed(truth: DataFrame, trim: bool) -> DataFrame:
    """Pairs of the lists that are not blank, repeats and empty pieces kept."""
    lists = truth.where(filled("matched_entity_ids"))
    return explode_id_list(lists, trim=trim, drop_blank=False, distinct=False)


def evaluate_blocking(
    pairs: DataFrame, truth: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame
) -> DataFrame:
    """Recall and reduction of a set of candidate pairs, as one row.

    The true pairs are the pieces of the lists as they stand; captured are those
    that, trimmed, occur among the candidate pairs.
    """
    captured = _listed(truth, trim=True).join(pairs.select(*PAIR), PAIR)
    counts = one_row(
        true_pairs=count_rows(_listed(truth, trim=False)),
        captured_pairs=count_rows(captured),
        candidate_pairs=count_rows(pairs),
        s1_records=count_rows(s1),
        s2_records=count_rows(s2),
        s3_records=count_rows(s3),
    )

    def share(part: str, whole: str):
        ratio = F.col(part).cast("double") / F.col(whole).cast("double")
        return F.when(F.col(whole) > 0, ratio).otherwise(F.lit(0.0))

    return (
        counts.withColumn(
            "all_pairs",
            (
                F.col("s1_records").cast("decimal(19,0)")
                * (F.col("s2_records") + F.col("s3_records")).cast("decimal(19,0)")
            ).cast("decimal(38,0)"),
        )
        .withColumn("missed_pairs", F.col("true_pairs") - F.col("captured_pairs"))
        .withColumn("recall", share("captured_pairs", "true_pairs"))
        .withColumn("candidate_ratio", share("candidate_pairs", "all_pairs"))
        .withColumn("reduction", F.lit(1.0) - F.col("candidate_ratio"))
        .drop("s1_records", "s2_records", "s3_records")
    )


def missed_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Listed true pairs that are not among the candidate pairs."""
    return _listed(truth, trim=True).join(pairs.select(*PAIR), PAIR, "left_anti")


def missed_details(
    pairs: DataFrame,
    truth: DataFrame,
    s1: DataFrame,
    candidates: DataFrame,
    sample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """The missed pairs with the text of both records; all of them, or ``sample``."""

    def side(df: DataFrame, id_name: str, prefix: str) -> DataFrame:
        have = [c for c in [*RAW, *CLEAN[:2]] if c in df.columns]
        names = {c: prefix + c.replace("business_", "") for c in have}
        return df.select(
            F.col("entity_id").alias(id_name), *[F.col(c).alias(names[c]) for c in have]
        )

    missed = missed_pairs(pairs, truth)
    details = missed.join(side(s1, PAIR[0], "s1_"), PAIR[0]).join(
        side(candidates, PAIR[1], "candidate_"), PAIR[1]
    )
    return keyed_sample(details, sample, PAIR, seed) if sample is not None else details
