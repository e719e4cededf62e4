"""Deterministic features of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import char_count, folded, same_text_flag
from twinfold.sources.entities import CLEAN, ENTITY, PAIR, as_text, require_columns

RAW_TEXT = ["name1", "name2", "address1", "address2", "country1", "country2"]
FIELDS = ["name", "address"]


def _digest(text: Column) -> Column:
    """16 bytes of the SHA-256, which are shuffled once per pair and do not compress."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _record(df: DataFrame, id_name: str, side: int) -> DataFrame:
    """A record's texts with what every one of its pairs needs of them: the length,
    and a 16-byte digest of the case-folded text in place of comparing texts.

    Done once per record, not once per pair; and a reader that asks for numbers
    only never moves the texts.
    """
    require_columns(df, ENTITY, "entities")
    texts = as_text(df, ENTITY)
    facts = []
    for field in FIELDS:
        text = f"clean_{field}"
        facts.append(char_count(text).alias(f"{field}{side}_length"))
        facts.append(_digest(folded(text)).alias(f"{field}{side}_digest"))
    named = [F.col(c).alias(f"{c.removeprefix('clean_')}{side}") for c in CLEAN]
    return texts.select(F.col("entity_id").alias(id_name), *named, *facts)


def pair_records(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """The pairs with both records.  Pairs without a record on either side drop
    out; a repeated entity id repeats its pairs.

    Both joins are on ids.  An id with very many pairs makes one side of a join
    skewed, which adaptive execution splits: each join reads plain shuffles and
    the partitioning it leaves is not used again.
    """
    return (
        as_text(pairs, PAIR)
        .join(_record(s1, PAIR[0], 1), PAIR[0])
        .join(_record(candidates, PAIR[1], 2), PAIR[1])
    )


def pair_features(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """Ids, 13 numeric features, and the texts that the similarity job needs."""
    nothing = _digest(F.lit(""))
    exact, missing, lengths = [], [], []
    for field in FIELDS:
        one, two = F.col(f"{field}1_digest"), F.col(f"{field}2_digest")
        exact.append((one == two).cast("int").alias(f"{field}_exact"))
        missing.append((one == nothing).cast("int").alias(f"{field}1_missing"))
        missing.append((two == nothing).cast("int").alias(f"{field}2_missing"))
        size = [F.col(f"{field}{side}_length") for side in (1, 2)]
        lengths += [*size, F.abs(size[0] - size[1]).alias(f"{field}_length_diff")]
    exact.append(same_text_flag("country1", "country2").alias("country_exact"))
    rows = pair_records(pairs, s1, candidates)
    return rows.select(*PAIR, *exact, *missing, *lengths, *RAW_TEXT)
