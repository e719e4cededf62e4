"""Token frequencies, and blocking on rare shared tokens."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions.text import filled, record_tokens, short_key
from twinfold.operators.exact import TEXTS, agree, digests, exact_rows, exact_rows_once, has_repeated_ids, without_exact
from twinfold.operators.pairs import stack_pairs, union_pairs
from twinfold.operators.postings import common_filter, drop_common, rare_postings
from twinfold.operators.skew import hot_keys, spread_join
from twinfold.session import stage, together
from twinfold.sources.entities import PAIR

# The bounds of the ten frequency buckets of the report.
BUCKETS = [
    ("1", 1, 1),
    ("2-5", 2, 5),
    ("6-10", 6, 10),
    ("11-50", 11, 50),
    ("51-100", 51, 100),
    ("101-500", 101, 500),
    ("501-1,000", 501, 1000),
    ("1,001-5,000", 1001, 5000),
    ("5,001-10,000", 5001, 10000),
    ("10,001+", 10001, None),
]


def token_frequency(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Occurrences of each token, repeats within a record included."""
    group = [by, "token"] if by else ["token"]
    tokens = df.where(filled(column)).select(
        *([by] if by else []), F.explode(F.split(F.col(column), " ")).alias("token")
    )
    return (
        tokens.where(F.trim("token") != "")
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def top_tokens(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    return token_frequency(df, column).orderBy(F.desc("frequency"), "token").limit(n)


def top_tokens_by_country(df: DataFrame, column: str = "clean_name", n: int = 15) -> DataFrame:
    """The ``n`` commonest tokens of each country; records without one are left out."""
    frequency = token_frequency(df.where(F.col("clean_country").isNotNull()), column, "clean_country")
    place = Window.partitionBy("clean_country").orderBy(F.desc("frequency"), "token")
    return frequency.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= n)


def _within(lower: int, upper: int | None) -> Column:
    f = F.col("frequency")
    return f >= lower if upper is None else f.between(lower, upper)


def frequency_buckets(frequency: DataFrame) -> DataFrame:
    """Tokens per frequency bucket, all ten buckets counted in one pass."""
    counted = frequency.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(label).alias("bucket"),
                    F.count_if(_within(lower, upper)).alias("tokens"),
                )
                for i, (label, lower, upper) in enumerate(BUCKETS)
            ]
        ).alias("rows")
    )
    return counted.select(F.inline("rows"))


def _index(df: DataFrame, column: str, min_len: int, also: Sequence[str] = ()) -> DataFrame:
    """One row per record and different token: ``entity_id, country, token``, digests of ``also``."""
    rows = df.where(filled(column)).select(
        "entity_id", "clean_country", F.explode(record_tokens(column)).alias("token"), *digests(also)
    )
    return rows.where(F.length("token") >= max(min_len, 1))


def _record_frequency(index: DataFrame) -> DataFrame:
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("frequency"))


def rare_tokens(df: DataFrame, column: str, max_freq: int = 50, min_len: int = 3) -> DataFrame:
    """Tokens carried by at most ``max_freq`` records, whatever their country."""
    frequency = _record_frequency(_index(df, column, min_len))
    return frequency.where(F.col("frequency") <= max_freq)


def token_lists(
    s1: DataFrame,
    candidates: DataFrame,
    column: str,
    max_freq: int = 50,
    min_len: int = 3,
    unless: Sequence[str] = (),
) -> DataFrame:
    """For each reference record and rare token, ``ids``: the candidates of its country that share it.

    Candidates that agree with the record on a column of ``unless`` are left out.
    """

    def index(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
        return _index(df, column, min_len, also).withColumns(
            {"token": short_key("token"), "country_key": short_key("clean_country")}
        ).drop("clean_country")

    keys = ["country_key", "token"]
    listed = index(candidates)
    in_country = F.col("country_key").isNotNull()
    left = index(s1, unless).where(in_country)

    def vocabulary() -> tuple:
        counted = stage(_record_frequency(listed))  # read several times
        return counted, common_filter(counted, ["token"], max_freq)

    (frequency, maps), hot = together(vocabulary, lambda: hot_keys(left, keys))
    fields = [f"{c}_digest" for c in unless]
    rows = index(candidates, unless).where(in_country)
    if unless:
        rows = rows.select(*keys, F.struct("entity_id", *fields).alias("entity_id"))
    postings = rare_postings(rows, frequency, ["token"], keys, max_freq, maps=maps)
    kept = drop_common(left, frequency, ["token"], max_freq, maps)
    met = spread_join(kept, postings, keys, hot, left_id="entity_id")
    ids = F.col("ids")
    if unless:
        others = F.filter(ids, lambda x: ~agree(unless, x))
        ids = F.transform(others, lambda x: x["entity_id"])
    found = met.select(F.col("entity_id").alias(PAIR[0]), ids.alias("ids"))
    return found.where(F.size("ids") > 0) if unless else found


def token_rows(
    s1: DataFrame, candidates: DataFrame, column: str, max_freq: int = 50, min_len: int = 3
) -> DataFrame:
    """Pairs of one country that share a rare token, repeated per shared token."""
    lists = token_lists(s1, candidates, column, max_freq, min_len)
    return lists.select(PAIR[0], F.explode("ids").alias(PAIR[1]))


def pairs_of_lists(*lists: DataFrame) -> DataFrame:
    """Distinct pairs of reference records and ids listed with them.

    Lists are shuffled as they are, by the reference record, and only opened there.
    """
    met = reduce(DataFrame.unionByName, lists).repartition(PAIR[0]).groupBy(PAIR[0])
    each = met.agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
    return each.select(PAIR[0], F.explode("ids").alias(PAIR[1]))


def token_block(
    s1: DataFrame, candidates: DataFrame, column: str, max_freq: int = 50, min_len: int = 3
) -> DataFrame:
    """Distinct pairs of one country that share a rare token of ``column``."""
    return pairs_of_lists(token_lists(s1, candidates, column, max_freq, min_len))


def combined_block(
    s1: DataFrame,
    candidates: DataFrame,
    columns: Sequence[str],
    max_freq: int = 50,
    min_len: int = 3,
    more: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Distinct pairs that agree on name or on address, share a rare token of one of ``columns``, or
    are among ``more``, which gives pairs of one country.

    Exact pairs may be very many.  They are made once and not shuffled; the others are made
    without them, and only among these are repeats looked for.
    """
    also = [more] if more else []
    if has_repeated_ids(s1, candidates):
        exact = [lambda c=c: exact_rows(s1, candidates, c) for c in TEXTS]
        rows = [lambda c=c: token_rows(s1, candidates, c, max_freq, min_len) for c in columns]
        return union_pairs(*together(*exact, *rows, *also))
    lists = [lambda c=c: token_lists(s1, candidates, c, max_freq, min_len, TEXTS) for c in columns]
    exact, *others = together(lambda: exact_rows_once(s1, candidates), *lists, *also)
    if more:
        rest = without_exact(others.pop(), s1, candidates)
        others.append(rest.select(PAIR[0], F.array(PAIR[1]).alias("ids")))
    return stack_pairs(*exact, pairs_of_lists(*others))
