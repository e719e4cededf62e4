"""Entity tables derived from the general test tables.

``line_cards``: the whole text of every document, two lines per record (a name
line and the address line under it; the last record of a text with an odd
number of lines has no address), country = language, copies and near copies
included.  ``part_cards``: one record per part, with short names.  ``dirty_cards``: line
cards with missing and blank values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import short_key
from twinfold.operators.skew import hot_keys, spread_join
from twinfold.session import stage
from twinfold.sources.entities import spread_small

# Queries over the line cards that run over the dirty ones too.
ALSO_DIRTY = [
    "entity_view", "profile_blanks", "profile_columns_all", "name_top20", "address_top20",
    "name_freq_summary", "address_freq_summary", "clean_country_counts", "rare_tokens_address",
    "token_buckets", "token_country_top15", "name_token_pairs_cap10", "exact_name_pairs",
    "exact_address_pairs", "block_capped_low", "block_combined", "ngram_frequency", "ngram_topk",
    "ngram_topk_low", "truth_pairs", "blocking_quality", "pair_features_lines", "output_candidates",
]


class Cards:
    """The three tables of one card table, told apart by ``origin``."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        build: Callable[[SparkSession, str], DataFrame],
    ):
        self.spark, self.sf_dir, self.kind = spark, sf_dir, build.__name__
        cards = self.all = self.derived("cards", lambda: build(spark, sf_dir))
        self.s1, self.s2, self.s3 = [
            cards.where(F.col("origin") == o).drop("origin") for o in ("S1", "S2", "S3")
        ]
        self.candidates = cards.where(F.col("origin") != "S1").drop("origin")

    def derived(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return written(self.spark, self.sf_dir, f"{self.kind}/{name}", build)


def tidy(c: str) -> Column:
    """Lower case, with every run of other than letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        "origin",
        F.concat(F.col("origin"), F.lit("-"), F.col("number")).alias("entity_id"),
        "business_name",
        "business_address",
        "country",
        tidy("business_name").alias("clean_name"),
        tidy("business_address").alias("clean_address"),
        F.col("country").alias("clean_country"),
    )


def _origin(number: Column, first: int, second: int) -> Column:
    return F.when(number < first, "S1").when(number < second, "S2").otherwise("S3")


def line_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the three tables, with their ``origin``: sources 0-6 of the
    documents are the reference list, 7-13 and 14-19 the candidate tables."""
    documents = spread_small(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    source = F.substring("source", 4, 10).cast("int")
    lines = documents.select(
        "doc_id",
        F.col("lang").alias("country"),
        _origin(source, 7, 14).alias("origin"),
        F.split("text", "\n").alias("lines"),
    )
    cards = lines.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.ceil(F.size("lines") / 2).cast("int") - 1)).alias("k"),
    )
    return _finish(
        cards.select(
            "origin",
            "country",
            F.concat_ws("-", "doc_id", "k").alias("number"),
            F.get("lines", F.col("k") * 2).alias("business_name"),
            F.get("lines", F.col("k") * 2 + 1).alias("business_address"),
        )
    )


def dirty_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line cards with faults by the number of their document: no address where 17 divides
    it, a name of spaces where 19 does, and no country where 23 does."""
    number = F.split("entity_id", "-")[1].cast("long")
    return line_cards(spark, sf_dir).withColumns(
        {
            "clean_name": F.when(number % 19 == 0, "   ").otherwise(F.col("clean_name")),
            "clean_address": F.when(number % 17 != 0, F.col("clean_address")),
            "clean_country": F.when(number % 23 != 0, F.col("clean_country")),
        }
    )


def part_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands 1-8 are the reference list, 9-16 and 17-25 the candidate tables."""
    parts = spread_small(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_partkey")
    brand = F.substring("p_brand", 7, 10).cast("int")
    return _finish(
        parts.select(
            _origin(brand, 9, 17).alias("origin"),
            F.col("p_type").alias("country"),
            F.col("p_partkey").cast("string").alias("number"),
            F.col("p_name").alias("business_name"),
            F.concat_ws(" ", F.lit("size"), F.col("p_size")).alias("business_address"),
        )
    )


_written: dict[tuple[str, str, str], DataFrame] = {}


def written(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A derived table, written once per application: jobs read it many times,
    as they read cleaned input files elsewhere."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = stage(build())
    return _written[key]


def truth_lists(cards: DataFrame) -> DataFrame:
    """Known matches: records that agree in country, name and address.

    Each candidate record belongs to one reference record of its group, the
    first by id, so a group of copies gives one pair per candidate and not all
    pairs.  A row lists the matches of one reference record in one document;
    repeated rows per record are part of the format.
    """
    key = ["country_key", "name_key", "address_key"]
    whole = cards.where((F.col("clean_name") != "") & (F.col("clean_address") != "")).select(
        "origin", "entity_id", *[short_key("clean_" + k.removesuffix("_key")).alias(k) for k in key]
    )
    heads = (
        whole.where(F.col("origin") == "S1")
        .groupBy(*key)
        .agg(F.min("entity_id").alias("source1_entity_id"))
    )
    others = whole.where(F.col("origin") != "S1").drop("origin")
    found = spread_join(others, heads, key, hot_keys(others, key), left_id="entity_id")
    document = F.regexp_replace("entity_id", "-[0-9]+$", "")
    return (
        found.groupBy("source1_entity_id", document.alias("document"))
        .agg(F.array_join(F.sort_array(F.collect_set("entity_id")), ",").alias("matched_entity_ids"))
        .drop("document")
    )
