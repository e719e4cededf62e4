"""A corpus from raw documents to packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm.common import new_name, row_key, table
from twinfold.llm.decontam import decontaminate
from twinfold.llm.exact_dedup import exact_dedup
from twinfold.llm.language import learned, remainder, with_language
from twinfold.llm.packing import pack_documents
from twinfold.llm.queries import TOKENIZER
from twinfold.llm.simhash import simhash_components
from twinfold.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``gone`` names by their ``row_key``.

    Those that go are the fewer, so they are what is joined.
    """
    key = new_name(docs, "gone_key")
    gone = gone.select(F.col("row_key").alias(key))
    return docs.join(gone, row_key() == gone[key], "left_anti")


def _one_of_each(docs: DataFrame, judged: DataFrame, group: str, stays: Column) -> DataFrame:
    """One row of each group: of the rows that may stay the one with the smallest ``row_key``.

    Each group has such a row, and rows of one key are in one group.
    """
    keys = stage(
        judged.groupBy("row_key").agg(
            F.first(group).alias("group"), F.first(stays).alias("stays"), F.count(F.lit(1)).alias("n")
        )
    )
    chosen = stage(keys.where("stays").groupBy("group").agg(F.min("row_key").alias("row_key")))
    gone = keys.join(chosen, "row_key", "left_anti").select("row_key")
    repeated = stage(keys.where("n > 1").join(chosen, "row_key", "left_semi").select("row_key"))
    if repeated.isEmpty():
        return _without(docs, gone)
    key = new_name(docs, "kept_key")
    again = repeated.select(F.col("row_key").alias(key))
    once = (
        docs.join(again, row_key() == again[key], "left_semi")
        .withColumn(key, row_key())
        .dropDuplicates([key])
        .drop(key)
    )
    return _without(docs, gone.unionByName(repeated)).unionByName(once)


def drop_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; if no language can be learned, none does.  Others that have no
    ``lang`` get the one found."""
    return with_language(docs, learned(docs, remainder() == 0))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, which has the largest id (or none if no row has one)."""
    return _one_of_each(docs, exact_dedup(docs, keyed=True), "text_sha256", F.col("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, which has the smallest id (or none if no row
    has one)."""
    judged = simhash_components(docs, keyed=True)
    return _one_of_each(docs, judged, "root", F.expr("doc_id <=> component_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"), keyed=True)
    return _without(docs, judged.where("contaminated").select("row_key").distinct())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all tokens of the documents in sequences of at most 2048."""
    return pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", drop_undetermined),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Language models and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs)
    return docs
