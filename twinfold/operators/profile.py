"""Profiles of an entity table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions.text import is_blank, short_key
from twinfold.operators.counts import one_row


def profile_table(df: DataFrame) -> DataFrame:
    """Per column its position, type, and how many rows lack it; one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(df.columns)],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"missing_{i}").alias("missing"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return counted.select(
        "row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(described)
    )


def blank_counts(df: DataFrame, columns: tuple[str, ...] = ("clean_name", "clean_address")) -> DataFrame:
    """Rows, and rows whose column is NULL or only white space, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(is_blank(c)).alias(f"empty_{c}") for c in columns],
    )


def duplicate_counts(df: DataFrame, id_column: str = "entity_id") -> DataFrame:
    """How many rows repeat an earlier row, and how many an earlier id.

    Rows are compared by the SHA-256 of their content, so the shuffle moves a
    digest and an id per row instead of the texts.
    """
    row = F.sha2(F.to_json(F.struct(*df.columns)), 256)

    def repeats(key) -> DataFrame:
        groups = df.select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        return groups.agg(
            (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).cast("long").alias("n")
        )

    return one_row(duplicate_rows=repeats(row), duplicate_ids=repeats(short_key(id_column)))


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """How often each non-blank value occurs: ``value, count``."""
    kept = df.where(~is_blank(column)).select(F.col(column).alias("value"))
    return kept.groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    return value_frequencies(df, column).orderBy(F.desc("count"), "value").limit(n)


def frequency_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the value counts.

    Counts are first grouped by size, which leaves few rows for the quartiles.
    """
    sizes = value_frequencies(df, column).groupBy("count").agg(F.count(F.lit(1)).alias("times"))
    n, times, weight = F.col("count"), F.col("times"), F.col("times").cast("double")
    everything = Window.partitionBy()
    mean = F.sum(n * weight).over(everything) / F.sum(weight).over(everything)
    total = F.sum(times)
    variance = F.sum(weight * (n - F.col("mean")) * (n - F.col("mean"))) / (total - 1)
    return sizes.withColumn("mean", mean).agg(
        F.coalesce(total, F.lit(0)).alias("unique_values"),
        F.first("mean").alias("mean"),
        F.when(total > 1, F.sqrt(variance)).alias("std"),
        F.min(n).alias("min"),
        *[F.percentile(n, q, times).alias(name) for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
        F.max(n).alias("max"),
    )


def country_distribution(df: DataFrame, column: str = "country", keep_null: bool = True) -> DataFrame:
    kept = df if keep_null else df.where(F.col(column).isNotNull())
    return kept.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
