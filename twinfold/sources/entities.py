"""Readers for entity tables, candidate pairs and id lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CLEAN = ["clean_name", "clean_address", "clean_country"]
ENTITY = ["entity_id", *CLEAN]
RAW = ["business_name", "business_address", "country"]
PAIR = ["source1_entity_id", "candidate_entity_id"]


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def require_columns(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    """``df`` itself, or an error that names the columns it lacks."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {missing}; it has {df.columns}")
    return df


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(name).cast("string").alias(name) for name in columns])


def read_entities(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """An entity table from Parquet, or from tab-separated text with a header.

    Text files are read without a schema pass: all entity columns are text,
    and a malformed row stops the job.
    """
    if str(path).lower().rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(str(path))
    else:
        lines = spark.read.option("sep", "\t").option("header", True)
        header = lines.option("inferSchema", False).csv(str(path)).columns
        df = lines.option("mode", "FAILFAST").schema(text_schema(header)).csv(str(path))
    wanted = columns or [name for name in [*ENTITY, *RAW] if name in df.columns]
    require_columns(df, wanted if columns else ENTITY, str(path))
    return as_text(df, wanted)


def candidates_of(*sources: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The candidate tables stacked into one."""
    wanted = columns or [c for c in sources[0].columns if all(c in s.columns for s in sources)]
    return reduce(DataFrame.unionByName, [as_text(s, wanted) for s in sources])


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return as_text(require_columns(spark.read.parquet(str(path)), PAIR, str(path)), PAIR)


def read_id_lists(spark: SparkSession, path: str, list_column: str) -> DataFrame:
    """A one-row-per-entity list file; an empty field comes back as ``''``."""
    columns = ["source1_entity_id", list_column]
    df = spark.read.csv(
        str(path), sep="\t", header=True, schema=text_schema(columns), mode="FAILFAST"
    )
    return df.select(columns[0], F.coalesce(columns[1], F.lit("")).alias(list_column))


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Hand a table stored in fewer splits than there are cores to all cores.

    A table of many splits is returned as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
