"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Capitals beyond ASCII, which must not change where only A-Z are lower-cased.
FOREIGN_CAPITAL = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^\x00-\x7F]]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z lower-cased and every other character as it is.

    ``lower`` is the faster function and does the same on texts without other capitals.
    """
    return F.when(c.rlike(FOREIGN_CAPITAL), F.translate(c, UPPER, UPPER.lower())).otherwise(
        F.lower(c)
    )


def text_or_empty() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def row_key() -> Column:
    """The digest of id and text (a null text is an empty one), which repeated rows share."""
    doc_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return F.sha2(F.concat_ws(":", doc_id, text_or_empty()), 256)


def new_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_held: dict = {}


def _give_back() -> None:
    """Returns freed memory to the system; the allocators keep hundreds of MB of it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def held(owner: str, key: object, build: Callable[[], object]) -> object:
    """What ``build`` makes, once for all tasks of a worker, until another owner holds something.

    Workers outlive stages: what one stage has learned must not lie beside what the next one does.
    """
    if _held.get("owner") != owner:
        _held.clear()
        _give_back()
        _held["owner"] = owner
    if key not in _held:
        _held[key] = build()
    return _held[key]


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def map_batches(
    df: DataFrame, ddl: str, start: Callable[[], Callable[[pa.RecordBatch], dict | None]]
) -> DataFrame:
    """``df`` mapped batch by batch.

    ``start`` is called once in each task and gives the function that turns a batch
    into a dictionary of columns (lists or arrays), or None for no rows.
    """
    schema = schema_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        step = start()
        for batch in batches:
            columns = step(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)
