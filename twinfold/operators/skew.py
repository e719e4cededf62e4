"""Joins on data keys of which a few may hold a large share of all rows.

A hash partition never has to hold a whole hot key: its rows are dealt over
several cells, and the cells over tasks by a shuffle of a fixed number of
partitions, which adaptive execution does not merge (it goes by bytes, and a
cell of few bytes may make many pairs).  Which keys are hot is counted
beforehand, on a 64-bit hash of the key, and written to a table that may have
any number of rows; only their number and the number of pairs they make reach
the driver.  The hash only decides how rows are dealt, never which rows join, so
a collision costs nothing but an extra cell.  Without a hot key the join is an
ordinary one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.session import by_merge, stage

# Pairs of hot keys for which another task is worth its start.
TASK_PAIRS = 50_000_000
MAX_TASKS = 100_000
# Rows of a key on either of two sides beyond which it is hot even if it makes few pairs.
SIDE_ROWS = 200_000
# Lists that the rows of a key, or of a cell of a hot key, are gathered in.
LISTS = 32
CELLS = ["left_cells_at", "right_cells_at"]


class Hot(NamedTuple):
    """Hot keys (``key_hash, left_cells, right_cells``), and the tasks to deal their cells over."""

    cells: DataFrame
    tasks: int


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(left: DataFrame, keys: list[str], left_rows: int = 200_000) -> Hot | None:
    """Hot keys of the left side, for a right side with one row per key."""
    counts = left.groupBy(_hash(keys).alias("key_hash")).agg(F.count(F.lit(1)).alias("l"))
    return _cells(counts.withColumn("r", F.lit(1)), left_rows, 1)


def hot_keys_of_both(
    left: DataFrame, right: DataFrame, keys: list[str], cell_rows: int
) -> Hot | None:
    """Hot keys of two sides that may both repeat a key."""
    tagged = left.select(
        _hash(keys).alias("key_hash"), F.lit(1).alias("l"), F.lit(0).alias("r")
    ).unionByName(
        right.select(_hash(keys).alias("key_hash"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = tagged.groupBy("key_hash").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    both = counts.where((F.col("l") > 0) & (F.col("r") > 0))
    return _cells(both, cell_rows, cell_rows, F.greatest("l", "r") > SIDE_ROWS)


def _cells(
    counts: DataFrame, left_rows: int, right_rows: int, also: Column | None = None
) -> Hot | None:
    """How many cells each side of a hot key is dealt over.

    A key is hot by the pairs it makes: more than a cell of ``left_rows`` and
    ``right_rows`` does, however they fall on the two sides, or if it is one of ``also``.
    """
    pairs = F.col("l").cast("double") * F.col("r")
    many = pairs > float(left_rows) * right_rows
    hot = stage(
        counts.where(many if also is None else many | also).select(
            "key_hash",
            F.ceil(F.col("l") / F.lit(left_rows)).cast("int").alias("left_cells"),
            F.ceil(F.col("r") / F.lit(right_rows)).cast("int").alias("right_cells"),
            pairs.alias("pairs"),
        )
    )
    keys, made = hot.agg(F.count(F.lit(1)), F.sum("pairs")).first()
    if not keys:
        return None
    spark = counts.sparkSession
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return Hot(hot.drop("pairs"), max(least, min(int(made / TASK_PAIRS) + 1, MAX_TASKS)))


def _deal(
    df: DataFrame, keys: list[str], hot: Hot, row_id: str | None, own: str, other: str, copied: bool
) -> DataFrame:
    """Rows with the cell they go to: one of ``own`` by id, and each of ``other`` if ``copied``."""
    own_cells = F.coalesce(F.col(own), F.lit(1))
    copies = F.coalesce(F.col(other), F.lit(1))
    at = F.pmod(F.xxhash64(F.col(row_id)), own_cells).cast("int") if row_id else F.lit(0)
    # An ordinary join: few hot keys are broadcast, many are not.
    placed = df.withColumn("key_hash", _hash(keys)).join(hot.cells, "key_hash", "left")
    placed = placed.withColumn(own + "_at", at)
    placed = placed.withColumn(
        other + "_at", F.explode(F.sequence(F.lit(0), copies - 1)) if copied else F.lit(0)
    )
    placed = placed.drop("key_hash", "left_cells", "right_cells")
    return placed.repartition(hot.tasks, *keys, *CELLS)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    hot: Hot | None,
    left_id: str,
    right_id: str | None = None,
) -> DataFrame:
    """Inner join that deals the rows of hot keys over a grid of cells.

    Left rows of a hot key go to one of its ``left_cells`` by id and are copied
    to each of its ``right_cells``; right rows the other way round, so every
    pair meets in exactly one cell.  ``right_id`` None means the right side has
    one row per key, which is only copied.
    """
    if hot is None:
        return left.join(right, keys)
    one = _deal(left, keys, hot, left_id, "left_cells", "right_cells", right_id is not None)
    two = _deal(right, keys, hot, right_id, "right_cells", "left_cells", True)
    return one.join(two, [*keys, *CELLS]).drop(*CELLS)


def spread_lists(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    hot: Hot | None,
    left_id: str,
    right_id: str,
    item: Column,
) -> DataFrame:
    """The same, but the right rows come as lists ``ids`` of ``item``, at most ``LISTS`` per key or cell.

    All left rows of a key meet one list after the other.  So pairs are made by opening lists, not by
    the join, and a file of them repeats the same few ids, which takes a fraction of its size.
    """
    at = list(keys)
    if hot is None:
        right = right.repartition(*keys)
    else:
        at += CELLS
        left = _deal(left, keys, hot, left_id, "left_cells", "right_cells", True)
        right = _deal(right, keys, hot, right_id, "right_cells", "left_cells", True)
    # Not the hash that cells go by: all rows of a cell have the same remainder of that.
    part = F.pmod(F.crc32(F.col(right_id).cast("binary")), F.lit(LISTS))
    lists = right.groupBy(*at, part.alias("list")).agg(F.collect_list(item).alias("ids"))
    # By merging, as a broadcast of the lists would turn the order round.
    return lists.drop("list").join(by_merge(left), at).drop(*CELLS)
