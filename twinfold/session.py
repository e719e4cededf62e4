"""Session settings, and the shared folder in which jobs cut their lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("twinfold")
    settings = {
        **CLUSTER_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="twinfold-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    For frames that several later steps scan.  Unlike a cache, the table
    survives lost executors; unlike ``checkpoint`` it keeps column pruning and
    filter pushdown for the readers.  All tables of an application lie in one
    folder named after it, which can be removed when the application has ended; those made in
    ``owned_tables`` are removed at its end.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    path = f"{folder}/staged-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_merge(df: DataFrame) -> DataFrame:
    """``df``, never broadcast in a join.

    For staged tables that grow with the input.  Spark sizes a table by its files, in which sorted ids
    take a fiftieth of the memory that they take in the driver, and would broadcast it.
    """
    return df.hint("merge")


_owned: ContextVar[list[str] | None] = ContextVar("owned tables", default=None)


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged inside, also by steps run side by side, whether or not all goes well.

    Nothing that leaves may still read them.
    """
    paths: list[str] = []
    outer = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(outer)
        for path in paths:
            remove(spark, path)


def _located(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of ``path``, and its path there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table that this application has written, if it is there."""
    system, place = _located(spark, path)
    system.delete(place, True)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Lets ``write`` make a new table beside ``path`` and then puts it there by renaming.

    If writing fails, what was at ``path`` is still there and nothing else is.
    """
    path = str(path).rstrip("/")
    folder, _, name = path.rpartition("/")
    before = f"{folder}/" if "/" in path else ""
    # Readers leave out names that begin with a dot.
    new, old = (f"{before}.{name}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    try:
        write(new)
        system, place = _located(spark, path)
        kept = system.exists(place)
        if kept and not system.rename(place, _located(spark, old)[1]):
            raise OSError(f"cannot replace {path}")
        if not system.rename(_located(spark, new)[1], place):
            if kept:
                system.rename(_located(spark, old)[1], place)
            raise OSError(f"cannot write {path}")
        if kept:
            remove(spark, old)
    finally:
        remove(spark, new)


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Results of independent steps that each run a Spark job, run side by side."""
    # Threads take over the job group and the scheduler pool of the caller, and its owned tables.
    inherit = inheritable_thread_target(SparkSession.builder.getOrCreate())
    inherited = [partial(copy_context().run, inherit(s)) for s in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        return list(pool.map(lambda step: step(), inherited))
