"""Files in the shared folder, on any file system Arrow can open."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from twinfold.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder in the shared folder, as a uri or path."""
    top = re.sub("^file:/(?=[^/])", "file:///", shared_folder(spark)).rstrip("/")
    folder = f"{top}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    system, path = located(folder)
    system.create_dir(path, recursive=True)
    return folder


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri``, and its path there."""
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def local_path(uri: str) -> str:
    """The path of a file that workers map into memory, which takes a mounted folder."""
    system, path = located(uri)
    if not isinstance(system, fs.LocalFileSystem):
        raise ValueError(f"spark.checkpoint.dir must be a mounted folder to map files of it: {uri}")
    return path
