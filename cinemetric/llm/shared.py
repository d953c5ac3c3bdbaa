"""Shared storage: written stage tables and files that tasks write once and map into memory.

Everything goes under the folder that the cluster names in ``spark.checkpoint.dir``.  Tables are
written by Spark; plain files go through ``pyarrow.fs`` (local, HDFS and object stores alike),
first under a name of the task attempt and then moved, so a retried or speculative task leaves
one whole file.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cinemetric.session import checkpoint_dir


def work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder of one operator run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back: cuts the lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(uri: str):
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, *arrays: np.ndarray) -> None:
    """Write the arrays one after the other into a file that appears whole or not at all."""
    system, path = _fs(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        for a in arrays:
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if a.size else b"")
    system.move(attempt, path)


_CACHE: dict[str, tempfile.TemporaryDirectory] = {}


def map_file(uri: str, dtype: str, count: int = -1, offset: int = 0) -> np.ndarray:
    """The file's values as a read-only memory map.

    A file of a store without POSIX paths is first copied to a scratch folder of the worker
    process, removed when the worker ends.
    """
    from pyarrow import fs

    system, path = _fs(uri)
    if not isinstance(system, fs.LocalFileSystem):
        folder = _CACHE.setdefault("dir", tempfile.TemporaryDirectory(prefix="mapped-")).name
        local = os.path.join(folder, uuid.uuid5(uuid.NAMESPACE_URL, uri).hex)
        if not os.path.exists(local):
            fs.copy_files(path, local + ".part", source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
            os.replace(local + ".part", local)
        path = local
    size = os.path.getsize(path)
    if count < 0:
        count = (size - offset) // np.dtype(dtype).itemsize
    if not count:
        return np.empty(0, dtype)
    return np.memmap(path, dtype, "r", offset, (count,))
