"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the driver's JVM ends.

    Only a local session may leave that setting out; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/lakemill-{spark.sparkContext.applicationId}"
    folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(hadoop)
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: cuts lineage, and lost executors recompute nothing before it."""
    folder = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_caches: dict[str, dict] = {}


def own_cache(owner: str) -> dict:
    """What an operator keeps in a Python worker. Workers live on from stage to stage: what others kept there goes."""
    for name in _caches.keys() - {owner}:
        _caches[name].clear()
    return _caches.setdefault(owner, {})


def open_store(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and plain path of a folder given as URI or as local path."""
    if "://" not in folder and not folder.startswith("file:"):
        return arrow_fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(folder)


def write_file(folder: str, name: str, chunks) -> int:
    """Write byte chunks under a temporary name and move the whole file into place.

    A task that runs twice writes the same bytes; readers see a whole file or none.
    """
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    parts, size = f"{base}/.{name}.{uuid.uuid4().hex}", 0
    with store.open_output_stream(parts, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    store.move(parts, f"{base}/{name}")
    return size
