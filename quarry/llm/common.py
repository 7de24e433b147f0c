"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """name, or name after as many underscores as it takes to be none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session, whose tasks run in this very process, gets a temporary one; on a cluster
    that is an error, as executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='quarry-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Paths that new_path() gave and that were not dropped.
_paths: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    atexit.register(_forget, spark, path)
    return path


def written_so_far() -> int:
    """A mark for release_since()."""
    return len(_paths)


def release_since(spark: SparkSession, mark: int, *keep: DataFrame) -> None:
    """Delete what was written since the mark but for what materialise() gave as keep."""
    for path in [p for p in _paths[mark:] if p not in {df.quarry_path for df in keep}]:
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _paths:
        _paths.remove(path)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # the session has ended: there is nobody left to delete with
        pass


@contextmanager
def setting(spark: SparkSession, name: str, value: object):
    """Inside, Spark has this setting; for tables that are materialised there."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int):
    """Inside, rows go to Python in batches of so many bytes, for tables with large rows that are materialised there."""
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", most_bytes):
        yield


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.quarry_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete what materialise() wrote."""
    drop_path(df.sparkSession, df.quarry_path)
