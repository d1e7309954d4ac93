"""Session helpers: a local session for tests, the shared folder, and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 4, app: str = "lamella") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAMELLA_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only where that setting is absent (tests on one machine) a temporary folder is made and set.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    own = spark.sparkContext.getCheckpointDir()
    if own:
        return own.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="lamella-")
    spark.sparkContext.setCheckpointDir(own)
    return own


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder; release() deletes it, at the latest when the application ends."""
    if not _SCRATCH:
        atexit.register(_at_exit, spark)
    _SCRATCH.append(f"{shared_dir(spark)}/lamella/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def release(spark: SparkSession) -> None:
    """Delete all tables that written() has made; to be called once the results that rest on them have been read."""
    while _SCRATCH:
        remove(spark, _SCRATCH.pop())


def _at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped before
        release(spark)


def _file(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, whichever it is, and the path in it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, at = _file(spark, path)
    fs.delete(at, True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all: written beside its place, then renamed."""
    fs, at = _file(spark, path)
    _, beside = _file(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(beside, at):
        raise OSError(f"{path} is there already")


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none if it isn't there."""
    fs, at = _file(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session (a double underscore for a dot) for as long as the block runs."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut, a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)
