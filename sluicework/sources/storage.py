"""File work through the Hadoop ``FileSystem`` API, for any store that Spark can reach."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.functions.metrics import observed


# Looks at a folder that others change.
_TRIES = 20


def _located(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _located(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _located(spark, path)
    # Someone else may delete it at the same time.
    if fs.exists(target) and not fs.delete(target, True) and fs.exists(target):
        raise OSError(f"could not delete {path}")


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, from_path = _located(spark, source)
    to_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    # Renaming onto an existing folder would move the source *into* it.
    if fs.exists(to_path) or not fs.rename(from_path, to_path):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _located(spark, path)
    fs.mkdirs(target)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, which one call makes visible."""
    fs, target = _located(spark, path)
    fs.create(target, True).close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """A new small file; False when there is one already, which then stays as it is."""
    fs, target = _located(spark, path)
    fs.mkdirs(target.getParent())
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.toString():
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The first bytes of a small file."""
    fs, target = _located(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readNBytes(1 << 16)).decode()
    finally:
        stream.close()


def _is_gone(error: Py4JJavaError) -> bool:
    return "FileNotFoundException" in error.java_exception.toString()


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written, None when it is gone."""
    fs, target = _located(spark, path)
    try:
        return time.time() - fs.getFileStatus(target).getModificationTime() / 1000
    except Py4JJavaError as error:
        if not _is_gone(error):
            raise
        return None


def children(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    fs, _ = _located(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}"))
    return sorted(status.getPath().getName() for status in found or [])


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files directly in a folder, 0 when there is none."""
    fs, target = _located(spark, path)
    return sum(f.getLen() for f in fs.listStatus(target)) if fs.exists(target) else 0


def tree_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, 0 when there is none."""
    fs, target = _located(spark, path)
    for tries in count(1):
        try:
            return fs.getContentSummary(target).getLength() if fs.exists(target) else 0
        except Py4JJavaError as error:
            # A file that someone else has moved or deleted between its listing and its look-up.
            if not _is_gone(error) or tries == _TRIES:
                raise
            time.sleep(0.1)


STAGING_SETTING = "sluicework.staging.dir"


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: ``sluicework.staging.dir`` of the session, else the folder
    the cluster names in ``spark.checkpoint.dir``.

    Only a local master (one machine, as in tests) may run with neither; there a new folder of
    the machine is made once and kept in the session's setting.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get(STAGING_SETTING, None)
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(
            f"set spark.checkpoint.dir or {STAGING_SETTING} to a folder all executors can reach"
        )
    spark.conf.set(STAGING_SETTING, tempfile.mkdtemp(prefix="sluicework-"))
    return spark.conf.get(STAGING_SETTING)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A frame without rows that the optimizer knows to be empty, so joins with it fold away."""
    return spark.createDataFrame([], schema).limit(0)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go when it has ended, for steps that write each of
    their results to a table; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


class Staging:
    """Intermediate results written as Parquet in the shared folder.

    A written table survives lost executors, cuts the lineage, fixes values that a second
    evaluation could change (row slots), and is read back column-pruned.  Close it when the
    result that reads from it has been written; otherwise it goes when the JVM ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.root = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
        fs, root = _located(spark, self.root)
        fs.mkdirs(root)
        fs.deleteOnExit(root)

    def table(self, frame: DataFrame) -> DataFrame:
        return self.measured_table(frame)[0]

    def measured_table(self, frame: DataFrame, **metrics: str) -> tuple[DataFrame, dict[str, Any]]:
        """The written table, and SQL aggregates over it that the write itself computes.

        Over no rows every aggregate is None.
        """
        path = self.folder()
        columns = [F.expr(sql).alias(name) for name, sql in metrics.items()]
        seen = Observation()
        (frame.observe(seen, *columns) if columns else frame).write.parquet(path)
        table = self._spark.read.schema(frame.schema).parquet(path)
        found = observed(seen) if columns else {}
        if found is None:  # no word from the write says nothing about what was written
            found = table.agg(*columns).first().asDict()
        return table, found

    def folder(self) -> str:
        return f"{self.root}/{uuid.uuid4().hex}"

    def close(self) -> None:
        delete(self._spark, self.root)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
