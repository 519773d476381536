"""Arrow helpers of the operators that work on batches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows, for work that holds a part's results."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def give_back() -> None:
    """Returns memory that this worker has freed to the machine; it serves many tasks, and what its
    allocators keep would count for as long as it lives."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def give_back_driver(spark: SparkSession) -> bool:
    """The same for the driver: its Python, its JVM's heap, and the C heap of that, where many short
    queries leave free memory behind.  Tells whether the JVM has a command for the last."""
    give_back()
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    jvm.System.gc()
    beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    server = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection")
    invoke = next(m for m in server.getMethods() if m.getName() == "invoke")
    asked = new_array(jvm.Object, 4)
    asked[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    asked[1] = "systemTrimNativeHeap"
    try:
        invoke.invoke(beans, asked)
    except Py4JJavaError:
        return False
    return True


def map_batches(
    frame: DataFrame,
    schema: str,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, Sequence]]],
) -> DataFrame:
    """``mapInArrow`` for work that yields columns by name, in the order of ``schema``.

    Python workers also look for this package where the driver found it, so a local session may be
    started in any folder; a cluster has the package installed or sent along.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    package = str(Path(__file__).resolve().parents[2])
    frame.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", package)
    names = StructType.fromDDL(schema)
    arrow = to_arrow_schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [
                column.cast(field.type)
                if isinstance(column, (pa.Array, pa.ChunkedArray))
                else pa.array(column, field.type)
                for field, column in ((f, columns[f.name]) for f in arrow)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        give_back()

    return frame.mapInArrow(run, names)
