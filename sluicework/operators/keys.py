"""Surrogate keys: the highest one in use, and the next dense run of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sluicework.functions.columns import quoted
from sluicework.sources import storage
from sluicework.sources.storage import Staging
from sluicework.sources.writers import stored_path

_SLOT = "_slot"
_PART = "_part"
# monotonically_increasing_id() = (partition number << 33) + position in the partition.
_POSITION_BITS = 33


def highest_key(table: DataFrame, name: str) -> int:
    """The largest key of a frame, 0 when there is none."""
    return table.agg(F.coalesce(F.max(quoted(name)), F.lit(0)).alias("top")).first()["top"]


def highest_stored_key(spark: SparkSession, path: str, schema, name: str) -> int:
    """Same over a stored table, answered from the Parquet footers instead of a column scan.

    A file with rows but without any key has no footer value, which raises.
    """
    if not storage.exists(spark, path):
        return 0
    path = stored_path(spark, path)
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = footers.read.schema(schema).parquet(path)
    return found.agg(F.max(quoted(name)).alias("top")).first()["top"] or 0


def range_clustered(frame: DataFrame, keys: DataFrame, key: str, parts: int) -> DataFrame:
    """The rows in ``parts`` partitions of disjoint, about equally full key ranges, each sorted.

    ``keys`` has the frame's keys, narrow and written, so that the ranges' limits are found without
    evaluating the frame.  Written like this, a file spans one range, and a scan for a few keys reads
    the files that have them.  Equal keys stay together, null keys come first.  Keys that are no
    numbers have their limits sampled from the frame.
    """
    name = F.col(quoted(key))
    if parts < 2:
        return frame.repartition(1).sortWithinPartitions(name)
    if not isinstance(keys.schema[key].dataType, NumericType):
        return frame.repartitionByRange(parts, name).sortWithinPartitions(name)
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(quoted(key), shares, 20 * parts).alias("limits")).first()
    limits = sorted(set(found["limits"] or []))
    # Two levels, so that a row is compared with about twice the root of the limits.
    width = int(len(limits) ** 0.5) + 1
    groups = [limits[i : i + width] for i in range(0, len(limits), width)] or [[]]
    kind = keys.schema[key].dataType.simpleString()

    def literal(values: list) -> str:
        return f"array({', '.join(f'CAST({v} AS {kind})' for v in values)})"

    column = quoted(key)
    coarse = f"size(filter({literal([g[0] for g in groups[1:]])}, x -> x <= {column}))"
    fine = f"array({', '.join(literal(g) for g in groups)})"
    # The limits of earlier groups are all passed.
    slot = F.expr(
        f"{coarse} * {width} + size(filter(element_at({fine}, {coarse} + 1), x -> x <= {column}))"
    )
    return frame.repartitionById(parts, F.coalesce(slot, F.lit(0))).sortWithinPartitions(name)


def dense_key(
    frame: DataFrame,
    order: list[str],
    name: str,
    staging: Staging,
    start: int | Callable[[int], int] = 0,
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` along ``order``, which must be unique.

    ``start`` may be a function that is told how many rows there are, such as ``KeyReservation``.

    A global ``row_number`` pulls every row through one task.  Here rows are range
    partitioned and sorted, each takes its slot (partition, position), and a partition's
    offset is the number of rows in the partitions before it: one shuffle, no global window.
    The slots are written before they are used, since the sampled range bounds may differ in
    a second evaluation.  The offsets are one row per range partition, hence the broadcast.
    """
    along = [F.col(quoted(c)) for c in order]
    slots = (
        frame.repartitionByRange(*along)
        .sortWithinPartitions(*along)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    if callable(start):
        placed, seen = staging.measured_table(slots, n="count(*)")
        start = start(seen["n"] or 0)
    else:
        placed = staging.table(slots)
    part = F.shiftrightunsigned(_SLOT, _POSITION_BITS)
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias(_PART)).agg((F.max(position) + 1).alias("size"))
    # Written, so that the slots are counted once however often the result is read.
    offsets = staging.table(
        sizes.select(_PART, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    return (
        placed.withColumn(_PART, part)
        .join(F.broadcast(offsets), _PART)
        .withColumn(name, (F.lit(start) + F.col("offset") + position + 1).cast("bigint"))
        .select(*map(quoted, frame.columns), quoted(name))
    )
