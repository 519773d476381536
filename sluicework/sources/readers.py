"""Scans: JSON drops, bronze days, curated tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.contracts import CORRUPT, DAY, REASON, TableContract
from sluicework.functions.columns import quoted
from sluicework.sources import storage
from sluicework.sources.writers import stored_path


def scan_drop(
    spark: SparkSession,
    contract: TableContract,
    path: str,
    snapshot_date: str,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """The JSON lines under ``<path>/<snapshot_date>`` with provenance and the corrupt-line column.

    All business columns are text and unknown fields are dropped.  Numbers and objects become
    their text, blank lines vanish, a top-level array gives one row per element, and text after
    a complete object is ignored; a line is corrupt only when its JSON is broken.

    The arrival time is a constant of the run, so a second evaluation gives the same rows and
    nothing has to be cached for that.
    """
    drop = f"{path}/{snapshot_date}"
    spark.catalog.refreshByPath(drop)
    arrival = ingested_at or datetime.now()
    lines = (
        spark.read.schema(contract.drop_schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(drop)
    )
    # Spark refuses a JSON query that needs nothing but the corrupt-line column, as a plain count
    # of the quarantine would; so that column leans on another one.
    also = contract.raw_names[0]
    return lines.select(
        *contract.raw_names,
        F.lit(arrival).cast(contract.timestamp).alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(snapshot_date).cast("date").alias(DAY),
        F.expr(f"IF(length(concat_ws('', {also})) >= 0, {CORRUPT}, NULL)").alias(CORRUPT),
    )


def readable(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt(lines: DataFrame) -> DataFrame:
    """The quarantine of a drop; the reason is the broken line itself."""
    return lines.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, REASON)


# Whole and broken lines of one scan, side by side in one frame.
KIND = "_kind"
ROWS, BROKEN = "rows", "broken"


def kept_apart(contract: TableContract, lines: DataFrame) -> DataFrame:
    """All lines with their kind, in the columns of the table.

    A broken line has nothing in these but, as JSON in the first one, whatever was read of it and
    the line itself, so that both kinds are written at once and neither has a column of the other.
    """
    names = contract.raw_names
    first, is_broken = names[0], F.col(CORRUPT).isNotNull()
    told = F.to_json(F.struct(*map(quoted, names), F.col(CORRUPT).alias(REASON)))
    return lines.select(
        F.when(is_broken, told).otherwise(F.col(quoted(first))).alias(first),
        *map(quoted, names[1:]),
        "ingested_at",
        "source_file",
        F.when(is_broken, BROKEN).otherwise(ROWS).alias(KIND),
    )


def broken_lines(contract: TableContract, rows: DataFrame) -> DataFrame:
    """The quarantine's rows out of those ``kept_apart`` as broken."""
    names = contract.raw_names
    schema = StructType()
    for name in (*names, REASON):
        schema = schema.add(name, "string")
    told = F.from_json(F.col(quoted(names[0])), schema).alias("told")
    return rows.select(told, "ingested_at", "source_file").select(
        *[F.col("told")[name].alias(name) for name in names],
        "ingested_at",
        "source_file",
        F.col("told")[REASON].alias(REASON),
    )


def load_drop(
    spark: SparkSession,
    contract: TableContract,
    path: str,
    snapshot_date: str,
    ingested_at: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(readable rows, corrupt lines) of one drop."""
    lines = scan_drop(spark, contract, path, snapshot_date, ingested_at)
    return readable(lines), corrupt(lines)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table under an explicit schema; empty when nothing is stored yet."""
    if not storage.exists(spark, path):
        return storage.empty(spark, schema)
    return spark.read.schema(schema).parquet(stored_path(spark, path))


# Below a bronze table: an empty file for each day that was landed without a readable row.
EMPTY_DAYS = "_empty_days"


def mark_day(spark: SparkSession, path: str, snapshot_date: str, rows: int) -> None:
    """Note that a day was landed without a row, or take that note back."""
    mark = f"{path}/{EMPTY_DAYS}/{snapshot_date}"
    if rows:
        storage.delete(spark, mark)
    else:
        storage.touch(spark, mark)


def read_day(
    spark: SparkSession, contract: TableContract, path: str, snapshot_date: str
) -> DataFrame:
    """One day of a bronze table; other days are pruned by partition.

    A day that was landed empty has no rows.  A day that is neither stored nor marked as empty
    was not landed, or is gone, and raises.
    """
    places = (f"{DAY}={snapshot_date}", f"{EMPTY_DAYS}/{snapshot_date}")
    if not any(storage.exists(spark, f"{path}/{place}") for place in places):
        raise FileNotFoundError(f"{path} has no landed day {snapshot_date}")
    bronze = spark.read.schema(contract.bronze_schema).parquet(path)
    return bronze.where(F.col(DAY) == F.lit(snapshot_date).cast("date"))


def _ordering(order_by: str) -> Column:
    return F.desc(order_by[1:]) if order_by.startswith("-") else F.asc(order_by)


def inspect(
    spark: SparkSession,
    path: str,
    snapshot_date: str | None = None,
    order_by: str = "played_at",
    limit: int | None = 20,
) -> DataFrame:
    """First rows of a stored table: one day or all, along one column (``-`` for descending)."""
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    table = spark.read.parquet(stored_path(spark, path))
    if snapshot_date:
        table = table.where(F.col(DAY) == F.lit(snapshot_date).cast("date"))
    if order_by:
        table = table.orderBy(_ordering(order_by))
    return table if limit is None else table.limit(limit)
