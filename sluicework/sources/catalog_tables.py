"""Sinks on tables of the session catalog: replace days by ``INSERT OVERWRITE ... PARTITION``."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.contracts import DAY, TableContract
from sluicework.functions.columns import quoted
from sluicework.functions.metrics import observed
from sluicework.sources.readers import read_table
from sluicework.sources.settings import setting


def create_day_table(
    spark: SparkSession, table: str, schema: StructType, location: str | None = None
) -> None:
    """A Parquet table of this schema by day, unless there is one of this name.

    ``table`` is an identifier as SQL has it, with its database and quotes where it needs them.
    Without a location the catalog owns the files.
    """
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    where = ""
    if location:
        where = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
        f" PARTITIONED BY ({DAY}){where}"
    )


def insert_days(frame: DataFrame, table: str, days: Sequence[str]) -> dict[str, int]:
    """Make each of ``days`` of a catalog table hold exactly the rows of ``frame``; rows per day.

    All days that have rows are replaced by one statement, which may read the table itself.  It
    leaves days without a row as they are, so each of these is then cleared by an insert of no row
    into that one partition.  Columns are taken by name; the frame must not hold other days.
    """
    spark = frame.sparkSession
    target = spark.table(table).schema
    names = [quoted(f.name) for f in target if f.name != DAY]
    written = Observation()
    per_day = [F.count(F.when(F.col(DAY) == F.lit(d).cast("date"), True)).alias(d) for d in days]
    view = f"sluicework_{uuid.uuid4().hex}"
    counted = frame.observe(written, *per_day) if per_day else frame
    counted.createOrReplaceTempView(view)
    try:
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY})"
                f" SELECT {', '.join([*names, DAY])} FROM {view}"
            )
    finally:
        spark.catalog.dropTempView(view)
    counts = observed(written) if per_day else {}
    if counts is None:  # no word from the write: what the frame has decides
        of_day = frame.groupBy(F.col(DAY).cast("string").alias("day")).count()
        counts = {row["day"]: row["count"] for row in of_day.collect()}
    rows = {day: counts.get(day, 0) or 0 for day in days}
    for day in [d for d, count in rows.items() if count == 0]:
        _clear(spark, table, target, day)
    return rows


def _clear(spark: SparkSession, table: str, schema: StructType, day: str) -> None:
    nothing = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()})" for f in schema if f.name != DAY
    )
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY} = DATE'{day}')"
        f" SELECT {nothing} WHERE false"
    )


def publish_days(
    spark: SparkSession,
    contract: TableContract,
    path: str,
    table: str,
    days: Sequence[str] | None = None,
) -> dict[str, int]:
    """Make days of a catalog table what the curated table at ``path`` holds of them.

    The catalog table is made when there is none.  Without ``days`` it becomes the whole curated
    table: the days that either of them has are replaced.
    """
    create_day_table(spark, table, contract.table_schema)
    stored = read_table(spark, path, contract.table_schema)
    if days is None:
        # A row per day of the calendar at most.
        both = stored.select(DAY).union(spark.table(table).select(DAY)).distinct()
        days = sorted(str(row[DAY]) for row in both.collect())
        wanted = stored
    else:
        wanted = stored.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))
    return insert_days(wanted, table, days)
