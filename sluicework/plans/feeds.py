"""The two feeds, shaped from the test tables with integer arithmetic only.

``events`` becomes the plays feed, ``orders`` with ``customer`` and ``nation`` the users feed.  The
shaping rules plant every kind of bad row: duplicates, null and malformed text, late rows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.contracts import DAY, PLAYS, USERS

# The test tables hold timestamps without a zone and bigint ids.
_TYPES = {"int": "bigint", "timestamp": "timestamp_ntz"}
EVENT_PLAYS = PLAYS.with_types(_TYPES)
CUSTOMER_USERS = USERS.with_types(_TYPES)

# Days of the users snapshots; the last one is after every order.
SNAPSHOTS = ("1995-06-30", "1997-12-31", "2001-12-31")
# Last day of the first plays load; the second load is everything after it.
FIRST_LOAD_UNTIL = "2024-01-15"


@lru_cache
def _stored_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    # Known schema: no footer job per read.
    return spark.read.schema(_stored_schema(spark, path)).parquet(path)


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as bronze plays, plus ``event_id`` and ``event_type``."""
    recorded = "ts + make_dt_interval(IF(event_id % 29 = 0, 1, 0))"
    return (
        table(spark, sf_dir, "events")
        .withColumn("recorded", F.expr(recorded))
        .selectExpr(
            "event_id",
            "event_type",
            "CAST(IF(event_id % 41 = 0 AND event_id > 0, event_id - 1, event_id) AS string)"
            " AS play_id",
            "CASE WHEN event_id % 53 <> 0 THEN CAST(user_id AS string) END AS user_id",
            "regexp_extract(props, '([0-9]+)', 1) AS content_id",
            "CAST(event_id % 5 + 1 AS string) AS device_id",
            "IF(event_id % 97 = 0, '03/01/2026', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"))"
            " AS played_at",
            "date_format(recorded, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS created_at",
            "CASE WHEN event_id % 61 = 0 THEN 'NaN' WHEN event_id % 67 = 0 THEN '-5000'"
            " ELSE CAST(event_id * 37 % 300000 + 1000 AS string) END AS ms_played",
            "CAST(date_add(CAST(recorded AS date), 1) AS timestamp_ntz) AS ingested_at",
            "concat('f', event_id % 4) AS source_file",
            f"CAST(recorded AS date) AS {DAY}",
        )
    )


def plays_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events in two loads."""
    raw = raw_plays(spark, sf_dir)
    first = F.col(DAY) <= F.lit(FIRST_LOAD_UNTIL).cast("date")
    return raw.where(first), raw.where(~first)


def corrected_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load again: negative durations put right, ``error`` events taken back."""
    first, _ = plays_loads(spark, sf_dir)
    return first.where("event_type <> 'error'").withColumn(
        "ms_played", F.expr("replace(ms_played, '-', '')")
    )


def raw_users(spark: SparkSession, sf_dir: str, snapshot: str) -> DataFrame:
    """The users known on a day: all customers, tier from the latest order until then.

    A customer without an order until then has neither tier nor creation time, which the rules
    refuse.  Every 31st customer is in the drop twice, the older copy with another tier.
    """
    until = F.lit(snapshot).cast("timestamp_ntz")
    history = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderdate") <= until)
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").alias("first"),
            F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("latest"),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("copy", F.expr("explode(IF(c_custkey % 31 = 0, array(0, 1), array(1)))"))
        .selectExpr(
            "concat(IF(c_custkey % 97 = 0, 'u-', ''), c_custkey) AS user_id",
            "CASE WHEN c_custkey % 89 <> 0"
            " THEN concat(lower(replace(c_name, '#', '.')), '@example.org') END AS email",
            "n_name AS country",
            "IF(copy = 0 AND first IS NOT NULL, 'trial', lower(latest.o_orderpriority))"
            " AS plan_tier",
            "date_format(first, \"yyyy-MM-dd'T'HH:mm:ss\") AS created_at",
            "CASE WHEN c_custkey % 101 = 0 THEN 'n/a' WHEN latest.o_orderdate > first"
            " THEN date_format(latest.o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") END AS updated_at",
            f"CAST('{snapshot} 10:00:00' AS timestamp_ntz) AS ingested_at",
            "concat('users_', copy) AS source_file",
            f"CAST('{snapshot}' AS date) AS {DAY}",
        )
    )


def _json_line(names: list[str]) -> str:
    parts = [f"'\"{name}\":', coalesce(concat('\"', {name}, '\"'), 'null')" for name in names]
    return f"concat('{{', {', \',\', '.join(parts)}, '}}')"


def play_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as JSON lines with their day; every 47th line is cut short."""
    return (
        raw_plays(spark, sf_dir)
        .withColumn("line", F.expr(_json_line(EVENT_PLAYS.raw_names)))
        .selectExpr(
            "event_id",
            "event_type",
            "IF(event_id % 47 = 0, substring(line, 1, length(line) - 5), line) AS value",
            DAY,
        )
    )


def user_lines(spark: SparkSession, sf_dir: str, snapshot: str) -> DataFrame:
    """A users snapshot as JSON lines; the line of every 43rd customer is cut short."""
    names = CUSTOMER_USERS.raw_names
    number = "CAST(replace(user_id, 'u-', '') AS bigint)"
    return (
        raw_users(spark, sf_dir, snapshot)
        .withColumn("line", F.expr(_json_line(names)))
        .selectExpr(
            f"IF({number} % 43 = 0, substring(line, 1, length(line) - 5), line) AS value"
        )
    )
