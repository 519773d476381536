"""Named queries: each operator over the whole test tables, and its SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.contracts import DAY, REASON, STAGE, TableContract
from sluicework.operators.dimension import History, merge_history
from sluicework.operators.facts import FactLoad, upsert_facts
from sluicework.operators.keys import dense_key, highest_stored_key
from sluicework.operators.quality import (
    Gated,
    cast_typed,
    classify,
    deduplicate,
    newest,
    quality_gate,
    validate,
)
from sluicework.plans import feeds, oracle
from sluicework.plans.feeds import CUSTOMER_USERS, EVENT_PLAYS, SNAPSHOTS
from sluicework.plans.jobs import run_bronze, run_silver, stored_keys
from sluicework.sources.catalog_tables import create_day_table, insert_days, publish_days
from sluicework.sources.readers import inspect, read_day, read_table
from sluicework.sources import storage
from sluicework.sources.storage import Staging, empty
from sluicework.sources.writers import replace_days, replace_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# Drops of the end-to-end runs: every event and every order is in one of them.
PLAY_DROPS = ("2024-01-16", "2024-01-31")
TWO_DAYS = (SNAPSHOTS[0], SNAPSHOTS[2])
LINE_ITEM_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        name = query.__name__
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(EVENT_PLAYS, feeds.raw_plays(spark, sf_dir))


def _gate_all(contract: TableContract, raws: list[DataFrame], staging: Staging) -> list[Gated]:
    """Each load through the gate.  Loads do not depend on each other there, so they overlap."""

    def gate(raw: DataFrame) -> Gated:
        return quality_gate(contract, classify(contract, raw), staging)

    with ThreadPoolExecutor(len(raws)) as pool:
        return list(pool.map(gate, raws))


def _gate_users(
    spark: SparkSession, sf_dir: str, days: tuple[str, ...], staging: Staging
) -> list[Gated]:
    raws = {day: feeds.raw_users(spark, sf_dir, day) for day in days}
    gated = _gate_all(CUSTOMER_USERS, list(raws.values()), staging)
    by_day = dict(zip(raws, gated, strict=True))
    return [by_day[day] for day in days]


# Casts and rules


@_query(
    f"WITH {oracle.RAW_PLAYS},{oracle.typed_plays('raw_plays', 'typed')}"
    f" SELECT {oracle.PLAY_COLUMNS} FROM typed WHERE cast_reason = ''"
)
def q_cast_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_typed(EVENT_PLAYS, feeds.raw_plays(spark, sf_dir))[0]


@_query(
    f"WITH {oracle.RAW_PLAYS},{oracle.typed_plays('raw_plays', 'typed')}"
    f" SELECT {oracle.PLAY_COLUMNS}, cast_reason AS error_reason"
    " FROM typed WHERE cast_reason <> ''"
)
def q_cast_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_typed(EVENT_PLAYS, feeds.raw_plays(spark, sf_dir))[1]


@_query(f"{oracle.PLAYS} SELECT {oracle.PLAY_COLUMNS} FROM plays_judged WHERE rule_reason = ''")
def q_validate_plays_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(EVENT_PLAYS, cast_typed(EVENT_PLAYS, feeds.raw_plays(spark, sf_dir))[0])[0]


@_query(
    f"{oracle.PLAYS} SELECT {oracle.PLAY_COLUMNS}, rule_reason AS error_reason"
    " FROM plays_judged WHERE rule_reason <> ''"
)
def q_validate_plays_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(EVENT_PLAYS, cast_typed(EVENT_PLAYS, feeds.raw_plays(spark, sf_dir))[0])[1]


def _typed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_typed(CUSTOMER_USERS, feeds.raw_users(spark, sf_dir, SNAPSHOTS[-1]))[0]


@_query(f"{oracle.USERS} SELECT {oracle.USER_COLUMNS} FROM users3_judged WHERE rule_reason = ''")
def q_validate_users_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(CUSTOMER_USERS, _typed_users(spark, sf_dir))[0]


@_query(
    f"{oracle.USERS} SELECT {oracle.USER_COLUMNS}, rule_reason AS error_reason"
    " FROM users3_judged WHERE rule_reason <> ''"
)
def q_validate_users_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(CUSTOMER_USERS, _typed_users(spark, sf_dir))[1]


@_query(
    f"{oracle.PLAYS} SELECT {oracle.PLAY_COLUMNS} FROM plays_judged"
    " WHERE rule_reason = '' AND late_arriving_data"
)
def q_late_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _plays(spark, sf_dir)
    return rows.where(f"{STAGE} IS NULL AND late_arriving_data").drop(REASON, STAGE)


# De-duplication


def _clean_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plays(spark, sf_dir).where(f"{STAGE} IS NULL").drop(REASON, STAGE)


@_query(f"{oracle.PLAYS} SELECT * FROM plays")
def q_dedup_plays_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(_clean_plays(spark, sf_dir), "play_id", EVENT_PLAYS.newest_first)


@_query(f"{oracle.PLAYS} SELECT {oracle.PLAY_COLUMNS} FROM plays_ranked WHERE nth > 1")
def q_dedup_plays_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean_plays(spark, sf_dir)
    return deduplicate(clean, "play_id", EVENT_PLAYS.newest_first, Staging(spark)).duplicates


def _clean_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify(CUSTOMER_USERS, feeds.raw_users(spark, sf_dir, SNAPSHOTS[-1]))
    return rows.where(f"{STAGE} IS NULL").drop(REASON, STAGE)


@_query(f"{oracle.USERS} SELECT * FROM users3")
def q_dedup_users_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(_clean_users(spark, sf_dir), "user_id", CUSTOMER_USERS.newest_first)


@_query(f"{oracle.USERS} SELECT {oracle.USER_COLUMNS} FROM users3_ranked WHERE nth > 1")
def q_dedup_users_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean_users(spark, sf_dir)
    return deduplicate(clean, "user_id", CUSTOMER_USERS.newest_first, Staging(spark)).duplicates


_LINE_ORDER = ", ".join(f"{c} DESC" for c in LINE_ITEM_COLUMNS if c != "l_shipdate")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.table(spark, sf_dir, "lineitem").withColumn(
        "line_id", F.expr("l_orderkey * 10 + l_linenumber")
    )


_NEWEST_LINE = ["l_shipdate", *[c for c in LINE_ITEM_COLUMNS if c != "l_shipdate"]]


def _ranked_lines(test: str) -> str:
    return f"""SELECT * EXCLUDE (nth) FROM (
      SELECT *, l_orderkey * 10 + l_linenumber AS line_id, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_LINE_ORDER}) AS nth
      FROM lineitem) WHERE nth {test}"""


@_query(_ranked_lines("= 1"))
def q_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(_lines(spark, sf_dir), "line_id", _NEWEST_LINE)


@_query(_ranked_lines("> 1"))
def q_dedup_lineitem_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return deduplicate(lines, "line_id", _NEWEST_LINE, Staging(spark)).duplicates


# The whole gate


@_query(f"{oracle.PLAYS} {oracle.play_errors('plays')}")
def q_plays_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate_all(EVENT_PLAYS, [feeds.raw_plays(spark, sf_dir)], Staging(spark))[0].rejected


@_query(f"{oracle.USERS} {oracle.user_errors('users3')}")
def q_users_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate_users(spark, sf_dir, SNAPSHOTS[-1:], Staging(spark))[0].rejected


# Facts


def _no_facts(spark: SparkSession) -> DataFrame:
    return empty(spark, EVENT_PLAYS.table_schema)


def _load(current: DataFrame, gated: Gated, staging: Staging, **options) -> FactLoad:
    return upsert_facts(
        EVENT_PLAYS,
        current,
        gated.accepted,
        staging,
        loaded_keys=gated.keys,
        key_range=gated.key_range,
        **options,
    )


def _first_load(raw: DataFrame, staging: Staging) -> DataFrame:
    gated = _gate_all(EVENT_PLAYS, [raw], staging)[0]
    return _load(_no_facts(raw.sparkSession), gated, staging, highest=0).rows


def _next_load(
    spark: SparkSession, gates: list[Gated], staging: Staging
) -> tuple[DataFrame, FactLoad]:
    stored = staging.table(_load(_no_facts(spark), gates[0], staging, highest=0).rows)
    return stored, _load(stored, gates[1], staging)


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FactLoad]:
    staging = Staging(spark)
    gates = _gate_all(EVENT_PLAYS, list(feeds.plays_loads(spark, sf_dir)), staging)
    return _next_load(spark, gates, staging)


def _redropped(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    staging = Staging(spark)
    raws = [*feeds.plays_loads(spark, sf_dir), feeds.corrected_first_load(spark, sf_dir)]
    gates = _gate_all(EVENT_PLAYS, raws, staging)
    first, second = _next_load(spark, gates, staging)
    stored = staging.table(first.unionByName(second.rows))
    load = _load(stored, gates[2], staging, **options)
    untouched = stored.where(F.col(DAY) > F.lit(feeds.FIRST_LOAD_UNTIL).cast("date"))
    return load.rows.unionByName(untouched)


@_query(f"{oracle.STORED_PLAYS} SELECT * FROM stored")
def q_silver_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_load(feeds.raw_plays(spark, sf_dir), Staging(spark))


@_query(f"{oracle.STORED_PLAYS} SELECT * FROM stored")
def q_facts_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert on its own, with nothing known beforehand."""
    staging = Staging(spark)
    gated = _gate_all(EVENT_PLAYS, [feeds.raw_plays(spark, sf_dir)], staging)[0]
    return upsert_facts(EVENT_PLAYS, _no_facts(spark), gated.accepted, staging).rows


@_query(f"{oracle.FACTS} SELECT * FROM both_rows")
def q_facts_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _two_loads(spark, sf_dir)
    return first.unionByName(second.rows)


@_query(
    f"{oracle.FACTS} SELECT l.play_id, l.snapshot_date, c.snapshot_date AS held_by"
    " FROM next_load l JOIN first_rows c ON c.play_id = l.play_id"
    " WHERE c.snapshot_date <> l.snapshot_date"
)
def q_facts_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir)[1].elsewhere


@_query(f"{oracle.FACTS} SELECT * FROM redropped")
def q_facts_redrop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redropped(spark, sf_dir)


@_query(
    f"{oracle.FACTS} SELECT * FROM redropped UNION ALL SELECT * FROM first_rows"
    " WHERE play_id NOT IN (SELECT play_id FROM again_load)"
)
def q_facts_retain_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redropped(spark, sf_dir, retain_missing=True)


def _bucketed_load(
    spark: SparkSession, folder: str, gated: Gated, staging: Staging, days: list[str]
) -> FactLoad:
    """One load into the stored table below ``folder``, whose keys are met in their buckets."""
    path = f"{folder}/plays"
    with stored_keys(spark, EVENT_PLAYS, folder) as copy:
        copy.sync()
        current = read_table(spark, path, EVENT_PLAYS.table_schema)
        load = _load(current, gated, staging, stored_keys=copy.frame())
        replace_days(load.rows.hint("rebalance", DAY), path, days)
        copy.sync()
    return load


def _days_of(gated: Gated) -> list[str]:
    return [str(row[DAY]) for row in gated.keys.select(DAY).distinct().collect()]


def _bucketed_redrop(spark: SparkSession, sf_dir: str) -> str:
    """Two loads and the first one again, corrected, each through the bucketed keys."""
    staging = Staging(spark)
    raws = [*feeds.plays_loads(spark, sf_dir), feeds.corrected_first_load(spark, sf_dir)]
    gates = _gate_all(EVENT_PLAYS, raws, staging)
    folder = staging.folder()
    for gated in gates:
        _bucketed_load(spark, folder, gated, staging, _days_of(gated))
    return folder


@_query(f"{oracle.FACTS} SELECT * FROM redropped")
def q_facts_redrop_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_bucketed_redrop(spark, sf_dir)}/plays"
    return read_table(spark, path, EVENT_PLAYS.table_schema)


@_query(f"{oracle.FACTS} SELECT play_id, play_sk, snapshot_date FROM redropped")
def q_stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bucketed copy beside the table holds after three loads."""
    copy = stored_keys(spark, EVENT_PLAYS, _bucketed_redrop(spark, sf_dir))
    copy.sync()  # nothing is copied; the catalog's table stays as long as the result is read
    return copy.frame()


_LINE_KEYS = ", ".join(LINE_ITEM_COLUMNS)


@_query(f"SELECT *, row_number() OVER (ORDER BY {_LINE_KEYS}) AS line_sk FROM lineitem")
def q_dense_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem")
    return dense_key(lines, list(LINE_ITEM_COLUMNS), "line_sk", Staging(spark))


# The dimension


def _history(
    spark: SparkSession, sf_dir: str, days: tuple[str, ...], staging: Staging, **options
) -> History:
    """Merge the snapshots of some days in the given order."""
    current = empty(spark, CUSTOMER_USERS.table_schema)
    merged, highest = None, 0
    for gated in _gate_users(spark, sf_dir, days, staging):
        if merged is not None:
            current, top = staging.measured_table(merged.rows, key="max(customer_sk)")
            highest = top["key"] or 0
        merged = merge_history(
            CUSTOMER_USERS, current, gated.accepted, staging, highest=highest, **options
        )
    return merged


@_query(f"{oracle.FIRST_HISTORY} SELECT * FROM dim")
def q_scd2_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, SNAPSHOTS[-1:], Staging(spark)).rows


@_query(f"{oracle.TWO_DAYS} SELECT * FROM dim")
def q_scd2_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, TWO_DAYS, Staging(spark)).rows


@_query(f"{oracle.HISTORY} SELECT * FROM dim3")
def q_scd2_day3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, SNAPSHOTS, Staging(spark)).rows


@_query(f"{oracle.HISTORY} SELECT * FROM dim3")
def q_scd2_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, (*SNAPSHOTS, SNAPSHOTS[-1]), Staging(spark)).rows


@_query(f"{oracle.HISTORY} SELECT * FROM dim3 WHERE is_current")
def q_scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, SNAPSHOTS, Staging(spark)).rows.where("is_current")


_LATE_DAYS = (SNAPSHOTS[0], SNAPSHOTS[2], SNAPSHOTS[1])


@_query(f"{oracle.LATE_HISTORY} SELECT * FROM back")
def q_scd2_older_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, _LATE_DAYS, Staging(spark)).rows


@_query(
    f"{oracle.LATE_HISTORY} SELECT {oracle.USER_COLUMNS}, 'out_of_order' AS error_reason,"
    " 'out_of_order' AS error_stage FROM back_new WHERE closes AND valid_from <= since"
)
def q_scd2_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, _LATE_DAYS, Staging(spark), order_guard=True).rejected


@_query(
    f"{oracle.HISTORY} SELECT user_id, email, country, plan_tier, valid_from, snapshot_date"
    " FROM dim3 WHERE is_current"
)
def q_active_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots, each compared with the active rows in their buckets; then these rows."""
    staging = Staging(spark)
    folder = staging.folder()
    path = f"{folder}/users"
    copy = stored_keys(spark, CUSTOMER_USERS, folder)
    for gated in _gate_users(spark, sf_dir, SNAPSHOTS, staging):
        copy.sync()
        current = read_table(spark, path, CUSTOMER_USERS.table_schema)
        merged = merge_history(
            CUSTOMER_USERS, current, gated.accepted, staging, stored_active=copy.frame()
        )
        replace_days(merged.arranged(), path, list(SNAPSHOTS))
    copy.sync()
    return copy.frame()


# Bronze: JSON drops and their quarantine


def _drop(lines: DataFrame, folder: str) -> None:
    lines.select("value").write.text(folder)


def _bronze_plays(spark: SparkSession, sf_dir: str) -> str:
    """All events landed as one drop; returns the bronze folder."""
    staging = Staging(spark)
    source, bronze = staging.folder(), staging.folder()
    _drop(feeds.play_lines(spark, sf_dir), f"{source}/{PLAY_DROPS[-1]}")
    run_bronze(spark, EVENT_PLAYS, source, PLAY_DROPS[-1], bronze)
    return bronze


@_query(
    f"{oracle.LINES} SELECT play_id, user_id, content_id, device_id, played_at, created_at,"
    f" ms_played, DATE '{PLAY_DROPS[-1]}' AS snapshot_date FROM play_lines"
    " WHERE event_id % 47 <> 0"
)
def q_bronze_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_bronze_plays(spark, sf_dir)}/plays"
    return read_table(spark, path, EVENT_PLAYS.bronze_schema).drop("ingested_at", "source_file")


@_query(
    f"{oracle.LINES} SELECT substring(line, 1, length(line) - 5) AS error_reason,"
    f" DATE '{PLAY_DROPS[-1]}' AS snapshot_date FROM play_lines WHERE event_id % 47 = 0"
)
def q_bronze_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_bronze_plays(spark, sf_dir)}/plays_errors"
    return spark.read.parquet(path).select(REASON, DAY)


# Sinks


def _stored_plays(spark: SparkSession, sf_dir: str) -> str:
    """All accepted plays as a stored table; returns its path."""
    staging = Staging(spark)
    path = staging.folder()
    gated = _gate_all(EVENT_PLAYS, [feeds.raw_plays(spark, sf_dir)], staging)[0]
    rows = _load(_no_facts(spark), gated, staging, highest=0).rows
    days = gated.keys.select(DAY).distinct().collect()
    replace_days(rows.hint("rebalance", DAY), path, [str(row[DAY]) for row in days])
    return path


def _replaced_day(spark: SparkSession, sf_dir: str, rows_of_day: str) -> DataFrame:
    """Replace a day of a stored table by some of its own rows, then read the table."""
    path, day = _stored_plays(spark, sf_dir), feeds.FIRST_LOAD_UNTIL
    stored = read_table(spark, path, EVENT_PLAYS.table_schema)
    same_day = stored.where(F.col(DAY) == F.lit(day).cast("date"))
    replace_days(same_day.where(rows_of_day), path, [day])
    return read_table(spark, path, EVENT_PLAYS.table_schema)


_ONE_DAY = f"DATE '{feeds.FIRST_LOAD_UNTIL}'"


@_query(
    f"{oracle.STORED_PLAYS} SELECT * FROM stored"
    f" WHERE snapshot_date <> {_ONE_DAY} OR NOT late_arriving_data"
)
def q_day_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced_day(spark, sf_dir, "NOT late_arriving_data")


@_query(f"{oracle.STORED_PLAYS} SELECT * FROM stored WHERE snapshot_date <> {_ONE_DAY}")
def q_day_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced_day(spark, sf_dir, "ms_played <= 0")


def _catalog_table(spark: SparkSession, folder: str) -> str:
    """An empty plays table of the session catalog; returns its name."""
    name = f"sluicework_{uuid.uuid4().hex}"
    create_day_table(spark, name, EVENT_PLAYS.table_schema, folder)
    return name


def _inserted_day(spark: SparkSession, sf_dir: str, rows_of_day: str) -> DataFrame:
    """As ``_replaced_day``, on a table of the session catalog."""
    table, day = _catalog_table(spark, Staging(spark).folder()), feeds.FIRST_LOAD_UNTIL
    publish_days(spark, EVENT_PLAYS, _stored_plays(spark, sf_dir), table)
    same_day = spark.table(table).where(F.col(DAY) == F.lit(day).cast("date"))
    insert_days(same_day.where(rows_of_day), table, [day])
    return spark.table(table)


@_query(
    f"{oracle.STORED_PLAYS} SELECT * FROM stored"
    f" WHERE snapshot_date <> {_ONE_DAY} OR NOT late_arriving_data"
)
def q_catalog_day_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inserted_day(spark, sf_dir, "NOT late_arriving_data")


@_query(f"{oracle.STORED_PLAYS} SELECT * FROM stored WHERE snapshot_date <> {_ONE_DAY}")
def q_catalog_day_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inserted_day(spark, sf_dir, "ms_played <= 0")


@_query(f"{oracle.TWO_DAYS} SELECT * FROM dim")
def q_dimension_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    path = staging.folder()
    for gated in _gate_users(spark, sf_dir, TWO_DAYS, staging):
        current = read_table(spark, path, CUSTOMER_USERS.table_schema)
        merged = merge_history(CUSTOMER_USERS, current, gated.accepted, staging)
        replace_table(merged.arranged(), path)
    return read_table(spark, path, CUSTOMER_USERS.table_schema)


@_query(f"{oracle.STORED_PLAYS} SELECT DISTINCT snapshot_date FROM stored")
def q_snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_plays(spark, sf_dir)
    return read_table(spark, path, EVENT_PLAYS.table_schema).select(DAY).distinct()


@_query(f"{oracle.STORED_PLAYS} SELECT max(play_sk) AS max_sk FROM stored")
def q_max_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_plays(spark, sf_dir)
    stored = read_table(spark, path, EVENT_PLAYS.table_schema)
    top = highest_stored_key(spark, path, EVENT_PLAYS.table_schema, "play_sk")
    # The rows that bear the key the footers told.
    return stored.where(F.col("play_sk") == top).select(F.col("play_sk").alias("max_sk"))


@_query(
    f"{oracle.STORED_PLAYS} SELECT * FROM stored WHERE snapshot_date = {_ONE_DAY}"
    " ORDER BY play_id DESC LIMIT 20"
)
def q_inspect_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_plays(spark, sf_dir)
    return inspect(spark, path, feeds.FIRST_LOAD_UNTIL, order_by="-play_id", limit=20)


# Drop to curated table, with the jobs a user runs


class Landing:
    """Drops of the plays feed through both layers, below one staging folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        staging = Staging(spark)
        self.spark, self.lines = spark, feeds.play_lines(spark, sf_dir)
        self.source, self.bronze, self.silver = (staging.folder() for _ in range(3))
        self.reports: list[tuple] = []

    def lines_of(self, day: str) -> DataFrame:
        first = F.col(DAY) <= F.lit(PLAY_DROPS[0]).cast("date")
        return self.lines.where(first if day == PLAY_DROPS[0] else ~first)

    def load(self, day: str, lines: DataFrame, **options) -> None:
        storage.delete(self.spark, f"{self.source}/{day}")
        _drop(lines, f"{self.source}/{day}")
        run_bronze(self.spark, EVENT_PLAYS, self.source, day, self.bronze)
        report = run_silver(
            self.spark, EVENT_PLAYS, f"{self.bronze}/plays", day, self.silver, **options
        )
        self.reports.append((day, report["rows"], report["rejected"], report["elsewhere"]))

    def load_both(self) -> Landing:
        for day in PLAY_DROPS:
            self.load(day, self.lines_of(day))
        return self

    def table(self) -> DataFrame:
        path = f"{self.silver}/plays"
        return read_table(self.spark, path, EVENT_PLAYS.table_schema).drop(*_PROVENANCE)

    def errors(self) -> DataFrame:
        path = f"{self.silver}/plays_errors"
        return read_table(self.spark, path, EVENT_PLAYS.error_schema).drop(*_PROVENANCE)


def _drop_cte(drop: str, out: str) -> str:
    """What a drop has after bronze: its whole lines, under the day of the drop."""
    side = "<=" if drop == PLAY_DROPS[0] else ">"
    return (
        f"{out} AS (SELECT * REPLACE (DATE '{drop}' AS snapshot_date,"
        " TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'drop' AS source_file)"
        f" FROM raw_plays WHERE event_id % 47 <> 0"
        f" AND snapshot_date {side} DATE '{PLAY_DROPS[0]}')"
    )


_LANDED = (
    f"WITH {oracle.RAW_PLAYS},{_drop_cte(PLAY_DROPS[0], 'drop1')},"
    f"{_drop_cte(PLAY_DROPS[1], 'drop2')},{oracle.typed_plays('raw_plays', 'typed_once')},"
    f"{oracle.NO_FACTS},{oracle.gated_plays('drop1', 'load1')},"
    f"{oracle.gated_plays('drop2', 'load2')},{oracle.upserted('no_facts', 'load1', 'rows1')},"
    f"{oracle.upserted('rows1', 'load2', 'rows2')}"
)
_PROVENANCE = ("bronze_ingested_at", "source_file")
_NO_PROVENANCE = f"EXCLUDE ({', '.join(_PROVENANCE)})"


_BOTH_DROPS = (
    f"{_LANDED} SELECT * {_NO_PROVENANCE} FROM rows1"
    f" UNION ALL SELECT * {_NO_PROVENANCE} FROM rows2"
)
# Accepted rows of the second drop whose key the first drop's day holds.
_HELD = (
    f"SELECT l.* {_NO_PROVENANCE}, 'play_id_held_by_' || strftime(c.snapshot_date, '%Y-%m-%d')"
    " AS error_reason, 'held_elsewhere' AS error_stage"
    " FROM load2 l JOIN rows1 c ON c.play_id = l.play_id"
)


@_query(_BOTH_DROPS)
def q_landed_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Landing(spark, sf_dir).load_both().table()


@_query(
    f"{_LANDED} SELECT * {_NO_PROVENANCE} FROM ({oracle.play_errors('load1')}"
    f" UNION ALL {oracle.play_errors('load2')}) UNION ALL {_HELD}"
)
def q_landed_plays_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Landing(spark, sf_dir).load_both().errors()


@_query(f"{_LANDED} {_HELD}")
def q_landed_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left out of a day because another one holds their key, from the quarantine."""
    return Landing(spark, sf_dir).load_both().errors().where(f"{STAGE} = 'held_elsewhere'")


_THIRD_DROP = "2024-02-15"
_HELD_AGAIN = (
    f"{_LANDED}, drop3 AS (SELECT * REPLACE (DATE '{_THIRD_DROP}' AS snapshot_date,"
    " TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'drop' AS source_file)"
    " FROM raw_plays WHERE event_id % 47 <> 0 AND event_id % 6 = 0),"
    f"{oracle.gated_plays('drop3', 'load3')},"
    " held AS (SELECT * FROM rows1 UNION ALL SELECT * FROM rows2)"
)


@_query(
    f"{_HELD_AGAIN} SELECT l.* {_NO_PROVENANCE}, 'play_id_held_by_'"
    " || strftime(c.snapshot_date, '%Y-%m-%d') AS error_reason, 'held_elsewhere' AS error_stage"
    " FROM load3 l JOIN held c ON c.play_id = l.play_id"
)
def q_landed_held_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third drop sends every sixth event of both drops again: their days hold the keys."""
    landing = Landing(spark, sf_dir).load_both()
    landing.load(_THIRD_DROP, landing.lines.where("event_id % 6 = 0"))
    return landing.errors().where(f"{STAGE} = 'held_elsewhere'")


def _report_sql(drop: str, load: str, rows: str, raw: str) -> str:
    return (
        f"SELECT '{drop}' AS drop_day, (SELECT count(*) FROM {rows}) AS n_rows,"
        f" (SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {load}) AS n_rejected,"
        f" (SELECT count(*) FROM {load}) - (SELECT count(*) FROM {rows}) AS n_elsewhere"
    )


@_query(
    f"{_LANDED} {_report_sql(PLAY_DROPS[0], 'load1', 'rows1', 'drop1')}"
    f" UNION ALL {_report_sql(PLAY_DROPS[1], 'load2', 'rows2', 'drop2')}"
)
def q_job_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the jobs say they did, a row per drop."""
    reports = Landing(spark, sf_dir).load_both().reports
    names = "drop_day string, n_rows bigint, n_rejected bigint, n_elsewhere bigint"
    return spark.createDataFrame(reports, names)


@_query(_BOTH_DROPS)
def q_landed_retain_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first drop again with no row that obeys the rules: what is stored stays."""
    landing = Landing(spark, sf_dir).load_both()
    refused = landing.lines_of(PLAY_DROPS[0]).withColumn(
        "value", F.regexp_replace("value", '"ms_played":"[^"]*"', '"ms_played":"-1"')
    )
    landing.load(PLAY_DROPS[0], refused, retain_missing=True)
    return landing.table()


@_query(f"{_LANDED} SELECT * {_NO_PROVENANCE} FROM rows2")
def q_landed_all_corrupt_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first drop again with broken lines only: its day is cleared."""
    landing = Landing(spark, sf_dir).load_both()
    broken = landing.lines_of(PLAY_DROPS[0]).withColumn("value", F.expr("substring(value, 1, 9)"))
    landing.load(PLAY_DROPS[0], broken)
    return landing.table()


@_query(f"{_LANDED} SELECT * {_NO_PROVENANCE} FROM rows2")
def q_published_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both drops, and the first again with broken lines only, as a catalog table follows them."""
    landing = Landing(spark, sf_dir)
    table = _catalog_table(spark, Staging(spark).folder())
    for day in PLAY_DROPS:
        landing.load(day, landing.lines_of(day), publish=table)
    broken = landing.lines_of(PLAY_DROPS[0]).withColumn("value", F.expr("substring(value, 1, 9)"))
    landing.load(PLAY_DROPS[0], broken, publish=table)
    return spark.table(table).drop(*_PROVENANCE)


# Both events of a repeated key are in one half.
_HALF = "CAST(floor((event_id + 1) / 41) AS bigint) % 2"
_HALVES = f"WITH {oracle.RAW_PLAYS}," + ",".join(
    f"half{n} AS (SELECT * REPLACE (DATE '{day}' AS snapshot_date,"
    " TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'drop' AS source_file)"
    f" FROM raw_plays WHERE event_id % 47 <> 0 AND {_HALF} = {n}),"
    + oracle.gated_plays(f"half{n}", f"load{n}")
    for n, day in enumerate(PLAY_DROPS)
)


@_query(
    f"{_HALVES} SELECT snapshot_date, count(*) AS n_rows, count(*) AS n_keys, count(*) AS key_span"
    " FROM (SELECT * FROM load0 UNION ALL SELECT * FROM load1) GROUP BY ROLLUP (snapshot_date)"
)
def q_loads_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops loaded at once: each has a dense run of surrogates, and so has the table."""
    landing = Landing(spark, sf_dir)
    for n, day in enumerate(PLAY_DROPS):
        _drop(landing.lines.where(f"{_HALF} = {n}"), f"{landing.source}/{day}")
        run_bronze(spark, EVENT_PLAYS, landing.source, day, landing.bronze)

    def load(day: str) -> None:
        run_silver(spark, EVENT_PLAYS, f"{landing.bronze}/plays", day, landing.silver)

    with ThreadPoolExecutor(2) as side:
        list(side.map(load, PLAY_DROPS))
    spans = F.max("play_sk") - F.min("play_sk") + 1
    return (
        landing.table()
        .rollup(DAY)
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("play_sk").alias("n_keys"),
            spans.alias("key_span"),
        )
    )


@_query(
    f"{oracle.LINES} SELECT play_id, TIMESTAMP '2024-02-01 06:30:00' AS ingested_at,"
    f" '{PLAY_DROPS[-1]}' AS drop_folder, 'txt' AS file_suffix, DATE '{PLAY_DROPS[-1]}'"
    " AS snapshot_date FROM play_lines WHERE event_id % 47 <> 0"
)
def q_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival time, and the file each row came from by its folder and kind."""
    landing = Landing(spark, sf_dir)
    _drop(landing.lines, f"{landing.source}/{PLAY_DROPS[-1]}")
    arrived = datetime(2024, 2, 1, 6, 30)
    run_bronze(spark, EVENT_PLAYS, landing.source, PLAY_DROPS[-1], landing.bronze, arrived)
    return read_day(spark, EVENT_PLAYS, f"{landing.bronze}/plays", PLAY_DROPS[-1]).select(
        "play_id",
        "ingested_at",
        F.element_at(F.split("source_file", "/"), -2).alias("drop_folder"),
        F.element_at(F.split("source_file", "[.]"), -1).alias("file_suffix"),
        DAY,
    )


def _landed_users(
    spark: SparkSession, sf_dir: str, from_lines: bool = False, **options
) -> tuple[str, str]:
    """The first and the last snapshot through the jobs; the bronze and the curated folder."""
    staging = Staging(spark)
    source, bronze, silver = (staging.folder() for _ in range(3))
    for day in TWO_DAYS:
        if from_lines:
            _drop(feeds.user_lines(spark, sf_dir, day), f"{source}/{day}")
            run_bronze(spark, CUSTOMER_USERS, source, day, bronze)
        else:
            replace_days(feeds.raw_users(spark, sf_dir, day), f"{bronze}/users", [day])
        run_silver(spark, CUSTOMER_USERS, f"{bronze}/users", day, silver, **options)
    return bronze, silver


def _stored_users(spark: SparkSession, silver: str) -> DataFrame:
    return read_table(spark, f"{silver}/users", CUSTOMER_USERS.table_schema)


@_query(f"{oracle.TWO_DAYS} SELECT * FROM dim")
def q_landed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_users(spark, _landed_users(spark, sf_dir)[1])


@_query(f"{oracle.TWO_DAYS} SELECT * FROM dim")
def q_landed_users_touched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only days with a closed or a new version are written, which is the default."""
    return _stored_users(spark, _landed_users(spark, sf_dir, whole_table=False)[1])


@_query(f"{oracle.TWO_DAYS} SELECT * FROM dim")
def q_landed_users_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_users(spark, _landed_users(spark, sf_dir, whole_table=True)[1])


_USER_LINES = "WITH " + ",".join(
    oracle.raw_users(day, f"raw_users{n}")
    + ","
    + oracle.user_lines(f"raw_users{n}", f"lines{n}")
    for n, day in ((1, TWO_DAYS[0]), (3, TWO_DAYS[1]))
)
_WHOLE_LINES = ",".join(
    # Both copies of a user come from one file, so their other columns decide.
    f"whole{n} AS (SELECT * EXCLUDE (line, cut) REPLACE ('drop' AS source_file)"
    f" FROM lines{n} WHERE NOT cut),"
    + oracle.gated_users(f"whole{n}", f"users{n}")
    for n in (1, 3)
)


@_query(
    f"{_USER_LINES} "
    + " UNION ALL ".join(
        f"SELECT {', '.join(oracle.USER_NAMES)}, CAST(NULL AS VARCHAR) AS error_reason,"
        f" snapshot_date FROM lines{n} WHERE NOT cut UNION ALL SELECT"
        f" {', '.join('NULL' for _ in oracle.USER_NAMES)}, substring(line, 1, length(line) - 5),"
        f" snapshot_date FROM lines{n} WHERE cut"
        for n in (1, 3)
    )
)
def q_bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two user drops landed from JSON, and the lines that do not read."""
    bronze, _ = _landed_users(spark, sf_dir, from_lines=True)
    names = [*oracle.USER_NAMES, REASON, DAY]
    good = spark.read.schema(CUSTOMER_USERS.bronze_schema).parquet(f"{bronze}/users")
    broken = spark.read.parquet(f"{bronze}/users_errors")
    nothing = [F.lit(None).cast("string").alias(n) for n in oracle.USER_NAMES]
    return good.withColumn(REASON, F.lit(None).cast("string")).select(*names).union(
        broken.select(*nothing, REASON, DAY)
    )


@_query(
    f"{_USER_LINES},{_WHOLE_LINES},{oracle.NO_USERS},"
    f"{oracle.merged('no_users', 'users1', 'dim1')},{oracle.merged('dim1', 'users3', 'dim')}"
    f" SELECT * {_NO_PROVENANCE} FROM dim"
)
def q_landed_users_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines through bronze into the dimension."""
    _, silver = _landed_users(spark, sf_dir, from_lines=True)
    return _stored_users(spark, silver).drop(*_PROVENANCE)
