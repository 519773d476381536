"""Batch jobs: one drop of one table into bronze, one bronze day into the curated table."""

from __future__ import annotations

import argparse
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluicework.contracts import DAY, TABLES, TableContract
from sluicework.functions.columns import quoted
from sluicework.functions.metrics import observed
from sluicework.operators.dimension import STORED_DAY, History, merge_history
from sluicework.operators.facts import upsert_facts
from sluicework.operators.keys import highest_stored_key, range_clustered
from sluicework.operators.quality import classify, quality_gate, row_bytes
from sluicework.sources import storage
from sluicework.sources.buckets import KeyedCopy
from sluicework.sources.catalog_tables import publish_days
from sluicework.sources.readers import (
    BROKEN,
    KIND,
    ROWS,
    broken_lines,
    kept_apart,
    mark_day,
    read_day,
    read_table,
    scan_drop,
)
from sluicework.sources.reservations import KeyReservation
from sluicework.sources.settings import setting
from sluicework.sources.storage import Staging
from sluicework.sources.writers import (
    DaySwap,
    Landing,
    clear_table_day,
    remove_leftovers,
    replace_days,
    replace_table,
    stored_path,
    table_version,
)

# A stored byte takes about this many in a shuffle, which does well with partitions of this size.
_EXPANSION = 4
_PARTITION_BYTES = 128 << 20
# Rows of a file of a fact day are sorted in one task and take so much memory there, or about twice
# as much with the sort.  Stored bytes tell little of that.
_FILE_BYTES = 256 << 20
_PARTITIONS = "spark.sql.shuffle.partitions"


def run_bronze(
    spark: SparkSession,
    contract: TableContract,
    source_path: str,
    snapshot_date: str,
    bronze_path: str,
    ingested_at: datetime | None = None,
) -> dict[str, int]:
    """Land one drop: the day of the bronze table and of its quarantine become this drop.

    The drop is scanned once: whole and broken lines are written side by side, a folder each, and
    counted by that write; the folders are then moved into the table and, as its own rows, into the
    quarantine (``Landing``).  A drop without a readable row leaves a mark, so that the next layer
    can tell it from a day that was never landed.
    """
    table, errors = f"{bronze_path}/{contract.name}", f"{bronze_path}/{contract.name}_errors"
    landing = Landing(spark, {"rows": table, "errors": errors}, snapshot_date)
    landing.finish_earlier()
    lines = scan_drop(spark, contract, source_path, snapshot_date, ingested_at)
    rows, broken = _land(kept_apart(contract, lines), landing.folder)
    filled = {"rows"} if rows else set()
    if broken:
        read = spark.read.schema(contract.bronze_schema).parquet(f"{landing.folder}/{BROKEN}")
        broken_lines(contract, read).write.parquet(f"{landing.folder}/errors")
        filled.add("errors")
    landing.commit(filled)
    mark_day(spark, table, snapshot_date, rows)
    return {"rows": rows, "corrupt": broken}


def _land(lines: DataFrame, folder: str) -> tuple[int, int]:
    """Write both kinds of lines below ``folder``; how many there are of each."""
    spark = lines.sparkSession
    seen = Observation()
    counts = [F.count(F.when(F.col(KIND) == k, True)).alias(k) for k in (ROWS, BROKEN)]
    # A task keeps a file open per kind, instead of sorting its lines by kind.
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        lines.observe(seen, *counts).write.partitionBy(KIND).parquet(f"{folder}/all")
    found = observed(seen)
    for kind in (ROWS, BROKEN):
        written = f"{folder}/all/{KIND}={kind}"
        if storage.exists(spark, written):
            storage.rename(spark, written, f"{folder}/{kind}")
            if found is None:
                found = {}
            if kind not in found:
                found[kind] = spark.read.parquet(f"{folder}/{kind}").count()
    return tuple((found or {}).get(kind, 0) for kind in (ROWS, BROKEN))


def stored_keys(spark: SparkSession, contract: TableContract, silver_path: str) -> KeyedCopy:
    """What a load compares with, beside the table in buckets of its key: of facts every key with
    its surrogate, of a dimension the active rows' tracked columns and their start."""
    if contract.is_dimension:
        columns, where = [*contract.tracked, "valid_from"], "is_current"
    else:
        columns, where = [contract.surrogate], None
    path = f"{silver_path}/{contract.name}"
    return KeyedCopy(spark, path, contract.table_schema, contract.key, columns, where)


@contextmanager
def sized_shuffles(spark: SparkSession, moved_bytes: int) -> Iterator[None]:
    """More shuffle partitions for a load of this size, as long as the block runs.

    Never fewer than the session has; adaptive execution merges those that turn out small.
    """
    before = spark.conf.get(_PARTITIONS)
    wanted = moved_bytes * _EXPANSION // _PARTITION_BYTES
    if wanted > int(before):
        spark.conf.set(_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def run_silver(
    spark: SparkSession,
    contract: TableContract,
    source_path: str,
    snapshot_date: str,
    silver_path: str,
    *,
    retain_missing: bool = False,
    order_guard: bool = False,
    whole_table: bool = False,
    keep_raw: bool = False,
    publish: str | None = None,
) -> dict[str, int]:
    """Take one bronze day through the quality gate into the curated table and its quarantine.

    Facts replace their day; a key that another day holds goes to the quarantine.  A dimension
    is replaced in the days that hold a closed or a new version, or with ``whole_table`` as a
    whole, in one step.  A day that bronze was never given raises, and changes nothing.  The
    days that were replaced are then carried to the catalog table ``publish``, when one is named.

    Loads of different days of one fact table may run side by side: each reserves its surrogates.
    They do not see each other's keys, so drops that have a key in common go one after the other, as
    do all loads of one dimension.
    """
    path = f"{silver_path}/{contract.name}"
    errors = f"{path}_errors"
    bronze = read_day(spark, contract, source_path, snapshot_date)
    # What moves are the rows of the day and the columns of the table that are compared with them.
    moved = storage.size(spark, f"{source_path}/{DAY}={snapshot_date}")
    # Steps that do not need each other run side by side.
    with (
        sized_shuffles(spark, moved),
        Staging(spark) as staging,
        stored_keys(spark, contract, silver_path) as copy,
        _reservation(spark, contract, path) as fresh_keys,
        ThreadPoolExecutor(2) as side,
    ):
        if contract.is_dimension:
            remove_leftovers(spark, path)
            DaySwap(spark, stored_path(spark, path)).finish_earlier()
        base = table_version(spark, path)
        current = read_table(spark, path, contract.table_schema)
        synced = side.submit(copy.sync)
        looked = side.submit(fresh_keys.look)
        gated = quality_gate(contract, classify(contract, bronze, keep_raw), staging)
        rejects, count = gated.rejected, gated.rejected_count
        synced.result()
        looked.result()
        if not contract.is_dimension:
            load = upsert_facts(
                contract,
                current,
                gated.accepted,
                staging,
                loaded_keys=gated.keys,
                key_range=gated.key_range,
                highest=fresh_keys,
                retain_missing=retain_missing,
                days=[snapshot_date],
                stored_keys=copy.frame(),
            )
            if load.elsewhere_count:
                rejects = rejects.unionByName(load.left_out, allowMissingColumns=True)
            refused = count + load.elsewhere_count
            written = side.submit(_write_rejected, rejects, refused, errors, snapshot_date)
            # Files of one key range each, so that a read for some keys leaves the others out.
            keys, held = gated.keys.select(quoted(contract.key)), gated.row_bytes
            if retain_missing:
                stored = current.where(F.col(DAY) == F.lit(snapshot_date).cast("date"))
                keys = keys.union(stored.select(quoted(contract.key)))
                total = F.expr(f"sum({row_bytes(stored.schema)})").alias("bytes")
                held += stored.agg(total).first()["bytes"] or 0
            placed = range_clustered(load.rows, keys, contract.key, held // _FILE_BYTES + 1)
            rows = _replace_day(placed, path, snapshot_date)
            copy.sync()
            written.result()
            if publish:
                publish_days(spark, contract, path, publish, [snapshot_date])
            return {"rows": rows, "rejected": count, "elsewhere": load.elsewhere_count}

        merged = merge_history(
            contract,
            current,
            gated.accepted,
            staging,
            highest=fresh_keys,
            order_guard=order_guard,
            stored_active=copy.frame(),
        )
        if merged.rejected_count:
            rejects = rejects.unionByName(merged.rejected, allowMissingColumns=True)
            count += merged.rejected_count
        _write_rejected(rejects, count, errors, snapshot_date)
        if whole_table:
            replace_table(merged.arranged(), path, base)
            touched = None
        else:
            touched = _replace_touched(merged, stored_path(spark, path), snapshot_date)
        copy.sync()
        if publish:
            publish_days(spark, contract, path, publish, touched)
        return {
            "versions": merged.opened_count,
            "closed": merged.closed_count,
            "rejected": count,
        }


def _replace_day(rows: DataFrame, path: str, day: str, keep_empty_table: bool = True) -> int:
    # All rows are of this day; saying so as a constant spares the write a sort by day.
    same_day = rows.withColumn(DAY, F.lit(day).cast("date"))
    return replace_days(same_day, path, [day], keep_empty_table)[day]


def _write_rejected(rejected: DataFrame, count: int, path: str, day: str) -> None:
    if count:
        _replace_day(rejected, path, day, keep_empty_table=False)
    else:
        clear_table_day(rejected.sparkSession, path, day)


def _replace_touched(merged: History, path: str, snapshot_date: str) -> list[str]:
    # One row per day of the table at most.
    stored = merged.closings.select(STORED_DAY).distinct().collect()
    days = sorted({str(row[STORED_DAY]) for row in stored} | {snapshot_date})
    touched = F.col(DAY).isin([date.fromisoformat(d) for d in days])
    DaySwap(merged.closings.sparkSession, path).replace(merged.arranged(touched), days)
    return days


def _reservation(spark: SparkSession, contract: TableContract, path: str) -> KeyReservation:
    def highest() -> int:
        return highest_stored_key(spark, path, contract.table_schema, contract.surrogate)

    return KeyReservation(spark, path, highest)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load one snapshot day of one table.")
    parser.add_argument("--layer", required=True, choices=["bronze", "silver"])
    parser.add_argument("--table", required=True, choices=sorted(TABLES))
    parser.add_argument(
        "--source", required=True, help="drop folder (bronze) or bronze table (silver)"
    )
    parser.add_argument("--snapshot-date", required=True, type=date.fromisoformat)
    parser.add_argument("--target", help="base folder of the layer, ./data/<layer> by default")
    parser.add_argument("--retain-missing", action="store_true")
    parser.add_argument("--order-guard", action="store_true")
    parser.add_argument("--whole-table", action="store_true")
    parser.add_argument("--keep-raw", action="store_true")
    parser.add_argument("--publish", help="catalog table that gets the replaced days too")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    """``spark-submit`` entry point."""
    given = _arguments(argv)
    contract, day = TABLES[given.table], given.snapshot_date.isoformat()
    target = given.target or f"./data/{given.layer}"
    spark = (
        SparkSession.builder.appName(f"{given.layer}-{given.table}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    try:
        if given.layer == "bronze":
            report = run_bronze(spark, contract, given.source, day, target)
        else:
            report = run_silver(
                spark,
                contract,
                given.source,
                day,
                target,
                retain_missing=given.retain_missing,
                order_guard=given.order_guard,
                whole_table=given.whole_table,
                keep_raw=given.keep_raw,
                publish=given.publish,
            )
        print(report)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
