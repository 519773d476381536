"""Quality gate: safe casts, declared rules, de-duplication, and a quarantine for each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from sluicework.contracts import DAY, REASON, STAGE, TableContract
from sluicework.functions.columns import (
    breaks_a_rule,
    cast_reasons,
    casts,
    literal,
    quoted,
    rule_reasons,
    unreadable,
)
from sluicework.sources.storage import Staging

RAW_RECORD = "raw_record"
COPIES = "_copies"
_ROW = "_row"

# Defaults of ``deduplicate``.  Key sets up to this many bytes are broadcast; the size is measured
# first.
BROADCAST_BYTES = 64 << 20
# Memory a broadcast entry takes besides the key itself.
_ENTRY_BYTES = 48
# Above this many rows a key is split off before a shuffle by key.
HEAVY_ROWS = 1_000_000


@dataclass(frozen=True)
class Deduplicated:
    """``keys`` holds one row per kept row: the key and the carried columns, nothing else.
    ``key_range`` are the smallest and largest of them."""

    kept: DataFrame
    duplicates: DataFrame
    keys: DataFrame
    key_range: tuple[Any, Any]
    duplicate_count: int


@dataclass(frozen=True)
class Gated:
    """``row_bytes`` is about what all classified rows take in memory."""

    accepted: DataFrame
    rejected: DataFrame
    keys: DataFrame
    key_range: tuple[Any, Any]
    rejected_count: int
    row_bytes: int


def _typed(contract: TableContract, bronze: DataFrame, *extra: str) -> DataFrame:
    """Typed columns, and the cast reasons of a row that does not read (null for one that does)."""
    columns = casts(contract)
    return bronze.selectExpr(
        *[f"{c.typed} AS {quoted(c.name)}" for c in columns],
        # Behind the test, so the text is only put together for the rows that need it.
        f"CASE WHEN {unreadable(columns)} THEN {cast_reasons(columns)} END AS {REASON}",
        *extra,
    )


def classify(contract: TableContract, bronze: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Type every column and tag each row with reason and stage (null for a clean row).

    One narrow pass.  Casts come first: a row that does not read is not judged by the rules.
    With ``keep_raw`` the row's own text stays with it as JSON.
    """
    raw = [RAW_RECORD] if keep_raw else []
    text = f"to_json(struct({', '.join(map(quoted, contract.raw_names))})) AS {RAW_RECORD}"
    broken = breaks_a_rule(contract.rules)
    return _typed(contract, bronze, *([text] if keep_raw else [])).selectExpr(
        *map(quoted, contract.silver_schema.names),
        *raw,
        f"CASE WHEN {REASON} IS NOT NULL THEN {REASON}"
        f" WHEN {broken} THEN {rule_reasons(contract.rules)} END AS {REASON}",
        f"CASE WHEN {REASON} IS NOT NULL THEN 'cast' WHEN {broken} THEN 'validation' END"
        f" AS {STAGE}",
    )


def cast_typed(contract: TableContract, bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose every value reads, the others with their reasons)."""
    typed = _typed(contract, bronze)
    return typed.where(f"{REASON} IS NULL").drop(REASON), typed.where(f"{REASON} IS NOT NULL")


def validate(contract: TableContract, typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that obey every rule, the others with all their reasons)."""
    broken = breaks_a_rule(contract.rules)
    invalid = typed.where(broken).selectExpr("*", f"{rule_reasons(contract.rules)} AS {REASON}")
    return typed.where(f"NOT ({broken})"), invalid


def _ranked(frame: DataFrame, key: str, newest_first: Sequence[str], *more: str) -> Column:
    """The struct that is largest for the newest row: the order, then all remaining columns."""
    rank = [
        F.expr(e if e not in frame.columns else quoted(e)).alias(f"_o{i}")
        for i, e in enumerate(newest_first)
    ]
    rest = [F.col(quoted(c)) for c in [*frame.columns, *more] if c != key]
    return F.struct(*rank, *rest)


def _unpacked(winners: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    return winners.select(
        F.col(quoted(key)), *[F.col(f"best.{quoted(c)}").alias(c) for c in names if c != key]
    )


def newest(frame: DataFrame, key: str, newest_first: Sequence[str]) -> DataFrame:
    """The row ``deduplicate`` would keep of each key, and no account of the others.

    One combinable maximum per key: a key's rows meet as one row per task.
    """
    best = frame.groupBy(F.col(quoted(key))).agg(
        F.max(_ranked(frame, key, newest_first)).alias("best")
    )
    return _unpacked(best, key, frame.columns).select(*map(quoted, frame.columns))


def deduplicate(
    frame: DataFrame,
    key: str,
    newest_first: Sequence[str],
    staging: Staging,
    carry: tuple[str, ...] = (),
    *,
    broadcast_bytes: int | None = None,
    heavy_rows: int | None = None,
) -> Deduplicated:
    """Keep one row per key, the largest by ``newest_first``; all others are duplicates.

    Ties are settled by the remaining columns, so the outcome does not depend on partitioning.
    Rows without a key are to be rejected before.  The frame is read several times, so it must
    give the same rows each time: stage one that may not.

    Built so that no task sees all rows of a key: keys are counted with map-side combine, only
    rows whose key repeats are looked at again, and their winners are a combinable maximum.
    Rows with a unique key are not shuffled by this operator unless the set of repeated keys
    takes more than ``broadcast_bytes``; then keys of over ``heavy_rows`` rows are split off.
    Both decide the plan only.
    """
    broadcast_bytes = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    heavy_rows = HEAVY_ROWS if heavy_rows is None else heavy_rows
    name = quoted(key)
    tally, size = staging.measured_table(
        frame.groupBy(F.col(name)).agg(
            F.count(F.lit(1)).alias(COPIES), *[F.min(quoted(c)).alias(c) for c in carry]
        ),
        keys=f"count_if({COPIES} > 1)",
        rows=f"sum(IF({COPIES} > 1, {COPIES}, 0))",
        bytes=f"sum(IF({COPIES} > 1, octet_length(CAST({name} AS string)), 0))",
        low=f"min({name})",
        high=f"max({name})",
    )
    key_range = (size["low"], size["high"])
    repeated = tally.where(f"{COPIES} > 1")
    listed = [name, *map(quoted, carry)]
    if not size["keys"]:
        return Deduplicated(frame, frame.limit(0), tally.select(*listed), key_range, 0)

    once, again = _split_by_key(frame, repeated, key, size, broadcast_bytes, heavy_rows)
    candidates = staging.table(again.withColumn(_ROW, F.monotonically_increasing_id()))
    best = candidates.groupBy(F.col(name)).agg(
        F.max(_ranked(frame, key, newest_first, _ROW)).alias("best")
    )
    winners = _unpacked(best, key, [*frame.columns, _ROW])
    if size["rows"] > heavy_rows:
        winners = staging.table(winners)
    columns = list(map(quoted, frame.columns))
    return Deduplicated(
        kept=once.select(*columns).union(winners.select(*columns)),
        # By the unique row number: no key can crowd this join.
        duplicates=candidates.join(winners.select(_ROW), _ROW, "left_anti").select(*columns),
        keys=tally.where(f"{COPIES} = 1").select(*listed).union(winners.select(*listed)),
        key_range=key_range,
        duplicate_count=size["rows"] - size["keys"],
    )


def _split_by_key(
    frame: DataFrame,
    repeated: DataFrame,
    key: str,
    size: dict[str, Any],
    broadcast_bytes: int,
    heavy_rows: int,
) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is unique, rows whose key repeats)."""
    if size["keys"] * _ENTRY_BYTES + size["bytes"] <= broadcast_bytes:
        listed = F.broadcast(repeated.select(quoted(key)))
        return frame.join(listed, key, "left_anti"), frame.join(listed, key, "left_semi")

    # Too many to broadcast: shuffle by key, but first take out the keys that would crowd one
    # task.  At most rows / threshold keys can be that heavy, which bounds the broadcast.
    mean_bytes = _ENTRY_BYTES + size["bytes"] / size["keys"]
    threshold = max(heavy_rows, int(size["rows"] * mean_bytes / broadcast_bytes) + 1)
    heavy = F.broadcast(repeated.where(f"{COPIES} > {threshold}").select(quoted(key)))
    light = repeated.where(f"{COPIES} <= {threshold}").select(quoted(key))
    spread = frame.join(heavy, key, "left_anti")
    again = frame.join(heavy, key, "left_semi").unionByName(spread.join(light, key, "left_semi"))
    return spread.join(light, key, "left_anti"), again


def row_bytes(schema: StructType) -> str:
    """SQL for about what a row takes in a task's memory: its fixed part and its texts."""
    texts = [f for f in schema if isinstance(f.dataType, StringType | BinaryType)]
    held = [f"coalesce(octet_length({quoted(f.name)}), 0)" for f in texts]
    return " + ".join([f"{16 * len(schema) + _ENTRY_BYTES}L", *held])


def quality_gate(contract: TableContract, classified: DataFrame, staging: Staging) -> Gated:
    """Split classified rows into one accepted row per key and everything else, with its reason.

    The rows are classified once and written typed, since they are read several times: for their
    keys, for the repeated ones, for either output.  Rejected rows never reach the
    de-duplication, so a bad row cannot displace a good one and null keys do not pile up.
    """
    rows, found = staging.measured_table(
        classified, rejected=f"count({STAGE})", bytes=f"sum({row_bytes(classified.schema)})"
    )
    clean = rows.where(f"{STAGE} IS NULL").drop(REASON, STAGE)
    unique = deduplicate(clean, contract.key, contract.newest_first, staging, carry=(DAY,))
    duplicates = unique.duplicates.selectExpr(
        "*",
        f"{literal(f'duplicate_{contract.key}')} AS {REASON}",
        f"'deduplication' AS {STAGE}",
    )
    return Gated(
        accepted=unique.kept.select(*map(quoted, contract.silver_schema.names)),
        rejected=rows.where(f"{STAGE} IS NOT NULL").unionByName(duplicates),
        keys=unique.keys,
        key_range=unique.key_range,
        rejected_count=(found["rejected"] or 0) + unique.duplicate_count,
        row_bytes=found["bytes"] or 0,
    )
