"""Facts: stable dense keys across loads and re-drops."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from itertools import pairwise
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sluicework.contracts import DAY, REASON, STAGE, TableContract
from sluicework.functions.columns import quoted
from sluicework.operators.keys import dense_key, highest_key
from sluicework.sources.storage import Staging

HELD_ELSEWHERE = "held_elsewhere"

# The loaded keys are summed up in so many blocks, and those in so many ranges for the scan.
KEY_BLOCKS = 1024
KEY_RANGES = 32


@dataclass(frozen=True)
class FactLoad:
    """``rows`` are the complete loaded days; ``elsewhere`` are the keys left out of them, with
    the day that already holds them; ``elsewhere_count`` is their number; ``left_out`` are their
    loaded rows as quarantine rows."""

    rows: DataFrame
    elsewhere: DataFrame
    elsewhere_count: int
    left_out: DataFrame


def upsert_facts(
    contract: TableContract,
    current: DataFrame,
    loaded: DataFrame,
    staging: Staging,
    *,
    loaded_keys: DataFrame | None = None,
    key_range: tuple[Any, Any] | None = None,
    highest: int | Callable[[int], int] | None = None,
    retain_missing: bool = False,
    days: Sequence[str | date] | None = None,
    stored_keys: DataFrame | None = None,
) -> FactLoad:
    """Key the loaded rows against the current table and return the loaded days in full.

    A key already on the same day keeps its surrogate and takes the loaded values; a key on
    another day is left out; a new key gets the next surrogate, in key order.  A key of the
    processed days that the load no longer has is dropped, or kept with ``retain_missing``.
    ``days`` are the processed days, which may have no loaded row at all; without them they are
    the days of the loaded keys.

    ``stored_keys`` has the key, day and surrogate of every stored row; one that is kept in buckets
    of the key (``KeyedCopy``) meets the loaded keys without being shuffled.  Without it they are
    read from ``current``.

    Everything up to the last join moves keys only.  ``loaded`` must have one row per key.  What
    the caller knows already (the loaded keys with their days, their range, the highest
    surrogate) is not computed again.  ``highest`` may be a reservation that gives it for a number
    of new keys (``KeyReservation``).
    """
    key, surrogate = contract.key, contract.surrogate
    keys = loaded_keys
    if keys is None:
        keys = staging.table(loaded.select(F.col(quoted(key)), DAY))
    columns = [F.col(quoted(c)) for c in loaded.columns]
    if current.isEmpty():
        start = highest if callable(highest) else 0
        fresh = dense_key(keys.select(F.col(quoted(key))), [key], surrogate, staging, start)
        rows = loaded.join(fresh, key).select(*columns, F.col(quoted(surrogate)))
        nothing = keys.select(F.col(quoted(key)), DAY, F.col(DAY).alias("held_by")).limit(0)
        return FactLoad(rows, nothing, 0, _left_out(key, loaded.limit(0), nothing))

    if highest is None:
        highest = highest_key(current, surrogate)
    stored = current if stored_keys is None else stored_keys
    held, elsewhere_count = _held_keys(contract, stored, keys, key_range, staging)
    new = keys.join(held, key, "left_anti").select(F.col(quoted(key)))
    fresh = dense_key(new, [key], surrogate, staging, highest)
    known = held.where(F.col("held_by") == F.col(DAY)).select(
        F.col(quoted(key)), F.col(quoted(surrogate))
    )
    rows = loaded.join(known.union(fresh), key).select(*columns, F.col(quoted(surrogate)))
    if retain_missing:
        if days is None:  # a row per day of the calendar at most
            days = [row[DAY] for row in keys.select(DAY).distinct().collect()]
        stored = current.where(F.col(DAY).isin([F.lit(str(d)).cast("date") for d in days]))
        rows = rows.unionByName(stored.join(keys, key, "left_anti"))
    other_day = held.where(F.col("held_by") != F.col(DAY))
    elsewhere = other_day.select(F.col(quoted(key)), DAY, "held_by")
    return FactLoad(rows, elsewhere, elsewhere_count, _left_out(key, loaded, elsewhere))


def _left_out(key: str, loaded: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """The loaded rows of keys that another day holds, as quarantine rows."""
    held = elsewhere.select(F.col(quoted(key)), "held_by")
    return loaded.join(held, key).select(
        *[F.col(quoted(c)) for c in loaded.columns],
        F.concat(F.lit(f"{key}_held_by_"), F.col("held_by").cast("string")).alias(REASON),
        F.lit(HELD_ELSEWHERE).alias(STAGE),
    )


def key_ranges(
    keys: DataFrame, key: str, known: tuple[Any, Any] | None = None
) -> list[tuple[Any, Any]]:
    """At most ``KEY_RANGES`` ranges that hold all keys and leave out the widest gaps.

    The keys are summed up per block of their whole range, so one outlying key makes a range of
    its own instead of widening the others.  Keys that are no whole numbers make one range.
    """
    name = F.col(quoted(key))
    ends = [F.min(name).alias("low"), F.max(name).alias("high")]
    low, high = known or keys.agg(*ends).first()
    if low is None:
        return []
    if not isinstance(keys.schema[key].dataType, IntegralType):
        return [(low, high)]
    width = (high - low) // KEY_BLOCKS + 1
    block = F.floor((name.cast("decimal(38,0)") - F.lit(low)) / F.lit(width)).alias("block")
    blocks = sorted(tuple(r) for r in keys.groupBy(block).agg(*ends).drop("block").collect())
    gaps = [i for i in range(1, len(blocks)) if blocks[i][0] - blocks[i - 1][1] > 1]
    widest = sorted(gaps, key=lambda i: blocks[i - 1][1] - blocks[i][0])[: KEY_RANGES - 1]
    cuts = [0, *sorted(widest), len(blocks)]
    return [
        (blocks[first][0], blocks[after - 1][1]) for first, after in pairwise(cuts)
    ]


def _within(name: Column, ranges: list[tuple[Any, Any]]) -> Column:
    tests = [name.between(F.lit(low), F.lit(high)) for low, high in ranges]
    return reduce(or_, tests, F.lit(False)) if tests else F.lit(False)


def _held_keys(
    contract: TableContract,
    stored: DataFrame,
    keys: DataFrame,
    known: tuple[Any, Any] | None,
    staging: Staging,
) -> tuple[DataFrame, int]:
    """The loaded keys the table already has (key, loaded day, the day that holds it, surrogate),
    and how many of them are held by another day.

    The ranges let the scan skip files and row groups, also when a late or outlying key is among
    the loaded ones; the inner join lets Spark broadcast the loaded keys when they are few.
    """
    held = held_rows(contract, stored, keys, key_ranges(keys, contract.key, known))
    written, found = staging.measured_table(held, elsewhere=f"count_if(held_by <> {DAY})")
    return written, found["elsewhere"] or 0


def held_rows(
    contract: TableContract, stored: DataFrame, keys: DataFrame, ranges: list[tuple[Any, Any]]
) -> DataFrame:
    """The stored keys within the ranges that are among the loaded ones."""
    name = F.col(quoted(contract.key))
    return (
        stored.where(_within(name, ranges))
        .select(name, F.col(DAY).alias("held_by"), F.col(quoted(contract.surrogate)))
        .join(keys.select(name, DAY), contract.key)
    )
