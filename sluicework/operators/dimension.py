"""Dimensions: type-2 history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.contracts import DAY, REASON, STAGE, TableContract
from sluicework.functions.columns import differs, quoted
from sluicework.operators.keys import dense_key, highest_key
from sluicework.sources.storage import Staging, empty

OUT_OF_ORDER = "out_of_order"
STORED_DAY = "_stored_day"
_CLOSES = "_closes"
_BACKWARDS = "_backwards"


@dataclass(frozen=True)
class History:
    """The merge result in parts.

    ``versions``, ``closings`` and ``rejected`` read written tables, whose rows were counted by the
    write; a closing is the key, the time the active version ends, and the day that version is
    stored under.
    """

    unchanged_history: DataFrame
    active: DataFrame
    versions: DataFrame
    closings: DataFrame
    rejected: DataFrame
    opened_count: int
    closed_count: int
    rejected_count: int

    @property
    def rows(self) -> DataFrame:
        return self.unchanged_history.union(self.active).union(self.versions)

    def arranged(self, condition: Column | None = None) -> DataFrame:
        """The rows, or some of them, as a write by day wants them.

        Only active rows may have been shuffled away from their day; rebalancing brings a day
        together again and, unlike hash partitioning, splits a big one.  History comes straight
        from files of few days each and is not shuffled at all.
        """
        parts = [self.unchanged_history, self.active, self.versions]
        if condition is not None:
            parts = [part.where(condition) for part in parts]
        history, active, versions = parts
        return history.union(active.hint("rebalance", DAY)).union(versions)


def compared_rows(contract: TableContract, active: DataFrame, loaded: DataFrame) -> DataFrame:
    """The loaded rows beside their key's active version, where there is one."""
    before = active.selectExpr(
        f"{quoted(contract.key)} AS _key",
        f"{DAY} AS {STORED_DAY}",
        "valid_from AS _since",
        *[f"{quoted(c)} AS {quoted(f'_old_{c}')}" for c in contract.tracked],
    )
    return loaded.join(before, F.expr(f"{quoted(contract.key)} = _key"), "left")


def merge_history(
    contract: TableContract,
    current: DataFrame,
    loaded: DataFrame,
    staging: Staging,
    *,
    highest: int | Callable[[int], int] | None = None,
    order_guard: bool = False,
    stored_active: DataFrame | None = None,
) -> History:
    """Merge a full snapshot into a type-2 dimension.

    A key without an active row starts a version; a key whose tracked columns changed closes
    its active row at the new version's start; all other rows stay as they are, also those of
    keys the snapshot does not have.  With ``order_guard`` a changed row that is not newer than
    the active version is rejected instead of closing it backwards.

    History rows are passed through without a shuffle.  The active rows meet the loaded rows
    once, on key and tracked columns only, and then the (usually few) closings.  ``stored_active``
    has the key, tracked columns, ``valid_from`` and day of the active rows; one that is kept in
    buckets of the key (``KeyedCopy``) meets the loaded rows without being shuffled.
    """
    key, surrogate = quoted(contract.key), contract.surrogate
    columns = list(map(quoted, contract.table_schema.names))
    loaded_columns = list(map(quoted, loaded.columns))
    active = current.where("is_current")
    joined = compared_rows(contract, active if stored_active is None else stored_active, loaded)
    changed = f"_key IS NOT NULL AND ({differs((c, f'_old_{c}') for c in contract.tracked)})"
    backwards = f"{_CLOSES} AND coalesce(valid_from <= _since, false)" if order_guard else "false"
    joined = (
        joined.selectExpr(
            *loaded_columns,
            f"{contract.effective_from} AS valid_from",
            STORED_DAY,
            "_since",
            "_key IS NULL AS _opens",
            f"{changed} AS {_CLOSES}",
        )
        .where(f"_opens OR {_CLOSES}")
        .withColumn(_BACKWARDS, F.expr(backwards))
    )
    # Written once: the join is read for the quarantine, for the keys and for the closings.
    compared, found = staging.measured_table(
        joined,
        rejected=f"count_if({_BACKWARDS})",
        opened=f"count_if(NOT {_BACKWARDS})",
        closed=f"count_if({_CLOSES} AND NOT {_BACKWARDS})",
    )
    rejected = empty(loaded.sparkSession, contract.error_schema)
    if found["rejected"]:
        rejected = compared.where(_BACKWARDS).selectExpr(
            *loaded_columns, f"'{OUT_OF_ORDER}' AS {REASON}", f"'{OUT_OF_ORDER}' AS {STAGE}"
        )

    if highest is None:
        highest = highest_key(current, surrogate)
    fresh = compared.where(f"NOT {_BACKWARDS}").select(
        *loaded_columns, "valid_from", STORED_DAY, _CLOSES
    )
    numbered = dense_key(fresh, [contract.key], surrogate, staging, highest)
    versions = numbered.selectExpr(
        "*", f"CAST(NULL AS {contract.timestamp}) AS valid_to", "true AS is_current"
    )
    closings = numbered.where(_CLOSES).selectExpr(
        f"{key} AS _key", "valid_from AS _until", STORED_DAY
    )
    followed = (
        active.drop("valid_to", "is_current")
        .join(closings, F.expr(f"{key} = _key"), "left")
        .selectExpr("*", "_until AS valid_to", "_key IS NULL AS is_current")
    )
    return History(
        unchanged_history=current.where("NOT is_current").select(*columns),
        active=followed.select(*columns),
        versions=versions.select(*columns),
        closings=closings,
        rejected=rejected,
        opened_count=found["opened"] or 0,
        closed_count=found["closed"] or 0,
        rejected_count=found["rejected"] or 0,
    )
