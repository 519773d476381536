"""Snapshot ingestion and data quality as Spark jobs.

Daily JSON drops become raw ("bronze") and curated ("silver") Parquet tables.  One
:class:`~sluicework.contracts.TableContract` describes a table; every operator is a
function from DataFrames to DataFrames that is driven by that contract.
"""

from sluicework.contracts import PLAYS, USERS, Field, Rule, TableContract
from sluicework.operators.dimension import merge_history
from sluicework.operators.facts import upsert_facts
from sluicework.operators.keys import dense_key
from sluicework.operators.quality import (
    cast_typed,
    classify,
    deduplicate,
    newest,
    quality_gate,
    validate,
)
from sluicework.plans.jobs import run_bronze, run_silver
from sluicework.sources.readers import inspect, load_drop, read_day, read_table
from sluicework.sources.buckets import KeyedCopy
from sluicework.sources.catalog_tables import create_day_table, insert_days, publish_days
from sluicework.sources.reservations import KeyReservation
from sluicework.sources.writers import CommitConflict, DaySwap, replace_days, replace_table

__all__ = [
    "CommitConflict",
    "DaySwap",
    "KeyReservation",
    "KeyedCopy",
    "PLAYS",
    "USERS",
    "Field",
    "Rule",
    "TableContract",
    "cast_typed",
    "classify",
    "create_day_table",
    "deduplicate",
    "dense_key",
    "insert_days",
    "inspect",
    "load_drop",
    "merge_history",
    "newest",
    "publish_days",
    "quality_gate",
    "read_day",
    "read_table",
    "replace_days",
    "replace_table",
    "run_bronze",
    "run_silver",
    "upsert_facts",
    "validate",
]
